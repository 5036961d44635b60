"""tapelake: a market-data lake toolkit on PySpark.

Trades and order-book level updates are read from raw files, normalized, validated and loaded idempotently into
day-partitioned Parquet tables; an instrument catalog is kept by upsert; coverage questions (which feed-days exist, how
large they are, which are missing) are answered for all instruments and days in one job.
"""
