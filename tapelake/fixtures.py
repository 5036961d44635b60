"""The lake's tables as views over general-purpose Parquet tables.

Those tables hold no market data, so events stand in for trades, line items for level updates and customers for
instruments. Prices go through DECIMAL(18,2): the source columns hold two decimals, and casting a double straight to
DECIMAL(38,18) would keep its binary noise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.operators.catalog import symbol_id
from tapelake.schemas import FEE, IDENTITY, INSTRUMENT, INSTRUMENT_FIELDS, LEVELS, PRICE, TRADES


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").cast(PRICE)


class Fixtures:
    """Views over the tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def instruments(self) -> DataFrame:
        """One instrument per customer, flat."""
        key = F.col("c_custkey")
        rows = self.table("customer").join(
            self.table("nation"), F.col("n_nationkey") == F.col("c_nationkey")
        )
        exchange = (
            F.when(F.col("n_regionkey") == 0, "BinanceSpot")
            .when(F.col("n_regionkey") == 1, "BinanceFutures")
            .when(F.col("n_regionkey") == 2, "OkexFutures")
            .when(F.col("n_regionkey") == 3, "KucoinSpot")
            .otherwise("KucoinFutures")
        )
        kind = F.when(key % 3 == 0, "spot").when(key % 3 == 1, "perpetual").otherwise("future")
        listing = F.when(
            key % 10 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int")).cast("timestamp_ntz")
        )
        expiration = F.when(
            key % 4 == 0, F.date_add(F.lit("2024-01-15").cast("date"), (key % 60).cast("int")).cast("timestamp_ntz")
        )
        return (
            rows.select(
                key.alias("instrument_id"),
                F.concat(F.lit("A"), key.cast("string")).alias("base_asset"),
                F.col("c_mktsegment").alias("quote_asset"),
                exchange.alias("exchange"),
                kind.alias("instrument_type"),
                F.upper(F.concat(F.lit("A"), key.cast("string"), F.col("c_mktsegment"))).alias("dataset"),
                (F.col("c_acctbal") > 0).alias("active"),
                listing.alias("available_since"),
                (key % 5).cast(PRICE).alias("price_increment"),
                (F.col("c_nationkey") % 4).cast(PRICE).alias("amount_increment"),
                F.lit(1).cast(PRICE).alias("min_trade_amount"),
                (F.col("c_nationkey") - 2).cast(FEE).alias("maker_fee"),
                F.col("n_regionkey").cast(FEE).alias("taker_fee"),
                (key % 2 == 0).alias("margin"),
                F.lit(None).cast("boolean").alias("inverse"),
                money("c_acctbal").alias("contract_multiplier"),
                listing.alias("listing"),
                expiration.alias("expiration"),
            )
            .withColumn("symbol_id", symbol_id())
            .select("instrument_id", "symbol_id", *IDENTITY, *INSTRUMENT_FIELDS)
        )

    def trades(self) -> DataFrame:
        event = F.col("event_type")
        return self.table("events").select(
            "ts",
            F.col("user_id").alias("instrument_id"),
            F.when(event == "purchase", 1).when(event == "click", -1).otherwise(0).cast("smallint").alias("side"),
            money("value").alias("price"),
            F.get_json_object("props", "$.k").cast(PRICE).alias("quantity"),
            F.col("event_id").alias("trade_id"),
            F.to_date("ts").alias("trading_day"),
        )

    def levels(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.table("lineitem").select(
            F.col("l_shipdate").alias("ts"),
            F.col("l_suppkey").alias("instrument_id"),
            F.when(flag == "R", 1).when(flag == "A", -1).otherwise(0).cast("smallint").alias("side"),
            money("l_extendedprice").alias("price"),
            money("l_quantity").alias("quantity"),
            (F.col("l_linestatus") == "F").alias("is_snapshot"),
            F.col("l_linenumber").alias("update_seq"),
            F.to_date("l_shipdate").alias("trading_day"),
        )

    def raw_trades(self) -> DataFrame:
        """Trades as a raw file has them, with the instrument they belong to; a quantity of 0 loses its time."""
        event = F.col("event_type")
        amount = F.get_json_object("props", "$.k").cast(PRICE)
        names = self.instruments().select("instrument_id", F.col("exchange").alias("venue"), "dataset")
        return (
            self.table("events")
            .join(names, F.col("user_id") == F.col("instrument_id"))
            .select(
                F.lower("venue").alias("exchange"),
                F.lower("dataset").alias("symbol"),
                F.when(amount != 0, F.unix_micros(F.col("ts").cast("timestamp"))).alias("timestamp"),
                F.unix_micros(F.col("ts").cast("timestamp")).alias("local_timestamp"),
                F.col("event_id").alias("id"),
                F.when(event == "purchase", "buy")
                .when(event == "click", "sell")
                .when(event == "view", "BUY")
                .when(event == "error", "unknown")
                .alias("side"),
                money("value").alias("price"),
                amount.alias("amount"),
                "instrument_id",
                F.to_date("ts").alias("file_day"),
                "dataset",
                "venue",
            )
        )

    def raw_levels(self) -> DataFrame:
        """Level updates as a raw file has them; the order key makes the local time, line by line."""
        micros = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
        flag = F.col("l_returnflag")
        return self.table("lineitem").select(
            F.lit("okex").alias("exchange"),
            F.concat(F.lit("L"), F.col("l_suppkey").cast("string")).alias("symbol"),
            micros.alias("timestamp"),
            (micros + F.col("l_orderkey")).alias("local_timestamp"),
            (F.col("l_linestatus") == "F").alias("is_snapshot"),
            F.when(flag == "R", "bid").when(flag == "A", "ask").otherwise("BID").alias("side"),
            money("l_extendedprice").alias("price"),
            money("l_quantity").alias("amount"),
            F.col("l_suppkey").alias("instrument_id"),
            F.to_date("l_shipdate").alias("file_day"),
        )

    def refresh_rows(self) -> DataFrame:
        """Catalog rows a refresh brings: one per order, so most instruments occur several times, some are new."""
        held = self.instruments().select(
            "instrument_id", "quote_asset", "exchange", "instrument_type", F.col("dataset").alias("held_dataset")
        )
        urgent = F.col("o_orderpriority") == "1-URGENT"
        prefix = F.when(F.col("o_orderstatus") == "P", "N").otherwise("A")
        return (
            self.table("orders")
            .join(held, F.col("o_custkey") == F.col("instrument_id"))
            .select(
                F.concat(prefix, F.col("o_custkey").cast("string")).alias("base_asset"),
                "quote_asset",
                "exchange",
                "instrument_type",
                F.col("held_dataset").alias("dataset"),
                (F.col("o_orderstatus") != "F").alias("active"),
                F.col("o_orderdate").alias("available_since"),
                money("o_totalprice").alias("price_increment"),
                F.lit(1).cast(PRICE).alias("amount_increment"),
                F.lit(2).cast(PRICE).alias("min_trade_amount"),
                F.lit(0).cast(FEE).alias("maker_fee"),
                F.lit(0).cast(FEE).alias("taker_fee"),
                F.when(~urgent, True).alias("margin"),
                F.lit(False).alias("inverse"),
                F.when(~urgent, money("o_totalprice")).alias("contract_multiplier"),
                F.when(~urgent, F.col("o_orderdate")).alias("listing"),
                F.lit(None).cast("timestamp_ntz").alias("expiration"),
                F.col("o_orderkey").alias("ordinal"),
            )
        )

    def instrument_list(self) -> DataFrame:
        """Instrument-list rows as the JSON reply has them, one per customer: odd spellings, gaps and alias columns."""
        key = F.col("c_custkey")
        text = key.cast("string")
        name = F.concat(F.lit("a"), text)
        null = F.lit(None).cast("string")
        since = F.when(
            key % 3 == 0, F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int")), "yyyy-MM-dd"), F.lit("T22:30:00-03:00"))
        ).when(key % 3 == 1, F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int")), "yyyy-MM-dd"), F.lit("T00:00:00.000Z")))
        return self.table("customer").select(
            F.when(key % 4 != 0, F.concat(name, F.lower("c_mktsegment"))).alias("datasetId"),
            F.when(key % 4 == 0, F.lit("")).alias("dataset"),
            null.alias("dataset_id"),
            F.when(key % 7 != 0, F.concat(F.lit(" Sym"), text, F.lit(" "))).alias("symbol"),
            null.alias("symbolId"),
            null.alias("symbol_id"),
            null.alias("id"),
            F.lit("OkexSwap").alias("exchange"),
            F.when(key % 11 != 0, name).alias("baseCurrency"),
            F.lower("c_mktsegment").alias("quoteCurrency"),
            F.when(key % 5 == 0, "swap")
            .when(key % 5 == 1, " Spot ")
            .when(key % 5 == 2, "perp")
            .when(key % 5 == 3, "FUTURE")
            .otherwise("option")
            .alias("type"),
            null.alias("instrumentType"),
            F.when(key % 2 == 0, F.col("c_acctbal") > 0).alias("active"),
            since.alias("availableSince"),
            null.alias("available_from"),
            F.when(key % 6 == 0, "2024-01-25T00:00:00Z").when(key % 6 == 1, "soon").alias("availableTo"),
            null.alias("available_to"),
            F.when(key % 13 != 0, F.lit(1)).cast(PRICE).alias("priceIncrement"),
            F.lit(1).cast(PRICE).alias("amountIncrement"),
            F.lit(1).cast(PRICE).alias("minTradeAmount"),
            F.lit(None).cast(FEE).alias("makerFee"),
            F.lit(None).cast(FEE).alias("takerFee"),
            F.lit(None).cast("boolean").alias("margin"),
            F.lit(True).alias("inverse"),
            F.lit(None).cast(PRICE).alias("contractMultiplier"),
            null.alias("listing"),
            null.alias("expiry"),
            key.alias("ordinal"),
        )

    def level_files(self) -> DataFrame:
        """All line items as level updates of 28 days and five data sets, with the order of their lines."""
        day = F.date_add(F.lit("2024-01-01").cast("date"), (F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date")) % 28).cast("int"))
        micros = F.unix_micros(day.cast("timestamp")) + (F.col("l_orderkey") % 86400) * 1_000_000
        flag = F.col("l_returnflag")
        return self.table("lineitem").select(
            F.lit("binance-futures").alias("exchange"),
            F.concat(F.lit("lvl"), (F.col("l_suppkey") % 5).cast("string")).alias("symbol"),
            micros.alias("timestamp"),
            (micros + F.col("l_linenumber")).alias("local_timestamp"),
            (F.col("l_linestatus") == "F").alias("is_snapshot"),
            F.when(flag == "R", "bid").when(flag == "A", "ask").otherwise("BID").alias("side"),
            money("l_extendedprice").alias("price"),
            money("l_quantity").alias("amount"),
            F.upper(F.concat(F.lit("lvl"), (F.col("l_suppkey") % 5).cast("string"))).alias("dataset"),
            day.alias("day"),
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").alias("line"),
        )

    def month_levels(self) -> DataFrame:
        """The rows of ``level_files`` as facts; the line number of an order stands for the update sequence."""
        side = F.when(F.col("side") == "bid", 1).when(F.col("side") == "ask", -1).otherwise(0)
        return self.level_files().select(
            F.timestamp_micros("timestamp").alias("ts"),
            F.concat(F.lit("i"), F.substring("dataset", 4, 1)).alias("instrument_id"),
            side.cast("smallint").alias("side"),
            "price",
            F.col("amount").alias("quantity"),
            "is_snapshot",
            F.col("line").cast("int").alias("update_seq"),
            F.col("day").alias("trading_day"),
        )

    def level_catalog(self) -> DataFrame:
        """The instruments of ``level_files``, ids as text; LVL4 is listed after the month."""
        number = F.col("id").cast("string")
        later = F.when(F.col("id") == 4, F.lit("2024-02-01").cast("timestamp"))
        known = {
            "instrument_id": F.concat(F.lit("i"), number),
            "symbol_id": number,
            "base_asset": F.concat(F.lit("L"), number),
            "quote_asset": F.lit("USDT"),
            "exchange": F.lit("BinanceFutures"),
            "instrument_type": F.lit("perpetual"),
            "dataset": F.concat(F.lit("LVL"), number),
            "available_since": later,
        }
        return self.spark.range(5).select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in INSTRUMENT])

    def text_levels(self) -> DataFrame:
        """``level_files`` for text: prices and amounts with the two decimals they have; the files of LVL3 on even days are left out."""
        rows = self.level_files().filter("NOT (dataset = 'LVL3' AND dayofmonth(day) % 2 = 0)")
        return rows.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("price", "amount")})

    def deliver_levels(self, root: str) -> None:
        """``level_files`` as delivered files below ``root``, one per data set and day, lines in order; the files of LVL3 on
        even days are left out."""
        text = f"{root}-text"
        rows = self.text_levels()
        (
            rows.repartition("dataset", "day")
            .sortWithinPartitions("dataset", "day", "order_key", "line", "price", "amount", "side", "is_snapshot")
            .drop("order_key", "line")
            .write.partitionBy("dataset", "day")
            .option("header", True)
            .option("compression", "gzip")
            .option("zlib.compress.level", "BEST_SPEED")
            .csv(text)
        )
        to_path = self.spark._jvm.org.apache.hadoop.fs.Path
        file_system = to_path(text).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in file_system.globStatus(to_path(f"{text}/*/*/part-*")):
            file = status.getPath()
            day = file.getParent().getName().removeprefix("day=").replace("-", "/")
            folder = to_path(f"{root}/v1/binance-futures/{LEVELS.segment}/{day}")
            file_system.mkdirs(folder)
            name = file.getParent().getParent().getName().removeprefix("dataset=")
            file_system.rename(file, to_path(f"{folder}/{name.lower()}.csv.gz"))

    def write_list(self, root: str) -> None:
        """``instrument_list`` as JSON arrays, one per file."""
        fields = [c for c in self.instrument_list().columns if c not in ("exchange", "ordinal")]
        rows = self.instrument_list().withColumn("part", F.col("ordinal") % 8)
        arrays = rows.groupBy("part").agg(F.to_json(F.collect_list(F.struct(*fields))).alias("value"))
        arrays.write.partitionBy("part").text(root)

    def write_cache(self, root: str, slug: str, kind: str) -> None:
        """The raw trades as a cache tree with one data set per venue, as many files per venue and day as their size demands."""
        rows = self.raw_trades().select(*TRADES.raw.names, F.col("venue").alias("dataset"), F.col("file_day").alias("day"))
        self._write_cache(rows.hint("rebalance", F.col("dataset"), F.col("day")), TRADES.tag, root, slug, kind)

    def write_level_cache(self, root: str, slug: str, kind: str) -> None:
        """``level_files`` as a cache tree, one file per data set and day; the files of LVL3 on even days are left out."""
        rows = self.text_levels().drop("order_key", "line")
        self._write_cache(rows.repartition("dataset", "day").sortWithinPartitions("dataset", "day"), LEVELS.tag, root, slug, kind)

    def _write_cache(self, rows: DataFrame, tag: str, root: str, slug: str, kind: str) -> None:
        """Spark writes the text files; then each gets the name a cached file has (a list of files, on whatever file system
        ``root`` is on)."""
        text = f"{root}-{tag}-text"
        rows.write.partitionBy("dataset", "day").option("header", True).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").csv(text)
        to_path = self.spark._jvm.org.apache.hadoop.fs.Path
        file_system = to_path(text).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in file_system.globStatus(to_path(f"{text}/*/*/part-*")):
            file = status.getPath()
            part, day, dataset = file.getName(), file.getParent().getName(), file.getParent().getParent().getName()
            folder = f"{root}/{slug}/{kind}/{dataset.removeprefix('dataset=')}"
            file_system.mkdirs(to_path(folder))
            name = f"{part.split('.')[0]}_{day.removeprefix('day=')}_{tag}.csv.gz"
            file_system.rename(file, to_path(f"{folder}/{name}"))
