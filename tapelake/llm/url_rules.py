"""URL filters: rules for hosts and paths, found by hash prefixes of URL expressions.

A rule names a host and a path that begins and ends with ``/``. It fits the host and its subdomains where the URL's path starts
with the rule's. Each URL is expanded into expressions, one for every host suffix (whole labels) and every path prefix that ends
with ``/``, no deeper than the deepest rule, since longer expressions can't equal one. Expressions and rules are joined on the
first bytes of their SHA-256 digests, whole digests confirm, and the longest rule wins (then the longer host, then block).

Verdicts are found once per distinct host and path, which pre-aggregates hot URLs, and joined back to the rows; adaptive skew
handling splits hot hosts and URLs. The rules may be of any number; Spark broadcasts them only below its size threshold.

Defined results: a null URL or one without ``://`` has an empty host and path; an empty path fits no rule; without a fitting rule
``rule`` is null and the verdict ``allow``; rules with null fields, another verdict, or a path not between ``/`` are refused.
Repeated rows are all returned; only the columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.plans.staging import stage

DEFAULT = "allow"
PREFIX = 8  # hexadecimal digits


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end. Path: then up to ``?``, ``#`` or the end."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def expressions(host: Column, path: Column, labels: int, folders: int) -> Column:
    """All host suffixes of at most ``labels`` labels, each with all path prefixes of at most ``folders`` slashes."""
    parts = F.split(host, r"\.", -1)
    n_labels = F.least(F.size(parts), F.lit(labels))
    suffixes = F.transform(F.sequence(F.lit(1), n_labels), lambda k: F.array_join(F.slice(parts, -k, k), "."))
    steps = F.split(path, "/", -1)
    n_folders = F.least(F.size(steps) - 1, F.lit(folders))
    prefixes = F.when(
        (n_folders > 0) & path.startswith("/"),
        F.transform(F.sequence(F.lit(1), n_folders), lambda k: F.concat(F.array_join(F.slice(steps, F.lit(1), k), "/"), F.lit("/"))),
    ).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def checked(rules: DataFrame) -> DataFrame:
    """rules (host, path, verdict) with ``rule``; raises if one can't be used."""
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").distinct()
    fine = (F.length("host") > 0) & F.col("path").startswith("/") & F.col("path").endswith("/") & F.col("verdict").isin("allow", "block")
    if rules.where(~F.coalesce(fine, F.lit(False))).limit(1).count():
        raise ValueError("a rule needs a host, a path that begins and ends with '/', and the verdict allow or block")
    return rules.withColumn("rule", F.concat("host", "path"))


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """A row per page (page_id, url): page_id, host, path, rule, verdict."""
    rules = stage(checked(rules), "rules")
    depth = rules.agg(F.max(F.size(F.split("host", r"\.", -1))).alias("labels"), F.max(F.size(F.split("path", "/", -1)) - 1).alias("folders")).first()
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    if depth.labels is None:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(DEFAULT)})
    digest = F.sha2(F.col("expression"), 256)
    asked = (
        rows.select("host", "path")
        .distinct()
        .withColumn("expression", F.explode(expressions(F.col("host"), F.col("path"), depth.labels, depth.folders)))
        .withColumn("digest", digest)
        .withColumn("prefix", F.substring("digest", 1, PREFIX))
    )
    listed = rules.select(
        F.sha2(F.col("rule"), 256).alias("rule_digest"),
        F.substring(F.sha2(F.col("rule"), 256), 1, PREFIX).alias("prefix"),
        "rule",
        F.col("verdict").alias("rule_verdict"),
        F.length("rule").alias("long"),
        F.length(F.col("host")).alias("host_long"),
    )
    fits = asked.join(listed, "prefix").where("digest = rule_digest")
    order = F.struct("long", "host_long", (F.col("rule_verdict") == "block").alias("blocks"), "rule", "rule_verdict")
    best = fits.groupBy("host", "path").agg(F.max(order).alias("best")).select("host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict"))
    return rows.join(best, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(DEFAULT)).alias("verdict"))
