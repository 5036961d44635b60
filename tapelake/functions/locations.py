"""Source and cache locations: building and parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapelake.schemas import FEEDS


def feed_segment(feed: Column) -> Column:
    """Feed name or file tag to its location segment; an unknown feed fails the job."""
    choice = None
    for spec in FEEDS.values():
        match = feed.isin(spec.name, spec.tag)
        choice = F.when(match, spec.segment) if choice is None else choice.when(match, spec.segment)
    return choice.otherwise(F.raise_error(F.concat(F.lit("no location for feed: "), F.coalesce(feed, F.lit("null")))))


def feed_tag(feed: Column) -> Column:
    """Feed name to file tag, null for an unknown feed."""
    choice = None
    for spec in FEEDS.values():
        choice = F.when(feed == spec.name, spec.tag) if choice is None else choice.when(feed == spec.name, spec.tag)
    return choice


def source_location(slug: Column, segment: Column, day: Column, dataset: Column) -> Column:
    """``v1/<slug>/<segment>/<yyyy>/<mm>/<dd>/<dataset>.csv.gz``"""
    return F.concat(
        F.concat_ws("/", F.lit("v1"), slug, segment, F.date_format(day, "yyyy/MM/dd"), dataset), F.lit(".csv.gz")
    )


def cache_location(slug: Column, kind: Column, dataset: Column, symbol: Column, day: Column, tag: Column) -> Column:
    """``<slug>/<type>/<DATASET>/<symbol>_<day>_<tag>.csv.gz``"""
    name = F.concat_ws("_", F.lower(symbol), F.date_format(day, "yyyy-MM-dd"), tag)
    return F.concat(F.concat_ws("/", slug, kind, F.upper(dataset), name), F.lit(".csv.gz"))


def flat_location(exchange: Column, dataset: Column, day: Column, feed: Column) -> Column:
    """``<Exchange>_<dataset>_<day>_<Feed>.csv.gz``"""
    return F.concat(F.concat_ws("_", exchange, dataset, F.date_format(day, "yyyy-MM-dd"), feed), F.lit(".csv.gz"))


# Fixed pattern: the end of a cached file's location.
CACHE_FILE = r"([^/]+)/[^/]*_(\d{4}-\d{2}-\d{2})_(trades|l2)\.csv\.gz$"


def parse_cache_location(path: Column, root: str = "") -> dict[str, Column]:
    """A cache location back to its parts.

    The data set is the folder right above the file, upper-cased; slug and type are the first two folders under ``root``.
    A path that is no cached file gives nulls.
    """
    below = re.escape(root.rstrip("/") + "/") if root else "^"

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))

    return {
        "slug": part(below + r"([^/]+)/([^/]+)/", 1),
        "instrument_type": part(below + r"([^/]+)/([^/]+)/", 2),
        "dataset": F.upper(part(CACHE_FILE, 1)),
        "file_day": part(CACHE_FILE, 2).try_cast("date"),
        "tag": part(CACHE_FILE, 3),
    }


# The two below run once per row, on names that a file scan has matched already: plain string cuts, no patterns.
def cached_parts(path: Column) -> dict[str, Column]:
    """Data set and day of a cached file's location."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    day = F.substring_index(F.substring_index(F.substring_index(path, "/", -1), "_", -2), "_", 1)
    return {"dataset": F.upper(folder), "file_day": day.try_cast("date")}


def delivered_parts(path: Column) -> dict[str, Column]:
    """Slug, data set and day of a source location."""
    day = F.substring_index(F.substring_index(path, "/", -4), "/", 3)
    return {
        "slug": F.substring_index(F.substring_index(path, "/", -6), "/", 1),
        "dataset": F.upper(F.substring_index(F.substring_index(path, "/", -1), ".csv.gz", 1)),
        "file_day": F.translate(day, "/", "-").try_cast("date"),
    }
