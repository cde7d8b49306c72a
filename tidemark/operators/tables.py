"""Operators on whole tables: latest rows, splits, lookups, slowly changing dimensions, intervals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], seldom: bool = False) -> DataFrame:
    """The first row of each key in the given order; ties are broken by a hash of all columns, so that the result never varies. A maximum of a
    struct would do as well for few columns; the window keeps all of them in one shuffle.

    Filtered by their number, rows are also sorted and cut before the shuffle, which is right for keys of many rows. Where keys seldom repeat that sort drops next to nothing, and each task
    holds all that it reads: with seldom, a row is the first because none comes before it, and rows are sorted after the shuffle alone; their hash is worked out there too, so that it isn't shuffled."""
    every = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    if seldom:
        return df.repartition(*keys).withColumn("__before", F.lag(F.lit(1)).over(every)).filter("__before is null").drop("__before")
    return df.withColumn("__place", F.row_number().over(every)).filter("__place = 1").drop("__place")


def split(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that are valid, all others): a condition that is null counts as false, so that no row is lost."""
    ok = F.coalesce(valid, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def look_up(df: DataFrame, side: DataFrame, key: str, value: str, missing: str = "UNKNOWN") -> DataFrame:
    """df with value from side by key: null for a null key, missing for one that side doesn't have. side must have each key once;
    whether it is broadcast is left to its measured size."""
    got = side.select(key, F.col(value), F.lit(True).alias("__hit"))
    filled = F.when(F.col(key).isNull(), F.lit(None)).when(F.col("__hit"), F.col(value)).otherwise(missing)
    return df.drop(value).join(got, key, "left").withColumn(value, filled).drop("__hit")


def differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """Whether any column differs between two aliases; null equals null."""
    return reduce(or_, (~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns))


#: The end of a version that still holds.
OPEN = date(9999, 12, 31)


def merge_versions(dim: DataFrame, now: DataFrame, key: str, tracked: Sequence[str], day: Column) -> DataFrame:
    """A dimension of versions (key, *tracked, valid_from, valid_to, is_current) after the rows of now, one per key, came in on day.

    New keys and changed ones get a version from day on; the one it replaces ends there. Older versions and keys that are not in now
    stay as they are. A second run with the same rows changes nothing.
    """
    current = dim.filter("is_current").alias("d")
    joined = now.select(key, *tracked).alias("s").join(current, key, "left")
    fresh = F.col("d.is_current").isNull()
    news = joined.filter(fresh | differs("s", "d", tracked)).select(key, *[F.col(f"s.{c}").alias(c) for c in tracked], day.alias("valid_from"), F.lit(OPEN).alias("valid_to"), F.lit(True).alias("is_current"))
    changed = news.select(key, F.lit(True).alias("__changed"))
    over = F.col("is_current") & F.coalesce("__changed", F.lit(False))
    old = dim.join(changed, key, "left").withColumn("valid_to", F.when(over, day).otherwise(F.col("valid_to"))).withColumn("is_current", F.col("is_current") & ~over).drop("__changed")
    return old.select(key, *tracked, "valid_from", "valid_to", "is_current").unionByName(news)


def version_at(facts: DataFrame, dim: DataFrame, key: str, at: str, columns: Sequence[str]) -> DataFrame:
    """facts with the columns of the version that held at the time: valid_from <= at < valid_to, an open valid_to being null. Of versions that overlap the one that began last counts.

    Nothing is multiplied: versions and facts of a key are put in order of time, and the last version is carried forward. That goes in two steps, so that a key of very many facts is
    spread over its days: first to the beginning of each day that has facts, over one row for each key and day; then within the day.
    """
    kind = facts.schema[at].dataType
    moment = lambda c: F.col(c).cast(kind)
    held = F.struct(moment("valid_to").alias("__end"), *[F.col(c) for c in columns])
    # Sorted by time, then: the version carried to the day, versions that begin then (those that end first before others), facts.
    versions = dim.filter(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(F.col(key).alias("__key"), moment("valid_from").alias("__at"), F.lit(1).alias("__kind"), held.alias("__version"))
    rows = facts.select(*[F.col(f"`{c}`") for c in facts.columns], F.col(key).alias("__key"), F.to_date(at).alias("__day"), F.col(at).alias("__at"), F.lit(2).alias("__kind"))
    days = rows.select("__key", "__day").distinct().withColumns({"__at": moment("__day"), "__kind": F.lit(2)})
    order = [F.col("__at"), F.col("__kind"), F.asc_nulls_last("__version.__end")]
    last = lambda *by: F.last("__version", ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    starts = days.unionByName(versions, allowMissingColumns=True).withColumn("__version", last("__key")).filter("__kind = 2").withColumn("__kind", F.lit(0))
    every = rows.unionByName(versions.withColumn("__day", F.to_date("__at")), allowMissingColumns=True).unionByName(starts, allowMissingColumns=True)
    out = every.withColumn("__version", last("__key", "__day")).filter("__kind = 2")
    holds = F.col("__version.__end").isNull() | (F.col("__at") < F.col("__version.__end"))
    return out.select(*[F.col(f"`{c}`") for c in facts.columns], *[F.when(holds, F.col(f"__version.`{c}`")).alias(c) for c in columns])
