"""Equality joins whose keys may be hot, and group totals without a window over a few keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgloom.session import cut, small

#: Rows of one key on the right side above which they are dealt to several tasks.
HOT_KEY = 20_000


def large_groups(df: DataFrame, by: list[str], rows: int, size: str | None = None) -> DataFrame | None:
    """``by`` of the groups with more than ``rows`` rows (or a greater sum of the column ``size``); None if there is none.

    A group of a finer key can only be large within these, so they bound what has to be counted.
    """
    counts = df.groupBy(*by).agg((F.sum(size) if size else F.count(F.lit(1))).alias("n"))
    large = counts.filter(F.col("n") > rows).select(*by)
    return None if large.isEmpty() else large


def salted_join(left: DataFrame, right: DataFrame, on: list[str], hot: int = HOT_KEY, counted: DataFrame | None = None, written: bool = False) -> DataFrame:
    """The inner join of two tables on equal keys, however many rows of ``right`` share one.

    Keys with more than ``hot`` rows of ``right`` are cut into parts by a hash of
    the whole row; rows of ``left`` with such a key are copied to each part. So no
    task holds more than some ``hot`` rows of the right side for a key, and no pair is lost or
    doubled. Null keys meet nothing. ``right`` is read twice, so give a written
    table, or in ``counted`` the part of it in which hot keys can be. With ``written`` the hot
    keys are written once and broadcast if they are few, so the sides aren't shuffled for them.
    """
    counts = (right if counted is None else counted).groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot)
    parts = counts.select(*on, F.ceil(F.col("__n") / hot).cast("int").alias("__parts"))
    parts = small(cut(parts)) if written else parts
    if parts.isEmpty():
        return left.join(right, on)
    one = F.coalesce("__parts", F.lit(1))
    copied = left.join(parts, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), one - 1))).drop("__parts")
    row = [c for c in right.columns if not right.schema[c].dataType.typeName().startswith("map")]
    dealt = right.join(parts, on, "left").withColumn("__salt", F.pmod(F.xxhash64(*row), one).cast("int")).drop("__parts")
    return copied.join(dealt, [*on, "__salt"]).drop("__salt")


def with_total(rows: DataFrame, by: list[str], value: str, total: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows of the same ``by``, null keys being one group: summed map-side, then joined back, so no key gathers in a task."""
    sums = rows.groupBy(*by).agg(F.sum(value).alias(total)).select(*[F.col(c).alias(f"__{c}") for c in by], total)
    on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    return rows.join(sums, on, "left").drop(*[f"__{c}" for c in by])
