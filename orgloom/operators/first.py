"""First-per-group, caps, ordered folds and running schedules, as windows and aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.session import cut


def first_rows(df: DataFrame, by: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group; rows with equal order are all different rows, so end the order with a key."""
    return df.withColumn("__rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("__rank") <= n).drop("__rank")


def earliest(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """One row for each group, the smallest by ``order``: a minimum, combined before the shuffle, instead of a sort."""
    rest = [c for c in df.columns if c not in by]
    least = df.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return least.select(*by, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)


def capped_hits(hits: DataFrame, url: str, host: str, order: list[Column], cap: int) -> DataFrame:
    """Hits in run order with each URL once and at most ``cap`` for a host.

    The same as going through the hits one by one: a URL has one host, so one
    that came too late for its host would have done so again.
    """
    return first_rows(first_rows(hits, [url], order), [host], order, cap)


def first_known(df: DataFrame, by: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Each column's first value that isn't null, by itself, in the order of the group."""
    return df.groupBy(*by).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in columns])


def preferred(df: DataFrame, by: list[str], better: Column, order: list[Column]) -> DataFrame:
    """The first row of each group, but any that is ``better`` before one that isn't."""
    return first_rows(df, by, [F.when(better, 0).otherwise(1), *order])


def joined_in_order(df: DataFrame, by: list[str], order: str, text: Column, separator: str, at_most: int, longest: int | None = None) -> DataFrame:
    """Texts of each group's first ``at_most`` rows joined in order: ``text, truncated``.

    The cap is the operator's own (a crawl keeps so many pages), and is applied
    before texts are gathered, so no group gathers more.
    """
    kept = first_rows(df.withColumn("__text", text), by, [F.col(order)], at_most)
    rows = kept.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("__text").alias("t")))).alias("__rows"))
    whole = F.array_join(F.transform("__rows", lambda r: r.t), separator)
    if longest is None:
        return rows.select(*by, whole.alias("text"), F.lit(False).alias("truncated"))
    return rows.select(*by, F.substring(whole, 1, longest).alias("text"), (F.length(whole) > longest).alias("truncated"))


#: Parts into which the rows of a running total are cut by their order, each of which is summed alone.
PARTS = 64


def _in_parts(df: DataFrame, order: list[str], parts: int) -> DataFrame:
    """Adds ``__part``: a number that grows with the order, about as many rows in each; equal orders are in one."""
    o = F.struct(*order)
    laid = df.withColumn("__order", o)
    return laid.repartitionByRange(parts, "__order").withColumn("__part", F.spark_partition_id()).drop("__order")


def running_sum(df: DataFrame, by: list[str], order: list[str], value: str, total: str, parts: int = PARTS) -> DataFrame:
    """Adds ``total``: the sum of ``value`` over the rows of the same ``by`` that come before a row; rows of equal order don't come before one another.

    Rows are cut into ranges of the order; the ranges' sums, one row for each and
    key, are summed up first, then each range goes on by itself, so a key may hold any share of the rows.
    """
    laid = cut(_in_parts(df, order, parts))
    sums = laid.groupBy(*by, "__part").agg(F.sum(value).alias("__sum"))
    before = F.sum("__sum").over(W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__part").alias("__p"), F.coalesce(before, F.lit(0)).alias("__before"))
    on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by] + [F.col("__part") == F.col("__p")]
    inside = F.sum(value).over(W.partitionBy(*by, "__part").orderBy(*order).rangeBetween(W.unboundedPreceding, W.currentRow) if len(order) == 1 else W.partitionBy(*by, "__part").orderBy(F.struct(*order)).rangeBetween(W.unboundedPreceding, W.currentRow))
    own = F.sum(value).over(W.partitionBy(*by, "__part", *order))
    joined = laid.join(sums, on, "left").withColumn(total, F.col("__before") + F.coalesce(inside, F.lit(0)) - F.coalesce(own, F.lit(0)))
    return joined.drop("__part", "__p", "__before", *[f"__{c}" for c in by])


def numbered(df: DataFrame, order: list[Column], name: str, parts: int = PARTS) -> DataFrame:
    """Adds the number of each row in an order that tells all rows apart, from 1; ranges of the order are counted first, so no task holds all rows."""
    keys = [f"__o{i}" for i in range(len(order))]
    laid = df.select("*", *[o.alias(k) for o, k in zip(order, keys)])
    return running_sum(laid.withColumn("__one", F.lit(1)), [], keys, "__one", name, parts).withColumn(name, F.col(name) + 1).drop("__one", *keys)


def spaced_schedule(df: DataFrame, by: str, at: str, tie: str, interval: float, parts: int = PARTS) -> DataFrame:
    """When each request of a host may start, if starts are at least ``interval`` seconds apart: adds ``start`` and ``wait``.

    ``at`` is a number of seconds. The recurrence start(i) = max(at(i), start(i-1) +
    interval) is a running maximum of at(j) - j * interval. Numbers and maxima
    are first made for ranges of the order and each host, then within each range, so a host may hold any share of the requests.
    """
    laid = cut(_in_parts(df, [at, tie], parts))
    inside = W.partitionBy(by, "__part").orderBy(at, tie)
    laid = laid.withColumn("__i", F.row_number().over(inside).cast("double"))
    lead = F.col(at) - F.col("__i") * interval
    ends = laid.groupBy(by, "__part").agg(F.count(F.lit(1)).cast("double").alias("__n"), F.max(lead).alias("__lead"))
    upto = W.partitionBy(by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("__before", F.coalesce(F.sum("__n").over(upto), F.lit(0.0))).withColumn("__lead", F.col("__lead") - F.col("__before") * interval)
    ends = ends.select(F.col(by).alias("__by"), F.col("__part").alias("__p"), "__before", F.max("__lead").over(upto).alias("__ahead"))
    rows = laid.join(ends, F.col(by).eqNullSafe(F.col("__by")) & (F.col("__part") == F.col("__p")))
    place = F.col("__before") + F.col("__i")
    most = F.greatest(F.max(F.col(at) - place * interval).over(inside.rowsBetween(W.unboundedPreceding, 0)), F.col("__ahead"))
    rows = rows.withColumn("start", most + place * interval).withColumn("wait", F.col("start") - F.col(at))
    return rows.drop("__i", "__part", "__p", "__by", "__before", "__ahead")


def within_budget(df: DataFrame, run: str, order: list[str], cost: Column, budget: float) -> DataFrame:
    """Adds ``allowed``: whether a row of a run is still begun, its cost counted after it was begun; free rows always are.

    The order must tell all rows of a run apart, so end it with a key.
    """
    rows = running_sum(df.withColumn("__cost", cost), [run], order, "__cost", "__spent")
    return rows.withColumn("allowed", (F.col("__cost") == 0) | (F.col("__spent") < budget)).drop("__cost", "__spent")
