"""Mixing documents of several sources to target shares of the total size.

The mixture is as large as the targets allow: a source that may repeat its
documents ``max_repeats`` times bounds the total, and every source's documents
are expected the same number of times. Systematic sampling turns expected
into whole copies: documents of a source are laid in a row, each as long as its
expected copies, and a copy is emitted at every whole step from one random
offset. Rows are ordered by size, so copies spread evenly over all
sizes and the shares come out close.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.session import cut

#: Parts into which documents of one source and size class are spread, for each of which a prefix sum runs alone.
PARTS = 4096


def expected_copies(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, weight, max_repeats, size, rate``: how often a document of each source is expected.

    ``sizes`` has one row for each source and its ``size``, ``targets`` the
    ``weight`` and ``max_repeats``. Sources without a target, or of weight 0,
    get the rate 0; targets whose source has no size take no part, and
    the weights of the others are scaled to sum to 1.
    """
    known = sizes.filter("source is not null").join(targets.select("source", F.col("weight").cast("double"), "max_repeats"), "source", "left")
    known = known.withColumn("weight", F.when((F.col("weight") > 0) & (F.col("size") > 0) & (F.coalesce("max_repeats", F.lit(1)) > 0), F.col("weight")).otherwise(0.0)).withColumn("max_repeats", F.coalesce("max_repeats", F.lit(1)))
    every = W.partitionBy(F.lit(1))  # one row for each source
    known = known.withColumn("weight", F.coalesce(F.try_divide(F.col("weight"), F.sum("weight").over(every)), F.lit(0.0)))
    known = known.withColumn("total", F.min(F.try_divide(F.col("size") * F.col("max_repeats"), F.col("weight"))).over(every))
    rate = F.when(F.col("weight") > 0, F.least(F.col("weight") * F.col("total") / F.col("size"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    return known.select("source", "weight", "max_repeats", "size", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def mix(documents: DataFrame, targets: DataFrame, seed: int = 17, parts: int = PARTS) -> DataFrame:
    """``doc_id, source, size, copies`` of every document: how often the mixture holds it.

    ``documents``: ``doc_id, source, size`` (tokens; null counts as 0).
    ``targets``: ``source, weight, max_repeats``. Documents of size 0 (null and
    empty texts) add nothing and get 0 copies, as do those without a source or
    with one that has no target; none is left out. Copies are at most
    ``max_repeats``. Repeated rows are documents of their own. Empty tables
    give an empty mixture.

    The prefix sum has two levels: counts of each source, size class and hash
    part are summed up first (a table of bounded size), then each part numbers
    its own documents; no source has to be in one task.
    """
    rows = documents.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    rates = expected_copies(rows.groupBy("source").agg(F.sum("size").alias("size")), targets).select("source", "rate", "max_repeats")
    rows = rows.withColumn("class", F.floor(F.log2(F.greatest("size", F.lit(1)).cast("double")) * 4).cast("int")).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(parts)).cast("int"))
    used = cut(rows.filter("size > 0 and source is not null").join(rates.filter("rate > 0"), "source"))
    counts = used.groupBy("source", "class", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("source").orderBy("class", "part").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    inside = F.row_number().over(W.partitionBy("source", "class", "part").orderBy("size", "doc_id"))
    placed = used.join(counts, ["source", "class", "part"]).withColumn("place", F.col("before") + inside)
    offset = (F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(1_000_003)) + 0.5) / 1_000_003
    # a rate that is a whole number must give each document just so many copies
    step = lambda n: F.floor(F.round(n * F.col("rate") + offset, 9))
    placed = placed.withColumn("copies", F.least(step(F.col("place")) - step(F.col("place") - 1), F.col("max_repeats")).cast("int"))
    rest = rows.join(rates.filter("rate > 0").select("source"), "source", "left_anti").unionByName(rows.filter("size = 0").join(rates.filter("rate > 0").select("source"), "source", "left_semi"))
    columns = ["doc_id", "source", "size"]
    return placed.select(*columns, "copies").unionByName(rest.select(*columns, F.lit(0).alias("copies")))


def mixture_shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """Of each source: ``source, target, actual`` (shares of the mixture's size), n_documents, n_used, n_copies, size, mixed_size``."""
    by = mixture.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("copies") > 0).alias("n_used"), F.sum("copies").alias("n_copies"), F.sum("size").alias("size"), F.sum(F.col("size") * F.col("copies")).alias("mixed_size")
    )
    by = by.join(targets.select("source", F.col("weight").alias("target")), "source", "full")
    filled = by.select("source", F.coalesce("target", F.lit(0.0)).alias("target"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_documents", "n_used", "n_copies", "size", "mixed_size")])
    total = F.sum("mixed_size").over(W.partitionBy(F.lit(1)))  # one row for each source
    return filled.select("source", "target", F.coalesce(F.try_divide(F.col("mixed_size").cast("double"), total), F.lit(0.0)).alias("actual"), "n_documents", "n_used", "n_copies", "size", "mixed_size")
