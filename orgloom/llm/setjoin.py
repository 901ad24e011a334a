"""Set-similarity join of short strings by prefix filtering."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.session import cut


def grams(key: str) -> list[str]:
    """The set of a string's parts: letters, padded pairs and pairs over one letter, each with the number of its occurrence.

    Letters and gapped pairs keep swapped and mistyped letters from breaking
    every part around them, as they would with pairs alone.
    """
    padded, seen, out = f"^{key}$", Counter(), []
    for part in [*key, *map("".join, zip(padded, padded[1:])), *map("_".join, zip(padded, padded[2:]))]:
        seen[part] += 1
        out.append(f"{part}{seen[part]}")
    return out


def _ordered(sets: DataFrame, keys: list[str]) -> DataFrame:
    """Sets as arrays of their members' ranks, from the rarest to the commonest among the entries (side 1).

    One order for both sides is all the method needs; counted over the
    entries alone, parts that only typos have come first and meet nothing. The
    ranks are numbered in one task: there are only so many pairs of letters.
    """
    parts = sets.select(*keys, F.explode("set").alias("part"))
    ranks = parts.groupBy("part").agg(F.count_if(F.col("side") == 1).alias("df"))
    ranks = ranks.select("part", F.row_number().over(W.partitionBy(F.lit(1)).orderBy("df", "part")).alias("rank"))
    return parts.join(ranks, "part").groupBy(*keys).agg(F.sort_array(F.collect_list("rank")).alias("parts"))


def similar_keys(keys: DataFrame, entries: DataFrame, threshold: float, gap: Column | None = None) -> DataFrame:
    """Pairs of a key and an entry of one ``kind`` whose sets have a Jaccard similarity of at least ``threshold``.

    Both tables have ``kind``, ``key`` (distinct, not empty) and its ``set`` of parts. Result:
    ``kind, key, entry, jaccard``. Parts are ordered by their rarity; two sets can only be that similar if their rare prefixes share a
    part, so only prefixes are joined. ``gap`` may bound the difference of the
    sets' sizes ``n_a`` and ``n_b`` further, where an exact check that follows does. Pairs whose lengths, or whose places of
    the shared part, rule the similarity out are dropped; the rest is verified
    exactly. A key has a bounded number of parts, so every group collected here
    is one key's own.
    """
    # no entry is large enough for a key beyond this size; such keys would carry long sets for nothing
    largest = entries.agg(F.max(F.size("set"))).first()[0] or 0
    keys = keys.filter(F.size("set") * threshold <= largest)
    both = keys.select("kind", "key", "set", F.lit(0).alias("side")).unionByName(entries.select("kind", "key", "set", F.lit(1).alias("side")))
    ordered = cut(_ordered(both, ["kind", "key", "side"])).withColumn("n", F.size("parts"))
    prefix = F.slice("parts", 1, F.col("n") - F.ceil(F.col("n") * threshold).cast("int") + 1)
    rare = ordered.select("kind", "key", "side", "parts", "n", F.posexplode(prefix).alias("at", "part"))
    a = rare.filter("side = 0").select("kind", "part", "key", F.col("parts").alias("parts_a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"))
    b = rare.filter("side = 1").select("kind", "part", F.col("key").alias("entry"), F.col("parts").alias("parts_b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"))
    met = a.join(b, ["kind", "part"]).filter((F.col("n_b") >= F.col("n_a") * threshold) & (F.col("n_a") >= F.col("n_b") * threshold))
    if gap is not None:
        met = met.filter(F.abs(F.col("n_a") - F.col("n_b")) <= gap)
    needed = (F.col("n_a") + F.col("n_b")) * (threshold / (1 + threshold))
    met = met.filter(F.least("at_a", "at_b") + 1 + F.least(F.col("n_a") - F.col("at_a") - 1, F.col("n_b") - F.col("at_b") - 1) >= needed - 1e-9)
    # a pair is kept where its first shared part is, which needs no shuffle to make pairs distinct;
    # written so that the intersection is made once
    similarity = lambda s: F.when(F.get(s, F.lit(0)) == F.col("part"), F.size(s) / (F.col("n_a") + F.col("n_b") - F.size(s)))
    met = met.withColumn("jaccard", F.get(F.transform(F.array(F.array_intersect("parts_a", "parts_b")), similarity), F.lit(0)))
    return met.filter(F.col("jaccard") >= threshold).select("kind", "key", "entry", "jaccard")
