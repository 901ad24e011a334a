"""Records that give one street address in different ways.

Streets of a place are compared as weighted character n-grams: an inverted
index over the rare n-grams of each name finds candidates, cosine similarity
verifies them, and rare spellings are led to the common one of their street.
Records agree if place, street and house number do, and kind and direction of
the street don't contradict.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgloom.llm.locate import joined_keys, locate, split_keys
from orgloom.llm.setjoin import grams
from orgloom.llm.streets import parse_address
from orgloom.llm.text import edits
from orgloom.operators.skew import large_groups, salted_join
from orgloom.session import cut

#: Cosine similarity of two spellings of one street.
THRESHOLD = 0.3
#: A name follows another that is this many times as common if they are similar; names of comparable counts only if they are all but equal.
COMMONER = 3
#: An n-gram of a place with more names than this is compared in parts.
HOT_GRAM = 20_000
#: A group with more records than this is paired in salted parts.
HOT_GROUP = 5_000


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        parts = [parse_address(a, split_keys(k)) if k is not None else None for a, k in zip(b.address, b.place_keys)]
        out = b[["key", "place_id", "postal"]].assign(number=[p and p[0] for p in parts], name=[p and p[1] for p in parts], kind=[p and p[2] for p in parts], direction=[p and p[3] for p in parts])
        yield out[out.number.notna()]


def _weights(idf: dict[str, float], name: str) -> list[tuple[str, float]]:
    """A name's n-grams, rarest first, with weights of norm 1; ``idf`` has all n-grams of all names."""
    ordered = sorted(((g, idf[g]) for g in grams(name)), key=lambda x: (-x[1], x[0]))
    norm = math.sqrt(sum(w * w for _, w in ordered)) or 1.0
    return [(g, w / norm) for g, w in ordered]


def _with_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"gram": [g for n in b.name for g in grams(n)]})


def one_street(x: str, y: str, much_rarer: bool) -> bool:
    """The exact check of two similar names: numbers must be equal, and few letters differ; where neither is much rarer only one, of six or more."""
    if re.findall(r"\d+", x) != re.findall(r"\d+", y):
        return False
    short = min(len(x), len(y))
    most = (1 if short < 5 else 2 if short < 10 else 3) if much_rarer else (1 if short > 5 else 0)
    return edits(x, y, most) <= most


def street_spellings(names: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``place_id, name, street``: the common spelling that each name of a place stands for.

    ``names``: ``place_id, name, n``, each name of a place once. A name follows
    the commonest spelling it is similar to: by ``one_street``, which asks for less where
    that one is ``COMMONER`` times as common, a ratio that doesn't change with the
    tables' size. Chains are followed to their end. The document frequencies of n-grams, of which there
    are a few thousand at most, are the only thing that goes by way of the driver.
    """
    names = cut(names)
    counts = names.select("name").distinct().mapInPandas(_with_grams, "gram string").groupBy("gram").count().collect()
    total = max((r["count"] for r in counts), default=1)
    idf = {r.gram: math.log(1 + total / r["count"]) for r in counts}

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for place, name, n in zip(b.place_id, b.name, b.n):
                parts, left, prefix = _weights(idf, name), 1.0, []
                for g, w in parts:
                    if left < threshold * threshold:
                        break
                    prefix.append(g)
                    left -= w * w
                out += [(place, name, n, g, i, prefix) for i, g in enumerate(prefix)]
            yield pd.DataFrame(out, columns=["place_id", "name", "n", "gram", "at", "prefix"]).astype({"place_id": "int32", "n": "int64", "at": "int32"})

    laid = cut(names.mapInPandas(index, "place_id int, name string, n long, gram string, at int, prefix array<string>"))
    a = laid.select("place_id", "gram", F.col("name").alias("name_a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), F.col("prefix").alias("prefix_a"))
    b = laid.select("place_id", "gram", F.col("name").alias("name_b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), F.col("prefix").alias("prefix_b"))
    # a name has an n-gram once, so no n-gram has more names than its place
    large = large_groups(names, ["place_id"], HOT_GRAM)
    met = a.join(b, ["place_id", "gram"]) if large is None else salted_join(a, b, ["place_id", "gram"], HOT_GRAM, b.join(large, "place_id", "left_semi"))
    met = met.filter((F.abs(F.length("name_a") - F.length("name_b")) <= 3) & ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("name_a") > F.col("name_b")))))
    met = met.filter((F.col("n_a") * COMMONER <= F.col("n_b")) | ((F.least(F.length("name_a"), F.length("name_b")) > 5) & (F.abs(F.length("name_a") - F.length("name_b")) <= 1)))
    # a pair is kept where its first shared n-gram is
    met = met.filter(~F.arrays_overlap(F.slice("prefix_a", F.lit(1), F.col("at_a")), F.slice("prefix_b", F.lit(1), F.col("at_b")))).select("place_id", "name_a", "n_a", "name_b", "n_b")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, dict[str, float]] = {}

        def vector(name: str) -> dict[str, float]:
            if name not in known:
                if len(known) > 50_000:
                    known.clear()
                known[name] = dict(_weights(idf, name))
            return known[name]

        for b in batches:
            cosine = []
            for x, y in zip(b.name_a, b.name_b):
                u, v = vector(x), vector(y)
                cosine.append(sum(w * v[g] for g, w in u.items() if g in v))
            b = b.assign(cosine=cosine)
            b = b[b.cosine >= threshold]
            yield b[[one_street(x, y, COMMONER * m <= n) for x, y, m, n in zip(b.name_a, b.name_b, b.n_a, b.n_b)]]

    close = met.mapInPandas(verify, "place_id int, name_a string, n_a long, name_b string, n_b long, cosine double")
    leads = cut(close.groupBy("place_id", F.col("name_a").alias("name")).agg(F.max_by("name_b", F.struct("n_b", "cosine", "name_b")).alias("street")))
    # every name leads to a commoner one, so the steps, doubled each time, come to an end
    while True:
        onward = leads.select("place_id", F.col("name").alias("street"), F.col("street").alias("further"))
        longer = leads.join(onward, ["place_id", "street"], "left").select("place_id", "name", F.coalesce("further", "street").alias("street"), F.col("further").isNotNull().alias("moved"))
        longer = cut(longer)
        leads = longer.drop("moved")
        if longer.filter("moved").isEmpty():
            break
    return names.select("place_id", "name").join(leads, ["place_id", "name"], "left").select("place_id", "name", F.coalesce("street", "name").alias("street"))


def _told(rows: DataFrame, by: list[str], column: str, least: float = 0.85) -> DataFrame:
    """The one value of ``column`` that ``least`` of the rows with a value share, for each ``by``."""
    n = rows.filter((F.col(column) != "") & F.col(by[-1]).isNotNull()).groupBy(*by, column).agg(F.sum("rows").alias("n"))
    name = f"{column}_by_{len(by)}"
    return n.groupBy(*by).agg(F.max_by(column, "n").alias(name), (F.max("n") / F.sum("n")).alias("share")).filter(F.col("share") >= least).drop("share")


def address_groups(records: DataFrame, places: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``key, address_group`` of every record whose address has a house number on a street of a known place.

    ``records``: ``key, address, city, province, lat, lng, postal, website``;
    any may be null. Where the kind or direction of the street isn't told, it
    is taken from records of the same number and postal code, else of the same number, else of
    the same street, if these agree on one. Records without a street, without
    a number or without a place belong to no group; null keys are left out.
    """
    rows = records.filter("key is not null and trim(address) <> ''")
    located = locate(rows, places, carry=["address", "postal"]).filter("place_id is not null")
    code = F.regexp_replace(F.upper("postal"), r"[^A-Z0-9]", "")
    located = located.withColumn("postal", F.when(code.rlike(r"^[A-Z]\d[A-Z]\d[A-Z]\d$"), code))
    parsed = cut(located.select("key", "address", "place_id", joined_keys(), "postal").mapInPandas(_parse, "key string, place_id int, postal string, number string, name string, kind string, direction string"))
    spelled = street_spellings(parsed.groupBy("place_id", "name").agg(F.count(F.lit(1)).alias("n")), threshold)
    parsed = parsed.join(spelled, ["place_id", "name"])
    forms = cut(parsed.groupBy("place_id", "street", "number", "postal", "kind", "direction").agg(F.count(F.lit(1)).alias("rows")))
    full = forms
    vague = forms.filter("kind = ''")
    for by in (["place_id", "street"], ["place_id", "street", "number"], ["place_id", "street", "number", "postal"]):
        vague = vague.join(_told(full, by, "kind"), by, "left")
    vague = vague.select("place_id", "street", "number", "postal", "direction", F.coalesce("kind_by_4", "kind_by_3", "kind_by_2", F.lit("")).alias("told"))
    same = lambda x, y: F.col(f"{x}.{y}").eqNullSafe(F.col(f"v.{y}"))
    forms = forms.alias("f").join(vague.alias("v"), [same("f", c) for c in ("place_id", "street", "number", "postal", "direction")] + [F.col("f.kind") == ""], "left")
    forms = forms.select("f.*", F.when(F.col("f.kind") != "", F.col("f.kind")).otherwise(F.coalesce("v.told", F.lit(""))).alias("full_kind"))
    sides = _told(forms.withColumn("kind", F.col("full_kind")), ["place_id", "street", "kind"], "direction").select("place_id", "street", F.col("kind").alias("full_kind"), F.col("direction_by_3").alias("usual"))
    forms = forms.join(sides, ["place_id", "street", "full_kind"], "left").withColumn("full_direction", F.when(F.col("direction") != "", F.col("direction")).otherwise(F.coalesce("usual", F.lit(""))))
    forms = forms.withColumn("address_group", F.xxhash64("place_id", "street", "number", "full_kind", "full_direction"))
    group = forms.select("place_id", "street", "number", F.coalesce("postal", F.lit("")).alias("code"), "kind", "direction", "address_group")
    return parsed.withColumn("code", F.coalesce("postal", F.lit(""))).join(group, ["place_id", "street", "number", "code", "kind", "direction"]).select("key", "address_group")


def pairs_of_groups(grouped: DataFrame, key: str, group: str, hot: int = HOT_GROUP) -> DataFrame:
    """All pairs of keys of one group, smaller first: ``key_a, key_b``.

    The result is what is asked for, and grows with the square of a group; a
    group of over ``hot`` records is cut into parts by a hash of the key, and
    each pair of parts is a join of its own, so no task holds a hot group.
    """
    rows = grouped.select(F.col(key).alias("key"), F.col(group).alias("group")).distinct()
    big = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("group", F.ceil(F.col("n") / hot).cast("int").alias("parts"))
    rows = rows.join(big, "group", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    a = rows.select("group", F.col("key").alias("key_a"), F.col("part").alias("part_a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part_b"))
    b = rows.select("group", F.col("key").alias("key_b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part_a"), F.col("part").alias("part_b"))
    return a.join(b, ["group", "part_a", "part_b"]).filter("key_a < key_b").select("key_a", "key_b")
