"""Variant spellings of names typed by people, linked over two tables.

Names are split into what an organisation is (mosque, school, ...), a given
name it is called after, and words of its own. Spellings meet if they are in
one place, of one purpose and share a phonetic block code of their sorted
words; Jaro–Winkler similarity of the words, with a table of nickname variants,
accepts pairs; connected components of the accepted pairs are the entities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.llm.components import connected_components
from orgloom.llm.locate import joined_keys, locate, split_keys
from orgloom.llm.names import LETTER_BITS, block_codes, letters, likeness, parse_name
from orgloom.operators.skew import large_groups, salted_join
from orgloom.session import cut, small

PARSED = "purpose string, given string, own string"
#: A block with more spellings than this is compared in parts.
HOT_BLOCK = 20_000
#: Rows of an entity above which its pairs are made in parts.
HOT_ENTITY = 100_000
#: Of a spelling: the number of its words, and ``names.letters`` of the first, the second of two, and all together.
MASKS = ["words", "one", "two", "whole"]


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        parts = [parse_name(n, split_keys(k)) for n, k in zip(b.name, b.place_keys)]
        yield pd.DataFrame({"key": b.key, "side": b.side, "place_id": b.place_id, "purpose": [p[0] for p in parts], "given": [p[1] for p in parts], "own": [" ".join(sorted(p[2])) for p in parts]})


def _with_codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        words = [o.split() for o in b.own]
        one, two = [letters(w[0]) for w in words], [letters(w[1]) if len(w) == 2 else 0 for w in words]
        yield b.assign(codes=[block_codes(tuple(w)) for w in words], words=[len(w) for w in words], one=one, two=two, whole=[letters("".join(w)) for w in words])


def parsed_names(located: DataFrame) -> DataFrame:
    """``key, side, place_id`` with the parts of ``name``; ``place_keys`` tell which words at its end are the place's."""
    return located.select("key", "side", "name", "place_id", joined_keys()).mapInPandas(_parse, f"key string, side int, place_id int, {PARSED}")


def _score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        like = [likeness(tuple(x.split()), g, tuple(y.split()), h) for x, g, y, h in zip(b.own_a, b.given_a, b.own_b, b.given_b)]
        out = pd.DataFrame({"node_a": b.node_a, "node_b": b.node_b, "vague_a": b.purpose_a == "", "vague_b": b.purpose_b == "", "like": pd.Series(like, index=b.index, dtype="float64")})
        yield out[out.like > 0]


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """A row for each block of a spelling; the block's ``code`` is a number, which moves and sorts more cheaply, and two codes of one number would only make more pairs to be compared."""
    rest = [c for c in nodes.columns if c != "codes"]
    return nodes.select(*rest, F.explode("codes").alias("code")).withColumn("code", F.xxhash64("code"))


_LOW = np.int64((1 << LETTER_BITS) - 1)


def _reaches(a: np.ndarray, b: np.ndarray, least: float, lower: np.ndarray | None = None) -> np.ndarray:
    """Whether ``word_likeness`` of two words may be ``least`` or more (0.8 where ``lower``), by their ``letters``: never false where it is."""
    both, m, n = (np.bitwise_count(x & _LOW).astype(np.float64) for x in (a & b, a, b))
    first = (a >> LETTER_BITS) == (b >> LETTER_BITS)
    t = np.where(lower, 0.8, least) if lower is not None else least
    # Jaro is at most (both/m + both/n + 1) / 3, and a common beginning takes off up to 0.4 of what is left to 1
    jaro = np.where(first, 3 * (t - 0.4) / 0.6 - 1, 3 * t - 1)
    short, long = np.minimum(m, n), np.maximum(m, n)
    typos = (both >= long - 1) | ((both >= long - 2) & (short > 6))
    longer = (first & (both >= short)) | typos | (both * (m + n) >= (jaro - 1e-9) * m * n)
    return (a < 0) | (b < 0) | np.where(short == 1, first, longer)


def _names_may_agree(words_a: pd.Series, one_a: pd.Series, two_a: pd.Series, whole_a: pd.Series, words_b: pd.Series, one_b: pd.Series, two_b: pd.Series, whole_b: pd.Series) -> pd.Series:
    w, x1, x2, x = (s.to_numpy() for s in (words_a, one_a, two_a, whole_a))
    v, y1, y2, y = (s.to_numpy() for s in (words_b, one_b, two_b, whole_b))
    in_turn = lambda y1, y2: _reaches(x1, y1, 0.86, x2 == y2) & _reaches(x2, y2, 0.86, x1 == y1)
    both, m, n = (np.bitwise_count(z & _LOW).astype(np.float64) for z in (x & y, x, y))
    as_one = (x < 0) | (y < 0) | ((np.abs(m - n) <= 2) & (both * (m + n) >= (3 * (0.96 - 0.4) / 0.6 - 1 - 1e-9) * m * n))
    return pd.Series(np.select([w != v, w == 2, w == 1], [as_one, in_turn(y1, y2) | in_turn(y2, y1), _reaches(x1, y1, 0.93)], True))


def may_agree() -> Column:
    """Whether ``likeness`` of the pair's names may be above 0; most pairs of a block can't, and are left before their names are joined.

    As arrays in Arrow batches: as a column expression it is too long a method for the JVM to compile.
    """
    names = F.pandas_udf(_names_may_agree, "boolean")(*[F.col(f"{c}_{s}") for s in "ab" for c in MASKS])
    return names & ((F.col("given_a") == "") | (F.col("given_b") == "") | (F.col("given_a") == F.col("given_b")))


def _met(a: DataFrame, b: DataFrame, names: DataFrame, on: list[str], rule, counted: DataFrame | None) -> DataFrame:
    """Distinct pairs of spellings that share a block, with their likeness and whether either tells no purpose; ``counted`` are those among which a block may have too many for one task, None if none has."""
    part = lambda d, s: d.select(*on, *[F.col(c).alias(f"{c}_{s}") for c in ("node", "given", "purpose", *MASKS)])
    one_kind = (F.col("purpose_a") == F.col("purpose_b")) | (F.col("purpose_a") == "") | (F.col("purpose_b") == "")
    pairs = (part(a, "a").join(part(b, "b"), on) if counted is None else salted_join(part(a, "a"), part(b, "b"), on, HOT_BLOCK, counted)).filter(one_kind & rule).filter(may_agree()).select("node_a", "node_b").distinct()
    # the names themselves only join pairs that are left
    named = lambda s: names.select(*[F.col(c).alias(f"{c}_{s}") for c in ("node", "own", "given", "purpose")])
    return pairs.join(named("a"), "node_a").join(named("b"), "node_b").mapInPandas(_score, "node_a long, node_b long, vague_a boolean, vague_b boolean, like double")


def entities(parsed: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(rows with their spelling's ``node``, ``node, entity``, a bound on the rows of any entity) of parsed names.

    A spelling without a purpose joins the entity of its place that it is most
    like (ties: the one with more rows), and is an entity by itself with others
    like it if there is none; a spelling without a place does so over all
    places, but only if the entities it is equally like are in one.
    """
    rows = parsed.filter("own <> ''").withColumn("node", F.xxhash64(F.coalesce("place_id", F.lit(-1)), "purpose", "given", "own"))
    rows = cut(rows)
    nodes = rows.groupBy("node", "place_id", "purpose", "given", "own").agg(F.count(F.lit(1)).alias("n"))
    nodes = cut(nodes.mapInPandas(_with_codes, f"node long, place_id int, {PARSED}, n long, codes array<string>, words int, one long, two long, whole long"))
    placed = _in_blocks(nodes.filter("place_id is not null"))
    # a spelling is in a block once, so a block has no more of them than its place; nor has an entity more rows than its place and those without one
    there = F.col("place_id").isNotNull()
    of_place = nodes.groupBy("place_id").agg(F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("rows"))
    top = of_place.agg(F.max(F.when(there, F.col("spellings"))), F.max(F.when(there, F.col("rows"))), F.max(F.when(~there, F.col("rows")))).first()
    large = large_groups(nodes.filter(there), ["place_id"], HOT_BLOCK) if (top[0] or 0) > HOT_BLOCK else None
    edges = cut(_met(placed, placed, nodes, ["code", "place_id"], F.col("node_a") < F.col("node_b"), None if large is None else placed.join(large, "place_id", "left_semi")))
    found = connected_components(edges.filter("vague_a = vague_b"), "node_a", "node_b")
    entity = nodes.select("node", "place_id", "n").join(found, "node", "left").withColumn("entity", F.coalesce("component", "node")).drop("component")
    entity = cut(entity)
    size = entity.groupBy("entity").agg(F.sum("n").alias("rows"))
    home = entity.select(F.col("node").alias("node_b"), F.col("entity").alias("to"), F.col("place_id").alias("to_place"))
    mixed = edges.filter("vague_a <> vague_b")
    near = mixed.select(F.when(F.col("vague_a"), F.col("node_a")).otherwise(F.col("node_b")).alias("node_a"), F.when(F.col("vague_a"), F.col("node_b")).otherwise(F.col("node_a")).alias("node_b"), "like").join(home, "node_b")
    lost = cut(_in_blocks(nodes.filter("place_id is null")))
    few = small(lost)
    far = cut(_met(few, placed, nodes, ["code"], F.lit(True), placed if few is lost else None).select("node_a", "node_b", "like"))
    far = far.join(home, "node_b")
    far = far.withColumn("best", F.max("like").over(W.partitionBy("node_a"))).filter("like >= best - 0.02")
    lone = far.groupBy("node_a").agg(F.countDistinct("to_place").alias("places")).filter("places = 1").select("node_a")
    far = far.join(lone, "node_a").drop("best")
    moves = near.unionByName(far).join(size.withColumnRenamed("entity", "to"), "to")
    moves = moves.groupBy(F.col("node_a").alias("node")).agg(F.max_by("to", F.struct("like", "rows", "to")).alias("to"))
    return rows, entity.join(cut(moves), "node", "left").select("node", F.coalesce("to", "entity").alias("entity")), (top[1] or 0) + (top[2] or 0)


def link_variants(targets: DataFrame, candidates: DataFrame, places: DataFrame) -> DataFrame:
    """Pairs of a target and a candidate whose names are spellings of one entity: ``target_key, candidate_key``.

    Both tables: ``key`` (string), ``name, city, province, lat, lng, postal,
    website``; other columns are ignored. Null, blank and wholly general names
    pair with nothing; names of equal spelling in one place do. Where neither the city nor
    anything else tells the place, see ``entities``. Null keys are left out,
    repeated rows give a pair once, very long names are compared whole, and
    empty tables give no pairs.
    """
    cols = ["name", "city", "province", "lat", "lng", "postal", "website"]
    rows = targets.select("key", F.lit(0).alias("side"), *cols).unionByName(candidates.select("key", F.lit(1).alias("side"), *cols)).filter("key is not null")
    rows, entity, most = entities(parsed_names(locate(rows, places, carry=["side", "name"])))
    found = rows.select("key", "side", "node").join(entity, "node")
    large = None if most <= HOT_ENTITY else large_groups(found, ["entity"], HOT_ENTITY)
    a = found.filter("side = 0").select(F.col("key").alias("target_key"), "entity")
    b = found.filter("side = 1").select(F.col("key").alias("candidate_key"), "entity")
    pairs = a.join(b, "entity") if large is None else salted_join(a, b, ["entity"], HOT_ENTITY, b.join(large, "entity", "left_semi"))
    return pairs.select("target_key", "candidate_key").distinct()
