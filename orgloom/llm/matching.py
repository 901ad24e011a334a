"""Entities of two tables without a common key, matched by sorted neighbourhood.

Both tables are laid into one order for each of several composite sort keys;
a record is compared with the ``window`` records of the other table before and
after it. Field similarities are weighted into a confidence, and records are
assigned so that the total confidence is greatest.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.llm.locate import host, joined_keys, locate, split_keys
from orgloom.llm.names import block_codes, likeness, parse_name, sound
from orgloom.session import cut, cut_in_order

#: Records of the other table that one is compared with, on either side, for each key.
WINDOW = 8
#: A host is a platform, on which addresses count with their path, unless so many organisations have this share of the rows that name one.
PLATFORM_NAMES, OWN_SHARE = 12, 0.8
#: Organisations of a host that are counted apart; the rows of further ones count together.
_APART = 64
#: Weights of the similarities in the confidence.
WEIGHTS = {"name": 0.5, "place": 0.15, "web": 0.2, "point": 0.1, "phone": 0.05}
_PROFILE = "node long, side int, place_id int, purpose string, given string, own string, web string"


def web_path(website: Column) -> Column:
    """The address below the host without page, query and fragment: at most two parts, small letters."""
    rest = F.regexp_replace(F.regexp_replace(F.lower(F.trim(website)), r"^(?:[a-z]+:)?/*", ""), r"[?#].*$", "")
    return F.regexp_extract(rest, r"^[^/]+/([^/]+(?:/[^/]+)?)", 1)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        parts = [parse_name(n, split_keys(k)) for n, k in zip(b.name, b.place_keys)]
        yield b.drop(columns=["name", "place_keys"]).assign(purpose=[p[0] for p in parts], given=[p[1] for p in parts], own=[" ".join(sorted(p[2])) for p in parts])


def _sort_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        keys, rows = [], []
        for i, (place, purpose, own, web) in enumerate(zip(b.place_id.tolist(), b.purpose.tolist(), b.own.tolist(), b.web.tolist())):
            words = own.split()
            if words and place == place and place is not None:
                at = f"{int(place):09d}"
                keys.append(f"1|{at}|{words[0]}|{purpose}|{' '.join(words[1:])}")
                if len(words) > 1:
                    keys.append(f"2|{at}|{words[-1]}|{purpose}|{' '.join(words[:-1])}")
                keys.append(f"3|{at}|{' '.join(sorted(map(sound, words)))}|{purpose}")
            if web:
                keys.append(f"4|{web}|{own}")
            rows += [i] * (len(keys) - len(rows))
        out = b.iloc[rows].reset_index(drop=True)
        out.insert(0, "sort_key", pd.Series(keys, dtype=object))
        yield out.astype({"place_id": "Int32"})


@lru_cache(maxsize=50_000)
def _words_and_codes(own: str) -> tuple[tuple[str, ...], frozenset[str]]:
    words = tuple(own.split())
    return words, frozenset(block_codes(words)) if words else frozenset()


class _Profile:
    __slots__ = ("node", "place", "purpose", "given", "name", "web")

    def __init__(self, key, node, side, place, purpose, given, own, web) -> None:
        self.node, self.place = node, None if place is None or place != place else int(place)
        self.purpose, self.given, self.name, self.web = purpose, given, own, web or None


def compare(a: _Profile, b: _Profile) -> tuple[float, int, int] | None:
    """(likeness of names, same place, same web address) of two profiles that may be one organisation, else None.

    The names must agree in one place, or the web address be the same and the
    names not contradict it. Two purposes that differ contradict.
    """
    if a.purpose and b.purpose and a.purpose != b.purpose:
        return None
    same_web = a.web is not None and a.web == b.web
    same_place = a.place is not None and a.place == b.place
    if not (same_web or same_place):
        return None
    if a.given and b.given and a.given != b.given:
        like = 0.0
    elif a.name == b.name:
        like = 1.0 if a.name else 0.0
    else:
        (own_a, codes_a), (own_b, codes_b) = _words_and_codes(a.name), _words_and_codes(b.name)
        like = 0.0 if codes_a.isdisjoint(codes_b) else likeness(own_a, a.given, own_b, b.given)
    if like > 0:
        return like, int(same_place), int(same_web)
    if same_web and not (a.name and b.name):
        return 0.0, int(same_place), 1
    return None


def _behind(rows: Iterator[tuple[int, _Profile]], past: deque[_Profile]) -> Iterator[tuple]:
    """Compares every left profile of a sorted stream with the right ones just behind it; holds no more than these."""
    for side, p in rows:
        if side == 1:
            past.append(p)
            continue
        for r in past:
            found = compare(p, r)
            if found:
                yield p.node, r.node, *found


def sorted_neighbours(profiles: DataFrame, window: int = WINDOW) -> DataFrame:
    """``left, right, name, place, web``: pairs of nodes of side 0 and side 1 that were neighbours and agree.

    The order is one range-partitioned sort over all keys together, written to
    the shared folder and walked once upwards and once downwards, so a worker only ever
    holds the last ``window`` right profiles, however many left ones lie
    between. Of every partition at most ``window`` right profiles at
    either end go by way of the driver to the partitions beside it, so the
    window is unbroken at the borders.
    """
    order = ["sort_key", "side", "node"]
    laid = profiles.mapInPandas(_sort_keys, f"sort_key string, {_PROFILE}")
    laid = cut_in_order(laid.repartitionByRange(*order).sortWithinPartitions(*order))
    columns = laid.columns

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first: list = []
        last: deque = deque(maxlen=window)
        for b in batches:
            for row in b[b.side == 1].itertuples(index=False):
                if len(first) < window:
                    first.append(row)
                last.append(row)
        part = TaskContext.get().partitionId()
        rows = [(part, 0, i, *r) for i, r in enumerate(first)] + [(part, 1, i, *r) for i, r in enumerate(last)]
        yield pd.DataFrame(rows, columns=["part", "end", "i", *columns]).astype({"place_id": "Int32"})

    border = laid.mapInPandas(ends, f"part int, end int, i int, sort_key string, {_PROFILE}").collect()
    border.sort(key=lambda r: (r.part, r.end, r.i))
    at = [[(r.part, tuple(r)[3:]) for r in border if r.end == end] for end in (0, 1)]
    ends_of = profiles.sparkSession.sparkContext.broadcast([([p for p, _ in rows], [r for _, r in rows]) for rows in at])

    def walk(upwards: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            part = TaskContext.get().partitionId()
            parts, ends = ends_of.value[1 if upwards else 0]
            if upwards:
                beside = ends[max(bisect_left(parts, part) - window, 0) : bisect_left(parts, part)]
            else:
                beside = ends[bisect_right(parts, part) :][:window][::-1]
            rows = ((r[2], _Profile(*r)) for b in batches for r in zip(*(b[c].tolist() for c in columns)))
            found: set = set()
            for pair in _behind(rows, deque((_Profile(*r) for r in beside), maxlen=window)):
                found.add(pair)
                if len(found) >= 10_000:
                    yield pd.DataFrame(list(found), columns=["left", "right", "name", "place", "web"])
                    found = set()
            yield pd.DataFrame(list(found), columns=["left", "right", "name", "place", "web"])

        return run

    schema = "left long, right long, name double, place int, web int"
    up = laid.mapInPandas(walk(True), schema)
    down = laid.sortWithinPartitions(*[F.desc(c) for c in order]).mapInPandas(walk(False), schema)
    return up.unionByName(down).distinct()


def _by_host(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of spellings, sorted by host, gathered into at most ``_APART`` organisations of a host and one row for all others.

    A spelling is taken for the organisation of an earlier one if the sound of
    one of its words, or a block code, is the same.
    """
    host, found, rest = None, [], 0
    signs: dict[str, int] = {}

    def told() -> pd.DataFrame:
        return pd.DataFrame([(host, *f) for f in found] + ([(host, "", rest)] if rest else []), columns=["host", "own", "n"])

    for b in batches:
        for row in b.itertuples(index=False):
            if row.host != host:
                if host is not None:
                    yield told()
                host, found, rest, signs = row.host, [], 0, {}
            words = tuple(row.own.split())
            mine = [s for s in map(sound, words) if len(s) > 1] + block_codes(words) if words else []
            at = next((signs[m] for m in mine if m in signs), None)
            if at is not None:
                found[at][1] += row.n
            elif words and len(found) < _APART:
                signs |= dict.fromkeys(mine, len(found))
                found.append([row.own, row.n])
            else:
                rest += row.n
    if host is not None:
        yield told()


def platforms(parsed: DataFrame) -> DataFrame:
    """``host, platform`` (true) of hosts whose ``PLATFORM_NAMES`` largest organisations have less than ``OWN_SHARE`` of the named rows.

    Spellings are gathered into organisations first, so however often one is
    seen, and mistyped, its site is its own. A worker holds ``_APART`` of them;
    a host's spellings are dealt to several workers, whose organisations are
    gathered again.
    """
    spelled = parsed.filter("host is not null and own <> ''").groupBy("host", "own").agg(F.count(F.lit(1)).alias("n"))
    many = spelled.groupBy("host").agg(F.count(F.lit(1)).alias("names")).filter(F.col("names") > PLATFORM_NAMES).select("host")
    part = spelled.join(many, "host").withColumn("share", F.pmod(F.hash("own"), F.lit(16)))
    part = part.repartition("host", "share").sortWithinPartitions("host", "share", F.desc("n"), "own").select(F.concat_ws(" ", "host", "share").alias("host"), "own", "n")
    part = part.mapInPandas(_by_host, "host string, own string, n long").withColumn("host", F.substring_index("host", " ", 1))
    whole = part.repartition("host").sortWithinPartitions("host", F.desc("n"), "own").mapInPandas(_by_host, "host string, own string, n long")
    sizes = whole.groupBy("host").agg(F.sum("n").alias("rows"), F.sort_array(F.collect_list(F.when(F.col("own") != "", F.col("n"))), asc=False).alias("sizes"))
    largest = F.aggregate(F.slice("sizes", 1, PLATFORM_NAMES), F.lit(0).cast("long"), lambda x, y: x + y)
    return sizes.filter(largest < OWN_SHARE * F.col("rows")).select("host", F.lit(True).alias("platform"))


def one_to_one(pairs: DataFrame, epsilon: float = 0.001) -> DataFrame:
    """``left_key, right_key, confidence``: an assignment in which no key stands twice, of the greatest total confidence.

    An auction: every left key without a partner bids, for the right key that is
    worth most to it at its price, as much as leaves it no better off than with
    its second choice, or with none; the highest bid gets the right key and sets its price. It
    ends when no one bids, with a total at most ``epsilon`` a pair below the
    greatest. A round is two aggregations and joins over the pairs; nothing but
    counts reaches the driver. Equal bids go to the smaller key; pairs
    of no positive confidence are left out; repeated pairs count once, with their greatest confidence.
    """
    pairs = cut(pairs.filter("confidence > 0 and left_key is not null and right_key is not null").groupBy("left_key", "right_key").agg(F.max("confidence").alias("confidence")))
    taken = cut(pairs.select("right_key", "left_key", F.col("confidence").alias("price")).limit(0))
    out = cut(pairs.select("left_key").limit(0))
    while True:
        bidders = pairs.join(taken.select("left_key"), "left_key", "left_anti").join(out, "left_key", "left_anti")
        worth = bidders.join(taken.select("right_key", "price"), "right_key", "left").withColumn("worth", F.col("confidence") - F.coalesce("price", F.lit(0.0)))
        dearest = W.partitionBy("left_key").orderBy(F.desc("worth"), "right_key")
        best = worth.withColumns({"place": F.row_number().over(dearest), "second": F.lead("worth").over(dearest)}).filter("place = 1")
        best = cut(best.select("left_key", "right_key", "confidence", "worth", F.greatest(F.coalesce("second", F.lit(0.0)), F.lit(0.0)).alias("second")))
        bids = best.filter(F.col("worth") > 0).select("left_key", "right_key", (F.col("confidence") - F.col("second") + epsilon).alias("price"))
        if bids.isEmpty():
            break
        out = cut(out.unionByName(best.filter(F.col("worth") <= 0).select("left_key")))
        both = bids.select("right_key", "left_key", "price").unionByName(taken)
        taken = cut(both.groupBy("right_key").agg(F.min_by(F.struct("left_key", "price"), F.struct(-F.col("price"), "left_key")).alias("w")).select("right_key", "w.left_key", "w.price"))
    return taken.join(pairs, ["left_key", "right_key"]).select("left_key", "right_key", "confidence")


def match_entities(left: DataFrame, right: DataFrame, places: DataFrame, window: int = WINDOW, assign: str = "sightings") -> DataFrame:
    """``left_key, right_key, confidence``: every left record's best right record, if it has any.

    Both tables: ``key, name, city, province, lat, lng, postal, phone,
    website``; other columns are ignored, any of these may be null or blank. A
    match needs names that agree in one place, or one web address and no
    contradicting names; names of general words alone don't agree. Right
    records are taken to be distinct entities. With ``assign='sightings'`` left ones are sightings of
    which an entity may have many, so each left record is assigned to one right
    record, the most confident (ties: the smaller key), which makes the total
    confidence greatest. With ``assign='entities'`` they are distinct too, and
    the assignment is one-to-one, see ``one_to_one``. Null keys are left out; repeated rows give one pair;
    an empty table gives none.
    """
    if assign not in ("sightings", "entities"):
        raise ValueError("assign must be 'sightings' or 'entities'")
    cols = ["name", "city", "province", "lat", "lng", "postal", "phone", "website"]
    rows = left.select("key", F.lit(0).alias("side"), *cols).unionByName(right.select("key", F.lit(1).alias("side"), *cols)).filter("key is not null")
    phone = F.regexp_extract(F.regexp_replace(F.regexp_replace(F.lower(F.col("phone")), r"ext.*$", ""), r"\D", ""), r"^1?(\d{10})$", 1)
    rows = rows.withColumns({"phone": F.when(phone != "", phone), "host": host(F.col("website")), "path": web_path(F.col("website"))})
    placed = locate(rows, places, carry=["side", "name", "host", "path", "lat", "lng", "phone"])
    parsed = placed.withColumn("place_keys", joined_keys()).mapInPandas(_parse, "key string, side int, host string, path string, lat double, lng double, phone string, place_id int, purpose string, given string, own string")
    parsed = cut(parsed)
    names = platforms(parsed)
    web = F.when(F.col("platform"), F.when(F.col("path") != "", F.concat_ws("/", "host", "path"))).otherwise(F.col("host"))
    parsed = parsed.join(names, "host", "left").withColumn("web", F.coalesce(web, F.lit(""))).filter("own <> '' or web <> ''")
    parsed = cut(parsed.withColumn("node", F.xxhash64(F.coalesce("place_id", F.lit(-1)), "purpose", "given", "own", "web")))
    profiles = parsed.select("node", "side", "place_id", "purpose", "given", "own", "web").distinct()
    pairs = sorted_neighbours(profiles, window)
    side = lambda s, name: parsed.filter(F.col("side") == s).select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("key", "lat", "lng", "phone")])
    met = pairs.join(side(1, "right"), "right").join(side(0, "left"), "left")
    apart = F.sqrt(F.pow(F.col("left_lat") - F.col("right_lat"), 2) + F.pow((F.col("left_lng") - F.col("right_lng")) * F.cos(F.radians("left_lat")), 2)) * 111.2
    point = F.when(apart < 0.3, 1.0).when(apart < 3, 0.5).when(apart.isNotNull(), 0.0)
    call = F.when(F.col("left_phone") == F.col("right_phone"), 1.0).when(F.col("left_phone").isNotNull() & F.col("right_phone").isNotNull(), 0.0)
    score = {"name": F.col("name"), "place": F.col("place").cast("double"), "web": F.col("web").cast("double"), "point": point, "phone": call}
    known = {k: c.isNotNull() for k, c in score.items()}
    total = sum((F.when(known[k], WEIGHTS[k] * c).otherwise(0.0) for k, c in score.items()), F.lit(0.0))
    weight = sum((F.when(known[k], WEIGHTS[k]).otherwise(0.0) for k in score), F.lit(0.0))
    met = met.withColumn("confidence", F.round(total / weight, 6))
    if assign == "entities":
        return one_to_one(met.select("left_key", "right_key", "confidence"))
    best = met.groupBy("left_key").agg(F.max_by(F.struct("right_key", "confidence"), F.struct("confidence", F.col("name"), F.translate("right_key", "0123456789abcdef", "fedcba9876543210"))).alias("b"))
    return best.select("left_key", "b.right_key", "b.confidence")
