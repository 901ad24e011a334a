"""Typed place names mapped to a canonical list of cities and provinces."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.llm.setjoin import grams, similar_keys
from orgloom.llm.text import edits, fold
from orgloom.session import cut

#: Spellings of provinces and territories that the list may lack, by code.
PROVINCE_SPELLINGS = {
    "AB": ["alberta", "alta"],
    "BC": ["british columbia", "brit columbia", "colombie britannique"],
    "MB": ["manitoba", "man"],
    "NB": ["new brunswick", "new bruns", "nouveau brunswick"],
    "NL": ["newfoundland and labrador", "newfoundland", "labrador", "nfld", "nf", "terre neuve", "terre neuve et labrador"],
    "NS": ["nova scotia", "nouvelle ecosse"],
    "NT": ["northwest territories", "northwest terr", "nwt", "territoires du nord ouest"],
    "NU": ["nunavut", "nvt"],
    "ON": ["ontario", "ont"],
    "PE": ["prince edward island", "prince edward isl", "pei", "ile du prince edouard"],
    "QC": ["quebec", "que", "pq"],
    "SK": ["saskatchewan", "sask"],
    "YT": ["yukon", "yukon territory", "yuk", "yk"],
}
#: Words around a place's name that aren't part of it.
AROUND = ["city of", "town of", "village of", "municipality of", "township of", "region of", "province of", "territory of", "ville de", "ville d'", "province de", "province du", "downtown", "greater", "area", "region", "city", "near", "the"]
#: Shortened first words of place names.
SHORT_FIRST = {"n": "north", "s": "south", "e": "east", "w": "west", "ft": "fort", "pt": "port", "mt": "mount", "st": "saint", "ste": "sainte", "upr": "upper", "up": "upper", "nw": "new", "lwr": "lower"}
COUNTRY = {"canada", "ca", "can", "cdn"}
#: Typed in place of a place.
NOT_A_PLACE = {"any", "all", "unknown", "none", "null", "na", "n a", "not in list", "select one", "other", "outside canada", "tbd", "online", "xx", "zz", "test", "various", "see website", "remote"}

_KEYED = "kind string, text string, key string, hint string"
_province = {re.sub(r"\W", "", s): code for code, spelled in PROVINCE_SPELLINGS.items() for s in [*spelled, code.lower()]}
_around = sorted(AROUND, key=len, reverse=True)


def _bare(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", text).strip()


def _unrepeated(words: list[str]) -> list[str]:
    half = len(words) // 2
    return words[:half] if half and words[:half] == words[half:] and len(words) % 2 == 0 else words


def split_places(text: str | None) -> tuple[list[str], str]:
    """(names, province code) of a typed city: of each piece that isn't a province the name, folded, without what stands around it; names without repeats, none empty."""
    s = fold(text or "")
    if not s or _bare(s) in NOT_A_PLACE:
        return [], ""
    hint, parts = "", []
    for piece in re.split(r"[,;/()\[\]|]| - |\s-|-\s", s):
        bare = _bare(piece)
        if not bare or bare in COUNTRY:
            continue
        code = _province.get(bare.replace(" ", ""))
        if code and (len(bare.replace(" ", "")) > 3 or len(bare) <= 3 or "." in piece):
            hint = hint or code
            continue
        parts.append(bare)
    names = []
    for part in parts:
        name, code = _one_place(part)
        hint = hint or code
        if name and name not in names:
            names.append(name)
    return names, hint


def _one_place(part: str) -> tuple[str, str]:
    words, hint = part.split(), ""
    for n in (3, 2, 1):  # a province behind or before the name, without a sign between
        if len(words) > n:
            if (code := _province.get("".join(words[-n:]))) and not (n > 1 and len("".join(words[-n:])) < 4):
                hint, words = hint or code, words[:-n]
            elif (code := _province.get("".join(words[:n]))) and n == 1 and len(words[0]) == 2 and words[0] not in SHORT_FIRST:
                hint, words = hint or code, words[n:]
    if len(words) > 1 and words[-1] in COUNTRY:
        words = words[:-1]
    name = " ".join(_unrepeated(words))
    for around in _around:
        if name.startswith(around + " ") and len(name) > len(around) + 3:
            name = name[len(around) + 1 :]
        if name.endswith(" " + around) and len(name) > len(around) + 3:
            name = name[: -len(around) - 1]
    words = _unrepeated(name.split())
    if len(words) > 1 and (len(words[0]) > 1 or len(words[1]) > 3):
        words[0] = SHORT_FIRST.get(words[0], words[0])
    name = "".join(words)
    return ("" if name in _province and len(name) > 3 else name), hint


def split_place(text: str | None) -> tuple[str, str]:
    """(name, province code) of a typed city, by its first piece; either may be empty."""
    names, hint = split_places(text)
    return (names[0] if names else ""), hint


def province_key(text: str | None) -> str:
    """A typed province, folded, without what stands around it; the code's first spelling where it is a known one."""
    s = fold(text or "")
    if not s or _bare(s) in NOT_A_PLACE:
        return ""
    found = ""
    for piece in re.split(r"[,;/()\[\]|]", s):
        bare = _bare(piece)
        for around in _around:
            if bare.startswith(around + " "):
                bare = bare[len(around) + 1 :]
        words = [w for w in bare.split() if w not in COUNTRY]
        joined = "".join(words)
        if joined in _province:
            return PROVINCE_SPELLINGS[_province[joined]][0].replace(" ", "")
        found = found or joined
    return found if found not in COUNTRY else ""


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        split = [split_places(t) if k == "city" else ([province_key(t)], "") for k, t in zip(b.kind, b.text)]
        out = [(k, t, key, hint, i) for k, t, (keys, hint) in zip(b.kind, b.text, split) for i, key in enumerate(keys or [""])]
        yield pd.DataFrame(out, columns=["kind", "text", "key", "hint", "at"]).astype({"at": "int32"})


def _with_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b.assign(set=[grams(k) for k in b.key])


def _close(key: str, entry: str) -> bool:
    """The exact check after the join: few enough edits for the length; short codes must be equal."""
    short = min(len(key), len(entry))
    if key == entry:
        return True
    if short < 4:
        return False
    return edits(key, entry, 4) <= (1 if short < 5 else 2 if short < 10 else 3 if short < 16 else 4)


def _close_ones(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b[[_close(k, e) for k, e in zip(b.key, b.entry)]]


def match_texts(texts: DataFrame, places: DataFrame, threshold: float = 0.35, slack: float = 0.1) -> DataFrame:
    """Entries each distinct text may mean: ``kind, text, at, hint, place_id, code, lat, lng, score``.

    ``texts`` has ``kind`` ('city' or 'province') and ``text``, both not null;
    ``places`` is the canonical list. Every piece of a text is looked up, ``at`` being its place in
    it; ``first_piece`` takes the first that means anything. Of a piece's entries those within
    ``slack`` of its best Jaccard similarity stay (two cities of one name do);
    a piece without any has one row with a null ``place_id``.
    """
    keyed = cut(texts.select("kind", "text").distinct().mapInPandas(_keys, f"{_KEYED}, at int"))
    named = places.select("place_id", "kind", F.col("province").alias("code"), "lat", "lng", F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("alt_names", F.array()), F.when(F.col("kind") == "province", F.array("province")).otherwise(F.array())))).alias("text"))
    named = named.filter(F.col("text").isNotNull())
    keyed_names = named.select("kind", "text").distinct().mapInPandas(_keys, f"{_KEYED}, at int").filter("at = 0").drop("hint", "at")
    entries = named.join(keyed_names, ["kind", "text"]).filter("key <> ''").select("place_id", "kind", "code", "lat", "lng", "key")
    spelled = F.create_map(*[x for code, names in PROVINCE_SPELLINGS.items() for x in (F.lit(code), F.array(*[F.lit(n.replace(" ", "")) for n in names if len(n) > 5]))])
    more = places.filter("kind = 'province'").select("place_id", "kind", F.col("province").alias("code"), "lat", "lng", F.explode(F.try_element_at(spelled, F.col("province"))).alias("key"))
    entries = cut(entries.unionByName(more).distinct())
    sets = lambda d: d.select("kind", "key").distinct().mapInPandas(_with_sets, "kind string, key string, set array<string>")
    # a key much longer than any entry can't be similar to one; its parts aren't even made
    longest = entries.agg(F.max(F.length("key"))).first()[0] or 0
    short = keyed.filter((F.col("key") != "") & (F.length("key") * threshold <= longest + 1))
    # every edit adds or takes three parts at most; as many edits as _close allows
    least = F.least("n_a", "n_b")
    gap = F.when(least < 3 * 5 + 1, 3).when(least < 3 * 10 + 1, 6).when(least < 3 * 16 + 1, 9).otherwise(12)
    pairs = similar_keys(cut(sets(short)), cut(sets(entries)), threshold, gap)
    pairs = pairs.withColumn("best", F.max("jaccard").over(W.partitionBy("kind", "key"))).filter(F.col("jaccard") >= F.col("best") - slack)
    pairs = pairs.filter((F.col("best") < 1) | (F.col("jaccard") == 1)).select("kind", "key", "entry", "jaccard").mapInPandas(_close_ones, "kind string, key string, entry string, jaccard double")
    meant = pairs.join(entries.withColumnRenamed("key", "entry"), ["kind", "entry"]).groupBy("kind", "key", "place_id", "code", "lat", "lng").agg(F.max("jaccard").alias("score"))
    return keyed.join(cut(meant), ["kind", "key"], "left").select("kind", "text", "at", "hint", "place_id", "code", "lat", "lng", "score")


def first_piece(options: Column) -> Column:
    """Of ``array<struct<place_id, at, ...>>`` those of the first piece that means an entry; empty where none does."""
    known = F.filter(options, lambda o: o.place_id.isNotNull())
    return F.filter(known, lambda o: o.at == F.array_min(F.transform(known, lambda p: p.at)))


def map_to_places(records: DataFrame, places: DataFrame, threshold: float = 0.35) -> DataFrame:
    """The entry each record's text means: ``record_id, field, place_id``; 0 where none is meant.

    ``records``: ``record_id, field, text`` and, as a help to tell cities of one
    name apart, ``province`` (typed, may be null), ``lat`` and ``lng`` (may be
    null). ``field`` is the kind of the entry looked for. Null, empty and blank
    texts are no records and give no row; texts that name no entry give 0; a
    repeated (record_id, field, text) gives one row. Ties that neither the
    province in the text, nor the record's own, nor its coordinates decide go
    to the smaller place_id. Very long texts are only compared in length. Other
    columns are ignored, and an empty list maps all to 0.

    Distinct texts are matched once, however often they occur; the records only
    meet the results by an equality join on (field, text).
    """
    rows = records.select("record_id", "field", "text", F.coalesce(F.col("province"), F.lit("")).alias("typed"), "lat", "lng").filter(F.trim(F.col("text")) != "")
    texts = rows.select(F.col("field").alias("kind"), "text").unionByName(rows.filter("field = 'city' and trim(typed) <> ''").select(F.lit("province").alias("kind"), F.col("typed").alias("text")))
    meant = match_texts(texts, places, threshold)
    typed = meant.filter("kind = 'province' and code is not null").groupBy(F.col("text").alias("typed")).agg(F.max_by("code", F.struct("score", "code")).alias("own"))
    one = meant.groupBy(F.col("kind").alias("field"), "text").agg(F.collect_list(F.struct("place_id", "at", "code", "lat", "lng", "score", "hint")).alias("options"))
    one = one.withColumn("options", first_piece(F.col("options")))
    rows = rows.join(one, ["field", "text"]).join(typed, "typed", "left")

    def weight(o):
        near = (F.abs(o.lat - F.col("lat")) < 0.3) & (F.abs(o.lng - F.col("lng")) < 0.3)
        by_hint = F.when(o.hint == "", F.when(F.col("own") == o.code, 0.15).otherwise(0.0)).otherwise(F.when(o.hint == o.code, 0.3).otherwise(0.0))
        return F.struct((o.score + by_hint + F.when(F.coalesce(near, F.lit(False)), 0.1).otherwise(0.0)).alias("score"), (-o.place_id).alias("minus"))

    best = F.array_max(F.transform("options", weight))
    return rows.select("record_id", "field", F.coalesce(-best.minus, F.lit(0)).cast("int").alias("place_id")).distinct()
