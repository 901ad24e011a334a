"""The place each typed record is in, from its city, coordinates, postal code and website."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.llm.places import first_piece, match_texts
from orgloom.session import cut, small

#: Degrees within which a coordinate belongs to a city of the list.
REACH = 0.12


def host(website: Column) -> Column:
    """The bare host of a typed address: small letters, no scheme, www, port or path; null where there is none."""
    h = F.regexp_extract(F.lower(F.trim(website)), r"^(?:[a-z]+:)?/*(?:(?:www\d?|m)\.)?([^/?#:\s]+)", 1)
    return F.when(h.contains("."), h)


def forward_area(postal: Column) -> Column:
    """The first three signs of a postal code that begins like one; else null."""
    p = F.regexp_extract(F.translate(F.upper(postal), " -", ""), r"^([A-Z]\d[A-Z])", 1)
    return F.when(p != "", p)


def joined_keys() -> Column:
    """``place_keys`` as one text, which goes to Python more cheaply than an array; see ``split_keys``."""
    return F.array_join("place_keys", "|").alias("place_keys")


@lru_cache(maxsize=50_000)
def split_keys(keys: str | None) -> tuple[str, ...]:
    return tuple(keys.split("|")) if keys else ()


def _usual(rows: DataFrame, key: str, least: float) -> DataFrame:
    """The place that ``least`` of a key's placed rows share."""
    n = rows.filter(F.col(key).isNotNull() & F.col("sure").isNotNull()).groupBy(key, "sure").agg(F.count(F.lit(1)).alias("n"))
    n = n.groupBy(key).agg(F.max_by("sure", F.struct("n", "sure")).alias(f"by_{key}"), (F.max("n") / F.sum("n")).alias(f"{key}_share"))
    return n.filter(F.col(f"{key}_share") >= least)


def locate(rows: DataFrame, places: DataFrame, carry: list[str] = []) -> DataFrame:
    """``key``, the ``carry`` columns, ``place_id`` (null where nothing tells) and ``place_keys``, the folded names of the place.

    ``rows`` needs ``key, city, province, lat, lng, postal, website``, any of
    which may be null. The typed city decides if it names one entry of the list; of entries of one
    name the province typed beside it, the row's province, its coordinates and
    its postal area decide. A row without such a city is placed where
    nearly all rows of its postal area are, else by its coordinates, else where
    most rows of its postal area, then of its website's host, are. Distinct texts are matched once.
    """
    kept = [f"carried_{i}" for i in range(len(carry))]
    rows = rows.select("key", *[F.col(c).alias(k) for c, k in zip(carry, kept)], F.coalesce("city", F.lit("")).alias("city"), F.coalesce("province", F.lit("")).alias("typed"), "lat", "lng", forward_area(F.col("postal")).alias("area"), host(F.col("website")).alias("host"))
    texts = rows.filter("trim(city) <> ''").select(F.lit("city").alias("kind"), F.col("city").alias("text")).unionByName(rows.filter("trim(typed) <> ''").select(F.lit("province").alias("kind"), F.col("typed").alias("text")))
    meant = cut(match_texts(texts, places).filter("place_id is not null"))
    own = meant.filter("kind = 'province'").groupBy(F.col("text").alias("typed")).agg(F.max_by("code", F.struct("score", "code")).alias("own"))
    options = meant.filter("kind = 'city'").groupBy(F.col("text").alias("city")).agg(F.collect_list(F.struct("place_id", "at", "code", "score", "hint")).alias("options"))
    options = options.withColumn("options", first_piece(F.col("options")))
    one = F.size("options") == 1
    options = options.select("city", F.when(one, F.col("options")[0].place_id).alias("only"), F.when(~one, F.col("options")).alias("options"))
    near = places.filter("kind = 'city' and lat is not null").select(F.col("place_id").alias("by_point"), F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng"))
    cells = lambda c: F.floor(F.col(c) / 0.25).cast("int")
    shifts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    near = near.withColumn("s", F.explode(shifts)).select("by_point", "p_lat", "p_lng", (cells("p_lat") + F.col("s.i")).alias("row"), (cells("p_lng") + F.col("s.j")).alias("col"))
    points = rows.filter("lat is not null and lng is not null").select(F.round("lat", 2).alias("r_lat"), F.round("lng", 2).alias("r_lng")).distinct()
    points = points.withColumns({"row": cells("r_lat"), "col": cells("r_lng")}).join(near, ["row", "col"]).filter((F.abs(F.col("p_lat") - F.col("r_lat")) <= REACH) & (F.abs(F.col("p_lng") - F.col("r_lng")) <= REACH))
    points = points.groupBy("r_lat", "r_lng").agg(F.min_by("by_point", F.struct(F.abs(F.col("p_lat") - F.col("r_lat")) + F.abs(F.col("p_lng") - F.col("r_lng")), "by_point")).alias("by_point"))
    options, own, points = (small(cut(d)) for d in (options, own, points))
    rows = rows.withColumns({"r_lat": F.round("lat", 2), "r_lng": F.round("lng", 2)}).join(options, "city", "left").join(own, "typed", "left").join(points, ["r_lat", "r_lng"], "left")

    def weight(area: Column):
        def of(o):
            told = F.when(o.hint != "", F.when(o.hint == o.code, 0.3).otherwise(0.0)).otherwise(F.when(F.col("own") == o.code, 0.15).otherwise(0.0))
            return F.struct((o.score + told + F.when(o.place_id == F.col("by_point"), 0.2).otherwise(0.0) + F.when(o.place_id == area, 0.1).otherwise(0.0)).alias("score"), (-o.place_id).alias("minus"))

        return of

    chosen = lambda area: -F.array_max(F.transform("options", weight(area))).minus
    rows = cut(rows.withColumn("sure", F.when(F.col("options").isNull(), F.coalesce("only", "by_point"))).drop("city", "typed", "lat", "lng", "r_lat", "r_lng"))
    easy, hard = rows.filter("only is not null"), rows.filter("only is null")
    hard = hard.join(_usual(rows, "area", 0.6), "area", "left")
    # a postal area of one place is surer than a coordinate, which may be misplaced
    by_area = F.when(F.col("area_share") >= 0.9, F.col("by_area"))
    hard = hard.select("key", *kept, "host", F.coalesce(chosen(F.col("by_area")), by_area, "by_point", "by_area").alias("place_id"))
    lost = hard.filter("place_id is null and host is not null").drop("place_id").join(_usual(rows, "host", 0.8), "host", "left").select("key", *kept, F.col("by_host").alias("place_id"))
    found = hard.filter("place_id is not null or host is null").select("key", *kept, "place_id")
    placed = easy.select("key", *kept, F.col("only").alias("place_id")).unionByName(found).unionByName(lost)
    named = places.filter("kind = 'city'").select("place_id", F.transform(F.concat(F.array("name"), F.coalesce("alt_names", F.array())), lambda n: F.regexp_replace(F.lower(n), "[^a-z]", "")).alias("place_keys"))
    return placed.select("key", *kept, "place_id").join(named, "place_id", "left").select("key", *[F.col(k).alias(c) for c, k in zip(carry, kept)], "place_id", "place_keys")
