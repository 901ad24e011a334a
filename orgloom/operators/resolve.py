"""Candidates resolved to organisations in tiers: same address, same host nearby, near and of a like name."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgloom.functions.geo import flat_km, trigram_similarity, trigrams
from orgloom.functions.url import site_host, without_scheme
from orgloom.operators.skew import salted_join
from orgloom.session import cut

#: Half widths of the band within which names are compared, in degrees.
BAND_LAT, BAND_LNG = 0.0023, 0.0031
#: Candidates of one cell above which it is dealt to several tasks.
HOT_CELL = 2_000


def _side(df: DataFrame, prefix: str, *others: str) -> DataFrame:
    """What the tiers compare, written once: pieces of names as 64-bit hashes, how many they are, and two words in which each sets a bit."""
    site, host = without_scheme(F.col("website")), site_host(F.col("website"))
    hashes = trigrams(F.coalesce("name", F.lit("")), F.xxhash64)
    rows = df.select(
        F.col("id").alias(f"{prefix}_id"), hashes.alias(f"{prefix}_grams"), F.col("lat").alias(f"{prefix}_lat"), F.col("lng").alias(f"{prefix}_lng"),
        F.when(site != "", site).alias("site"), F.when(host != "", host).alias("host"), *others,
    )
    bits = lambda k: F.aggregate(f"{prefix}_grams", F.lit(0).cast("long"), lambda a, h: F.when(h.bitwiseAND(F.lit(64)) == 64 * k, a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int")))).otherwise(a))
    return cut(rows.withColumns({f"{prefix}_n": F.size(f"{prefix}_grams"), f"{prefix}_bits0": bits(0), f"{prefix}_bits1": bits(1)}))


def _similar() -> Column:
    return trigram_similarity(F.col("c_grams"), F.col("o_grams"))


def _may_be_alike(least: float) -> Column:
    """False only for names less alike than ``least``: a bit that one side alone has comes from a piece that it alone has."""
    n = F.col("c_n") + F.col("o_n")
    apart = F.bit_count(F.col("c_bits0").bitwiseXOR(F.col("o_bits0"))) + F.bit_count(F.col("c_bits1").bitwiseXOR(F.col("o_bits1")))
    return (n - apart) >= (n + apart) * (least - 1e-9)


def _near() -> Column:
    return flat_km(F.col("o_lat"), F.col("o_lng"), F.col("c_lat"), F.col("c_lng"))


def _near_pairs(c: DataFrame, o: DataFrame, on: str, km: float, least: float) -> DataFrame:
    """Pairs of equal ``on`` and like names at most ``km`` apart, joined by ``on`` and a grid cell together, so a host that many share is cut up by place.

    Rows of cells are as high as the distance, and columns as wide as it is at
    84 degrees of latitude; beyond that a row is one cell. One side is copied to the cells that the distance reaches from it.
    """
    high, wide = km / 111.32 * 1.001, km / 111.32 / math.cos(math.radians(84.1)) * 1.001
    polar = lambda row: F.greatest(F.abs(row), F.abs(row + 1)) * high > 84
    row, col = lambda s: F.floor(F.col(f"{s}_lat") / high), lambda lng: F.floor(lng / wide)
    c = c.filter("c_lat is not null and c_lng is not null").withColumn("row", row("c")).withColumn("col", F.when(polar(F.col("row")), 0).otherwise(col(F.col("c_lng"))))
    reach = high / F.cos(F.radians(F.least(F.abs("o_lat") + high, F.lit(84.1))))
    cols = F.when(polar(F.col("row")), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(col(F.col("o_lng") - reach), col(F.col("o_lng") + reach)))
    o = o.filter("o_lat is not null and o_lng is not null").withColumn("row", F.explode(F.array(*[row("o") + i for i in (-1, 0, 1)]))).withColumn("col", F.explode(cols))
    return c.join(o, [on, "row", "col"]).filter(_may_be_alike(least) & (_near() <= km) & (_similar() >= least)).drop("row", "col")


def _same_path(c: DataFrame, o: DataFrame) -> DataFrame:
    path = F.col("site").contains("/")
    return c.filter(path).select("c_id", "site").join(o.filter(path).select("o_id", "site"), "site")


def exact_tier(candidates: DataFrame, organizations: DataFrame, km: float = 2.0, least: float = 0.45) -> DataFrame:
    """Pairs of one web address: if it has a path, or else if the two are near and of a like name."""
    c, o, path = _side(candidates, "c").drop("host"), _side(organizations, "o").drop("host"), F.col("site").contains("/")
    both = _same_path(c, o).select("c_id", "o_id").unionByName(_near_pairs(c.filter(~path), o.filter(~path), "site", km, least).select("c_id", "o_id"))
    return both.select(F.col("c_id").alias("candidate_id"), F.col("o_id").alias("org_id"), F.lit("exact").alias("tier"), F.lit(1.0).alias("score"))


def domain_tier(candidates: DataFrame, organizations: DataFrame, km: float = 2.0, least: float = 0.45) -> DataFrame:
    """Pairs of one host, near and of a like name, where just one organisation is."""
    both = _near_pairs(_side(candidates, "c").drop("site"), _side(organizations, "o").drop("site"), "host", km, least)
    one = both.groupBy("c_id").agg(F.min("o_id").alias("org_id"), F.max("o_id").alias("last")).filter("org_id = last")
    return one.select(F.col("c_id").alias("candidate_id"), "org_id", F.lit("domain").alias("tier"), F.lit(0.9).alias("score"))


def _within_band(c: DataFrame, o: DataFrame, least: float) -> DataFrame:
    """``c_id, o_id, score`` of the pairs within the band whose names are alike.

    A band join would compare all with all; here one side gets its cell of a
    little more than twice the band's half widths, the other the cells that the band around it reaches, four as a rule, and the exact band is
    tested after the equality join. Each pair meets in one cell; cells of many
    candidates, as those of made-up coordinates, are dealt to several tasks.
    """
    cell = lambda x, half: F.floor(x / (half * 2.02))
    reached = lambda x, half: F.explode(F.sequence(cell(F.col(x) - half * 1.01, half), cell(F.col(x) + half * 1.01, half)))
    c = c.drop("site", "host").filter("c_lat is not null and c_lng is not null").withColumns({"row": cell(F.col("c_lat"), BAND_LAT), "col": cell(F.col("c_lng"), BAND_LNG)})
    o = o.drop("site", "host", "last").filter("o_lat is not null and o_lng is not null").withColumn("row", reached("o_lat", BAND_LAT)).withColumn("col", reached("o_lng", BAND_LNG))
    near = (F.abs(F.col("c_lat") - F.col("o_lat")) <= BAND_LAT) & (F.abs(F.col("c_lng") - F.col("o_lng")) <= BAND_LNG)
    both = salted_join(o, c, ["row", "col"], hot=HOT_CELL, written=True).filter(near & _may_be_alike(least)).withColumn("score", _similar())
    return both.filter(F.col("score") >= least).select("c_id", "o_id", "score")


def geoname_tier(candidates: DataFrame, organizations: DataFrame, least: float = 0.55) -> DataFrame:
    """Pairs within the band of latitude and longitude whose names are alike."""
    both = _within_band(_side(candidates, "c"), _side(organizations, "o"), least)
    return both.select(F.col("c_id").alias("candidate_id"), F.col("o_id").alias("org_id"), F.lit("geoname").alias("tier"), "score")


def resolve(candidates: DataFrame, organizations: DataFrame, km: float = 2.0, least: float = 0.45, least_near: float = 0.55) -> DataFrame:
    """One organisation for each candidate that any tier finds: the earliest tier, in it the best score, then the smallest id.

    Rows of equal name, site and place are compared once, of candidates by a 64-bit hash, of organisations as the
    smallest and the largest id. Both sides are written once. Pairs near under one host are made once for two tiers, as an address without
    a path is a host, and each tier is brought down to a row for a candidate before they meet.
    """
    alike = ["name", "website", "lat", "lng"]
    known = [F.isnull(x) for x in alike]  # else null and a value could change places
    candidates = candidates.select("id", F.xxhash64(*known, *alike).alias("key"), *alike)
    organizations = organizations.groupBy(*alike).agg(F.min("id").alias("id"), F.max("id").alias("last"))
    c, o = _side(candidates.dropDuplicates(["key"]).drop("id").withColumnRenamed("key", "id"), "c"), _side(organizations, "o", "last")
    # an address with a path says all, so of the many organisations that give one ("n/a") only the smallest id has to meet its candidates
    path = _same_path(c, o.groupBy("site").agg(F.min("o_id").alias("o_id")))
    same = (F.col("c_site") == F.col("o_site")) & ~F.col("c_site").contains("/")
    near = _near_pairs(c.withColumnRenamed("site", "c_site"), o.withColumnRenamed("site", "o_site"), "host", km, least).select("c_id", "o_id", "last", same.alias("same"))
    near = near.groupBy("c_id").agg(F.min(F.when(F.col("same"), F.col("o_id"))).alias("org"), F.min("o_id").alias("first"), F.max("last").alias("last"))
    # of a candidate only the earliest tier counts, so its row of the hosts is either exact or the domain's
    near = near.withColumn("rank", F.when(F.col("org").isNotNull(), 1).when(F.col("first") == F.col("last"), 2))
    hosts = near.filter("rank is not null").select("c_id", F.struct("rank", F.when(F.col("rank") == 1, -1.0).otherwise(-0.9).alias("less"), F.coalesce("org", "first").alias("org_id")).alias("best"))
    paths = path.select("c_id", F.struct(F.lit(1).alias("rank"), F.lit(-1.0).alias("less"), F.col("o_id").alias("org_id")).alias("best"))
    cells = _within_band(c, o, least_near).groupBy("c_id").agg(F.min(F.struct(F.lit(3).alias("rank"), (-F.col("score")).alias("less"), F.col("o_id").alias("org_id"))).alias("best"))
    found = paths.unionByName(hosts).unionByName(cells).groupBy("c_id").agg(F.min("best").alias("best"))
    tier = F.when(F.col("best.rank") == 1, "exact").when(F.col("best.rank") == 2, "domain").otherwise("geoname")
    found = candidates.select("id", "key").join(found, F.col("key") == F.col("c_id"))
    return found.select(F.col("id").alias("candidate_id"), F.col("best.org_id").alias("org_id"), tier.alias("tier"), (-F.col("best.less")).alias("score"))
