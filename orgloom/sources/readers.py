"""Readers of the engine's inputs. Live fetchers are tables of what they brought, so every run can be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.functions.geo import region_code

TAGGED_PLACES = "elements array<struct<type string, id long, lat double, lon double, center struct<lat double, lon double>, tags map<string,string>>>"
#: Platforms told by their name in an address, in the order in which they are tried.
SOCIAL_PLATFORMS = ["facebook", "instagram", "twitter", "youtube", "tiktok", "whatsapp"]
ANSWERS = "query_hash string, results array<struct<title string, url string, content string>>"


def table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, file or folder; columns and filters reach the scan."""
    return spark.read.parquet(path)


def tagged_places(spark: SparkSession, path: str, tags: dict[str, str] | None = None, area: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Elements of a map extract in JSON as candidate rows, see ``place_rows``."""
    return place_rows(spark.read.schema(TAGGED_PLACES).json(path, multiLine=True).select(F.explode("elements").alias("e")).select("e.*"), tags, area)


def place_rows(elements: DataFrame, tags: dict[str, str] | None = None, area: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Nodes and ways with certain tags within an area (west, south, east, north) as candidate rows: contact tags before plain ones, the centre where an element has no point."""
    e = elements.filter(F.col("type").isin("node", "way"))
    for name, value in (tags or {}).items():
        e = e.filter(F.col("tags")[name] == value)
    if area:
        west, south, east, north = area
        e = e.filter(F.coalesce("lat", "center.lat").between(south, north) & F.coalesce("lon", "center.lon").between(west, east))
    tag = lambda *names: F.coalesce(*[F.when(F.col("tags")[n] != "", F.col("tags")[n]) for n in names])
    street = F.concat_ws(" ", tag("addr:housenumber"), tag("addr:street"))
    social = F.map_filter(F.create_map(*[x for p in ("facebook", "instagram", "twitter", "youtube") for x in (F.lit(p), tag(f"contact:{p}", p))]), lambda k, v: v.isNotNull())
    return e.select(
        F.concat_ws("/", "type", F.col("id").cast("string")).alias("external_id"), tag("name", "name:en").alias("name"), tag("contact:phone", "phone").alias("phone"), tag("contact:email", "email").alias("email"), tag("contact:website", "website").alias("website"),
        F.when(street != "", street).alias("address_line1"), tag("addr:city").alias("city"), tag("addr:province", "addr:state").alias("province"), tag("addr:postcode").alias("postal_code"),
        F.coalesce("lat", "center.lat").alias("lat"), F.coalesce("lon", "center.lon").alias("lng"), social.alias("social"), F.to_json("tags").alias("raw"),
    )


def open_places(places: DataFrame, category: str, box: tuple[float, float, float, float], country: str) -> DataFrame:
    """Rows of a GeoParquet places table of one category within a box (west, south, east, north) and country, as candidate rows."""
    west, south, east, north = box
    wanted = (F.col("categories.primary") == category) | F.coalesce(F.array_contains("categories.alternate", category), F.lit(False))
    first = lambda c: F.get(F.col(c), F.lit(0))
    social = first_by_platform(F.col("socials")) if "socials" in places.columns else F.create_map().cast("map<string,string>")
    within = F.col("bbox.xmin").between(west, east) & F.col("bbox.ymin").between(south, north) & (first("addresses").country == country)
    return places.filter(wanted & within).select(
        F.col("id").alias("external_id"), F.col("names.primary").alias("name"), first("phones").alias("phone"), first("emails").alias("email"), first("websites").alias("website"),
        first("addresses").freeform.alias("address_line1"), first("addresses").locality.alias("city"), region_code(first("addresses").region).alias("province"), first("addresses").postcode.alias("postal_code"),
        ((F.col("bbox.ymin") + F.col("bbox.ymax")) / 2).alias("lat"), ((F.col("bbox.xmin") + F.col("bbox.xmax")) / 2).alias("lng"), social.alias("social"),
    )


def first_by_platform(addresses: Column) -> Column:
    """A map of the first address of each platform, by the first platform whose name stands in it."""
    low = lambda a: F.lower(a)
    named = F.transform(F.coalesce(addresses, F.array().cast("array<string>")), lambda a: F.struct(F.coalesce(*[F.when(low(a).contains(p), F.lit(p)) for p in SOCIAL_PLATFORMS]).alias("key"), a.alias("value")))
    known = F.filter(named, lambda x: x.key.isNotNull())
    once = F.filter(known, lambda x, i: ~F.exists(F.slice(known, 1, i), lambda y: y.key == x.key))
    return F.map_from_entries(once)


def latest_release(spark: SparkSession, path: str) -> str | None:
    """The tag a small JSON document names as the latest."""
    row = spark.read.schema("latest string").json(path, multiLine=True).first()
    return row.latest if row else None


def kept_answers(spark: SparkSession, path: str) -> DataFrame:
    """Search answers kept as JSON lines: one row for each hit, in order; unreadable lines count as not kept."""
    read = spark.read.schema(ANSWERS).json(path, mode="PERMISSIVE").filter("query_hash is not null and results is not null")
    return read.select("query_hash", F.posexplode("results").alias("seq", "r")).select("query_hash", "seq", "r.*")


def allowed_by_robots(urls: DataFrame, rules: DataFrame, url: str) -> DataFrame:
    """Adds ``allowed``: whether the longest rule (``origin, prefix, allow``) for a URL lets it be read; without one it is."""
    keyed = urls.select(F.col(url).alias("__url")).distinct().withColumns({"origin": F.regexp_extract("__url", r"^([a-z]+://[^/?#]+)", 1), "__path": F.regexp_extract("__url", r"^[a-z]+://[^/?#]+([^#]*)", 1)})
    hit = keyed.join(rules, "origin").filter((F.col("prefix") != "") & F.col("__path").startswith(F.col("prefix")))
    best = hit.groupBy("__url").agg(F.max_by("allow", F.struct(F.length("prefix"), F.col("allow"))).alias("allow"))
    return urls.join(best, urls[url] == best["__url"], "left").withColumn("allowed", F.coalesce("allow", F.lit(True))).drop("__url", "allow")
