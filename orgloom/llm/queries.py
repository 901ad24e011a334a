"""Queries of the subpackage's operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.llm import addresses, golden, matching, mixing, places, stuffing, tokenize, variants
from orgloom.session import cut


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.encode(read(spark, sf_dir, "documents"), "doc_id", "text")


def place_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed cities and provinces of org_candidates and enrichment_proposals, whole tables."""
    candidates = read(spark, sf_dir, "org_candidates")
    city = candidates.select(F.col("id").alias("record_id"), F.lit("city").alias("field"), F.col("city").alias("text"), "province", "lat", "lng")
    nothing = F.lit(None)
    province = candidates.select(F.col("id").alias("record_id"), F.lit("province").alias("field"), F.col("province").alias("text"), nothing.cast("string").alias("province"), nothing.cast("double").alias("lat"), nothing.cast("double").alias("lng"))
    proposed = read(spark, sf_dir, "enrichment_proposals").filter(F.col("field").isin("city", "province"))
    proposed = proposed.select(F.col("id").alias("record_id"), "field", F.col("proposed_value").alias("text"), nothing.cast("string").alias("province"), nothing.cast("double").alias("lat"), nothing.cast("double").alias("lng"))
    return city.unionByName(province).unionByName(proposed)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.map_to_places(place_records(spark, sf_dir), read(spark, sf_dir, "ref_places"))


def candidate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "org_candidates").select(F.col("id").alias("key"), "name", "city", "province", "lat", "lng", F.col("postal_code").alias("postal"), "website")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = read(spark, sf_dir, "search_targets").select(
        F.col("target_id").cast("string").alias("key"), "name", "city", F.lit(None).cast("string").alias("province"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"), F.lit(None).cast("string").alias("postal"), F.coalesce("website", "domain").alias("website")
    )
    pairs = variants.link_variants(targets, candidate_rows(spark, sf_dir), read(spark, sf_dir, "ref_places"))
    return pairs.select(F.col("target_key").cast("long").alias("target_id"), F.col("candidate_key").alias("candidate_id"))


def match_rows(table: DataFrame) -> DataFrame:
    return table.select(F.col("id").alias("key"), "name", "city", "province", "lat", "lng", F.col("postal_code").alias("postal"), "phone", "website")


def p3_matches(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    """Unresolved candidates and the organisations they are, with confidences."""
    candidates = read(spark, sf_dir, "org_candidates").filter("resolved_org_id is null")
    organizations = read(spark, sf_dir, "organizations").filter("merged_into is null")
    found = matching.match_entities(match_rows(candidates), match_rows(organizations), read(spark, sf_dir, "ref_places"), **how)
    return found.select(F.col("left_key").alias("candidate_id"), F.col("right_key").alias("org_id"), "confidence")


def p3_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same candidates taken for distinct entities: no candidate and no organisation stands twice."""
    return p3_matches(spark, sf_dir, assign="entities")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_matches(spark, sf_dir).select("candidate_id", "org_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden.surviving_records(read(spark, sf_dir, "organizations"), read(spark, sf_dir, "org_candidates"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "org_candidates").select(F.col("id").alias("key"), F.col("address_line1").alias("address"), "city", "province", "lat", "lng", F.col("postal_code").alias("postal"), "website")
    pairs = addresses.pairs_of_groups(addresses.address_groups(rows, read(spark, sf_dir, "ref_places")), "key", "address_group")
    return pairs.select(F.col("key_a").alias("candidate_id_a"), F.col("key_b").alias("candidate_id_b"))


def mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents, targets = read(spark, sf_dir, "documents"), read(spark, sf_dir, "mix_targets")
    sized = tokenize.encode(documents, "doc_id", "text", counts_only=True, carry=["source"]).withColumnRenamed("n_tokens", "size")
    return mixing.mix(cut(sized), targets), targets  # read several times, so encoded once


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mixture holds each document, by its size in tokens of byte_bpe_50k."""
    return mixture(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target and actual share of each source."""
    return mixing.mixture_shares(*mixture(spark, sf_dir))


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a document of each source is expected in a mixture by characters."""
    sizes = read(spark, sf_dir, "documents").groupBy("source").agg(F.coalesce(F.sum("n_chars"), F.lit(0)).alias("size"))
    rates = mixing.expected_copies(sizes, read(spark, sf_dir, "mix_targets"))
    return rates.select("source", F.round("weight", 9).alias("weight"), "max_repeats", "size", F.round("rate", 9).alias("rate"))


P9_RATES_SQL = """WITH s AS (SELECT source, CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS size FROM documents WHERE source IS NOT NULL GROUP BY 1),
    k AS (SELECT s.source, s.size, coalesce(t.max_repeats, 1) AS max_repeats, CASE WHEN t.weight > 0 AND s.size > 0 AND coalesce(t.max_repeats, 1) > 0 THEN t.weight ELSE 0 END AS w FROM s LEFT JOIN mix_targets t USING (source)),
    n AS (SELECT *, coalesce(w / nullif(sum(w) OVER (), 0), 0) AS weight FROM k),
    m AS (SELECT *, min(CASE WHEN weight > 0 THEN size * max_repeats / weight END) OVER () AS total FROM n)
    SELECT source, round(weight, 9) AS weight, max_repeats, size, round(CASE WHEN weight > 0 THEN least(weight * total / size, max_repeats) ELSE 0 END, 9) AS rate FROM m"""


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffing.stuffed(read(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p3_found": p3_found, "p3_matches": p3_matches, "p3_assigned": p3_assigned, "p4_found": p4_found, "p6_found": p6_found, "p8_ids": p8_ids, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p9_rates": p9_rates, "p10_found": p10_found}

ORACLES = {"p9_rates": P9_RATES_SQL}
