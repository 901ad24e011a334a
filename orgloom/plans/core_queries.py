"""Queries of the two data-pipeline operators of the core (p5 and p7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.operators import proximity, quality

PROFILED = ["email", "phone", "province"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def p5_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile(read(spark, sf_dir, "organizations"), "load_id", PROFILED)


def p5_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.aggregates(read(spark, sf_dir, "organizations"), "load_id", PROFILED)


def p5_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.pattern_coverage(read(spark, sf_dir, "organizations"), "load_id", PROFILED)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.departed_loads(read(spark, sf_dir, "organizations"), "load_id", PROFILED).select("load_id", "column_name")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = read(spark, sf_dir, "org_candidates").filter(F.col("lat").between(41, 70) & F.col("lng").between(-142, -50))
    near = proximity.pairs_within(points, "id", "lat", "lng", 50.0)
    return near.select(F.col("id_a").alias("candidate_id_a"), F.col("id_b").alias("candidate_id_b"))


QUERIES = {"p5_found": p5_found, "p5_profile": p5_profile, "p5_aggregates": p5_aggregates, "p5_coverage": p5_coverage, "p7_found": p7_found}

ORACLES = {
    "p5_aggregates": """
        WITH v AS (
            SELECT load_id, 'email' AS column_name, nullif(email, '') AS raw FROM organizations UNION ALL SELECT load_id, 'phone', phone FROM organizations
            UNION ALL SELECT load_id, 'province', province FROM organizations
        ), c AS (SELECT load_id, column_name, CASE WHEN trim(raw) <> '' THEN raw END AS value, count(*) AS n FROM v GROUP BY ALL)
        SELECT load_id, column_name, CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (value IS NULL), 0) AS BIGINT) AS n_missing, count(value) AS n_distinct, min(value) AS min_value, max(value) AS max_value,
            CAST(min(length(value)) AS INT) AS min_length, CAST(max(length(value)) AS INT) AS max_length, max_by(value, {'n': n, 'v': value}) FILTER (value IS NOT NULL) AS top_value, max(n) FILTER (value IS NOT NULL) AS top_n
        FROM c GROUP BY 1, 2""",
    "p7_found": """
        WITH c AS (
            SELECT id, lat, lng, CAST(floor(lat * 2000) AS INT) AS band FROM org_candidates
            WHERE lat BETWEEN 41 AND 70 AND lng BETWEEN -142 AND -50
        ), n AS (SELECT id, lat, lng, unnest([band - 1, band, band + 1]) AS band FROM c)
        SELECT a.id AS candidate_id_a, b.id AS candidate_id_b
        FROM c a JOIN n b ON a.band = b.band AND a.id < b.id AND abs(a.lng - b.lng) < 0.0015
        WHERE 2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2)
              + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2)))) <= 50
        GROUP BY ALL""",
}
