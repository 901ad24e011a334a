"""The engine's tables as it declares them, and their creation in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Tables in the order in which they are made.
TABLES = {
    "sources": "id string, label string, trust smallint, enabled boolean",
    "source_records": "id string, source_id string, external_id string, url string, fetched_at timestamp, http_status smallint, content_hash string, storage_path string, meta string",
    "organizations": "id string, name string, alt_names array<string>, slug string, status string, website string, phone string, email string, address_line1 string, city string, province string, postal_code string, lat double, lng double, province_source string, social map<string,string>, confidence smallint, verified_at timestamp, merged_into string, raw_context string, created_at timestamp, updated_at timestamp",
    "contacts": "id string, org_id string, kind string, value string, label string, is_primary boolean, valid boolean, invalid boolean, verification string, created_at timestamp, updated_at timestamp",
    "field_provenance": "id string, entity_type string, entity_id string, field string, source_record_id string, method string, confidence smallint, verified boolean, created_at timestamp",
    "org_candidates": "id string, source_id string, external_id string, name string, alt_name string, phone string, email string, website string, address_line1 string, city string, province string, postal_code string, lat double, lng double, social map<string,string>, raw string, run_id string, resolved_org_id string, created_at timestamp",
    "crawl_jobs": "id string, url string, domain string, org_id string, reason string, status string, attempts smallint, fail_category string, fail_reason string, queued_at timestamp, started_at timestamp, finished_at timestamp, next_attempt_at timestamp, run_id string",
    "extraction_runs": "id string, run_id string, started_at timestamp, finished_at timestamp, pages_seen int, orgs_created int, orgs_updated int, rejected int, error string",
    "suppression": "id string, kind string, value string, reason string, created_at timestamp",
    "search_query_ledger": "query_hash string, query string, target_domain string, template string, results_count int, run_id string, searched_at timestamp",
    "enrichment_proposals": "id string, run_id string, org_id string, candidate_id string, domain string, field string, proposed_value string, source_url string, evidence string, vetting string, vet_rule string, status string, created_at timestamp, applied_at timestamp",
}


def columns(spark: SparkSession) -> DataFrame:
    """``table, position, column, type`` of all tables."""
    rows = [(t, i, f.name, f.dataType.simpleString()) for t, ddl in TABLES.items() for i, f in enumerate(spark.createDataFrame([], ddl).schema)]
    return spark.createDataFrame(rows, "table string, position int, column string, type string")


def create_tables(spark: SparkSession, folder: str, dry_run: bool = False) -> list[str]:
    """Makes the tables that aren't there yet, empty, as Parquet; returns their names in order. With ``dry_run`` nothing is written."""
    made = []
    for table, ddl in TABLES.items():
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{table}.parquet")
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            continue
        made.append(table)
        if not dry_run:
            spark.createDataFrame([], ddl).write.parquet(at.toString())
    return made
