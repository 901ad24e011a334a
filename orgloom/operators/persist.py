"""What an extraction leaves behind: records of the pages, contacts, their provenance, context and the run's metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.functions.text import content_hash, short_hash

#: The kind of contact of each part of an answer.
CONTACT_KINDS = {"emails": "email", "phones": "phone", "socials": "social", "contact_forms": "contact_form"}


def source_records(pages: DataFrame, url: str, status: str, html: str, run_id: str, method: str) -> DataFrame:
    """One audit row for each page and run, to be appended: ``id, source_id, external_id, url, http_status, content_hash, meta``; no page is kept."""
    external = F.concat(F.lit(f"{run_id}:"), F.coalesce(F.col(url), F.lit("")))
    meta = F.to_json(F.struct(F.lit(run_id).alias("run_id"), F.lit(method).alias("method")))
    return pages.select(short_hash(external, 32).alias("id"), F.lit("web").alias("source_id"), external.alias("external_id"), F.col(url).alias("url"), F.col(status).alias("http_status"), content_hash(F.coalesce(F.col(html), F.lit(""))).alias("content_hash"), meta.alias("meta"))


def contacts(items: DataFrame, org: str) -> DataFrame:
    """``org_id, kind, value, label, source_url`` of kept items; one row for each contact, the last item's label and page."""
    kind = F.create_map(*[F.lit(x) for kv in CONTACT_KINDS.items() for x in kv])[F.col("kind")]
    rows = items.filter("kind <> 'raw_context'").select(F.col(org).alias("org_id"), kind.alias("kind"), "value", F.col("platform").alias("label"), "source_url", "seq")
    return rows.groupBy("org_id", "kind", "value").agg(F.max_by("label", F.when(F.col("label").isNotNull(), F.col("seq"))).alias("label"), F.max_by("source_url", "seq").alias("source_url"))


def provenance(found: DataFrame, records: DataFrame, method: str) -> DataFrame:
    """``org_id, kind, value, source_record_id, method`` of the contacts whose page is among the records; others leave none."""
    by_url = records.groupBy("url").agg(F.max("id").alias("source_record_id"))
    return found.join(by_url, found["source_url"] == by_url["url"]).select("org_id", "kind", "value", "source_record_id", F.lit(method).alias("method"))


def raw_contexts(items: DataFrame, org: str) -> DataFrame:
    """``org_id, raw_context``: the context of each organisation as blocks that name their page, in order; none where there is no context, so nothing is overwritten."""
    block = F.concat(F.lit("--- "), F.coalesce("source_url", F.lit("")), F.lit(" ---\n"), "value")
    rows = items.filter("kind = 'raw_context'").groupBy(F.col(org).alias("org_id")).agg(F.array_sort(F.collect_list(F.struct("seq", block.alias("t")))).alias("b"))
    return rows.select("org_id", F.array_join(F.transform("b", lambda b: b.t), "\n\n").alias("raw_context"))


def persisted_counts(found: DataFrame, org: str = "org_id") -> DataFrame:
    """How many contacts of each kind an organisation got: ``org_id, kind, n``."""
    return found.groupBy(F.col(org).alias("org_id"), "kind").agg(F.count(F.lit(1)).alias("n"))


def run_summary(domains: DataFrame, run: str, most: int = 20, longest: int = 500) -> DataFrame:
    """``run, pages_seen, orgs_updated, rejected, error`` of per-domain rows (``run, domain, pages, prompt_tokens, completion_tokens, error``).

    ``error`` is a JSON of the token totals and the first ``most`` errors (by
    domain, each cut to ``longest`` characters), null where there are neither.
    """
    message = F.concat_ws(": ", "domain", F.substring("error", 1, longest))
    ranked = domains.withColumn("__n", F.when(F.col("error").isNotNull(), F.row_number().over(W.partitionBy(run, F.col("error").isNull()).orderBy("domain", "error"))))
    tokens = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    kept = F.array_sort(F.collect_list(F.when(F.col("__n") <= most, F.struct(F.col("__n").alias("n"), message.alias("m")))))
    rows = ranked.groupBy(run).agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("pages_seen"), F.count_if(F.col("error").isNull()).alias("orgs_updated"), F.count_if(F.col("error").isNotNull()).alias("rejected"), tokens("prompt_tokens"), tokens("completion_tokens"), kept.alias("e"))
    detail = F.to_json(F.struct(F.struct(F.col("prompt_tokens").alias("prompt"), F.col("completion_tokens").alias("completion")).alias("tokens"), F.transform("e", lambda e: e.m).alias("errors")))
    told = (F.size("e") > 0) | (F.col("prompt_tokens") > 0) | (F.col("completion_tokens") > 0)
    return rows.select(run, "pages_seen", "orgs_updated", "rejected", F.when(told, detail).alias("error"))
