"""Claims from a queue and gates before requests, as set operations on a snapshot (one writer)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgloom.functions.url import canonical_seed, host, host_matches, without_scheme_and_slash


def claim(jobs: DataFrame, due: Column, order: list[Column], n: int, key: str, changed: dict[str, Column]) -> DataFrame:
    """The next snapshot of a queue: its first ``n`` due rows get the ``changed`` columns."""
    taken = jobs.filter(due).orderBy(*order).limit(n).select(key, F.lit(True).alias("__taken"))
    marked = jobs.join(taken, key, "left")
    return marked.select(*[F.when(F.col("__taken"), changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in jobs.columns])


def eligible(status: Column, next_attempt: Column, now: Column, domain: Column, domains: list[str] | None = None) -> Column:
    """Whether a job may be claimed: queued and due; with ``domains``, any job of these that isn't running and is due."""
    due = next_attempt.isNull() | (next_attempt <= now)
    if domains:
        return F.coalesce((status != "running") & domain.isin(domains) & due, F.lit(False))
    return F.coalesce((status == "queued") & due, F.lit(False))


def random_claim(jobs: DataFrame, due: Column, n: int, key: str, seed: int) -> DataFrame:
    """``n`` due rows in an order that a hash of their key and the seed gives, the same however the table is partitioned."""
    return jobs.filter(due).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), key)), key).limit(n)


def organisation_of_jobs(jobs: DataFrame, candidates: DataFrame, organizations: DataFrame) -> DataFrame:
    """``id, org_id, candidate_id, created``: the organisation of each job (``id, url, domain, org_id``).

    Its own; else that of the candidate of exactly its web address, resolved ones
    first, then the earliest; else the organisation of that address with the
    smallest id; else a new one, whose id is made of the
    candidate's (``created``). Null where no candidate has the address.
    """
    at = lambda c: without_scheme_and_slash(F.col(c))
    open_jobs = jobs.filter("org_id is null").select("id", at("url").alias("__site"))
    wanted = open_jobs.select("__site").distinct()
    c = candidates.select(at("website").alias("__site"), F.struct(F.col("resolved_org_id").isNull().alias("a"), "created_at", F.col("id").alias("c")).alias("o"), F.struct(F.col("id").alias("candidate_id"), "resolved_org_id").alias("v"))
    c = c.join(wanted, "__site", "left_semi").groupBy("__site").agg(F.min_by("v", "o").alias("v")).select("__site", "v.*")
    o = organizations.select(at("website").alias("__site"), "id").join(wanted, "__site", "left_semi").groupBy("__site").agg(F.min("id").alias("__org"))
    found = open_jobs.join(c, "__site").join(o, "__site", "left")
    made = F.concat(F.lit("new:"), "candidate_id")
    found = found.select("id", F.coalesce("resolved_org_id", "__org", made).alias("__found"), "candidate_id", F.coalesce("resolved_org_id", "__org").isNull().alias("created"))
    return jobs.join(found, "id", "left").select("id", F.coalesce("org_id", "__found").alias("org_id"), "candidate_id", F.coalesce("created", F.lit(False)).alias("created"))


def seeded(websites: DataFrame, site: str, blocked: list[str]) -> tuple[DataFrame, DataFrame]:
    """(``url, domain`` of jobs to be queued, ``inserted, skipped_blocked``) of web addresses."""
    rows = websites.select(canonical_seed(F.col(site)).alias("url")).withColumn("domain", host(F.col("url")))
    rows = rows.withColumn("__blocked", host_matches(F.col("domain"), blocked))
    return rows.filter(~F.col("__blocked")).drop("__blocked"), rows.agg(F.count_if(~F.col("__blocked")).alias("inserted"), F.count_if("__blocked").alias("skipped_blocked"))


def attempts_until_done(states: Column, retryable: list[int], most: int) -> Column:
    """``struct<attempts, last>`` of a request that is made again, ``most`` times in all, while it is answered by a retryable state or, null, not at all."""
    first = F.slice(states, 1, most)
    bad = lambda s: s.isNull() | s.isin(retryable)
    ends = F.array_position(F.transform(first, lambda s: F.when(bad(s), 0).otherwise(1)), 1)
    n = F.when(ends > 0, ends).otherwise(F.size(first)).cast("int")
    return F.struct(n.alias("attempts"), F.get(first, n - 1).alias("last"))


def changed_where(rows: DataFrame, condition: Column, changed: dict[str, Column]) -> DataFrame:
    """The next snapshot of a table in which rows that meet a condition get the ``changed`` columns."""
    return rows.select(*[F.when(condition, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in rows.columns])


def not_lately(requests: DataFrame, ledger: DataFrame, cached: DataFrame, key: str, at: str, now: Column, days: int) -> DataFrame:
    """Requests that weren't made in the last ``days`` days, or whose answer is kept anyway."""
    fresh = ledger.filter(F.col(at) > now - F.make_interval(days=F.lit(days))).select(key).distinct()
    blocked = fresh.join(cached.select(key).distinct(), key, "left_anti")
    return requests.join(blocked, key, "left_anti")
