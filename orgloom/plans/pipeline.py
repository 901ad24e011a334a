"""Queries over crawl, extraction, search, job and report operators on the driver's tables.

What those steps get from elsewhere (pages fetched, answers of a model, search
results, states of a queue) is made of the tables' own rows by fixed rules,
which each query's SQL repeats.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.functions import text, url
from orgloom.operators import crawl, directory, enrich, first, jobs, payloads, persist, proximity, report, upsert
from orgloom.plans.catalogue import LIVE_SQL, NOW, SLOTS_SQL, suppressed_values
from orgloom.plans.core_queries import read
from orgloom.plans.expressions import FOUND_SQL, HOST_SQL, JUNK_SQL, PHONES_SQL, PLACE_PATTERN, PLACE_SQL, POSTAL_SQL, RUN_ON_SQL
from orgloom.plans.registry import Registry
from orgloom.session import shared_dir
from orgloom.sources import readers, schemas, writers

REGISTRY = Registry()
query = REGISTRY.query


def now() -> Column:
    return F.expr("TIMESTAMP_NTZ '2026-04-01 00:00:00'")


# --- fetching and crawling -------------------------------------------------------------------------

@query("""WITH u AS (SELECT url, min(doc_id) AS doc_id FROM documents WHERE url IS NOT NULL GROUP BY 1), p AS (SELECT u.url, d.doc_id, d.text FROM u JOIN documents d USING (doc_id)),
    r AS (SELECT url, doc_id, coalesce(text, '') AS text, CASE WHEN doc_id % 9 = 0 THEN 404 WHEN doc_id % 17 = 0 THEN 503 ELSE 200 END AS status, CASE WHEN doc_id % 13 = 0 THEN 'application/pdf' ELSE 'text/html' END AS ct,
        contains(url, '/n') AND NOT contains(url, '/ne') AS barred, regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) AS path FROM p),
    f AS (SELECT *, CASE WHEN starts_with(path, '/n') AND NOT starts_with(path, '/ne') THEN 'blocked by robots.txt' WHEN doc_id % 19 = 0 THEN 'error: connection failed' WHEN status >= 400 THEN 'status ' || status WHEN ct <> 'text/html' THEN 'not html: ' || ct
        WHEN strlen(text) < 500 THEN 'content too short: ' || length(text) || ' bytes' END AS reason FROM r)
    SELECT url, reason IS NULL AS ok, reason AS fail_reason, CASE WHEN reason IS NULL THEN length(text) ELSE 0 END AS n FROM f""")
def fetch_outcomes(spark, d):
    """What came of fetching each document's URL: its text is the page, numbers decide on states and types, and rules bar some paths."""
    docs = first.earliest(read(spark, d, "documents").filter("url is not null").select("url", "doc_id", "text"), ["url"], ["doc_id"])
    n = F.col("doc_id")
    pages = docs.filter(n % 19 != 0).select("url", F.col("url").alias("final_url"), F.when(n % 9 == 0, 404).when(n % 17 == 0, 503).otherwise(200).alias("status"), F.when(n % 13 == 0, "application/pdf").otherwise("text/html").alias("content_type"), F.col("text").alias("html"))
    origin = docs.select(F.regexp_extract("url", r"^([a-z]+://[^/?#]+)", 1).alias("origin")).distinct()
    rules = origin.select("origin", F.explode(F.array(F.struct(F.lit("/n").alias("prefix"), F.lit(False).alias("allow")), F.struct(F.lit("/ne").alias("prefix"), F.lit(True).alias("allow")))).alias("r")).select("origin", "r.*")
    return crawl.fetch_results(docs.select("url"), "url", pages, rules, []).select("url", "ok", "fail_reason", F.length("html").cast("long").alias("n"))


TREE_SQL = """ranked AS (SELECT domain, url, row_number() OVER (PARTITION BY domain ORDER BY doc_id, url) AS r, strlen(text) >= 500 AS ok FROM (
        SELECT url, min(doc_id) AS doc_id, min_by(domain, doc_id) AS domain, min_by(text, doc_id) AS text FROM documents WHERE url IS NOT NULL AND domain IS NOT NULL AND text IS NOT NULL GROUP BY 1)),
    reached AS (SELECT domain, url, r, ok, 0 AS level FROM ranked WHERE r = 1
        UNION ALL SELECT c.domain, c.url, c.r, c.ok, p.level + 1 FROM reached p JOIN ranked c ON c.domain = p.domain AND c.r // 2 = p.r AND c.r > 1 WHERE p.ok)"""


@query(f"""WITH RECURSIVE {TREE_SQL}, o AS (SELECT *, coalesce(sum(CAST(ok AS INT)) OVER (PARTITION BY domain ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY domain ORDER BY r) AS place FROM reached)
    SELECT domain, url, CAST(level AS INT) AS level, place, ok FROM o WHERE before < 10""")
def crawl_reach(spark, d):
    """Each domain's pages in the order of a crawl from its first one, until ten were good.

    The n-th page links to the pages 2n and 2n + 1, and back to the first.
    """
    docs = read(spark, d, "documents").filter("url is not null and domain is not null and text is not null")
    docs = first.earliest(docs.select("url", "doc_id", "domain", (F.octet_length("text") >= 500).alias("ok")), ["url"], ["doc_id"])
    docs = docs.withColumn("r", F.row_number().over(W.partitionBy("domain").orderBy("doc_id", "url")))
    to = docs.select("domain", F.col("url").alias("target"), F.col("r").alias("to"))
    down = docs.select("domain", "url", F.explode(F.array(F.struct((F.col("r") * 2).alias("to"), F.lit(0).alias("position")), F.struct((F.col("r") * 2 + 1).alias("to"), F.lit(1).alias("position")), F.struct(F.lit(1).alias("to"), F.lit(2).alias("position")))).alias("e"))
    edges = down.select("domain", "url", "e.to", "e.position").join(to, ["domain", "to"]).select("url", "target", "position")
    seeds = docs.filter("r = 1").select(F.col("url").alias("seed"), F.lit(False).alias("single"))
    found = crawl.reach(seeds, edges, docs.select("url", "ok"))
    return found.join(docs.select("url", "domain"), "url").select("domain", "url", "level", "place", "ok")


# --- answers of an extraction model -----------------------------------------------------------------

ANSWERS_SQL = f"""pages AS (SELECT domain, doc_id, url, text, row_number() OVER (PARTITION BY domain ORDER BY doc_id) AS k FROM documents WHERE domain IS NOT NULL AND text IS NOT NULL AND url IS NOT NULL),
    kept AS (SELECT * FROM pages WHERE k <= 10), e AS (SELECT DISTINCT domain, lower(unnest({FOUND_SQL.format("text")})) AS e FROM kept),
    mails AS (SELECT domain, e, row_number() OVER (PARTITION BY domain ORDER BY e) - 1 AS seq FROM e),
    domains AS (SELECT domain, length(domain) % 7 AS m, min_by(url, k) AS first_url, string_agg('--- page: ' || url || ' ---' || chr(10) || text, chr(10) ORDER BY k) AS corpus FROM kept GROUP BY 1),
    good AS (SELECT * FROM domains WHERE m NOT IN (0, 1, 2)),
    items AS (
        SELECT domain, 'emails' AS kind, seq, e AS value, coalesce((SELECT min_by(p.url, p.k) FROM kept p WHERE p.domain = mails.domain AND contains(p.text, mails.e)), first_url) AS source_url, CAST(NULL AS VARCHAR) AS platform FROM mails JOIN good USING (domain)
        UNION ALL SELECT domain, 'emails', 1000, 'ghost@' || domain, first_url, NULL FROM good
        UNION ALL SELECT domain, 'contact_forms', 0, first_url, first_url, NULL FROM good
        UNION ALL SELECT domain, 'contact_forms', 1, first_url || '/ghost', first_url, NULL FROM good
        UNION ALL SELECT domain, 'socials', 0, 'https://facebook.com/' || split_part(domain, '.', 1), 'https://x.test/', 'facebook' FROM good
        UNION ALL SELECT domain, 'raw_context', 0, 'about ' || domain, first_url, NULL FROM good),
    checked AS (SELECT i.*, CASE WHEN kind = 'raw_context' THEN true WHEN kind = 'emails' THEN contains(regexp_replace(lower(corpus), '[^a-z0-9]', '', 'g'), regexp_replace(lower(value), '[^a-z0-9]', '', 'g'))
        ELSE len(list_filter(regexp_extract_all(corpus, 'https?://[^\\s"''<>\\\\]+'), lambda u: lower(rtrim(split_part(split_part(replace(u, '&amp;', '&'), '#', 1), '?', 1), '/')) = lower(rtrim(split_part(split_part(value, '#', 1), '?', 1), '/'))
            AND starts_with(substr(split_part(replace(u, '&amp;', '&'), '#', 1), length(split_part(split_part(replace(u, '&amp;', '&'), '#', 1), '?', 1)) + 2), substr(split_part(value, '#', 1), length(split_part(split_part(value, '#', 1), '?', 1)) + 2)))) > 0 END AS verbatim FROM items i JOIN good USING (domain))"""


def answers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(``domain, answer``, pages) of a model that read each domain's first ten pages: it names their addresses as bare strings, some contacts that aren't there, and a seventh of its answers each are no JSON, no object, or of another shape."""
    pages = read(spark, d, "documents").filter("domain is not null and text is not null and url is not null").select("domain", "doc_id", "url", "text")
    pages = first.first_rows(pages, ["domain"], [F.col("doc_id")], 10)
    per = pages.groupBy("domain").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(text.emails(F.col("text")))))).alias("mails"), F.min_by("url", "doc_id").alias("first_url"))
    obj = lambda **kv: F.to_json(F.struct(*[v.alias(k) for k, v in kv.items()]))
    quoted = F.transform("mails", lambda m: F.concat(F.lit('"'), m, F.lit('"')))
    ghost = obj(value=F.concat(F.lit("ghost@"), "domain"), source_url=F.col("first_url"))
    mails = F.concat(F.lit('"emails":['), F.array_join(F.concat(quoted, F.array(ghost)), ","), F.lit("]"))
    forms = F.concat(F.lit('"contact_forms":["'), "first_url", F.lit('",'), obj(value=F.concat("first_url", F.lit("/ghost")), source_url=F.col("first_url")), F.lit("]"))
    social = F.concat(F.lit('"socials":['), obj(platform=F.lit("facebook"), value=F.concat(F.lit("https://facebook.com/"), F.split_part("domain", F.lit("."), F.lit(1))), source_url=F.lit("https://x.test/")), F.lit(',"https://unknown.test/"]'))
    context = F.concat(F.lit('"raw_context":['), obj(text=F.concat(F.lit("about "), "domain"), source_url=F.col("first_url")), F.lit("]"))
    whole = F.concat(F.lit("```json\n{"), F.concat_ws(",", mails, forms, social, context), F.lit("}\n```"))
    m = F.length("domain") % 7
    answer = F.when(m == 0, F.lit("Sorry, no contacts")).when(m == 1, F.lit("[1, 2]")).when(m == 2, F.when(F.length("domain") % 2 == 0, F.lit('{"emails": [{"value": "a@b.ca", "page": "x"}]}')).otherwise(F.lit('{"emails": [], "notes": []}'))).otherwise(whole)
    return per.select("domain", answer.alias("answer")), pages


def extraction(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    responses, pages = answers(spark, d)
    kept, dropped, errors = payloads.extracted(responses, pages, "domain", "answer", "doc_id", "url", "text", cap=10_000_000)
    return kept, dropped, errors, pages


@query(f"WITH {ANSWERS_SQL} SELECT domain, kind, value, source_url, platform FROM checked WHERE verbatim")
def payload_items(spark, d):
    """Contacts of the answers that their pages hold, with the page each was found on."""
    return extraction(spark, d)[0].select("domain", "kind", "value", "source_url", "platform")


@query(f"WITH {ANSWERS_SQL} SELECT kind, count(*) AS n FROM checked WHERE NOT verbatim GROUP BY 1")
def payload_dropped(spark, d):
    return payloads.dropped_counts(extraction(spark, d)[1])


@query(f"WITH {ANSWERS_SQL} SELECT domain, CASE m WHEN 0 THEN 'not JSON' WHEN 1 THEN 'not an object' ELSE CASE WHEN length(domain) % 2 = 0 THEN 'emails out of shape' ELSE 'unknown part' END END AS error FROM domains WHERE m IN (0, 1, 2)")
def payload_errors(spark, d):
    return extraction(spark, d)[2]


FANOUT_SQL = ANSWERS_SQL + """, contacts AS (SELECT domain AS org_id, CASE kind WHEN 'emails' THEN 'email' WHEN 'contact_forms' THEN 'contact_form' WHEN 'socials' THEN 'social' END AS kind, value, platform AS label, source_url FROM checked WHERE verbatim AND kind <> 'raw_context')"""


@query(f"WITH {FANOUT_SQL} SELECT org_id, kind, value, label FROM contacts")
def contacts_fanout(spark, d):
    return persist.contacts(extraction(spark, d)[0], "domain").select("org_id", "kind", "value", "label")


@query(f"WITH {FANOUT_SQL} SELECT org_id, kind, count(*) AS n FROM contacts GROUP BY 1, 2")
def persisted_counts(spark, d):
    return persist.persisted_counts(persist.contacts(extraction(spark, d)[0], "domain"))


@query(f"WITH {FANOUT_SQL}, r AS (SELECT url, max(left(sha256('run-1:' || url), 32)) AS id FROM kept GROUP BY 1) SELECT c.org_id, c.kind, c.value, r.id AS source_record_id, 'llm:v1' AS method FROM contacts c JOIN r ON r.url = c.source_url")
def provenance_fanout(spark, d):
    """The record of the page each contact was found on; contacts of pages that weren't read have none."""
    kept, _, _, pages = extraction(spark, d)
    records = persist.source_records(pages.withColumn("status", F.lit(200)), "url", "status", "text", "run-1", "llm:v1")
    return persist.provenance(persist.contacts(kept, "domain"), records, "llm:v1")


@query(f"WITH {ANSWERS_SQL} SELECT domain AS org_id, '--- ' || first_url || ' ---' || chr(10) || 'about ' || domain AS raw_context FROM good")
def raw_contexts(spark, d):
    return persist.raw_contexts(extraction(spark, d)[0], "domain")


@query("""SELECT left(sha256('run-1:' || coalesce(url, '')), 32) AS id, 'web' AS source_id, 'run-1:' || coalesce(url, '') AS external_id, url, CAST(200 AS INT) AS http_status, sha256(coalesce(text, '')) AS content_hash, '{"run_id":"run-1","method":"llm:v1"}' AS meta FROM documents""")
def source_audit(spark, d):
    """The audit row of every document read by a run."""
    return persist.source_records(read(spark, d, "documents").withColumn("status", F.lit(200)), "url", "status", "text", "run-1", "llm:v1")


@query("""WITH x AS (SELECT CAST(doc_id % 4 AS VARCHAR) AS run, coalesce(domain, 'none') || '/' || doc_id AS domain, CASE WHEN text IS NULL OR text = '' THEN 'no text' END AS error, coalesce(n_chars, 0) // 4 AS pt, 7 AS ct FROM documents),
    r AS (SELECT *, CASE WHEN error IS NOT NULL THEN row_number() OVER (PARTITION BY run, error IS NULL ORDER BY domain, error) END AS k FROM x)
    SELECT run, count(*) AS pages_seen, count(*) FILTER (error IS NULL) AS orgs_updated, count(*) FILTER (error IS NOT NULL) AS rejected,
        '{"tokens":{"prompt":' || CAST(sum(pt) AS BIGINT) || ',"completion":' || CAST(sum(ct) AS BIGINT) || '},"errors":[' || coalesce(string_agg('"' || domain || ': ' || error || '"', ',' ORDER BY k) FILTER (k <= 20), '') || ']}' AS error FROM r GROUP BY 1""")
def run_summary(spark, d):
    """Runs of the documents with token totals and their first twenty errors."""
    rows = read(spark, d, "documents").select((F.col("doc_id") % 4).cast("string").alias("run"), F.concat_ws("/", F.coalesce("domain", F.lit("none")), "doc_id").alias("domain"), F.lit(1).cast("long").alias("pages"), F.floor(F.coalesce("n_chars", F.lit(0)) / 4).alias("prompt_tokens"), F.lit(7).cast("long").alias("completion_tokens"), F.when(F.coalesce("text", F.lit("")) == "", "no text").alias("error"))
    return persist.run_summary(rows, "run")


@query("""WITH s AS (SELECT doc_id, n_chars * 300 AS c, 131072 - 8192 - 6000 AS w, 100000 + doc_id % 50000 AS r FROM documents WHERE n_chars > 200),
    a AS (SELECT doc_id, c, CAST(floor(c * least(0.8 * w / r, 0.9)) AS BIGINT) AS a1, least(0.8 * w / r, 0.9) AS f FROM s), b AS (SELECT *, CAST(floor(a1 * f) AS BIGINT) AS a2 FROM a), e AS (SELECT *, CAST(floor(a2 * f) AS BIGINT) AS a3 FROM b)
    SELECT doc_id, c AS first_size, CAST(1 + (a1 >= 20000)::INT + (a2 >= 20000)::INT + (a3 >= 20000)::INT AS INT) AS tries, CASE WHEN a3 >= 20000 THEN a3 WHEN a2 >= 20000 THEN a2 WHEN a1 >= 20000 THEN a1 ELSE c END AS last_size FROM e""")
def shrunk_corpora(spark, d):
    """The sizes to which corpora are cut when a model reports too many tokens."""
    sizes = payloads.shrunk_budgets(F.lit(100_000) + F.col("doc_id") % 50_000, F.col("n_chars") * 300, 131_072 - 8_192 - 6_000)
    rows = read(spark, d, "documents").filter("n_chars > 200").select("doc_id", sizes.alias("s"))
    return rows.select("doc_id", F.get("s", F.lit(0)).alias("first_size"), F.size("s").alias("tries"), F.element_at("s", -1).alias("last_size"))


@query("SELECT count(*) AS n, CAST(sum(coalesce(n_chars, 0)) AS BIGINT) AS prompt_tokens, CAST(sum(doc_id % 100) AS BIGINT) AS completion_tokens, CAST(sum(doc_id % 1000) AS BIGINT) AS latency_ms, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS characters FROM documents")
def answer_usage(spark, d):
    rows = read(spark, d, "documents").select("text", F.coalesce("n_chars", F.lit(0)).alias("prompt_tokens"), (F.col("doc_id") % 100).alias("completion_tokens"), (F.col("doc_id") % 1000).alias("latency_ms"))
    return payloads.usage(rows, "text", "prompt_tokens", "completion_tokens", "latency_ms")


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY doc_id) AS k FROM documents WHERE domain IS NOT NULL AND text IS NOT NULL),
    w AS (SELECT domain, string_agg(text, chr(10) || chr(10) ORDER BY doc_id) AS t FROM k WHERE k <= 10 GROUP BY 1) SELECT domain, md5(left(t, 2000)) AS hash, length(t) > 2000 AS truncated FROM w""")
def capped_corpora(spark, d):
    """Texts of each domain's first ten pages, cut hard at a size, with whether they were."""
    docs = read(spark, d, "documents").filter("domain is not null and text is not null")
    return first.joined_in_order(docs, ["domain"], "doc_id", F.col("text"), "\n\n", 10, longest=2000).select("domain", F.md5("text").alias("hash"), "truncated")


# --- jobs ------------------------------------------------------------------------------------------

JOBS_SQL = """jobs AS (SELECT id, domain, coalesce(source_url, '') AS url, org_id, CASE WHEN status = 'open' THEN 'queued' WHEN status = 'applied' THEN 'done' ELSE 'failed' END AS status, CASE WHEN vetting = 'verified' THEN 'blocked' END AS fail_category, length(field) % 3 AS attempts,
    CASE WHEN field = 'phone' THEN created_at + INTERVAL 600 DAY END AS next_attempt_at, created_at AS queued_at, CAST(NULL AS TIMESTAMP) AS started_at, run_id FROM enrichment_proposals)"""


def job_rows(spark: SparkSession, d: str) -> DataFrame:
    """Proposals taken for the jobs of a queue."""
    p = read(spark, d, "enrichment_proposals")
    return p.select(
        "id", "domain", F.coalesce("source_url", F.lit("")).alias("url"), "org_id", F.when(F.col("status") == "open", "queued").when(F.col("status") == "applied", "done").otherwise("failed").alias("status"), F.when(F.col("vetting") == "verified", "blocked").alias("fail_category"), (F.length("field") % 3).alias("attempts"),
        F.when(F.col("field") == "phone", F.col("created_at") + F.expr("INTERVAL 600 DAYS")).alias("next_attempt_at"), F.col("created_at").alias("queued_at"), F.lit(None).cast("timestamp_ntz").alias("started_at"), "run_id",
    )


@query(f"""WITH {JOBS_SQL}
    SELECT id, coalesce(status = 'queued' AND (next_attempt_at IS NULL OR next_attempt_at <= {NOW}), false) AS due, coalesce(status <> 'running' AND domain IN ('mosque.example', 'a.test') AND (next_attempt_at IS NULL OR next_attempt_at <= {NOW}), false) AS targeted FROM jobs""")
def eligible_jobs(spark, d):
    """Jobs that may be claimed, by the queue's rule and by that for named domains."""
    j = job_rows(spark, d)
    of = lambda domains: jobs.eligible(F.col("status"), F.col("next_attempt_at"), now(), F.col("domain"), domains)
    return j.select("id", of(None).alias("due"), of(["mosque.example", "a.test"]).alias("targeted"))


@query(f"""WITH {JOBS_SQL}, k AS (SELECT *, CASE WHEN status = 'queued' AND (next_attempt_at IS NULL OR next_attempt_at <= {NOW}) THEN row_number() OVER (PARTITION BY status = 'queued' AND (next_attempt_at IS NULL OR next_attempt_at <= {NOW}) ORDER BY queued_at, id) END AS k FROM jobs)
    SELECT id, CASE WHEN k <= 40 THEN 'running' ELSE status END AS status, CASE WHEN k <= 40 THEN attempts + 1 ELSE attempts END AS attempts, CASE WHEN k <= 40 THEN {NOW} END AS started_at FROM k""")
def job_claims(spark, d):
    """The queue after a claim of the forty oldest due jobs: running, one attempt more."""
    j = job_rows(spark, d)
    due = jobs.eligible(F.col("status"), F.col("next_attempt_at"), now(), F.col("domain"))
    got = jobs.claim(j, due, [F.col("queued_at"), F.col("id")], 40, "id", {"status": F.lit("running"), "attempts": F.col("attempts") + 1, "started_at": now()})
    return got.select("id", "status", F.col("attempts").cast("long").alias("attempts"), "started_at")


SITE_B_SQL = "lower(regexp_replace(regexp_replace(coalesce({0}, ''), '^https?://(www\\.)?', ''), '/+$', ''))"


@query(f"""WITH c AS (SELECT {SITE_B_SQL.format("website")} AS site, min_by({{'id': id, 'r': resolved_org_id}}, {{'a': resolved_org_id IS NULL, 'b': created_at, 'c': id}}) AS v FROM org_candidates GROUP BY 1),
    o AS (SELECT {SITE_B_SQL.format("website")} AS site, min(id) AS org FROM organizations GROUP BY 1), j AS (SELECT CAST(target_id AS VARCHAR) AS id, org_id, {SITE_B_SQL.format("coalesce(website, 'https://' || domain)")} AS site FROM search_targets)
    SELECT j.id, coalesce(j.org_id, c.v.r, CASE WHEN c.site IS NOT NULL THEN coalesce(o.org, 'new:' || c.v.id) END) AS org_id, CASE WHEN j.org_id IS NULL THEN c.v.id END AS candidate_id, j.org_id IS NULL AND c.site IS NOT NULL AND c.v.r IS NULL AND o.org IS NULL AS created
    FROM j LEFT JOIN c ON c.site = j.site LEFT JOIN o ON o.site = j.site""")
def job_organisations(spark, d):
    """The organisation of each target's web address: its own, its candidate's, one of that address, or a new one."""
    j = read(spark, d, "search_targets").select(F.col("target_id").cast("string").alias("id"), F.coalesce("website", F.concat(F.lit("https://"), "domain")).alias("url"), "domain", "org_id")
    return jobs.organisation_of_jobs(j, read(spark, d, "org_candidates"), read(spark, d, "organizations"))


@query(f"""WITH s AS (SELECT CASE WHEN regexp_matches(trim(website), '^[A-Za-z][A-Za-z0-9+.-]*:') THEN trim(website) ELSE 'https://' || trim(website) END AS u FROM org_candidates WHERE trim(website) <> ''), h AS (SELECT {HOST_SQL.format("u")} AS h FROM s)
    SELECT count(*) FILTER (NOT b) AS inserted, count(*) FILTER (b) AS skipped_blocked FROM (SELECT regexp_matches(h, '(^|\\.)(moonode\\.com|islaminfo\\.com|google\\.com|docs\\.google\\.com|facebook\\.com|instagram\\.com|twitter\\.com|x\\.com|youtube\\.com|wa\\.me|whatsapp\\.com|linkedin\\.com|yellowpages\\.ca|yelp\\.ca)$') AS b FROM h)""")
def seed_counts(spark, d):
    """How many websites become jobs, and how many are on the list of hosts that never do."""
    return jobs.seeded(read(spark, d, "org_candidates").filter("trim(website) <> ''"), "website", url.BLOCKED_HOSTS)[1]


@query(f"""WITH {JOBS_SQL}, p AS (SELECT url, min_by({{'s': status, 'f': fail_category}}, id) AS v FROM jobs WHERE url <> '' GROUP BY 1),
    n AS (SELECT DISTINCT url FROM documents WHERE url IS NOT NULL UNION SELECT url FROM p WHERE length(url) % 2 = 0)
    SELECT coalesce(p.url, n.url) AS url, CASE WHEN p.url IS NULL THEN 'queued' WHEN n.url IS NOT NULL AND p.v.s = 'failed' AND (p.v.f IS NULL OR p.v.f <> 'blocked') THEN 'queued' ELSE p.v.s END AS status FROM p FULL JOIN n ON n.url = p.url""")
def jobs_requeued(spark, d):
    """The queue after seeding: new addresses are queued, known ones only if they failed and aren't blocked."""
    old = first.earliest(job_rows(spark, d).filter("url <> ''").select("url", "id", "status", "fail_category"), ["url"], ["id"]).drop("id")
    new = read(spark, d, "documents").filter("url is not null").select("url").union(old.filter(F.length("url") % 2 == 0).select("url")).distinct()
    new = new.withColumns({"status": F.lit("queued"), "fail_category": F.lit(None).cast("string")})
    again = lambda o, n: (F.col(f"{o}.status") == "failed") & (F.col(f"{o}.fail_category").isNull() | (F.col(f"{o}.fail_category") != "blocked"))
    return upsert.upsert(old, new, ["url"], {"status": "replace"}, when=again).select("url", "status")


# --- upserts ----------------------------------------------------------------------------------------

EDGE = "TIMESTAMP '2025-06-01'"


@query(f"""WITH k AS (SELECT org_id, field AS kind, proposed_value AS value, min(created_at) AS a, max(created_at) AS b, min_by(vet_rule, {{'a': created_at, 'i': id}}) AS l, max_by(vet_rule, {{'a': created_at, 'i': id}}) AS m FROM enrichment_proposals WHERE org_id IS NOT NULL AND proposed_value IS NOT NULL AND field IN ('email', 'phone') GROUP BY 1, 2, 3)
    SELECT org_id, kind, value, CASE WHEN a < {EDGE} AND b < {EDGE} THEN l WHEN a < {EDGE} THEN coalesce(CASE WHEN length(value) % 2 = 0 THEN m END, l) ELSE CASE WHEN length(value) % 2 = 0 THEN m END END AS label,
        CASE WHEN b >= {EDGE} THEN b ELSE a END AS updated_at FROM k""")
def contacts_upsert(spark, d):
    """Contacts touched by a later run: a new label only where it has one."""
    p = read(spark, d, "enrichment_proposals").filter("org_id is not null and proposed_value is not null and field in ('email', 'phone')")
    keys = ["org_id", "kind", "value"]
    k = p.groupBy("org_id", F.col("field").alias("kind"), F.col("proposed_value").alias("value")).agg(F.min("created_at").alias("a"), F.max("created_at").alias("b"), F.min_by("vet_rule", F.struct("created_at", "id")).alias("l"), F.max_by("vet_rule", F.struct("created_at", "id")).alias("m"))
    edge = F.expr("TIMESTAMP_NTZ '2025-06-01 00:00:00'")
    old = k.filter(F.col("a") < edge).select(*keys, F.col("l").alias("label"), F.col("a").alias("updated_at"))
    new = k.filter(F.col("b") >= edge).select(*keys, F.when(F.length("value") % 2 == 0, F.col("m")).alias("label"), F.col("b").alias("updated_at"))
    return upsert.upsert(old, new, keys, {"label": "coalesce_new", "updated_at": "replace"})


@query("""SELECT org_id AS entity_id, field, max_by(id, {'a': created_at, 'i': id}) AS source_record_id, max_by(run_id, {'a': created_at, 'i': id}) AS method FROM enrichment_proposals WHERE org_id IS NOT NULL GROUP BY 1, 2""")
def provenance_upsert(spark, d):
    """The latest origin of each field: later rows replace earlier ones."""
    p = read(spark, d, "enrichment_proposals").filter("org_id is not null").select(F.col("org_id").alias("entity_id"), "field", F.col("id").alias("source_record_id"), F.col("run_id").alias("method"), "created_at", "id")
    late = F.expr("TIMESTAMP_NTZ '2025-06-01 00:00:00'")
    last = lambda rows: first.first_rows(rows, ["entity_id", "field"], [F.desc("created_at"), F.desc("id")]).drop("created_at", "id")
    return upsert.upsert(last(p.filter(F.col("created_at") < late)), last(p.filter(F.col("created_at") >= late)), ["entity_id", "field"], {"source_record_id": "replace", "method": "replace"})


@query(f"""WITH {SLOTS_SQL}, q AS (SELECT substr(sha256(lower(trim(s.q))), 1, 32) AS query_hash, s.t AS template, t.requested_at, slot FROM slots JOIN search_targets t USING (target_id)),
    o AS (SELECT query_hash, min_by(slot, {{'a': requested_at, 'b': slot}}) AS n, min(requested_at) AS at FROM q WHERE requested_at < {EDGE} GROUP BY 1), n AS (SELECT query_hash, max_by(slot, {{'a': requested_at, 'b': slot}}) AS n, max(requested_at) AS at FROM q WHERE requested_at >= {EDGE} GROUP BY 1)
    SELECT coalesce(o.query_hash, n.query_hash) AS query_hash, CAST(coalesce(o.n, n.n) AS INT) AS results_count, coalesce(n.at, o.at) AS searched_at FROM o FULL JOIN n ON n.query_hash = o.query_hash""")
def ledger_upsert(spark, d):
    """The ledger of queries after a run: their time is renewed, the count of their results isn't."""
    t = read(spark, d, "search_targets")
    q = enrich.slots_of(t, "target_id", "mosque", "Canada").join(t.select("target_id", "requested_at"), "target_id")
    edge, order = F.expr("TIMESTAMP_NTZ '2025-06-01 00:00:00'"), F.struct("requested_at", "slot")
    old = q.filter(F.col("requested_at") < edge).groupBy("query_hash").agg(F.min_by("slot", order).alias("results_count"), F.min("requested_at").alias("searched_at"))
    new = q.filter(F.col("requested_at") >= edge).groupBy("query_hash").agg(F.max_by("slot", order).alias("results_count"), F.max("requested_at").alias("searched_at"))
    return upsert.upsert(old, new, ["query_hash"], {"searched_at": "replace"})


@query("""SELECT id, label, CAST(trust AS INT) AS trust FROM sources UNION ALL SELECT DISTINCT source, source, 50 FROM documents WHERE source IS NOT NULL AND source NOT IN (SELECT id FROM sources)""")
def sources_seeded(spark, d):
    """Sources completed by those of the documents; known ones stay as they are."""
    s = read(spark, d, "sources").select("id", "label", F.col("trust").cast("int").alias("trust"))
    new = read(spark, d, "documents").filter("source is not null").select(F.col("source").alias("id"), F.col("source").alias("label"), F.lit(50).alias("trust")).distinct()
    return upsert.insert_missing(s, new.unionByName(s.withColumn("trust", F.lit(0))), ["id"])


@query("""WITH c AS (SELECT resolved_org_id AS id, min_by(email, id) FILTER (email <> '') AS email FROM org_candidates WHERE resolved_org_id IS NOT NULL GROUP BY 1)
    SELECT o.id, 'update' AS change FROM organizations o JOIN c USING (id) WHERE o.email IS NULL AND c.email IS NOT NULL UNION ALL SELECT id, 'delete' FROM organizations WHERE status = 'inactive' AND NOT EXISTS (SELECT 1 FROM c WHERE c.id = organizations.id AND organizations.email IS NULL AND c.email IS NOT NULL)
    UNION ALL SELECT 'candidate:' || id, 'insert' FROM org_candidates WHERE resolved_org_id IS NULL AND source_id = 'manual'""")
def dry_run(spark, d):
    """What a write of filled, dropped and new organisations would change, without writing."""
    o, c = read(spark, d, "organizations"), read(spark, d, "org_candidates")
    found = c.filter("resolved_org_id is not null and email <> ''").groupBy(F.col("resolved_org_id").alias("id")).agg(F.min_by("email", "id").alias("email"))
    filled = upsert.fill_nulls(o.select("id", "email", "status"), "id", found, ["email"])
    gained = filled.join(o.filter("email is null").select("id"), "id", "left_semi").filter("email is not null").select("id")
    kept = filled.filter("status <> 'inactive' or status is null").unionByName(filled.filter("status = 'inactive'").join(gained, "id", "left_semi"))
    new = c.filter("resolved_org_id is null and source_id = 'manual'").select(F.concat(F.lit("candidate:"), "id").alias("id"), "email", F.lit("new").alias("status"))
    return upsert.changes(o.select("id", "email", "status"), kept.unionByName(new), ["id"])


@query("""WITH v AS (SELECT p.*, row_number() OVER (PARTITION BY p.org_id, field ORDER BY created_at, id) AS k FROM enrichment_proposals p SEMI JOIN organizations o ON o.id = p.org_id WHERE vetting = 'verified' AND status = 'open' AND proposed_value IS NOT NULL),
    w AS (SELECT org_id AS id, max(proposed_value) FILTER (field = 'email' AND k = 1) AS email, max(proposed_value) FILTER (field = 'city' AND k = 1) AS city, max(proposed_value) FILTER (field = 'province' AND k = 1) AS province FROM v GROUP BY 1),
    r AS (SELECT org_id AS id, min_by(proposed_value, {'a': created_at, 'i': id}) AS pair FROM v WHERE field = 'province' AND vet_rule = 'table_agrees' GROUP BY 1)
    SELECT o.id, coalesce(o.email, w.email) AS email, coalesce(o.city, w.city) AS city, coalesce(o.province, CASE WHEN w.city IS NOT NULL THEN coalesce(w.province, r.pair) ELSE w.province END) AS province FROM organizations o LEFT JOIN w USING (id) LEFT JOIN r USING (id)""")
def verified_applied(spark, d):
    """Organisations after open verified proposals filled their nulls; a city brings the province verified with it."""
    p = read(spark, d, "enrichment_proposals").filter("vetting = 'verified' and status = 'open' and proposed_value is not null")
    return enrich.applied(p, read(spark, d, "organizations"), ["email", "city", "province"], ["created_at", "id"], "table_agrees")[0].select("id", "email", "city", "province")


@query("""SELECT id, CASE WHEN vetting = 'verified' AND status = 'open' AND proposed_value IS NOT NULL AND org_id IN (SELECT id FROM organizations) THEN 'applied' ELSE status END AS status FROM enrichment_proposals""")
def proposals_marked(spark, d):
    """Proposals with those marked that were applied."""
    p = read(spark, d, "enrichment_proposals")
    done = enrich.applied(p.filter("vetting = 'verified' and status = 'open' and proposed_value is not null"), read(spark, d, "organizations"), ["email"], ["created_at", "id"], "table_agrees")[1]
    return directory.flagged(p, done, "id", "done").select("id", F.when(F.col("done"), "applied").otherwise(F.col("status")).alias("status"))


@query("""SELECT org_id, min_by(proposed_value, {'a': created_at, 'i': id}) AS value FROM enrichment_proposals WHERE field = 'province' AND vet_rule = 'table_agrees' AND proposed_value IS NOT NULL GROUP BY 1""")
def paired_provinces(spark, d):
    """The province verified with each organisation's city; rows without an organisation are one group."""
    return enrich.paired(read(spark, d, "enrichment_proposals").filter("proposed_value is not null"), "org_id", "province", "table_agrees", ["created_at", "id"])


@query("""WITH f AS (SELECT o.id AS org, c.id AS cand FROM org_candidates c JOIN organizations o ON o.website = c.website WHERE c.website <> '' AND o.merged_into IS NULL), b AS (SELECT cand, min(org) AS org FROM f GROUP BY 1)
    SELECT c.id, coalesce(c.resolved_org_id, b.org) AS resolved_org_id FROM org_candidates c LEFT JOIN b ON b.cand = c.id""")
def links_stamped(spark, d):
    """Candidates with the organisation of exactly their website where none is set."""
    c, o = read(spark, d, "org_candidates"), read(spark, d, "organizations").filter("merged_into is null and website <> ''")
    found = c.select("id", "website").join(o.groupBy("website").agg(F.min("id").alias("resolved_org_id")), "website").select("id", "resolved_org_id")
    return upsert.fill_nulls(c.select("id", "resolved_org_id"), "id", found, ["resolved_org_id"])


# --- searches ---------------------------------------------------------------------------------------

@query(f"""WITH {SLOTS_SQL}, q AS (SELECT target_id, slot, substr(sha256(lower(trim(s.q))), 1, 32) AS h FROM slots), kept AS (SELECT DISTINCT h FROM q WHERE target_id % 6 = 0), live AS (SELECT DISTINCT h FROM q WHERE target_id % 6 <> 1),
    c AS (SELECT target_id, slot, h IN (SELECT h FROM kept) AS cached, h IN (SELECT h FROM live) AS answered FROM q),
    b AS (SELECT *, coalesce(sum(CASE WHEN answered AND NOT cached THEN 1 ELSE 0 END) OVER (ORDER BY target_id, slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM c)
    SELECT target_id, CAST(slot AS INT) AS slot, CASE WHEN cached THEN 'cache' WHEN answered AND spent < 200 THEN 'live' ELSE 'none' END AS source, CAST(least(spent, 200) AS BIGINT) AS credits FROM b""")
def search_answers(spark, d):
    """Where each slot's answer comes from: the cache for free, a search while the budget of 200 lasts, or nowhere."""
    slots = enrich.slots_of(read(spark, d, "search_targets"), "target_id", "mosque", "Canada")
    kept, live = slots.filter("target_id % 6 = 0"), slots.filter("target_id % 6 <> 1")
    return enrich.answered(slots, ["target_id", "slot"], kept, live, 200).select("target_id", "slot", "source", "credits")


@query("""WITH e AS (SELECT user_id, CASE event_id % 10 WHEN 3 THEN 432 WHEN 5 THEN 429 WHEN 7 THEN 500 ELSE 200 END AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    n AS (SELECT *, sum((s = 432)::INT) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS dropped FROM e), l AS (SELECT * FROM n WHERE coalesce(dropped, 0) < 3)
    SELECT user_id, count(*) FILTER (s = 200) AS credits, count(*) FILTER (s = 432) AS dropped, count(*) AS calls, count(*) FILTER (s = 432) >= 3 AS stopped FROM l GROUP BY 1""")
def key_pools(spark, d):
    """Pools of three keys, one for each user, by what their calls are answered."""
    state = F.get(F.array(*[F.lit(x) for x in (200, 200, 200, 432, 200, 429, 200, 500, 200, 200)]), (F.col("event_id") % 10).cast("int"))
    calls = read(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", state.alias("s")))).alias("e"))
    p = calls.select("user_id", enrich.key_pool(F.transform("e", lambda e: e.s), 3).alias("p")).select("user_id", "p.*")
    return p.select("user_id", *[F.col(c).cast("long").alias(c) for c in ("credits", "dropped", "calls")], "stopped")


@query("""WITH s AS (SELECT doc_id, domain, CASE WHEN contains(lower(text), 'contact') THEN 4 ELSE 0 END + CASE WHEN contains(text, '@') THEN 3 ELSE 0 END - CASE WHEN contains(text, 'http') THEN 2 ELSE 0 END AS score FROM documents WHERE domain IS NOT NULL AND text IS NOT NULL)
    SELECT doc_id, domain, CAST(score AS INT) AS score, CAST(row_number() OVER (PARTITION BY domain ORDER BY score DESC, doc_id) AS INT) AS place FROM s""")
def hits_by_score(spark, d):
    """Hits of each domain by a sum of weighted terms, best first, then as they came."""
    score = enrich.term_score({"contact": (F.lower("text"), 4), "@": (F.col("text"), 3), "http": (F.col("text"), -2)})
    hits = read(spark, d, "documents").filter("domain is not null and text is not null").select("doc_id", "domain", score.alias("score"))
    return enrich.ranked_hits(hits, ["domain"], "score", "doc_id")


@query(f"""WITH t AS (SELECT doc_id, url, text, concat(' ', url, ' ', text) AS t FROM documents WHERE text IS NOT NULL AND url IS NOT NULL),
    e AS (SELECT doc_id, unnest(list_transform({FOUND_SQL.format("t")}, lambda x: lower(x))) AS e, generate_subscripts({FOUND_SQL.format("t")}, 1) AS i FROM t),
    c AS (SELECT doc_id, {RUN_ON_SQL.format("e")} AS e, i FROM e), k AS (SELECT doc_id, e, min(i) AS i FROM c WHERE NOT ({JUNK_SQL.format("e")}) AND NOT regexp_matches(e, '\\.(png|jpe?g|gif|webp|css|js|svg)$') GROUP BY 1, 2),
    m AS (SELECT doc_id, e, row_number() OVER (PARTITION BY doc_id ORDER BY (split_part(e, '@', 1) NOT IN ('info', 'admin', 'contact', 'office', 'masjid', 'administrator', 'secretary', 'imam')), length(e), i) AS n FROM k),
    f AS (SELECT doc_id, text, nullif(upper(regexp_extract(t, '\\b([A-PR-Wa-pr-w]\\d[A-PR-Za-pr-w])\\s?\\d[A-PR-Za-pr-w]\\d\\b', 1)), '') AS postal_code, {PLACE_SQL} AS city, {PHONES_SQL.format("t")}[1] AS phone,
        list_filter(list_zip(list_transform(regexp_extract_all(t, {PLACE_PATTERN}, 1), lambda c: lower(trim(c))), regexp_extract_all(t, {PLACE_PATTERN}, 2)), lambda p: length(p[1]) > 2)[1][2] AS told FROM t),
    p AS (SELECT doc_id, 'email' AS field, e AS value FROM m WHERE n <= 2 UNION ALL SELECT doc_id, 'phone', left(phone, 3) || '-' || substr(phone, 4, 3) || '-' || right(phone, 4) FROM f WHERE phone IS NOT NULL UNION ALL SELECT doc_id, 'postal_code', postal_code FROM f WHERE postal_code IS NOT NULL
        UNION ALL SELECT doc_id, 'city', city FROM f WHERE city IS NOT NULL UNION ALL SELECT doc_id, 'province', {POSTAL_SQL} FROM f WHERE {POSTAL_SQL} IS NOT NULL UNION ALL SELECT doc_id, 'province', told FROM f WHERE postal_code IS NULL AND told IS NOT NULL)
    SELECT p.doc_id, field, lower(value) AS value, url AS source_url, left(CASE WHEN text <> '' THEN text ELSE '' END, 300) AS evidence FROM p JOIN t USING (doc_id)""")
def hit_proposals(spark, d):
    """What documents, as hits, propose for their domains (values in small letters)."""
    hits = read(spark, d, "documents").filter("text is not null and url is not null").select("doc_id", F.lit("").alias("title"), "url", F.col("text").alias("content"))
    return enrich.proposals_of(hits, "doc_id").withColumn("value", F.lower("value"))


@query("""WITH g AS (SELECT org_id, list(DISTINCT CASE WHEN field = 'postal_code' THEN 'province' ELSE field END) AS got FROM enrichment_proposals WHERE org_id IS NOT NULL GROUP BY 1),
    o AS (SELECT id AS org_id FROM organizations)
    SELECT o.org_id FROM o LEFT JOIN g USING (org_id) WHERE NOT (list_contains(coalesce(got, []), 'email') AND list_contains(coalesce(got, []), 'province'))""")
def targets_still_missing(spark, d):
    """Organisations for which proposals don't cover both the address and the province."""
    targets = read(spark, d, "organizations").select(F.col("id").alias("org_id"), F.array(F.lit("email"), F.lit("province")).alias("missing"))
    found = read(spark, d, "enrichment_proposals").filter("org_id is not null").select("org_id", "field")
    return enrich.still_missing(targets, found, "org_id").select("org_id")


@query("""WITH c AS (SELECT resolved_org_id AS id, bool_or(email <> '') AS e, bool_or(phone <> '') AS p, bool_or(province <> '') AS v FROM org_candidates WHERE resolved_org_id IS NOT NULL GROUP BY 1)
    SELECT field, n FROM (SELECT count(*) FILTER (coalesce(c.e, false) AND o.email IS NULL) AS email, count(*) FILTER (coalesce(c.p, false) AND o.phone IS NULL) AS phone, count(*) FILTER (coalesce(c.v, false) AND o.province IS NULL) AS province FROM organizations o LEFT JOIN c USING (id)) UNPIVOT (n FOR field IN (email, phone, province))""")
def enrichment_gain(spark, d):
    """How many organisations their candidates would give an address, a number and a province they lack."""
    fields = ["email", "phone", "province"]
    c = read(spark, d, "org_candidates").filter("resolved_org_id is not null").groupBy(F.col("resolved_org_id").alias("id")).agg(*[F.max(F.when(F.col(f) != "", F.col(f))).alias(f"found_{f}") for f in fields])
    o = read(spark, d, "organizations").select("id", *[F.col(f).isNotNull().alias(f"have_{f}") for f in fields]).join(c, "id", "left")
    return report.enrichment_gains(o, fields)


@query("SELECT source_id, count(*) AS n FROM org_candidates WHERE resolved_org_id IS NULL GROUP BY 1")
def unresolved_counts(spark, d):
    return read(spark, d, "org_candidates").filter("resolved_org_id is null").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT h AS host, count(*) AS n FROM (VALUES ('google.com'), ('facebook.com'), ('instagram.com'), ('twitter.com'), ('x.com'), ('youtube.com'), ('yelp.ca'), ('wa.me'), ('linkedin.com'), ('wikipedia.org')) v(h) GROUP BY 1")
def blocklist_union(spark, d):
    """Two lists of hosts as one set."""
    lists = spark.createDataFrame([(["google.com", "facebook.com", "instagram.com", "twitter.com", "x.com", "youtube.com", "yelp.ca"], ["wa.me", "linkedin.com", "wikipedia.org", "facebook.com"])], "a array<string>, b array<string>")
    return lists.select(F.explode(F.array_union("a", "b")).alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("n"))


# --- the directory and its reports ------------------------------------------------------------------

@query(f"""WITH {LIVE_SQL}, domains AS (SELECT DISTINCT domain FROM enrichment_proposals WHERE status = 'dismissed' AND domain <> ''), manual AS (SELECT DISTINCT resolved_org_id AS id FROM org_candidates WHERE source_id = 'manual'),
    gone AS (SELECT DISTINCT org_id FROM enrichment_proposals WHERE status = 'dismissed' AND org_id IS NOT NULL), prov AS (SELECT c.org_id, string_agg(DISTINCT p.vet_rule, ',' ORDER BY p.vet_rule) AS methods, coalesce(bool_or(contains(lower(p.source_url), 'contact')), false) AS from_contact
        FROM contacts c JOIN enrichment_proposals p ON p.org_id = c.org_id AND p.field = 'email' WHERE c.kind = 'email' GROUP BY 1)
    SELECT o.id, CASE WHEN lower(o.email) IN (SELECT lower(value) FROM suppressed WHERE kind = 'email') THEN NULL ELSE o.email END AS email,
        CASE WHEN regexp_replace(o.phone, '\\D', '', 'g') IN (SELECT regexp_replace(value, '\\D', '', 'g') FROM suppressed WHERE kind = 'phone' AND regexp_replace(value, '\\D', '', 'g') <> '') THEN NULL ELSE o.phone END AS phone,
        o.id IN (SELECT org_id FROM gone) AS org_suppressed, coalesce(EXISTS (SELECT 1 FROM domains s WHERE contains(lower(o.website), s.domain)), false) AS domain_suppressed, o.id IN (SELECT id FROM manual WHERE id IS NOT NULL) AS has_manual_edits,
        coalesce(p.methods, '') AS methods, coalesce(p.from_contact, false) AS from_contact
    FROM organizations o LEFT JOIN prov p ON p.org_id = o.id WHERE o.status <> 'merged' AND o.merged_into IS NULL""")
def directory_flags(spark, d):
    """Live organisations with suppressed values blanked, the three flags, and where their address was found."""
    p, o = read(spark, d, "enrichment_proposals"), read(spark, d, "organizations").filter("status <> 'merged' and merged_into is null")
    gone = suppressed_values(spark, d)
    dismissed = p.filter("status = 'dismissed'")
    sites = o.select("id", F.lower("website").alias("site")).filter("site is not null")
    by_domain = directory.containing(sites, "site", dismissed.filter("domain <> ''").select("domain").distinct(), "domain", 12).select("id")
    manual = read(spark, d, "org_candidates").filter("source_id = 'manual'").select(F.col("resolved_org_id").alias("id"))
    found = p.filter("field = 'email' and org_id is not null").select("org_id", "vet_rule", "source_url", F.lit("email").alias("kind"))
    proven = directory.contact_origin(directory.contacts_of(read(spark, d, "organizations")), found, "vet_rule", "source_url", "email")
    o = directory.blanked(directory.blanked(o, "email", gone, "email"), "phone", gone, "phone")
    o = directory.flagged(o, dismissed.filter("org_id is not null").select(F.col("org_id").alias("id")), "id", "org_suppressed")
    o = directory.flagged(directory.flagged(o, by_domain, "id", "domain_suppressed"), manual, "id", "has_manual_edits").join(proven.withColumnRenamed("org_id", "id"), "id", "left")
    return o.select("id", "email", "phone", "org_suppressed", "domain_suppressed", "has_manual_edits", F.coalesce("methods", F.lit("")).alias("methods"), F.coalesce("from_contact", F.lit(False)).alias("from_contact"))


LEADS_SQL = f"""l AS (SELECT coalesce(o.name, c.name, p.domain, 'Unknown organisation') AS org, p.id, p.field, p.proposed_value AS value, p.source_url, coalesce(p.vet_rule, 'unreviewed_field') AS rule, p.status,
        lower(split_part(regexp_replace(coalesce(p.source_url, ''), '^https?://(www\\.)?', ''), '/', 1)) AS sh, lower(split_part(regexp_replace(coalesce(p.domain, ''), '^https?://(www\\.)?', ''), '/', 1)) AS dh
        FROM enrichment_proposals p LEFT JOIN organizations o ON o.id = p.org_id LEFT JOIN org_candidates c ON c.id = p.candidate_id WHERE p.status <> 'dismissed' AND p.proposed_value IS NOT NULL),
    v AS (SELECT *, CASE WHEN rule IN ('email_domain_match', 'email_on_own_page', 'phone_on_own_page', 'fsa_own_page', 'province_fsa_own_page', 'city_table_agrees') THEN 'confirmed' ELSE 'review' END AS level FROM l),
    r AS (SELECT *, row_number() OVER (PARTITION BY lower(org), field, lower(value) ORDER BY level <> 'confirmed', id) AS k FROM v),
    leads AS (SELECT org AS o, CASE field WHEN 'email' THEN 'Email' WHEN 'phone' THEN 'Phone' WHEN 'city' THEN 'City' WHEN 'province' THEN 'Province' WHEN 'postal_code' THEN 'Postal code' WHEN 'website' THEN 'Website' ELSE field END AS f, value AS v, coalesce(source_url, '') AS u,
        coalesce(nullif(sh, ''), nullif(dh, ''), '') AS h, level AS l, status = 'applied' AS a FROM r WHERE k = 1)"""


def leads(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "enrichment_proposals").filter("status <> 'dismissed' and proposed_value is not null")
    o = read(spark, d, "organizations").select(F.col("id").alias("org_id"), F.col("name").alias("org_name"))
    c = read(spark, d, "org_candidates").select(F.col("id").alias("candidate_id"), F.col("name").alias("candidate_name"))
    bare = lambda x: F.lower(F.split_part(F.regexp_replace(F.coalesce(F.col(x), F.lit("")), r"^https?://(www\.)?", ""), F.lit("/"), F.lit(1)))
    rows = p.join(o, "org_id", "left").join(c, "candidate_id", "left").select(F.coalesce("org_name", "candidate_name", "domain", F.lit("Unknown organisation")).alias("org"), "domain", "field", F.col("proposed_value").alias("value"), "source_url", bare("source_url").alias("site_host"), bare("domain").alias("domain_host"), F.coalesce("vet_rule", F.lit("unreviewed_field")).alias("rule"), "status", "id")
    return report.lead_rows(rows, "id")


@query(f"WITH {LEADS_SQL} SELECT o, f, v, u, h, l, a, row_number() OVER (ORDER BY l <> 'confirmed', lower(o), f, v, u) AS place FROM leads")
def lead_report(spark, d):
    """Leads as shown, each value of an organisation once, in the report's order."""
    rows = leads(spark, d).select("o", "f", "v", "u", "h", "l", "a")
    return first.numbered(rows, [F.when(F.col("l") != "confirmed", 1).otherwise(0).alias("x"), F.lower("o").alias("y"), F.col("f"), F.col("v"), F.col("u")], "place")


@query(f"WITH {LEADS_SQL} SELECT count(*) AS total, count(*) FILTER (l = 'confirmed') AS confirmed, count(*) FILTER (l <> 'confirmed') AS review FROM leads")
def lead_stats(spark, d):
    return report.lead_counts(leads(spark, d))


@query(f"WITH {LEADS_SQL} SELECT o, f, v, h FROM leads WHERE l = 'review' AND (contains(lower(o), 'masjid') OR contains(lower(v), 'masjid') OR contains(lower(h), 'masjid'))")
def lead_tab(spark, d):
    """The leads to be reviewed that name a masjid."""
    return report.leads_page(leads(spark, d), "review", "Masjid").select("o", "f", "v", "h")


@query("""SELECT id, CASE WHEN coalesce(email, '') <> '' AND coalesce(phone, '') <> '' AND cardinality(social) > 0 THEN 80 WHEN coalesce(email, '') <> '' THEN 40 WHEN coalesce(phone, '') <> '' THEN 1 ELSE 0 END AS band,
    cardinality(map_from_entries(list_filter(map_entries(social), lambda e: regexp_matches(e.value, '^https?:')))) AS n_shown FROM organizations""")
def directory_bands(spark, d):
    """The band of each organisation in the page's filter, and how many of its channels can be opened."""
    o = read(spark, d, "organizations")
    n = F.size(F.map_keys("social"))
    return o.select("id", report.contact_band(F.col("email"), F.col("phone"), n).alias("band"), F.size(F.map_keys(report.shown_links(F.col("social")))).cast("long").alias("n_shown"))


@query("""SELECT count(*) AS total, count(*) FILTER (coalesce(email, '') <> '') AS with_email, count(*) FILTER (cardinality(social) > 0) AS with_social, count(*) FILTER (coalesce(confidence, 0) >= 80) AS "full" FROM organizations""")
def payload_stats(spark, d):
    """Counts of the directory page's payload."""
    return report.payload_counts(report.payload(read(spark, d, "organizations"), F.col("confidence")))


@query("""WITH g AS (SELECT province AS p, count(*) AS n FROM organizations WHERE province <> '' GROUP BY 1) SELECT p, CAST((least(2, ceil(n / 25.0)) - 1) * 25 + 1 AS BIGINT) || '-' || CAST(least(least(2, ceil(n / 25.0)) * 25, n) AS BIGINT) || ' of ' || n AS shown FROM g""")
def page_windows(spark, d):
    """What the second page of each province's list says it shows."""
    g = read(spark, d, "organizations").filter("province <> ''").groupBy(F.col("province").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("p", report.window_text(2, 25, F.col("n")).alias("shown"))


# --- sources ----------------------------------------------------------------------------------------

@query("""SELECT CASE WHEN length(id) % 2 = 0 THEN 'node/' ELSE 'way/' END || CAST(abs(hash_id) AS VARCHAR) AS external_id, nullif(name, '') AS name, CASE WHEN phone <> '' THEN phone END AS phone, nullif(email, '') AS email, nullif(address_line1, '') AS address_line1, nullif(city, '') AS city, lat, lng
    FROM (SELECT *, CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS hash_id FROM org_candidates WHERE source_id = 'osm') WHERE lat BETWEEN 43 AND 60 AND lng BETWEEN -180 AND 180""")
def place_elements(spark, d):
    """Candidates of a map, put into its elements and read out of them again: by tags and area, with contact tags first."""
    c = read(spark, d, "org_candidates").filter("source_id = 'osm'")
    c = first.numbered(c, [F.col("id")], "nr")
    tags = F.map_filter(F.create_map(*[x for k, v in {"amenity": F.lit("place_of_worship"), "religion": F.lit("muslim"), "name": F.col("name"), "contact:phone": F.when(F.length("id") % 3 == 0, F.col("phone")), "phone": F.col("phone"), "email": F.col("email"), "addr:street": F.col("address_line1"), "addr:city": F.col("city")}.items() for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())
    even = F.length("id") % 2 == 0
    e = c.select(F.when(even, "node").otherwise("way").alias("type"), F.col("nr").alias("id"), F.when(even, F.col("lat")).alias("lat"), F.when(even, F.col("lng")).alias("lon"), F.when(~even, F.struct("lat", F.col("lng").alias("lon"))).alias("center"), tags.alias("tags"))
    rows = readers.place_rows(e, {"amenity": "place_of_worship", "religion": "muslim"}, (-180.0, 43.0, 180.0, 60.0))
    return rows.select("external_id", "name", "phone", "email", "address_line1", "city", "lat", "lng")


@query("""SELECT id AS external_id, name, phone, website, city, CASE WHEN regexp_replace(upper(trim(province)), '^[A-Z]{2}-', '') IN ('ON', 'QC', 'BC', 'AB', 'SK', 'MB', 'NS', 'NB', 'NL', 'PE', 'NT', 'YT', 'NU') THEN regexp_replace(upper(trim(province)), '^[A-Z]{2}-', '') END AS province, coalesce(social['facebook'], '') AS facebook, lat, lng FROM org_candidates
    WHERE source_id = 'overture' AND lng BETWEEN -141 AND -52 AND lat BETWEEN 41 AND 84 AND ascii(right(id, 1)) % 3 <> 0""")
def open_places(spark, d):
    """Candidates of an open places table, put into its nested columns and read by category, box and country."""
    c = read(spark, d, "org_candidates").filter("source_id = 'overture'")
    kind = F.ascii(F.right("id", F.lit(1))) % 3
    nested = c.select(
        "id", F.struct(F.col("name").alias("primary")).alias("names"), F.struct(F.when(kind == 1, "mosque").otherwise("place").alias("primary"), F.when(kind == 2, F.array(F.lit("x"), F.lit("mosque"))).alias("alternate")).alias("categories"), F.array("phone").alias("phones"), F.lit(None).cast("array<string>").alias("emails"), F.array("website").alias("websites"),
        F.array(F.struct(F.lit(None).cast("string").alias("freeform"), F.col("city").alias("locality"), F.col("province").alias("region"), F.lit(None).cast("string").alias("postcode"), F.lit("CA").alias("country"))).alias("addresses"), F.map_values("social").alias("socials"), F.struct(F.col("lng").alias("xmin"), F.col("lng").alias("xmax"), F.col("lat").alias("ymin"), F.col("lat").alias("ymax")).alias("bbox"),
    )
    rows = readers.open_places(nested, "mosque", (-141.0, 41.0, -52.0, 84.0), "CA")
    social = c.select(F.col("id").alias("external_id"), F.coalesce(F.col("social")["facebook"], F.lit("")).alias("facebook"))
    return rows.select("external_id", "name", "phone", "website", "city", "province", "lat", "lng").join(social, "external_id")


@query("SELECT id, name, email FROM organizations")
def json_round_trip(spark, d):
    """Organisations written as JSON lines in two goes and read again."""
    at = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-tables/json-{uuid.uuid4().hex}"
    o = read(spark, d, "organizations").select("id", "name", "email")
    writers.json_lines(o.filter("length(id) % 2 = 0"), at)
    writers.json_lines(o.filter("length(id) % 2 = 1"), at)
    return spark.read.schema("id string, name string, email string").json(at)


@query("""SELECT substr(sha256(lower(trim(domain))), 1, 32) AS query_hash, CAST(row_number() OVER (PARTITION BY lower(trim(domain)) ORDER BY doc_id) - 1 AS INT) AS seq, url, left(text, 50) AS content FROM documents WHERE domain IS NOT NULL AND trim(domain) <> ''""")
def answer_cache(spark, d):
    """Documents of each domain kept as the answer to its name, and read from the cache again."""
    at = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-tables/cache-{uuid.uuid4().hex}"
    docs = read(spark, d, "documents").filter("domain is not null and trim(domain) <> ''")
    hit = F.struct("doc_id", F.struct(F.lit("").alias("title"), "url", F.substring("text", 1, 50).alias("content")).alias("r"))
    results = docs.groupBy(text.query_key(F.col("domain")).alias("query_hash")).agg(F.transform(F.array_sort(F.collect_list(hit)), lambda h: h.r).alias("results"))
    writers.keep_answers(results, at)
    return readers.kept_answers(spark, at).select("query_hash", "seq", "url", "content")


@query("""WITH g AS (SELECT p.place_id, p.lat - 0.3 AS a, p.lat + 0.3 AS b, p.lng - 0.3 AS c, p.lng + 0.3 AS e FROM ref_places p WHERE kind = 'city' AND lat IS NOT NULL)
    SELECT DISTINCT o.id, g.place_id AS region FROM org_candidates o LEFT JOIN g ON o.lat >= g.a AND o.lat < g.b AND o.lng >= g.c AND o.lng < g.e""")
def places_around(spark, d):
    """The boxes around cities that hold each candidate's point, as polygons."""
    corner = lambda i, j: F.struct((F.col("lat") + i).alias("lat"), (F.col("lng") + j).alias("lng"))
    ring = F.array(corner(-0.3, -0.3), corner(-0.3, 0.3), corner(0.3, 0.3), corner(0.3, -0.3))
    regions = read(spark, d, "ref_places").filter("kind = 'city' and lat is not null").select("place_id", ring.alias("ring"))
    return proximity.regions_of(read(spark, d, "org_candidates"), regions, "id", "lat", "lng", "place_id", "ring")


@query("""SELECT column_name AS "column", data_type AS type FROM (VALUES ('id', 'string'), ('label', 'string'), ('trust', 'smallint'), ('enabled', 'boolean')) v(column_name, data_type)""")
def schema_columns(spark, d):
    """The columns of the table of sources as the engine declares it."""
    return schemas.columns(spark).filter("table = 'sources'").select("column", "type")
