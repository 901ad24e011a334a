"""Queries over the engine's operators on the driver's tables, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.functions import geo, text, url
from orgloom.operators import crawl, directory, enrich, first, jobs, resolve, upsert
from orgloom.plans.core_queries import read
from orgloom.plans.registry import Registry

REGISTRY = Registry()
query, QUERIES, ORACLES = REGISTRY.query, REGISTRY.queries, REGISTRY.sql
NOW = "TIMESTAMP '2026-04-01 00:00:00'"


# --- contacts, suppression and the directory ---------------------------------------------------

CONTACTS_SQL = """contacts AS (
    SELECT id AS org_id, 'email' AS kind, email AS value FROM organizations WHERE trim(email) <> ''
    UNION ALL SELECT id, 'phone', phone FROM organizations WHERE trim(phone) <> ''
    UNION ALL SELECT id, 'contact_form', website FROM organizations WHERE trim(website) <> '')"""
SUPPRESSED_SQL = """suppressed AS (
    SELECT field AS kind, proposed_value AS value FROM enrichment_proposals WHERE status = 'dismissed' AND field IN ('email', 'phone'))"""
LIVE_SQL = f"""{CONTACTS_SQL}, {SUPPRESSED_SQL}, live AS (
    SELECT * FROM contacts c WHERE NOT EXISTS (
        SELECT 1 FROM suppressed s WHERE s.kind = c.kind
          AND ((c.kind = 'email' AND lower(s.value) = lower(c.value))
            OR (c.kind = 'phone' AND regexp_replace(s.value, '\\D', '', 'g') = regexp_replace(c.value, '\\D', '', 'g')
                AND regexp_replace(c.value, '\\D', '', 'g') <> ''))))"""
ROLLUP_SQL = """SELECT org_id, bool_or(kind = 'email') AS has_email, bool_or(kind = 'phone') AS has_phone,
    bool_or(kind = 'contact_form') AS has_form, count(DISTINCT kind) AS n_kinds FROM {} GROUP BY org_id"""


def suppressed_values(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "enrichment_proposals").filter((F.col("status") == "dismissed") & F.col("field").isin("email", "phone"))
    return rows.select(F.col("field").alias("kind"), F.col("proposed_value").alias("value"))


@query(f"WITH {CONTACTS_SQL} {ROLLUP_SQL.format('contacts')}")
def contact_rollup(spark, d):
    return directory.contact_rollup(directory.contacts_of(read(spark, d, "organizations")))


@query(f"WITH {LIVE_SQL} SELECT * FROM live")
def live_contacts(spark, d):
    return directory.live_contacts(directory.contacts_of(read(spark, d, "organizations")), suppressed_values(spark, d))


EVIDENCE_SQL = """evidence AS (
    SELECT resolved_org_id AS org_id, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS methods,
        coalesce(bool_or(contains(lower(website), 'contact')), false) AS from_contact_page, max(created_at) AS last_seen, count(*) AS n_records
    FROM org_candidates WHERE resolved_org_id IS NOT NULL GROUP BY 1)"""


@query(f"WITH {EVIDENCE_SQL} SELECT org_id, methods, from_contact_page, last_seen, n_records FROM evidence")
def evidence_rollup(spark, d):
    return directory.evidence(read(spark, d, "org_candidates"), "resolved_org_id", "source_id", "website", "created_at").withColumnRenamed("resolved_org_id", "org_id")


@query(
    f"""WITH {LIVE_SQL}, rollup AS ({ROLLUP_SQL.format("live")}), {EVIDENCE_SQL}, gone AS (
        SELECT DISTINCT org_id FROM enrichment_proposals WHERE status = 'dismissed' AND org_id IS NOT NULL)
    SELECT o.id, o.name, upper(o.province) AS province, coalesce(r.has_email, false) AS has_email, coalesce(r.has_phone, false) AS has_phone,
        coalesce(r.has_form, false) AS has_form, coalesce(r.n_kinds, 0) AS n_kinds, cardinality(o.social) AS n_platforms, e.methods,
        coalesce(e.from_contact_page, false) AS from_contact_page, e.last_seen, g.org_id IS NOT NULL AS dismissed,
        CASE WHEN lower(o.email) IN (SELECT lower(value) FROM suppressed WHERE kind = 'email') THEN NULL ELSE o.email END AS email
    FROM organizations o LEFT JOIN rollup r ON r.org_id = o.id LEFT JOIN evidence e ON e.org_id = o.id LEFT JOIN gone g ON g.org_id = o.id
    WHERE o.status <> 'merged' AND o.merged_into IS NULL"""
)
def directory_view(spark, d):
    """The directory: live organisations with their channels, evidence and flags, suppressed values blanked."""
    o = read(spark, d, "organizations").filter((F.col("status") != "merged") & F.col("merged_into").isNull())
    gone = suppressed_values(spark, d)
    rollup = directory.contact_rollup(directory.live_contacts(directory.contacts_of(read(spark, d, "organizations")), gone)).withColumnRenamed("org_id", "id")
    seen = evidence_rollup(spark, d).withColumnRenamed("org_id", "id")
    dismissed = read(spark, d, "enrichment_proposals").filter("status = 'dismissed' and org_id is not null").select(F.col("org_id").alias("id"))
    mails = gone.filter("kind = 'email'").select(F.lower("value").alias("mail"))
    o = directory.flagged(o.withColumn("mail", F.lower("email")), mails, "mail", "suppressed")
    o = directory.flagged(o, dismissed, "id", "dismissed").join(rollup, "id", "left").join(seen, "id", "left")
    false = F.lit(False)
    return o.select(
        "id", "name", F.upper("province").alias("province"), *[F.coalesce(c, false).alias(c) for c in ("has_email", "has_phone", "has_form")], F.coalesce("n_kinds", F.lit(0)).alias("n_kinds"),
        F.size(F.map_keys("social")).cast("long").alias("n_platforms"), "methods", F.coalesce("from_contact_page", false).alias("from_contact_page"), "last_seen", "dismissed", F.when(~F.col("suppressed"), F.col("email")).alias("email"),
    )


@query("""SELECT b.band, count(o.id) AS n FROM (VALUES ('<40'), ('40-59'), ('60-79'), ('80+')) b(band)
    LEFT JOIN organizations o ON o.confidence IS NOT NULL AND b.band = CASE WHEN o.confidence < 40 THEN '<40' WHEN o.confidence < 60 THEN '40-59' WHEN o.confidence < 80 THEN '60-79' ELSE '80+' END GROUP BY 1""")
def confidence_bands(spark, d):
    return directory.bands(read(spark, d, "organizations"), "confidence", [40, 60, 80])


@query("SELECT upper(province) AS key, count(*) AS n FROM organizations WHERE province <> '' GROUP BY 1")
def province_facets(spark, d):
    return directory.facets(read(spark, d, "organizations"), F.col("province"))


@query("""SELECT field, n_known, round(n_known / n, 6) AS share FROM (
    SELECT count(*) AS n, count(*) FILTER (coalesce(name, '') <> '') AS name, count(*) FILTER (coalesce(website, '') <> '') AS website,
        count(*) FILTER (coalesce(phone, '') <> '') AS phone, count(*) FILTER (coalesce(email, '') <> '') AS email, count(*) FILTER (coalesce(province, '') <> '') AS province
    FROM org_candidates) UNPIVOT (n_known FOR field IN (name, website, phone, email, province))""")
def coverage_summary(spark, d):
    return directory.coverage(read(spark, d, "org_candidates"), ["name", "website", "phone", "email", "province"])


@query("""SELECT id, lower(name) AS name_key, cardinality(social) AS n_platforms FROM organizations
    WHERE upper(province) = 'ON' AND trim(email) <> '' AND (contains(lower(name), 'centre') OR contains(lower(coalesce(city, '')), 'centre'))
    ORDER BY cardinality(social) DESC, lower(name), id LIMIT 25 OFFSET 25""")
def directory_page(spark, d):
    """The second page of a filtered list, most platforms first."""
    platforms = F.size(F.map_keys("social")).cast("long")
    wanted = (F.upper("province") == "ON") & (F.trim("email") != "") & (F.lower("name").contains("centre") | F.lower(F.coalesce("city", F.lit(""))).contains("centre"))
    rows = directory.page(read(spark, d, "organizations"), wanted, [platforms.desc(), F.lower("name"), F.col("id")], 2, 25)
    return rows.select("id", F.lower("name").alias("name_key"), platforms.alias("n_platforms"))


@query("""SELECT id, row_number() OVER (PARTITION BY load_id ORDER BY (coalesce(email, '') = ''), (coalesce(phone, '') = ''), cardinality(social) DESC, lower(name), id) AS place, load_id FROM organizations""")
def contact_first_order(spark, d):
    """The place of each organisation in its load's report: with email first, then with phone, then by platforms and name."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    w = W.partitionBy("load_id").orderBy(blank("email"), blank("phone"), F.size(F.map_keys("social")).desc(), F.lower("name"), "id")
    return read(spark, d, "organizations").select("id", F.row_number().over(w).alias("place"), "load_id")


@query("""SELECT id, array_to_string(list_filter([CASE WHEN coalesce(email, '') = '' THEN 'email' END, CASE WHEN coalesce(phone, '') = '' THEN 'phone' END,
    CASE WHEN coalesce(province, '') = '' THEN 'province' END], lambda x: x IS NOT NULL), ',') AS missing FROM organizations
    WHERE coalesce(email, '') = '' OR coalesce(phone, '') = '' OR coalesce(province, '') = ''""")
def missing_fields(spark, d):
    return read(spark, d, "organizations").select("id", directory.missing_fields({c: F.col(c) for c in ("email", "phone", "province")}).alias("missing")).filter("missing <> ''")


@query("""SELECT id, origin FROM (
    SELECT 'c:' || id AS id, 'candidate' AS origin, 0 AS k, id AS o FROM org_candidates WHERE resolved_org_id IS NULL AND coalesce(email, '') = ''
    UNION ALL SELECT 'o:' || id, 'organization', 1, id FROM organizations WHERE coalesce(province, '') = '' AND status <> 'merged') ORDER BY k, o LIMIT 2000""")
def targets_topup(spark, d):
    c = read(spark, d, "org_candidates").filter("resolved_org_id is null and coalesce(email, '') = ''")
    o = read(spark, d, "organizations").filter("coalesce(province, '') = '' and status <> 'merged'")
    row = lambda t, mark, origin: t.select(F.concat(F.lit(mark), "id").alias("id"), F.lit(origin).alias("origin"), F.col("id").alias("o"))
    return directory.topped_up(row(c, "c:", "candidate"), row(o, "o:", "organization"), ["o"], 2_000).select("id", "origin")


@query("""SELECT g.domain, g.first_seen, g.n, min(c.id) AS candidate_id FROM (
        SELECT domain, min(created_at) AS first_seen, count(*) AS n FROM enrichment_proposals WHERE status = 'dismissed' AND domain <> '' GROUP BY 1) g
    LEFT JOIN org_candidates c ON contains(lower(c.website), g.domain) GROUP BY ALL""")
def manual_queue(spark, d):
    """Dismissed domains with the first candidate whose website holds the domain anywhere."""
    p = read(spark, d, "enrichment_proposals").filter("status = 'dismissed' and domain <> ''")
    groups = p.groupBy("domain").agg(F.min("created_at").alias("first_seen"), F.count(F.lit(1)).alias("n"))
    sites = read(spark, d, "org_candidates").select("id", F.lower("website").alias("site")).filter("site is not null")
    found = directory.containing(sites, "site", groups.select("domain"), "domain", 12).groupBy("domain").agg(F.min("id").alias("candidate_id"))
    return groups.join(found, "domain", "left").select("domain", "first_seen", "n", "candidate_id")


@query("""SELECT org_id, field, proposed_value, vetting FROM (
    SELECT *, row_number() OVER (PARTITION BY org_id, field ORDER BY (vetting <> 'verified'), created_at, id) AS k FROM enrichment_proposals
    WHERE status <> 'dismissed' AND org_id IS NOT NULL AND vetting IS NOT NULL) WHERE k = 1""")
def leads_preferred(spark, d):
    """One proposal for each organisation and field: the first, but any verified one before others."""
    p = read(spark, d, "enrichment_proposals").filter("status <> 'dismissed' and org_id is not null and vetting is not null")
    return first.preferred(p, ["org_id", "field"], F.col("vetting") == "verified", [F.col("created_at"), F.col("id")]).select("org_id", "field", "proposed_value", "vetting")


@query("""SELECT p.id, coalesce(o.name, c.name, p.domain, 'unknown') AS label, split_part(coalesce(p.vetting, 'proposed') || ':' || coalesce(p.vet_rule, 'none'), ':', 2) AS rule
    FROM enrichment_proposals p LEFT JOIN organizations o ON o.id = p.org_id LEFT JOIN org_candidates c ON c.id = p.candidate_id WHERE p.status <> 'dismissed'""")
def lead_labels(spark, d):
    p = read(spark, d, "enrichment_proposals").filter("status <> 'dismissed'")
    o = read(spark, d, "organizations").select(F.col("id").alias("org_id"), F.col("name").alias("org_name"))
    c = read(spark, d, "org_candidates").select(F.col("id").alias("candidate_id"), F.col("name").alias("candidate_name"))
    code = F.concat_ws(":", F.coalesce("vetting", F.lit("proposed")), F.coalesce("vet_rule", F.lit("none")))
    rows = p.join(o, "org_id", "left").join(c, "candidate_id", "left")
    return rows.select("id", F.coalesce("org_name", "candidate_name", "domain", F.lit("unknown")).alias("label"), F.split_part(code, F.lit(":"), F.lit(2)).alias("rule"))


# --- URLs ------------------------------------------------------------------------------------------

SITE_SQL = "lower(regexp_replace(website, '^https?://(www\\.)?', '', 'i'))"


@query(f"""SELECT id, {SITE_SQL} AS site, split_part({SITE_SQL}, '/', 1) AS site_host,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(website, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), ':\\d*$', ''), '^www\\.', '') AS host,
    nullif(regexp_replace(regexp_replace(coalesce(nullif(website, ''), NULL), '^https?://(www\\.)?', ''), '^/+|/+$', '', 'g'), '') AS slug
    FROM org_candidates WHERE website IS NOT NULL""")
def website_parts(spark, d):
    w = F.col("website")
    rows = read(spark, d, "org_candidates").filter("website is not null")
    return rows.select("id", url.without_scheme(w).alias("site"), url.site_host(w).alias("site_host"), url.host(w).alias("host"), url.site_slug(w, F.lit(None).cast("string")).alias("slug"))


@query(f"""WITH h AS (SELECT id, split_part({SITE_SQL}, '/', 1) AS host FROM org_candidates WHERE trim(website) <> ''),
    a AS (SELECT id, host, CASE WHEN regexp_extract(host, '([^.]+\\.[^.]+)$', 1) = '' THEN host ELSE regexp_extract(host, '([^.]+\\.[^.]+)$', 1) END AS apex FROM h)
    SELECT apex, count(*) AS n, count(DISTINCT host) AS n_hosts, count(*) FILTER (regexp_matches(host, '(^|\\.)(centres\\.macnet\\.ca|macnet\\.ca|ahmadiyya\\.ca|ahmadiyya\\.org)$')) AS n_shared FROM a GROUP BY 1""")
def apex_counts(spark, d):
    h = read(spark, d, "org_candidates").filter("trim(website) <> ''").select(url.site_host(F.col("website")).alias("host"))
    h = h.withColumn("apex", url.apex(F.col("host"))).withColumn("shared", url.host_matches(F.col("host"), url.SHARED_HOSTS))
    return h.groupBy("apex").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("host").alias("n_hosts"), F.count_if("shared").alias("n_shared"))


@query(f"""SELECT site, id, created_at FROM (SELECT {SITE_SQL} AS site, id, created_at, row_number() OVER (PARTITION BY {SITE_SQL} ORDER BY created_at, id) AS k
    FROM org_candidates WHERE website <> '') WHERE k = 1""")
def earliest_per_website(spark, d):
    rows = read(spark, d, "org_candidates").filter("website <> ''").select(url.without_scheme(F.col("website")).alias("site"), "id", "created_at")
    return first.earliest(rows, ["site"], ["created_at", "id"])


@query("""WITH u AS (SELECT id, CASE WHEN regexp_matches(trim(website), '^[A-Za-z][A-Za-z0-9+.-]*:') THEN trim(website) ELSE 'https://' || trim(website) END AS u FROM org_candidates WHERE trim(website) <> ''),
    f AS (SELECT id, regexp_replace(u, '#.*$', '') AS u FROM u), l AS (SELECT id, lower(regexp_extract(u, '^([^:]*)', 1)) || regexp_extract(u, '^[^:]*(:.*)$', 1) AS u FROM f)
    SELECT id, CASE WHEN regexp_matches(u, '^[a-z][a-z0-9+.-]*://[^/?]*$') THEN u || '/' ELSE u END AS seed FROM l""")
def canonical_seeds(spark, d):
    return read(spark, d, "org_candidates").filter("trim(website) <> ''").select("id", url.canonical_seed(F.col("website")).alias("seed"))


@query(r"""WITH l AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"''>]*)["'']', 1))) AS target FROM documents)
    SELECT doc_id, target, lower(regexp_extract(target, '^https?://(?:www\.)?([^/?#:]+)', 1)) AS target_host FROM l""")
def document_links(spark, d):
    rows = read(spark, d, "documents").select("doc_id", F.explode(url.hrefs(F.col("text"))).alias("target"))
    return rows.select("doc_id", "target", F.lower(F.regexp_extract("target", r"^https?://(?:www\.)?([^/?#:]+)", 1)).alias("target_host"))


@query(r"""WITH l AS (SELECT unnest(list_distinct(regexp_extract_all(text, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"''>]*)["'']', 1))) AS target FROM documents),
    h AS (SELECT lower(regexp_extract(target, '^https?://(?:www\.)?([^/?#:]+)', 1)) AS target_host FROM l) SELECT target_host, count(*) AS n FROM h WHERE target_host <> '' GROUP BY 1""")
def link_host_counts(spark, d):
    return document_links(spark, d).filter("target_host <> ''").groupBy("target_host").agg(F.count(F.lit(1)).alias("n"))


# --- texts -----------------------------------------------------------------------------------------

EMAILS_SQL = "list_transform(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'), lambda x: lower(x))"


@query(f"SELECT doc_id, email, count(*) AS n FROM (SELECT doc_id, unnest({EMAILS_SQL}) AS email FROM documents WHERE text IS NOT NULL) GROUP BY ALL")
def document_emails(spark, d):
    return read(spark, d, "documents").select("doc_id", F.explode(text.emails(F.col("text"))).alias("email")).groupBy("doc_id", "email").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH e AS (SELECT DISTINCT doc_id, unnest({EMAILS_SQL}) AS email FROM documents WHERE text IS NOT NULL),
    o AS (SELECT DISTINCT lower(email) AS email FROM organizations WHERE email <> '')
    SELECT e.doc_id, e.email, contains(regexp_replace(lower(t.text), '[^a-z0-9]', '', 'g'), regexp_replace(e.email, '[^a-z0-9]', '', 'g')) AS verbatim FROM e JOIN o USING (email) JOIN documents t USING (doc_id)""")
def verbatim_contacts(spark, d):
    """Addresses of organisations that documents name, checked against the text without signs."""
    docs = read(spark, d, "documents").filter("text is not null")
    known = read(spark, d, "organizations").filter("email <> ''").select(F.lower("email").alias("email")).distinct()
    # texts are looked into where they lie; only addresses move
    hay = text.bare(F.col("text"))
    pairs = F.transform(F.array_distinct(text.emails(F.col("text"))), lambda e: F.struct(e.alias("email"), ((text.bare(e) != "") & hay.contains(text.bare(e))).alias("verbatim")))
    found = docs.select("doc_id", F.explode(pairs).alias("p")).select("doc_id", "p.email", "p.verbatim")
    return found.join(known, "email", "left_semi").select("doc_id", "email", "verbatim")


@query("SELECT sha256(text) AS hash, min(doc_id) AS first_doc, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def repeated_contents(spark, d):
    rows = read(spark, d, "documents").filter("text is not null").select(text.content_hash(F.col("text")).alias("hash"), "doc_id")
    return rows.groupBy("hash").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY doc_id) AS k FROM documents WHERE domain IS NOT NULL AND text IS NOT NULL)
    SELECT domain, md5(string_agg('--- page: ' || coalesce(url, '') || ' ---' || chr(10) || text, chr(10) ORDER BY doc_id)) AS hash, count(*) AS pages FROM k WHERE k <= 10 GROUP BY 1""")
def corpus_per_domain(spark, d):
    """The texts of each domain's first ten pages in order, behind a line that names the page (as a hash)."""
    docs = read(spark, d, "documents").filter("domain is not null and text is not null")
    page = F.concat(F.lit("--- page: "), F.coalesce("url", F.lit("")), F.lit(" ---\n"), "text")
    whole = first.joined_in_order(docs, ["domain"], "doc_id", page, "\n", 10)
    pages = docs.groupBy("domain").agg(F.least(F.count(F.lit(1)), F.lit(10)).alias("pages"))
    return whole.join(pages, "domain").select("domain", F.md5("text").alias("hash"), "pages")


SCORE_SQL = """CASE WHEN contains(lower(url), 'contact') THEN 4 ELSE 0 END + CASE WHEN contains(lower(text), 'mosque') THEN 2 ELSE 0 END
    + CASE WHEN contains(lower(text), 'islamic') THEN 2 ELSE 0 END + CASE WHEN contains(text, '@') THEN 3 ELSE 0 END - CASE WHEN contains(lower(url), '/news') THEN 3 ELSE 0 END - CASE WHEN contains(lower(url), '/event') THEN 3 ELSE 0 END"""


@query(f"""WITH s AS (SELECT doc_id, url, domain, {SCORE_SQL} AS score FROM documents WHERE url IS NOT NULL AND domain IS NOT NULL AND text IS NOT NULL),
    u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY doc_id) AS k FROM s WHERE score >= -2) WHERE k = 1)
    SELECT doc_id, domain, CAST(score AS INT) AS score FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY doc_id) AS c FROM u) WHERE c <= 3""")
def capped_hits(spark, d):
    """Pages as hits in order: each URL once, scored by terms, at most three of a domain."""
    low, address = F.lower("text"), F.lower("url")
    score = enrich.term_score({"contact": (address, 4), "mosque": (low, 2), "islamic": (low, 2), "@": (F.col("text"), 3), "/news": (address, -3), "/event": (address, -3)})
    hits = read(spark, d, "documents").filter("url is not null and domain is not null and text is not null").select("doc_id", "url", "domain", score.alias("score"))
    return first.capped_hits(hits.filter("score >= -2"), "url", "domain", [F.col("doc_id")], 3).select("doc_id", "domain", "score")


# --- targets, slots, ledger ----------------------------------------------------------------------

SLOTS_SQL = """slots AS (SELECT target_id, unnest(s[1:3]) AS s, generate_subscripts(s[1:3], 1) - 1 AS slot FROM (
    SELECT target_id, list_filter([
        CASE WHEN site IS NOT NULL THEN {t: 'site_contact', q: site || ' contact email phone'} END,
        CASE WHEN n <> '' THEN {t: 'name_contact', q: '"' || n || '" mosque contact'} END,
        CASE WHEN n <> '' AND coalesce(city, '') <> '' THEN {t: 'name_city', q: '"' || n || '" ' || city || ' mosque'} END,
        CASE WHEN n <> '' AND coalesce(city, '') = '' THEN {t: 'name_country', q: '"' || n || '" mosque Canada'} END], lambda x: x IS NOT NULL) AS s
    FROM (SELECT target_id, trim(name) AS n, city, nullif(regexp_replace(regexp_replace(coalesce(nullif(website, ''), 'https://' || nullif(domain, '')), '^https?://(www\\.)?', ''), '^/+|/+$', '', 'g'), '') AS site FROM search_targets)))"""


@query(f"WITH {SLOTS_SQL} SELECT target_id, CAST(slot AS INT) AS slot, s.t AS template, s.q AS query, substr(sha256(lower(trim(s.q))), 1, 32) AS query_hash FROM slots")
def query_slots(spark, d):
    return enrich.slots_of(read(spark, d, "search_targets"), "target_id", "mosque", "Canada")


@query(f"""WITH {SLOTS_SQL}, q AS (SELECT t.target_id, slot, t.requested_at, substr(sha256(lower(trim(s.q))), 1, 32) AS h FROM slots JOIN search_targets t USING (target_id)),
    ledger AS (SELECT h, requested_at FROM q WHERE target_id % 3 = 0), kept AS (SELECT h FROM q WHERE target_id % 6 = 0)
    SELECT target_id, CAST(slot AS INT) AS slot FROM q WHERE h NOT IN (SELECT h FROM ledger WHERE requested_at > {NOW} - INTERVAL 90 DAY AND h NOT IN (SELECT h FROM kept))""")
def ledger_gate(spark, d):
    """Slots still to be asked: not asked in the last 90 days, or with a kept answer. A third of the targets make up the ledger of this query, every second of them with a kept answer."""
    t = read(spark, d, "search_targets")
    q = enrich.slots_of(t, "target_id", "mosque", "Canada").join(t.select("target_id", "requested_at"), "target_id")
    asked, kept = q.filter(F.col("target_id") % 3 == 0), q.filter(F.col("target_id") % 6 == 0)
    return jobs.not_lately(q, asked, kept, "query_hash", "requested_at", F.expr(NOW), 90).select("target_id", "slot")


# --- upserts and fills ---------------------------------------------------------------------------

UPSERT_KEYS = """SELECT source_id, external_id, name, phone, email, website, address_line1, created_at, row_number() OVER (PARTITION BY source_id, external_id ORDER BY created_at, id) AS k,
    row_number() OVER (PARTITION BY source_id, external_id ORDER BY created_at DESC, id DESC) AS r FROM org_candidates"""


@query(f"""WITH s AS ({UPSERT_KEYS}), o AS (SELECT * FROM s WHERE k = 1 AND created_at < TIMESTAMP '2025-06-01'), n AS (SELECT * FROM s WHERE r = 1 AND created_at >= TIMESTAMP '2025-01-01')
    SELECT coalesce(o.source_id, n.source_id) AS source_id, coalesce(o.external_id, n.external_id) AS external_id, coalesce(n.name, o.name) AS name, coalesce(o.phone, n.phone) AS phone,
        CASE WHEN n.source_id IS NULL THEN o.website ELSE n.website END AS website, CASE WHEN o.source_id IS NULL THEN n.address_line1 ELSE o.address_line1 END AS address_line1
    FROM o FULL JOIN n ON o.source_id = n.source_id AND o.external_id = n.external_id""")
def candidate_upsert(spark, d):
    """An older state of the candidates brought up to date by a newer one, column by column."""
    cols = ["source_id", "external_id", "name", "phone", "website", "address_line1"]
    c = read(spark, d, "org_candidates")
    keys = ["source_id", "external_id"]
    old = first.first_rows(c, keys, [F.col("created_at"), F.col("id")]).filter(F.col("created_at") < F.expr("TIMESTAMP_NTZ '2025-06-01 00:00:00'")).select(*cols)
    new = first.first_rows(c, keys, [F.desc("created_at"), F.desc("id")]).filter(F.col("created_at") >= F.expr("TIMESTAMP_NTZ '2025-01-01 00:00:00'")).select(*cols)
    return upsert.upsert(old, new, keys, {"name": "coalesce_new", "phone": "coalesce_old", "website": "replace"})


@query("""WITH k AS (SELECT org_id, candidate_id, field, proposed_value, min(created_at) AS a, max(created_at) AS b, min(status) AS s FROM enrichment_proposals GROUP BY ALL)
    SELECT org_id, candidate_id, field, proposed_value, CASE WHEN a < TIMESTAMP '2025-06-01' AND b >= TIMESTAMP '2025-06-01' AND s <> 'dismissed' THEN b WHEN a < TIMESTAMP '2025-06-01' THEN a ELSE b END AS created_at, s AS status FROM k""")
def proposals_upsert(spark, d):
    """Proposals upserted on a key whose nulls are equal; dismissed rows stay as they are."""
    keys = ["org_id", "candidate_id", "field", "proposed_value"]
    k = read(spark, d, "enrichment_proposals").groupBy(*keys).agg(F.min("created_at").alias("a"), F.max("created_at").alias("b"), F.min("status").alias("status"))
    edge = F.expr("TIMESTAMP_NTZ '2025-06-01 00:00:00'")
    old = k.filter(F.col("a") < edge).select(*keys, F.col("a").alias("created_at"), "status")
    new = k.filter(F.col("b") >= edge).select(*keys, F.col("b").alias("created_at"), "status")
    return upsert.upsert(old, new, keys, {"created_at": "replace"}, when=lambda o, n: F.col(f"{o}.status") != "dismissed", null_keys=True)


@query("""WITH c AS (SELECT resolved_org_id AS id, min_by(email, id) FILTER (email <> '') AS email, min_by(phone, id) FILTER (phone <> '') AS phone FROM org_candidates WHERE resolved_org_id IS NOT NULL GROUP BY 1)
    SELECT o.id, coalesce(o.email, c.email) AS email, coalesce(o.phone, c.phone) AS phone FROM organizations o LEFT JOIN c USING (id)""")
def fill_from_candidates(spark, d):
    """Null contacts of organisations filled from their candidates, each from the first that has one."""
    c = read(spark, d, "org_candidates").filter("resolved_org_id is not null").select(F.col("resolved_org_id").alias("org"), F.col("id").alias("cid"), *[F.when(F.col(x) != "", F.col(x)).alias(x) for x in ("email", "phone")])
    found = first.first_known(c, ["org"], ["cid"], ["email", "phone"]).withColumnRenamed("org", "id")
    return upsert.fill_nulls(read(spark, d, "organizations"), "id", found, ["email", "phone"]).select("id", "email", "phone")


@query("""WITH v AS (SELECT org_id AS id, min_by(proposed_value, struct_pack(created_at, id)) FILTER (field = 'email') AS email, min_by(proposed_value, struct_pack(created_at, id)) FILTER (field = 'phone') AS phone
        FROM enrichment_proposals WHERE vetting = 'verified' AND org_id IS NOT NULL AND proposed_value IS NOT NULL GROUP BY 1)
    SELECT o.id, coalesce(o.email, v.email) AS email, coalesce(o.phone, v.phone) AS phone FROM organizations o JOIN v USING (id)""")
def apply_verified(spark, d):
    """Organisations with the first verified proposal in place of each null."""
    p = read(spark, d, "enrichment_proposals").filter("vetting = 'verified' and org_id is not null").withColumnRenamed("org_id", "org")
    values = enrich.first_values(p, "org", ["email", "phone"], ["created_at", "id"]).withColumnRenamed("org", "id")
    o = read(spark, d, "organizations").join(values.select("id"), "id", "left_semi")
    return upsert.fill_nulls(o, "id", values, ["email", "phone"]).select("id", "email", "phone")


# --- resolution ------------------------------------------------------------------------------------

GRAMS_SQL = """list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower(coalesce(name, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''),
    lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))"""
SIDES_SQL = f"""c AS (SELECT id, lat, lng, {GRAMS_SQL} AS g, nullif({SITE_SQL}, '') AS site, nullif(split_part({SITE_SQL}, '/', 1), '') AS host FROM org_candidates),
    o AS (SELECT id, lat, lng, {GRAMS_SQL} AS g, nullif({SITE_SQL}, '') AS site, nullif(split_part({SITE_SQL}, '/', 1), '') AS host FROM organizations WHERE merged_into IS NULL)"""
SIM_SQL = "coalesce(len(list_intersect(c.g, o.g)) / nullif(len(c.g) + len(o.g) - len(list_intersect(c.g, o.g)), 0), 0.0)"
KM_SQL = "111.32 * sqrt(pow(o.lat - c.lat, 2) + pow((o.lng - c.lng) * cos(radians(c.lat)), 2))"
TIERS_SQL = f"""{SIDES_SQL},
    exact AS (SELECT c.id AS candidate_id, o.id AS org_id, 1 AS k, CAST(1.0 AS DOUBLE) AS score FROM c JOIN o USING (site) WHERE contains(site, '/') OR ({KM_SQL} <= 2 AND {SIM_SQL} >= 0.45)),
    domain AS (SELECT c.id AS candidate_id, min(o.id) AS org_id, 2 AS k, CAST(0.9 AS DOUBLE) AS score FROM c JOIN o USING (host) WHERE {KM_SQL} <= 2 AND {SIM_SQL} >= 0.45 GROUP BY 1 HAVING count(DISTINCT o.id) = 1),
    geo AS (SELECT c.id AS candidate_id, o.id AS org_id, 3 AS k, {SIM_SQL} AS score FROM c JOIN o ON abs(c.lat - o.lat) <= 0.0023 AND abs(c.lng - o.lng) <= 0.0031 WHERE {SIM_SQL} >= 0.55)"""


def resolution_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return read(spark, d, "org_candidates"), read(spark, d, "organizations").filter("merged_into is null")


@query(f"WITH {TIERS_SQL} SELECT candidate_id, org_id FROM exact")
def resolve_exact(spark, d):
    return resolve.exact_tier(*resolution_sides(spark, d)).select("candidate_id", "org_id")


@query(f"WITH {TIERS_SQL} SELECT candidate_id, org_id FROM domain")
def resolve_domain(spark, d):
    return resolve.domain_tier(*resolution_sides(spark, d)).select("candidate_id", "org_id")


@query(f"WITH {TIERS_SQL} SELECT candidate_id, org_id, round(score, 9) AS score FROM geo")
def resolve_geoname(spark, d):
    return resolve.geoname_tier(*resolution_sides(spark, d)).select("candidate_id", "org_id", F.round("score", 9).alias("score"))


@query(f"""WITH {TIERS_SQL}, f AS (SELECT * FROM exact UNION ALL SELECT * FROM domain UNION ALL SELECT * FROM geo)
    SELECT candidate_id, org_id, CASE k WHEN 1 THEN 'exact' WHEN 2 THEN 'domain' ELSE 'geoname' END AS tier FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY k, score DESC, org_id) AS r FROM f) WHERE r = 1""")
def resolve_tiers(spark, d):
    return resolve.resolve(*resolution_sides(spark, d)).select("candidate_id", "org_id", "tier")


@query(f"""WITH {TIERS_SQL}, f AS (SELECT * FROM exact UNION ALL SELECT * FROM domain UNION ALL SELECT * FROM geo), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY k, score DESC, org_id) AS r FROM f) WHERE r = 1)
    SELECT CASE k WHEN 1 THEN 'exact' WHEN 2 THEN 'domain' ELSE 'geoname' END AS tier, count(*) AS n FROM b GROUP BY 1""")
def tier_counts(spark, d):
    return resolve_tiers(spark, d).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


# --- queues, schedules, graphs and sets -----------------------------------------------------------

@query("""SELECT id, CASE WHEN k <= 50 THEN 'running' ELSE status END AS status, CASE WHEN k <= 50 THEN 'run-1' ELSE run_id END AS run_id FROM (
    SELECT *, CASE WHEN status = 'open' THEN row_number() OVER (PARTITION BY status ORDER BY created_at, id) END AS k FROM enrichment_proposals)""")
def claim_oldest(spark, d):
    p = read(spark, d, "enrichment_proposals").select("id", "status", "run_id", "created_at")
    return jobs.claim(p, F.col("status") == "open", [F.col("created_at"), F.col("id")], 50, "id", {"status": F.lit("running"), "run_id": F.lit("run-1")}).drop("created_at")


@query(f"""SELECT id, CASE WHEN status = 'open' AND created_at < {NOW} - INTERVAL 400 DAY AND run_id <> '20240301T020000Z' THEN 'queued' ELSE status END AS status FROM enrichment_proposals""")
def reclaim_orphans(spark, d):
    p = read(spark, d, "enrichment_proposals")
    orphan = (F.col("status") == "open") & (F.col("created_at") < F.expr(NOW).cast("timestamp_ntz") - F.expr("INTERVAL 400 DAYS")) & (F.col("run_id") != "20240301T020000Z")
    return jobs.changed_where(p, orphan, {"status": F.lit("queued")}).select("id", "status")


@query("SELECT id FROM enrichment_proposals WHERE status = 'open' ORDER BY md5('7:' || id), id LIMIT 25")
def claim_at_random(spark, d):
    return jobs.random_claim(read(spark, d, "enrichment_proposals"), F.col("status") == "open", 25, "id", 7).select("id")


@query("""WITH e AS (SELECT event_id, user_id, epoch(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    s AS (SELECT event_id, user_id, t, max(t - i * 3600.0) OVER (PARTITION BY user_id ORDER BY i) + i * 3600.0 AS start FROM e)
    SELECT event_id, CAST(round(start - t, 3) AS DOUBLE) AS wait FROM s""")
def spaced_starts(spark, d):
    """How long each user's request waits if an hour must lie between two."""
    e = read(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").cast("double").alias("at"))
    return first.spaced_schedule(e, "user_id", "at", "event_id", 3600.0).select("event_id", F.round("wait", 3).alias("wait"))


@query("""WITH e AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE 1.0 END AS cost FROM events),
    s AS (SELECT *, coalesce(sum(cost) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM e)
    SELECT event_id, cost = 0 OR spent < 200 AS allowed FROM s""")
def budget_cutoff(spark, d):
    e = read(spark, d, "events").withColumn("cost", F.when(F.col("event_id") % 4 == 0, 0.0).otherwise(1.0))
    return first.within_budget(e, "event_type", ["ts", "event_id"], F.col("cost"), 200.0).select("event_id", "allowed")


@query("""WITH RECURSIVE r AS (SELECT id, id AS root, 0 AS steps FROM organizations WHERE merged_into IS NULL
    UNION ALL SELECT o.id, r.root, r.steps + 1 FROM organizations o JOIN r ON o.merged_into = r.id) SELECT root AS seed, id AS url, CAST(steps AS INT) AS level FROM r WHERE root IN (SELECT merged_into FROM organizations)""")
def merge_reach(spark, d):
    """Rows reached from each surviving organisation along merges: the crawl operator on that graph."""
    o = read(spark, d, "organizations")
    edges = o.filter("merged_into is not null").select(F.col("merged_into").alias("url"), F.col("id").alias("target"), F.col("id").alias("position"))
    seeds = o.filter("merged_into is null").select(F.col("id").alias("seed")).join(edges.select(F.col("url").alias("seed")), "seed", "left_semi").withColumn("single", F.lit(False))
    return crawl.reach(seeds, edges, o.select(F.col("id").alias("url"), F.lit(True).alias("ok")), max_ok=None).select("seed", "url", "level")


@query("""SELECT source_id, kind, count(*) AS n, count(score) AS n_scored, CAST(round(coalesce(avg(score), 0), 6) AS DOUBLE) AS mean_score FROM (
    SELECT source_id, json_extract_string(raw, '$.kind') AS kind, CAST(json_extract_string(raw, '$.score') AS DOUBLE) AS score FROM org_candidates) GROUP BY 1, 2""")
def raw_kinds(spark, d):
    """Kinds and scores in the candidates' raw JSON."""
    j = F.from_json("raw", "kind string, score double")
    rows = read(spark, d, "org_candidates").select("source_id", j.alias("j")).select("source_id", "j.kind", "j.score")
    return rows.groupBy("source_id", "kind").agg(F.count(F.lit(1)).alias("n"), F.count("score").alias("n_scored"), F.round(F.coalesce(F.avg("score"), F.lit(0.0)), 6).alias("mean_score"))


@query("""SELECT run_id, count(*) AS n, count(*) FILTER (vetting = 'verified') AS n_verified, count(DISTINCT domain) AS n_domains, min(created_at) AS started, max(created_at) AS ended,
    string_agg(DISTINCT field, ',' ORDER BY field) AS fields FROM enrichment_proposals GROUP BY 1""")
def run_metrics(spark, d):
    return read(spark, d, "enrichment_proposals").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("vetting") == "verified").alias("n_verified"), F.count_distinct("domain").alias("n_domains"), F.min("created_at").alias("started"), F.max("created_at").alias("ended"), F.array_join(F.array_sort(F.collect_set("field")), ",").alias("fields")
    )


@query("""SELECT id, source_id FROM org_candidates WHERE (coalesce(email, '') <> '' OR coalesce(phone, '') <> '') AND resolved_org_id IS NULL AND id NOT IN (SELECT candidate_id FROM enrichment_proposals WHERE candidate_id IS NOT NULL)
    UNION SELECT id, 'organizations' FROM organizations WHERE id IN (SELECT org_id FROM enrichment_proposals)""")
def semi_anti_sets(spark, d):
    p = read(spark, d, "enrichment_proposals")
    c = read(spark, d, "org_candidates").filter("(coalesce(email, '') <> '' or coalesce(phone, '') <> '') and resolved_org_id is null").select("id", "source_id")
    c = c.join(p.select(F.col("candidate_id").alias("id")), "id", "left_anti")
    o = read(spark, d, "organizations").select("id", F.lit("organizations").alias("source_id")).join(p.select(F.col("org_id").alias("id")), "id", "left_semi")
    return c.unionByName(o).distinct()


@query("""WITH h AS (SELECT id, kind, x FROM (SELECT id, json_extract_string(raw, '$.kind') AS kind, lat, lng, email FROM org_candidates) c, LATERAL (SELECT c.email AS x) WHERE c.lat BETWEEN 41 AND 60 AND c.lng BETWEEN -120 AND -60)
    SELECT id, kind FROM h WHERE kind = 'place_of_worship' OR coalesce(x, '') LIKE 'info@%'""")
def box_and_kind(spark, d):
    """A scan with a box, an alternative and a projection, as importers make it."""
    rows = read(spark, d, "org_candidates").filter(F.col("lat").between(41, 60) & F.col("lng").between(-120, -60)).select("id", F.get_json_object("raw", "$.kind").alias("kind"), "email")
    return rows.filter((F.col("kind") == "place_of_worship") | F.coalesce("email", F.lit("")).startswith("info@")).select("id", "kind")


@query("""SELECT org_id, min_by(email, struct_pack(created_at, id)) FILTER (email IS NOT NULL) AS email, min_by(phone, struct_pack(created_at, id)) FILTER (phone IS NOT NULL) AS phone,
    min_by(city, struct_pack(created_at, id)) FILTER (city IS NOT NULL) AS city FROM (SELECT resolved_org_id AS org_id, * FROM org_candidates WHERE resolved_org_id IS NOT NULL) GROUP BY 1""")
def first_known_fields(spark, d):
    c = read(spark, d, "org_candidates").filter("resolved_org_id is not null").withColumnRenamed("resolved_org_id", "org_id")
    return first.first_known(c, ["org_id"], ["created_at", "id"], ["email", "phone", "city"])
