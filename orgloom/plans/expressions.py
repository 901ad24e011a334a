"""Queries that run the expressions of ``functions`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgloom.functions import geo, outcomes, text, url
from orgloom.operators import contained, jobs
from orgloom.plans.core_queries import read
from orgloom.plans.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query
HOST_SQL = "regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), ':\\d*$', ''), '^www\\.', '')"
APEX_SQL = "(CASE WHEN regexp_extract({0}, '([^.]+\\.[^.]+)$', 1) = '' THEN {0} ELSE regexp_extract({0}, '([^.]+\\.[^.]+)$', 1) END)"


def sql_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


# --- outcomes of fetches -------------------------------------------------------------------------

REASONS = ["status 429", "status 404", "blocked unsafe redirect: loopback", "error: connection reset", "read timeout", "content too short (120 chars)", "no pages fetched", "crawl failed: status 403", "crawl failed: blocked by robots.txt", "crawl failed: blocked by url_guard: dns resolution failed", "crawl failed: status 503", None]


@query("""WITH k(i, kind) AS (VALUES (0, 'retryable'), (1, 'permanent'), (2, 'blocked'), (3, 'retryable'), (4, 'retryable'), (5, 'thin'), (6, 'permanent'), (7, 'blocked'), (8, 'blocked'), (9, 'blocked'), (10, 'retryable'), (11, 'permanent'))
    SELECT event_type, kind, count(*) AS n, count(*) FILTER (kind = 'retryable') AS n_retry FROM events JOIN k ON event_id % 12 = i GROUP BY 1, 2""")
def failure_kinds(spark, d):
    """Reasons of failures, dealt to the events, by kind."""
    reason = F.get(F.array(*[F.lit(r) for r in REASONS]), (F.col("event_id") % 12).cast("int"))
    rows = read(spark, d, "events").select("event_type", outcomes.failure_kind(reason).alias("kind"), outcomes.may_retry(reason).alias("again"))
    return rows.groupBy("event_type", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("again").alias("n_retry"))


@query("""WITH s AS (SELECT user_id, list(CASE event_id % 5 WHEN 0 THEN 503 WHEN 1 THEN 429 WHEN 2 THEN NULL WHEN 3 THEN 200 ELSE 404 END ORDER BY ts, event_id) AS s FROM events GROUP BY 1),
    f AS (SELECT user_id, s[1:3] AS s FROM s), p AS (SELECT user_id, s, list_position(list_transform(s, lambda x: x IS NOT NULL AND x NOT IN (429, 500, 502, 503, 504)), true) AS p FROM f)
    SELECT user_id, CAST(coalesce(nullif(p, 0), len(s)) AS INT) AS attempts, CAST(s[coalesce(nullif(p, 0), len(s))] AS INT) AS last FROM p""")
def retry_attempts(spark, d):
    """How often each user's request is made if it is made again, three times in all, after a passing failure."""
    state = F.get(F.array(*[F.lit(x).cast("int") for x in (503, 429, None, 200, 404)]), (F.col("event_id") % 5).cast("int"))
    rows = read(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", state.alias("s")))).alias("e"))
    return rows.select("user_id", jobs.attempts_until_done(F.transform("e", lambda e: e.s), outcomes.TRANSIENT_STATES, 3).alias("a")).select("user_id", "a.*")


# --- URLs ----------------------------------------------------------------------------------------

@query(f"""WITH h AS (SELECT id, {HOST_SQL.format("website")} AS seed, {HOST_SQL.format("'https://' || split_part(email, '@', 2)")} AS cand FROM org_candidates WHERE email IS NOT NULL AND website IS NOT NULL),
    a AS (SELECT id, seed, cand, {APEX_SQL.format("seed")} AS apex FROM h) SELECT id, apex <> '' AND cand <> '' AND (cand = apex OR ends_with(cand, '.' || apex)) AS inside FROM a""")
def scope_pairs(spark, d):
    """Whether the domain of a candidate's address is on its site."""
    c = read(spark, d, "org_candidates").filter("email is not null and website is not null")
    return c.select("id", url.in_scope(F.col("website"), F.concat(F.lit("https://"), text.email_domain(F.col("email")))).alias("inside"))


@query(f"""WITH u AS (SELECT doc_id, url || CASE doc_id % 5 WHEN 0 THEN '.PDF' WHEN 1 THEN '?f=a.pdf' WHEN 2 THEN '.json' ELSE '' END AS u FROM documents WHERE url IS NOT NULL)
    SELECT doc_id, regexp_matches(u, '^(?i:https?)://') AND NOT regexp_matches(lower(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1)),
    '\\.(pdf|doc|docx|xls|xlsx|ppt|pptx|zip|gz|rar|7z|exe|dmg|jpg|jpeg|png|gif|webp|svg|ico|css|js|mp3|mp4|avi|mov|mkv|woff|woff2|ttf|eot|rss|atom|xml|json)$') AS crawlable FROM u""")
def crawlable_urls(spark, d):
    """Whether a document's URL, with an ending added to some, is a page's."""
    tail = F.get(F.array(*[F.lit(x) for x in (".PDF", "?f=a.pdf", ".json", "", "")]), (F.col("doc_id") % 5).cast("int"))
    return read(spark, d, "documents").filter("url is not null").select("doc_id", url.crawlable(F.concat("url", tail)).alias("crawlable"))


@query(f"""WITH h AS (SELECT id, {HOST_SQL.format("website")} AS h FROM org_candidates WHERE trim(website) <> '') SELECT h AS host, count(*) AS n FROM h
    WHERE contains(h, 'facebook.com') OR contains(h, 'instagram.com') OR contains(h, 'twitter.com') OR contains(h, 'x.com') OR contains(h, 'youtube.com') OR contains(h, 'google.com') OR contains(h, 'wa.me') OR contains(h, 'link') GROUP BY 1""")
def blacklisted_hosts(spark, d):
    """Hosts that contain an entry of a list anywhere, by how many candidates name them."""
    bad = ["facebook.com", "instagram.com", "twitter.com", "x.com", "youtube.com", "google.com", "wa.me", "link"]
    h = read(spark, d, "org_candidates").filter("trim(website) <> ''").select(url.host(F.col("website")).alias("host"))
    return h.filter(url.host_contains(F.col("host"), bad)).groupBy("host").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH e AS (SELECT event_id, event_id % 256 AS a, (event_id * 7) % 256 AS b, (event_id * 13) % 256 AS c FROM events)
    SELECT event_id, NOT (a IN (0, 10, 127) OR a >= 224 OR (a = 100 AND b BETWEEN 64 AND 127) OR (a = 169 AND b = 254) OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168)
        OR (a = 192 AND b = 0 AND c IN (0, 2)) OR (a = 198 AND b IN (18, 19)) OR (a = 198 AND b = 51 AND c = 100) OR (a = 203 AND b = 0 AND c = 113)) AND event_id % 11 <> 0 AS public FROM e""")
def public_urls(spark, d):
    """Whether addresses made of the events' numbers are public; every eleventh has another scheme."""
    part = lambda k: ((F.col("event_id") * k) % 256).cast("string")
    address = F.concat(F.when(F.col("event_id") % 11 == 0, "ftp").otherwise("http"), F.lit("://"), F.concat_ws(".", part(1), part(7), part(13), F.lit("5")), F.lit(":80/x"))
    return read(spark, d, "events").select("event_id", url.is_public_literal(address).alias("public"))


@query(f"""WITH o AS (SELECT id, website, email, regexp_replace(lower(regexp_extract(CASE WHEN contains(site, '://') THEN site ELSE 'https://' || site END, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS h FROM (
        SELECT id, website, email, coalesce(nullif(website, ''), 'https://' || nullif(split_part(email, '@', 2), '')) AS site FROM organizations)),
    a AS (SELECT id, nullif({APEX_SQL.format("h")}, '') AS apex, regexp_replace(lower(regexp_extract(website, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS p FROM o)
    SELECT id, apex, coalesce(apex <> '' AND {APEX_SQL.format("p")} = apex, false) AS own FROM a""")
def own_pages(spark, d):
    """The apex of each organisation, and whether its website's address is on it."""
    o = read(spark, d, "organizations")
    top = url.org_apex(F.col("website"), text.email_domain(F.col("email")))
    return o.select("id", top.alias("apex"), url.on_org_page(F.col("website"), top).alias("own"))


@query("""WITH b AS (SELECT id, lower(regexp_replace(regexp_replace(coalesce(website, ''), '^https?://(www\\.)?', ''), '/+$', '')) AS site FROM org_candidates) SELECT site, count(*) AS n FROM b GROUP BY 1""")
def sites_without_slash(spark, d):
    return read(spark, d, "org_candidates").groupBy(url.without_scheme_and_slash(F.col("website")).alias("site")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH l AS (SELECT doc_id, url, unnest(list_distinct(list_transform(regexp_extract_all(text, '(?is)<a\\b[^>]*?\\shref\\s*=\\s*["'']?([^"''\\s>]*)', 1), lambda t: trim(replace(t, '&amp;', '&'))))) AS t FROM documents WHERE url IS NOT NULL)
    SELECT DISTINCT doc_id, regexp_replace(t, '#.*$', '') AS target FROM l WHERE regexp_matches(t, '^https?://[^/]+/') """)
def absolute_links(spark, d):
    """Links of documents to other sites, resolved against the document's own URL."""
    docs = read(spark, d, "documents").filter("url is not null").select("doc_id", F.explode(url.links(F.col("url"), F.col("text"))).alias("target"), url.netloc(F.col("url")).alias("own"))
    return docs.filter(url.netloc(F.col("target")) != F.col("own")).select("doc_id", "target")


# --- texts ---------------------------------------------------------------------------------------

@query("""SELECT id, rtrim(left(trim(regexp_replace(lower(regexp_replace(regexp_replace(strip_accents(name), '\\p{Z}', ' ', 'g'), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-'), 60), '-') AS slug, left(sha256(name), 8) AS hash FROM organizations WHERE name IS NOT NULL""")
def slugs(spark, d):
    o = read(spark, d, "organizations").filter("name is not null")
    return o.select("id", text.slug(F.col("name")).alias("slug"), text.short_hash(F.col("name")).alias("hash"))


@query("""SELECT id, trim(regexp_replace(replace(replace(address_line1, chr(8206), ''), chr(8203), ''), '[\\s\\x{0085}\\p{Z}]+', ' ', 'g')) AS clean, length(address_line1) AS before FROM org_candidates WHERE address_line1 IS NOT NULL""")
def squeezed_addresses(spark, d):
    c = read(spark, d, "org_candidates").filter("address_line1 is not null")
    return c.select("id", text.squeeze(F.col("address_line1")).alias("clean"), F.length("address_line1").cast("long").alias("before"))


@query("""SELECT id, replace(replace(replace(replace(name, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS shown FROM org_candidates WHERE name IS NOT NULL""")
def escaped_names(spark, d):
    return read(spark, d, "org_candidates").filter("name is not null").select("id", text.escape(F.col("name")).alias("shown"))


@query("""WITH s AS (SELECT source_id, ' ' || upper(string_agg(DISTINCT left(trim(external_id), 2), ' , ' ORDER BY left(trim(external_id), 2))) || ',,' AS t FROM org_candidates GROUP BY 1)
    SELECT source_id, e FROM (SELECT source_id, unnest(list_filter(list_transform(string_split(t, ','), lambda x: lower(trim(x))), lambda x: x <> '')) AS e FROM s)""")
def csv_entries(spark, d):
    """Entries of comma lists."""
    c = read(spark, d, "org_candidates").groupBy("source_id").agg(F.array_join(F.array_sort(F.collect_set(F.substring(F.trim("external_id"), 1, 2))), " , ").alias("t"))
    return c.select("source_id", F.explode(text.csv_list(F.concat(F.lit(" "), F.upper("t"), F.lit(",,")))).alias("e"))


SITE_HOST_SQL = "lower(split_part(regexp_replace(website, '^https?://(www\\.)?', '', 'i'), '/', 1))"


@query(f"""SELECT id, split_part(email, '@', 2) AS domain, string_split(email, '@')[-1] AS last_domain, coalesce(email IS NOT NULL AND website IS NOT NULL AND lower(split_part(email, '@', 2)) <> '' AND {SITE_HOST_SQL} <> ''
    AND ({SITE_HOST_SQL} = lower(split_part(email, '@', 2)) OR ends_with({SITE_HOST_SQL}, '.' || lower(split_part(email, '@', 2))) OR ends_with(lower(split_part(email, '@', 2)), '.' || {SITE_HOST_SQL})), false) AS own FROM organizations""")
def email_domains(spark, d):
    """The domain of each address by either reading, and whether it is the site's."""
    e = F.col("email")
    return read(spark, d, "organizations").select("id", text.email_domain(e).alias("domain"), text.last_email_domain(e).alias("last_domain"), text.email_on_site(e, url.site_host(F.col("website"))).alias("own"))


@query("""WITH v AS (SELECT id, unnest(map_values(social)) AS v FROM org_candidates), p AS (SELECT lower(v) AS v FROM v WHERE v IS NOT NULL)
    SELECT CASE WHEN contains(v, 'facebook.com') OR contains(v, 'fb.com') THEN 'facebook' WHEN contains(v, 'instagram.com') OR contains(v, 'instagr.am') THEN 'instagram' WHEN contains(v, 'youtube.com') OR contains(v, 'youtu.be') THEN 'youtube'
        WHEN contains(v, 'whatsapp.com') OR contains(v, 'wa.me') THEN 'whatsapp' WHEN contains(v, 'tiktok.com') THEN 'tiktok' WHEN contains(v, 'linkedin.com') OR contains(v, 'lnkd.in') THEN 'linkedin'
        WHEN contains(v, 'twitter.com') THEN 'twitter' WHEN contains(v, 'x.com') THEN 'x' END AS platform, count(*) AS n FROM p GROUP BY 1""")
def platform_counts(spark, d):
    v = read(spark, d, "org_candidates").select(F.explode(F.map_values("social")).alias("v")).filter("v is not null")
    return v.groupBy(text.platform(F.col("v")).alias("platform")).agg(F.count(F.lit(1)).alias("n"))


LABELS = "com|ca|org|net|edu|gov|io|us|uk|co|info|biz|me|dev|app|xyz|online|site|live|store|email|church|islam|mosque|de|fr|nl|au|in|pk|ir|sa|eg|tr|my|id|eu|ch|it|es|pl"
LONGEST_FIRST = "online|church|mosque|store|email|islam|info|site|live|com|org|net|edu|gov|biz|dev|app|xyz|ca|io|us|uk|co|me|de|fr|nl|au|in|pk|ir|sa|eg|tr|my|id|eu|ch|it|es|pl"
RUN_ON_SQL = f"CASE WHEN regexp_matches({{0}}, '\\.({LABELS})$') THEN {{0}} ELSE regexp_replace({{0}}, '\\.({LONGEST_FIRST})[a-z]+$', '.\\1') END"
JUNK_SQL = " OR ".join(f"contains({{0}}, '{j}')" for j in ["example.", "sentry", "wixpress", ".png", ".jpg", ".gif", ".webp", ".css", ".js", "yourdomain", "domain.com", "email.com", "@2x", "no-reply", "noreply", "@duckduckgo.com", "@google.com"])
FOUND_SQL = "regexp_extract_all({0}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}')"
PHONES_SQL = r"""list_filter(list_transform(regexp_extract_all({0}, '(?:^|[^\d])((?:\+?1[\s.-]?)?\(?[2-9]\d{{2}}\)?[\s.-]?\d{{3}}[\s.-]?\d{{4}})(?:[^\d]|$)', 1), lambda p: right(regexp_replace(p, '\D', '', 'g'), 10)),
    lambda p: left(p, 3) NOT IN ('201','212','213','214','305','310','312','323','404','415','469','512','602','614','617','619','646','702','704','713','718','727','971'))"""


@query(f"""WITH e AS (SELECT doc_id, unnest(list_transform({FOUND_SQL.format("text")}, lambda x: lower(x))) AS e, generate_subscripts({FOUND_SQL.format("text")}, 1) AS i FROM documents WHERE text IS NOT NULL),
    c AS (SELECT doc_id, {RUN_ON_SQL.format("e")} AS e, i FROM e),
    k AS (SELECT doc_id, e, min(i) AS i FROM c WHERE NOT ({JUNK_SQL.format("e")}) AND NOT regexp_matches(e, '\\.(png|jpe?g|gif|webp|css|js|svg)$') GROUP BY 1, 2)
    SELECT doc_id, string_agg(e, ',' ORDER BY (split_part(e, '@', 1) NOT IN ('info', 'admin', 'contact', 'office', 'masjid', 'administrator', 'secretary', 'imam')), length(e), i) AS emails FROM k GROUP BY 1""")
def document_contacts(spark, d):
    """Contact addresses of whole texts in order of preference, by the default rules."""
    return read(spark, d, "documents").select("doc_id", F.array_join(text.clean_emails(F.col("text")), ",").alias("emails")).filter("emails <> ''")


@query(f"""WITH p AS (SELECT doc_id, unnest({PHONES_SQL.format("text")}) AS p, generate_subscripts({PHONES_SQL.format("text")}, 1) AS i FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, CAST(i - 1 AS INT) AS seq, left(p, 3) || '-' || substr(p, 4, 3) || '-' || right(p, 4) AS phone FROM p""")
def document_phones(spark, d):
    """Numbers of whole texts in order."""
    return read(spark, d, "documents").select("doc_id", F.posexplode(text.phones(F.col("text"))).alias("seq", "phone"))


PLACE_PATTERN = r"""'\b([A-Z][A-Za-z''.\- ]{2,28}?),\s*(ON|BC|AB|SK|MB|QC|NS|NB|NL|PE|YT|NT|NU)\b'"""
PLACE_SQL = f"""list_filter(list_transform(regexp_extract_all(t, {PLACE_PATTERN}, 1), lambda c: lower(trim(c))), lambda c: length(c) > 2)[1]"""


@query(f"""WITH t AS (SELECT doc_id, concat(' ', coalesce(url, ''), ' ', coalesce(text, '')) AS t FROM documents)
    SELECT doc_id, nullif(upper(regexp_extract(t, '\\b([A-PR-Wa-pr-w]\\d[A-PR-Za-pr-w])\\s?\\d[A-PR-Za-pr-w]\\d\\b', 1)), '') AS postal_area, {PLACE_SQL} AS city,
        {PHONES_SQL.format("t")}[1] AS phone FROM t""")
def document_fields(spark, d):
    """The contact fields of each document as a hit: postal area, city (in small letters) and first number."""
    f = text.fields(F.lit(None).cast("string"), F.col("url"), F.col("text"))
    return read(spark, d, "documents").select("doc_id", f.alias("f")).select("doc_id", "f.postal_area", F.lower("f.city").alias("city"), F.replace("f.phone", F.lit("-"), F.lit("")).alias("phone"))


@query(f"""WITH e AS (SELECT doc_id, unnest(list_transform({FOUND_SQL.format("text")}, lambda x: lower(x))) AS e, generate_subscripts({FOUND_SQL.format("text")}, 1) AS i FROM documents WHERE text IS NOT NULL),
    k AS (SELECT doc_id, e, i FROM e WHERE NOT ({JUNK_SQL.format("e")}) AND NOT regexp_matches(e, '\\.(png|jpe?g|gif|webp|css|js|svg)$'))
    SELECT doc_id, min_by(e, struct_pack(a := split_part(e, '@', 1) NOT IN ('info', 'admin', 'contact', 'office', 'masjid', 'administrator', 'secretary'), b := length(e), c := i)) AS email FROM k GROUP BY 1""")
def document_first_email(spark, d):
    """The one address of each document by the older rules."""
    return read(spark, d, "documents").select("doc_id", text.plain_fields(F.col("text")).email.alias("email")).filter("email is not null")


@query(f"""WITH o AS (SELECT DISTINCT id, website, {SITE_HOST_SQL} AS h FROM organizations WHERE website IS NOT NULL), p AS (SELECT o.id, o.website, t.doc_id, t.text FROM o JOIN documents t ON t.domain = o.h WHERE t.text IS NOT NULL),
    n AS (SELECT *, lower(rtrim(split_part(split_part(replace(website, '&amp;', '&'), '#', 1), '?', 1), '/')) AS path, substr(split_part(website, '#', 1), length(split_part(split_part(website, '#', 1), '?', 1)) + 2) AS q,
        list_transform(regexp_extract_all(text, 'https?://[^\\s"''<>\\\\]+'), lambda u: split_part(replace(u, '&amp;', '&'), '#', 1)) AS us FROM p)
    SELECT id, doc_id, regexp_matches(path, '^https?://') AND len(list_filter(us, lambda u: lower(rtrim(split_part(u, '?', 1), '/')) = path AND starts_with(substr(u, length(split_part(u, '?', 1)) + 2), q))) > 0 AS named,
        contains(text, website) AS exact FROM n""")
def named_sites(spark, d):
    """Whether documents of an organisation's own domain name its website, by path and query, or to the letter."""
    o = read(spark, d, "organizations").filter("website is not null").select("id", "website").distinct()
    o = o.select(url.site_host(F.col("website")).alias("domain"), "id", "website", text.url_parts(F.col("website")).alias("want"))
    t = read(spark, d, "documents").filter("text is not null").select("domain", "doc_id", "text", text.urls_parts(F.col("text")).alias("urls"))
    plain = {"named": text.among_urls(F.col("website"), F.col("want"), F.col("urls")), "exact": text.contains_exact(F.col("website"), F.col("text"))}

    def held(needles, hays):
        by_path: dict[str, list[tuple[str, str]]] = {}
        for site, want in zip(needles["website"], needles["want"]):
            if site.startswith(("http://", "https://")):
                by_path.setdefault(want["path"], []).append((want["query"], site))
        named = [list({s for u in urls for q, s in by_path.get(u["path"], ()) if u["query"].startswith(q)}) for urls in hays["urls"]]
        return {"named": named, "exact": contained.contained(list(needles["website"]), list(hays["text"]))}

    return contained.marked_pairs(o, t, "domain", "id", "website", "doc_id", F.length("text"), held, plain, rest={"exact": lambda site: site == ""})


@query(f"""WITH o AS (SELECT DISTINCT id, name, {SITE_HOST_SQL} AS h FROM organizations WHERE website IS NOT NULL)
    SELECT o.id, t.doc_id, regexp_replace(lower(o.name), '[^a-z0-9]', '', 'g') <> '' AND contains(regexp_replace(lower(t.text), '[^a-z0-9]', '', 'g'), regexp_replace(lower(o.name), '[^a-z0-9]', '', 'g')) AS named FROM o JOIN documents t ON t.domain = o.h WHERE t.text IS NOT NULL AND o.name IS NOT NULL""")
def verbatim_names(spark, d):
    """Whether documents of an organisation's own domain hold its name, whatever signs stand between the letters."""
    o = read(spark, d, "organizations").filter("website is not null and name is not null").select("id", "name", url.site_host(F.col("website")).alias("domain")).distinct()
    o = o.select("domain", "id", text.bare(F.col("name")).alias("needle"))
    t = read(spark, d, "documents").filter("text is not null").select("domain", "doc_id", text.bare(F.col("text")).alias("hay"))
    held = lambda needles, hays: {"named": contained.contained(list(needles["needle"]), list(hays["hay"]))}
    return contained.marked_pairs(o, t, "domain", "id", "needle", "doc_id", F.length("hay"), held, {"named": (F.col("needle") != "") & F.col("hay").contains(F.col("needle"))})


@query("""SELECT run_id, CAST(round_even(100.0 * count(*) FILTER (vetting = 'verified') / count(*), 0) AS INT) || '%' AS verified, strftime(min(created_at), '%B %-d, %Y') AS began, strftime(max(created_at), '%Y%m%dT%H%M%SZ') AS stamp FROM enrichment_proposals GROUP BY 1""")
def run_labels(spark, d):
    p = read(spark, d, "enrichment_proposals").groupBy("run_id").agg(F.count_if(F.col("vetting") == "verified").alias("v"), F.count(F.lit(1)).alias("n"), F.min("created_at").alias("a"), F.max("created_at").alias("b"))
    return p.select("run_id", text.percent(F.col("v"), F.col("n")).alias("verified"), text.long_date(F.col("a")).alias("began"), text.run_stamp(F.col("b")).alias("stamp"))


@query("""SELECT id, md5(raw) AS hash FROM org_candidates WHERE raw IS NOT NULL""")
def unfenced(spark, d):
    """JSON texts put into a fenced block and taken out of it again."""
    c = read(spark, d, "org_candidates").filter("raw is not null")
    fenced = F.concat(F.lit(" ```json\n"), "raw", F.lit("\n``` "))
    return c.select("id", F.md5(text.without_fence(F.when(F.length("id") % 2 == 0, fenced).otherwise(F.concat(F.lit("```\n"), "raw", F.lit("\n```"))))).alias("hash"))


# --- provinces -----------------------------------------------------------------------------------

POSTAL_SQL = """CASE upper(substr(trim(postal_code), 1, 1)) WHEN 'A' THEN 'NS' WHEN 'B' THEN 'NS' WHEN 'C' THEN 'SK' WHEN 'E' THEN 'NB' WHEN 'G' THEN 'QC' WHEN 'H' THEN 'QC' WHEN 'J' THEN 'QC' WHEN 'K' THEN 'ON' WHEN 'L' THEN 'ON'
    WHEN 'M' THEN 'ON' WHEN 'N' THEN 'ON' WHEN 'P' THEN 'ON' WHEN 'R' THEN 'MB' WHEN 'S' THEN 'SK' WHEN 'T' THEN 'AB' WHEN 'V' THEN 'BC' WHEN 'Y' THEN 'NT' END"""


@query(f"""WITH c AS (SELECT lower(name) AS city, min(province) AS by_city FROM ref_places WHERE kind = 'city' GROUP BY 1 HAVING count(DISTINCT province) = 1),
    p AS (SELECT o.id, o.province AS old, upper(trim(o.province)) AS own, {POSTAL_SQL} AS postal, c.by_city FROM organizations o LEFT JOIN c ON c.city = lower(trim(regexp_replace(o.city, '[\\s\\x{{0085}}\\p{{Z}}]+', ' ', 'g')))),
    b AS (SELECT *, own IN ('ON', 'QC', 'BC', 'AB', 'SK', 'MB', 'NS', 'NB', 'NL', 'PE', 'NT', 'YT', 'NU') AS valid FROM p)
    SELECT id, CASE WHEN valid THEN own ELSE coalesce(postal, by_city) END AS province, CASE WHEN valid THEN 'own' WHEN postal IS NOT NULL THEN 'postal' WHEN by_city IS NOT NULL THEN 'city' END AS how,
        coalesce(postal <> by_city, false) AS conflict, coalesce(CASE WHEN valid THEN own ELSE coalesce(postal, by_city) END, '') <> coalesce(old, '') AS changed FROM b""")
def province_backfill(spark, d):
    """Each organisation's province: its own valid code, else by its postal code, else by its city if that is in one province only."""
    places = read(spark, d, "ref_places").filter("kind = 'city'").groupBy(F.lower("name").alias("city_key")).agg(F.min("province").alias("by_city"), F.count_distinct("province").alias("n")).filter("n = 1").drop("n")
    o = read(spark, d, "organizations").select("id", F.col("province").alias("old"), "postal_code", F.lower(text.squeeze(F.col("city"))).alias("city_key"))
    best = geo.derived_province(F.trim("old"), geo.province_from_postal(F.col("postal_code")), F.col("by_city"))
    rows = o.join(places, "city_key", "left").select("id", "old", best.alias("b"))
    return rows.select("id", "b.province", "b.how", "b.conflict", (F.coalesce("b.province", F.lit("")) != F.coalesce("old", F.lit(""))).alias("changed"))


@query("""WITH k AS (SELECT id, lower(trim(province)) AS p FROM org_candidates WHERE province IS NOT NULL) SELECT id, CASE WHEN p IN ('on', 'qc', 'bc', 'ab', 'sk', 'mb', 'ns', 'nb', 'nl', 'pe', 'nt', 'yt', 'nu') THEN upper(p)
    WHEN p = 'alberta' THEN 'AB' WHEN p = 'british columbia' THEN 'BC' WHEN p = 'manitoba' THEN 'MB' WHEN p = 'new brunswick' THEN 'NB' WHEN p IN ('newfoundland and labrador', 'newfoundland') THEN 'NL' WHEN p = 'northwest territories' THEN 'NT'
    WHEN p = 'nova scotia' THEN 'NS' WHEN p = 'nunavut' THEN 'NU' WHEN p = 'ontario' THEN 'ON' WHEN p = 'prince edward island' THEN 'PE' WHEN p = 'quebec' THEN 'QC' WHEN p = 'saskatchewan' THEN 'SK' WHEN p = 'yukon' THEN 'YT' END AS code,
    CASE WHEN regexp_replace(p, '^[a-z]{2}-', '') IN ('on', 'qc', 'bc', 'ab', 'sk', 'mb', 'ns', 'nb', 'nl', 'pe', 'nt', 'yt', 'nu') THEN upper(regexp_replace(p, '^[a-z]{2}-', '')) END AS region FROM k""")
def province_codes(spark, d):
    """Typed provinces by name or code, and as regions with a country before them."""
    p = F.col("province")
    return read(spark, d, "org_candidates").filter("province is not null").select("id", geo.province_code(p).alias("code"), geo.region_code(p).alias("region"))
