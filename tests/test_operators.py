"""Relational operators on small literal tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from orgloom.functions import text, url
from orgloom.operators import contained, crawl, directory, enrich, first, jobs, payloads, persist, proximity, quality, report, resolve, skew, upsert
from orgloom.plans import catalogue, expressions


def test_first_rows_and_cap(spark, rows):
    df = spark.createDataFrame([("a", 1, "u"), ("a", 2, "u"), ("a", 3, "v"), ("a", 4, "w"), ("b", 5, "x"), (None, 6, "y")], "host string, seq int, url string")
    assert rows(first.capped_hits(df, "url", "host", [F.col("seq")], 2).select("seq")) == [(1,), (3,), (5,), (6,)]
    assert rows(first.earliest(df, ["host"], ["seq"])) == [("a", 1, "u"), ("b", 5, "x"), (None, 6, "y")]


def test_preferred_and_known(spark, rows):
    df = spark.createDataFrame([("k", 1, None, "x"), ("k", 2, "b", None), ("k", 3, "c", "z")], "k string, seq int, p string, q string")
    assert rows(first.first_known(df, ["k"], ["seq"], ["p", "q"])) == [("k", "b", "x")]
    assert rows(first.preferred(df, ["k"], F.col("seq") == 3, [F.col("seq")]).select("seq")) == [(3,)]


def test_joined_in_order(spark, rows):
    df = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a"), ("s", 3, "c")], "s string, o int, t string")
    assert rows(first.joined_in_order(df, ["s"], "o", F.col("t"), "-", 2)) == [("s", "a-b", False)]
    assert rows(first.joined_in_order(df, ["s"], "o", F.col("t"), "-", 9, longest=3)) == [("s", "a-b", True)]


def test_schedule_equals_the_loop(spark):
    random.seed(3)
    data = [(random.choice("xy"), round(random.uniform(0, 9), 2), i) for i in range(60)]
    got = {r.i: r.start for r in first.spaced_schedule(spark.createDataFrame(data, "h string, t double, i int"), "h", "t", "i", 1.0).collect()}
    last = {}
    for h, t, i in sorted(data, key=lambda x: (x[0], x[1], x[2])):
        last[h] = max(t, last.get(h, -math.inf) + 1.0)
        assert got[i] == pytest.approx(last[h])


def test_budget(spark, rows):
    df = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, 1.0), (4, 1.0), (5, 0.0)], "seq int, cost double").withColumn("run", F.lit("r"))
    assert rows(first.within_budget(df, "run", ["seq"], F.col("cost"), 2.0).select("seq", "allowed")) == [(1, True), (2, True), (3, True), (4, False), (5, True)]


def test_upsert_policies(spark, rows):
    old = spark.createDataFrame([("a", None, "o", "k", "x"), ("b", "n", "o", "k", "x")], "id string, p string, q string, r string, s string")
    new = spark.createDataFrame([("a", "new", None, "z", "y"), ("c", "new", None, "z", "y")], "id string, p string, q string, r string, s string")
    got = rows(upsert.upsert(old, new, ["id"], {"p": "coalesce_old", "q": "coalesce_new", "s": "replace"}))
    assert got == [("a", "new", "o", "k", "y"), ("b", "n", "o", "k", "x"), ("c", "new", None, "z", "y")]
    assert rows(upsert.changes(old, upsert.upsert(old, new, ["id"], {"s": "replace"}), ["id"])) == [("a", "update"), ("c", "insert")]


def test_upsert_null_keys_and_condition(spark, rows):
    old = spark.createDataFrame([(None, 1, "done"), ("k", 1, "open")], "k string, v int, st string")
    new = spark.createDataFrame([(None, 2, "x"), ("k", 2, "x")], "k string, v int, st string")
    got = upsert.upsert(old, new, ["k"], {"v": "replace"}, when=lambda o, n: F.col(f"{o}.st") == "open", null_keys=True)
    assert rows(got) == [("k", 2, "open"), (None, 1, "done")]
    assert upsert.upsert(old, new, ["k"], {"v": "replace"}).count() == 3  # null keys don't meet
    assert upsert.upsert(old.limit(0), new.limit(0), ["k"], {}).count() == 0
    assert rows(upsert.insert_missing(old, new, ["k"]).select("k", "v")) == [("k", 1), (None, 1), (None, 2)]


def test_resolution_tiers(spark, rows):
    c = "id string, name string, website string, lat double, lng double"
    cand = [("1", "Masjid Noor", "https://p.org/noor", None, None), ("2", "Noor Mosque", "http://www.noor.ca", 43.0, -79.0), ("3", "Noor Mosque", None, 43.0005, -79.0005), ("4", None, None, None, None), ("5", "Other", "https://other.ca", 43.0, -79.0)]
    orgs = [("A", "X", "http://p.org/noor", None, None), ("B", "Noor Mosque", "https://noor.ca/home", 43.001, -79.001), ("C", "", "", 0.0, 0.0)]
    got = rows(resolve.resolve(spark.createDataFrame(cand, c), spark.createDataFrame(orgs, c)).select("candidate_id", "org_id", "tier"))
    assert got == [("1", "A", "exact"), ("2", "B", "domain"), ("3", "B", "geoname")]
    assert resolve.resolve(spark.createDataFrame([], c), spark.createDataFrame(orgs, c)).count() == 0


def test_crawl_order_and_caps(spark):
    seeds = spark.createDataFrame([("s", False), ("p", True)], "seed string, single boolean")
    edges = spark.createDataFrame([("s", "a", 1), ("s", "b", 2), ("s", "a", 3), ("a", "c", 1), ("b", "s", 1), ("b", "d", 2), ("p", "q", 1)], "url string, target string, position int")
    pages = spark.createDataFrame([("s", True), ("a", False), ("b", True), ("c", True), ("d", True), ("p", True), ("q", True)], "url string, ok boolean")
    got = {(r.seed, r.url): r.place for r in crawl.reach(seeds, edges, pages).collect()}
    assert got == {("s", "s"): 1, ("s", "a"): 2, ("s", "b"): 3, ("s", "d"): 4, ("p", "p"): 1}  # a failed, so c isn't seen; p is a single page
    assert {r.url for r in crawl.reach(seeds, edges, pages, max_ok=2).filter("seed = 's'").collect()} == {"s", "a", "b"}


@pytest.mark.parametrize("max_ok", [4, None])
def test_crawl_equals_a_queue(spark, max_ok):
    random.seed(9)
    n = 40
    links = {i: random.sample(range(n), random.randint(0, 4)) for i in range(n)}
    fine = {i: random.random() > 0.25 for i in range(n)}
    edges = spark.createDataFrame([(str(i), str(t), k) for i, ts in links.items() for k, t in enumerate(ts)], "url string, target string, position int")
    pages = spark.createDataFrame([(str(i), ok) for i, ok in fine.items()], "url string, ok boolean")
    seeds = spark.createDataFrame([("0", False), ("7", False), ("9", True)], "seed string, single boolean")
    want = {}
    for seed, single in ((0, False), (7, False), (9, True)):
        queue, seen, good, place = [seed], {seed}, 0, 0
        while queue and (max_ok is None or good < max_ok):
            at = queue.pop(0)
            place += 1
            want[(str(seed), str(at))] = place
            if fine[at]:
                good += 1
                if single:
                    break
                for t in links[at]:
                    if t not in seen:
                        seen.add(t)
                        queue.append(t)
    assert {(r.seed, r.url): r.place for r in crawl.reach(seeds, edges, pages, max_ok=max_ok).collect()} == want


def test_a_long_chain_is_followed_to_its_end(spark):
    n = 40
    edges = spark.createDataFrame([(f"p{i}", f"p{i + 1}", 0) for i in range(n)], "url string, target string, position int")
    pages = spark.createDataFrame([(f"p{i}", True) for i in range(n + 1)], "url string, ok boolean")
    got = crawl.reach(spark.createDataFrame([("p0", False)], "seed string, single boolean"), edges, pages, max_ok=None)
    assert got.agg(F.max("level"), F.count("*")).first()[:] == (n, n + 1)


def test_fetches_are_guarded(spark, rows):
    page = "x" * 600
    pages = spark.createDataFrame([("https://a.ca/", "https://a.ca/home", 200, "text/html", page), ("https://a.ca/private", "https://a.ca/private", 200, "text/html", page), ("https://b.ca/private", "https://b.ca/private", 200, "Text/HTML", page), ("https://a.ca/x", None, 503, None, None), ("http://10.0.0.1/", None, 200, "text/html", page)], "url string, final_url string, status int, content_type string, html string")
    rules = spark.createDataFrame([("https://a.ca", "/private", False), ("https://b.ca", "/private", False)], "origin string, prefix string, allow boolean")
    urls = pages.select("url").union(spark.createDataFrame([("https://gone.ca/",)], "url string"))
    got = {r.url: (r.final_url, r.ok, r.fail_reason) for r in crawl.fetch_results(urls, "url", pages, rules, ["b.ca"]).collect()}
    assert got == {
        "https://a.ca/": ("https://a.ca/home", True, None), "https://a.ca/private": ("https://a.ca/private", False, "blocked by robots.txt"), "https://b.ca/private": ("https://b.ca/private", True, None), "https://a.ca/x": ("https://a.ca/x", False, "status 503"),
        "http://10.0.0.1/": ("http://10.0.0.1/", False, "blocked by url_guard: not a public address"), "https://gone.ca/": ("https://gone.ca/", False, "error: connection failed"),
    }
    fetched = spark.createDataFrame([("https://a.ca/", "https://a.ca/home/", True, "<a href=sub>1</a><a href='/x.pdf'>2</a><a href='https://www.facebook.com/a'>3</a>"), ("https://b.ca/", "https://b.ca/", False, "<a href='/q'>1</a>")], "url string, final_url string, ok boolean, html string")
    assert rows(crawl.link_edges(fetched, "url", ["facebook.com"])) == [("https://a.ca/", "https://a.ca/home/sub", 0)]


def test_contacts_and_suppression(spark, rows):
    o = spark.createDataFrame([("1", "A@x.ca", "(905) 555-1234", ""), ("2", "b@x.ca", None, "w.ca")], "id string, email string, phone string, website string")
    gone = spark.createDataFrame([("email", "a@X.ca"), ("phone", "905.555.1234"), ("phone", "no digits")], "kind string, value string")
    live = directory.live_contacts(directory.contacts_of(o), gone)
    assert rows(live) == [("2", "contact_form", "w.ca"), ("2", "email", "b@x.ca")]
    assert rows(directory.contact_rollup(live)) == [("2", True, False, True, 2)]


def test_containing(spark, rows):
    t = spark.createDataFrame([("1", "https://www.abcdef.ca/x"), ("2", "xy"), ("3", None), ("4", "abcdefabcdef.ca")], "id string, site string")
    p = spark.createDataFrame([("abcdef.ca",), ("xy",), ("",), (None,), ("zzzzzzzz",)], "d string")
    assert rows(directory.containing(t, "site", p, "d").select("id", "d")) == [("1", "abcdef.ca"), ("2", "xy"), ("4", "abcdef.ca")]


def test_bands_facets_coverage(spark, rows):
    df = spark.createDataFrame([(10, "on"), (40, "ON"), (None, ""), (85, None)], "v int, p string")
    assert rows(directory.bands(df, "v", [40, 60, 80])) == [("40-59", 1), ("60-79", 0), ("80+", 1), ("<40", 1)]
    assert [tuple(r) for r in directory.facets(df, F.col("p")).collect()] == [("ON", 2)]
    assert rows(directory.coverage(df, ["v", "p"])) == [("p", 2, 0.5), ("v", 3, 0.75)]
    assert rows(directory.coverage(df.limit(0), ["v"])) == [("v", 0, 0.0)]
    assert [r.v for r in directory.page(df, F.lit(True), [F.asc_nulls_last("v")], 2, 2).collect()] == [85, None]


def test_queue(spark, rows):
    q = spark.createDataFrame([("1", "queued", 3), ("2", "queued", 1), ("3", "done", 0)], "id string, status string, at int")
    assert rows(jobs.claim(q, F.col("status") == "queued", [F.col("at")], 1, "id", {"status": F.lit("running")})) == [("1", "queued", 3), ("2", "running", 1), ("3", "done", 0)]
    assert jobs.random_claim(q, F.col("status") == "queued", 5, "id", 1).count() == 2
    picked = [[r.id for r in jobs.random_claim(spark.range(200).select(F.col("id").cast("string").alias("id")).repartition(n), F.lit(True), 9, "id", 1).collect()] for n in (1, 7)]
    assert picked[0] == picked[1]


def test_retries_and_key_pool(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    states = lambda *s: F.array(*[F.lit(x).cast("int") for x in s])
    assert tuple(one(jobs.attempts_until_done(states(503, None, 200, 200), [429, 503], 3))) == (3, 200)
    assert tuple(one(jobs.attempts_until_done(states(503, 429, 503, 200), [429, 503], 3))) == (3, 503)
    assert tuple(one(jobs.attempts_until_done(states(404, 200), [429, 503], 3))) == (1, 404)
    assert tuple(one(enrich.key_pool(states(200, 429, 432, 200, 432, 200), 2))) == (2, 2, 5, True)
    assert tuple(one(enrich.key_pool(states(500, 200), 1))) == (1, 0, 2, False)
    assert tuple(one(enrich.key_pool(F.array().cast("array<int>"), 2))) == (0, 0, 0, False)


def test_answers_within_budget(spark, rows):
    slots = spark.createDataFrame([(i, h) for i, h in enumerate(["a", "b", "c", "d", "e"])], "n int, query_hash string")
    hashes = lambda *h: spark.createDataFrame([(x,) for x in h], "query_hash string")
    got = enrich.answered(slots, ["n"], hashes("c"), hashes("a", "b", "d", "c"), 2)
    assert rows(got.select("n", "source", "credits")) == [(0, "live", 0), (1, "live", 1), (2, "cache", 2), (3, "none", 2), (4, "none", 2)]
    assert {r.source for r in enrich.answered(slots, ["n"], hashes("c"), hashes("a"), 2, offline=True).collect()} == {"cache", "none"}


def test_organisation_of_jobs(spark, rows):
    j = spark.createDataFrame([("1", "https://www.a.ca/", "a.ca", None), ("2", "http://b.ca", "b.ca", None), ("3", "c.ca", "c.ca", "own"), ("4", "https://new.ca", "new.ca", None), ("5", "https://nowhere.ca", None, None)], "id string, url string, domain string, org_id string")
    c = spark.createDataFrame([("x", "http://a.ca", "o1", 2), ("w", "http://a.ca/", None, 1), ("y", "https://b.ca/", None, 1), ("z", "new.ca", None, 1)], "id string, website string, resolved_org_id string, created_at int")
    o = spark.createDataFrame([("o2", "http://www.b.ca/"), ("o9", None)], "id string, website string")
    assert rows(jobs.organisation_of_jobs(j, c, o)) == [("1", "o1", "x", False), ("2", "o2", "y", False), ("3", "own", None, False), ("4", "new:z", "z", True), ("5", None, None, False)]


def test_running_sums_equal_the_loop(spark):
    random.seed(5)
    data = [(random.choice([None, "x", "y"]), random.randint(0, 30), i, random.randint(0, 9)) for i in range(200)]
    df = spark.createDataFrame(data, "k string, o int, i int, v int")
    got = {r.i: r.t for r in first.running_sum(df, ["k"], ["o", "i"], "v", "t", parts=7).collect()}
    tied = {r.i: r.t for r in first.running_sum(df, ["k"], ["o"], "v", "t", parts=7).collect()}
    for k, o, i, _ in data:
        assert got[i] == sum(v for k2, o2, i2, v in data if k2 == k and (o2, i2) < (o, i))
        assert tied[i] == sum(v for k2, o2, i2, v in data if k2 == k and o2 < o)
    assert first.running_sum(df.limit(0), ["k"], ["o"], "v", "t").count() == 0
    places = {r.i: r.nr for r in first.numbered(df, [-F.col("o"), F.col("i")], "nr").collect()}
    assert [i for i, _ in sorted(places.items(), key=lambda x: x[1])] == [d[2] for d in sorted(data, key=lambda d: (-d[1], d[2]))] and sorted(places.values()) == list(range(1, 201))


def test_leads(spark, rows):
    cols = "org string, domain string, field string, value string, source_url string, site_host string, domain_host string, rule string, status string, id int"
    rows_ = [("Noor", "n.ca", "email", "I@n.ca", "https://x.org/", "x.org", "n.ca", "email_third_party", "open", 1), ("NOOR", "n.ca", "email", "i@N.ca", None, "", "n.ca", "email_domain_match", "applied", 2), ("Ada", None, "fax", "1", None, "", "", "no such rule", "open", 3)]
    got = report.lead_rows(spark.createDataFrame(rows_, cols), "id")
    assert [tuple(r) for r in report.leads_in_order(got).collect()] == [("NOOR", "Email", "i@N.ca", "", "n.ca", "confirmed", "Email on the organisation's own domain", True), ("Ada", "fax", "1", "", "", "review", "Not yet checked by a rule", False)]
    assert tuple(report.lead_counts(got).first()) == (2, 1, 1)
    assert report.leads_page(got, "review", "ADA").count() == 1 and report.leads_page(got, "confirmed", "ada").count() == 0
    text_ = lambda n, k: spark.range(1).select(report.window_text(k, 25, F.lit(n)).alias("x")).first().x
    assert [text_(60, 1), text_(60, 3), text_(60, 9), text_(0, 1)] == ["1-25 of 60", "51-60 of 60", "51-60 of 60", "0-0 of 0"]


def test_slots(spark):
    t = spark.createDataFrame([(1, "Pee Mosque", None, "peemosque.ca", "Toronto"), (2, "Noor", None, None, None), (3, " ", None, None, "X"), (4, None, "", "", None)], "id int, name string, website string, domain string, city string")
    got = {}
    for r in enrich.slots_of(t, "id", "mosque", "Canada").orderBy("id", "slot").collect():
        got.setdefault(r.id, []).append(r.template)
    assert got == {1: ["site_contact", "name_contact", "name_city"], 2: ["name_contact", "name_country"]}


def test_proposals(spark, rows):
    hits = spark.createDataFrame([(1, "t", "https://a.ca", "a@m.ca b@m.ca info@m.ca 416-555-1234 M2N 7J8 in Toronto, ON"), (2, "nothing", "https://b.ca", None)], "id int, title string, url string, content string")
    got = enrich.proposals_of(hits, "id")
    assert rows(got.select("field", "value")) == [("city", "Toronto"), ("email", "a@m.ca"), ("email", "info@m.ca"), ("phone", "416-555-1234"), ("postal_code", "M2N"), ("province", "ON")]
    targets = spark.createDataFrame([(1, ["email", "province"]), (2, ["email"]), (3, [])], "id int, missing array<string>")
    assert rows(enrich.still_missing(targets, got, "id").select("id")) == [(2,)]


ANSWERS = [
    ("a", '```json\n{"emails": ["i@x.ca", {"value": "I@x.ca ", "source_url": "u"}, {"value": "no@x.ca", "source_url": "u"}], "socials": ["https://fb.com/p?a=1&b=2", "https://nowhere.org/p"], "contact_forms": ["https://x.ca/contact"], "raw_context": [{"text": "t", "source_url": "u"}]}\n```'),
    ("b", "[1]"),
    ("c", '{"other": []}'),
    ("d", None),
    ("e", "no contacts found"),
    ("f", '{"emails": [{"value": "x"}]}'),
    ("g", '{"emails": [{"value": "x", "source_url": "u", "page": 1}]}'),
    ("h", '{"socials": [{"platform": "myspace", "value": "x", "source_url": "u"}]}'),
    ("i", '{"raw_context": ["bare"]}'),
    ("j", '{"phones": "416"}'),
    ("k", "{}"),
]


def test_payloads(spark, rows):
    responses = spark.createDataFrame(ANSWERS, "k string, t string")
    pages = spark.createDataFrame([("a", 2, "https://x.ca/2", "<p>I@x.ca i@x.ca</p><a href='https://x.ca/contact/'>"), ("a", 1, "https://x.ca/1", "https://fb.com/p?a=1&amp;b=2&amp;c=3")], "k string, o int, u string, h string")
    kept, dropped, errors = payloads.extracted(responses, pages, "k", "t", "o", "u", "h")
    assert rows(errors) == [("b", "not an object"), ("c", "unknown part"), ("d", "not JSON"), ("e", "not JSON"), ("f", "emails out of shape"), ("g", "emails out of shape"), ("h", "socials out of shape"), ("i", "raw_context out of shape"), ("j", "phones out of shape")]
    assert rows(kept.select("kind", "value", "source_url", "platform")) == [
        ("contact_forms", "https://x.ca/contact", "https://x.ca/2", None), ("emails", "i@x.ca", "https://x.ca/2", None), ("raw_context", "t", "u", None), ("socials", "https://fb.com/p?a=1&b=2", "https://x.ca/1", "facebook"),
    ]
    assert rows(payloads.dropped_counts(dropped)) == [("emails", 1)]
    short = payloads.extracted(responses, pages, "k", "t", "o", "u", "h", cap=60)[0]
    assert rows(short.select("kind")) == [("raw_context",), ("socials",)]  # the second page isn't shown to the model
    assert [x.count() for x in payloads.extracted(responses.limit(0), pages.limit(0), "k", "t", "o", "u", "h")] == [0, 0, 0]


def test_a_page_in_its_own_heading_is_verbatim(spark, rows):
    responses = spark.createDataFrame([("a", '{"contact_forms": ["https://x.ca/form", "https://x.ca/other"]}')], "k string, t string")
    pages = spark.createDataFrame([("a", 1, "https://x.ca/form", "<form>"), ("z", 1, None, None)], "k string, o int, u string, h string")
    assert rows(payloads.extracted(responses, pages, "k", "t", "o", "u", "h")[0].select("value", "source_url")) == [("https://x.ca/form", "https://x.ca/form")]


def test_persisted(spark, rows):
    items = spark.createDataFrame(
        [("o", "emails", 0, "a@x.ca", "u1", None), ("o", "socials", 0, "https://x.com/a", "u9", "twitter"), ("o", "socials", 1, "https://x.com/a", "u2", "x"), ("o", "raw_context", 1, "second", "u2", None), ("o", "raw_context", 0, "first", "u1", None)],
        "k string, kind string, seq int, value string, source_url string, platform string",
    )
    pages = spark.createDataFrame([("u1", 200, "é"), ("u2", None, None)], "u string, s int, h string")
    records = persist.source_records(pages, "u", "s", "h", "r", "m")
    assert {r.url: (r.external_id, r.http_status, r.content_hash[:6]) for r in records.collect()} == {"u1": ("r:u1", 200, "4a99557e4033c3539de2eb65472017cad5f9557f7a0625a09f1c3f6e2ba69c4c"[:6]), "u2": ("r:u2", None, "e3b0c4")}
    found = persist.contacts(items, "k")
    assert rows(found) == [("o", "email", "a@x.ca", None, "u1"), ("o", "social", "https://x.com/a", "x", "u2")]
    assert rows(persist.provenance(found, records.filter("url = 'u1'"), "m").select("value")) == [("a@x.ca",)]
    assert rows(persist.raw_contexts(items, "k")) == [("o", "--- u1 ---\nfirst\n\n--- u2 ---\nsecond")]
    assert rows(persist.persisted_counts(found)) == [("o", "email", 1), ("o", "social", 1)]
    runs = spark.createDataFrame([("r", "d1", 2, 5, 1, None), ("r", "d2", 0, 0, 0, "x" * 900), ("q", "d3", 0, 0, 0, None)], "run string, domain string, pages long, prompt_tokens long, completion_tokens long, error string")
    got = {r.run: r for r in persist.run_summary(runs, "run", most=1, longest=3).collect()}
    assert (got["r"].pages_seen, got["r"].orgs_updated, got["r"].rejected, got["r"].error) == (2, 1, 1, '{"tokens":{"prompt":5,"completion":1},"errors":["d2: xxx"]}') and got["q"].error is None


def test_shrunk_budgets(spark):
    sizes = spark.range(1).select(payloads.shrunk_budgets(F.lit(200_000.0), F.lit(350_000), 131_072).alias("s")).first().s
    assert len(sizes) == 4 and sizes[0] == 350_000 and all(a > b for a, b in zip(sizes, sizes[1:])) and sizes[-1] >= 20_000
    assert spark.range(1).select(payloads.shrunk_budgets(F.lit(900_000.0), F.lit(60_000), 131_072).alias("s")).first().s == [60_000]


# --- points ---------------------------------------------------------------------------------------


def metres(a, b):
    h = math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * proximity.EARTH_RADIUS_M * math.asin(math.sqrt(min(1, h)))


@pytest.mark.parametrize("radius, around", [(50.0, (49.0, -80.0)), (5_000.0, (89.9, 0.0)), (3_000.0, (10.0, 179.99)), (400_000.0, (60.0, -179.0))])
def test_pairs_equal_brute_force(spark, radius, around):
    random.seed(7)
    spread = radius / 111_000 * 2
    points = [(f"{i:03d}", min(90.0, around[0] + random.uniform(-spread, spread)), (around[1] + random.uniform(-spread, spread) / max(0.01, math.cos(math.radians(around[0]))) + 180) % 360 - 180) for i in range(150)]
    want = {(a[0], b[0]) for a in points for b in points if a[0] < b[0] and metres(a, b) <= radius}
    for hot in (20_000, 5):
        got = [(r.id_a, r.id_b) for r in proximity.pairs_within(spark.createDataFrame(points, "id string, la double, lo double"), "id", "la", "lo", radius, hot_cell=hot).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_pairs_edge_cases(spark, rows):
    s = "id string, lat double, lng double, cell int, salt string"
    data = [("a", 1.0, 1.0, 1, "x"), ("b", 1.0, 1.0, 1, "x"), ("b", 1.0, 1.0, 1, "x"), (None, 1.0, 1.0, 1, "x"), ("c", None, 1.0, 1, "x"), ("d", float("nan"), 1.0, 1, "x"), ("e", 95.0, 1.0, 1, "x")]
    assert rows(proximity.pairs_within(spark.createDataFrame(data, s), "id", "lat", "lng", 10.0)) == [("a", "b", 0.0)]
    assert proximity.pairs_within(spark.createDataFrame([], s), "id", "lat", "lng", 10.0).count() == 0
    with pytest.raises(ValueError):
        proximity.pairs_within(spark.createDataFrame([], s), "id", "lat", "lng", 0.0)


def test_regions(spark, rows):
    ring = "struct<lat double, lng double>"
    regions = spark.createDataFrame([("r", [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0)]), ("s", [(1.0, 1.0), (1.0, 3.0), (3.0, 1.0)]), ("t", [(0.0, 0.0)]), ("u", None)], f"region string, ring array<{ring.replace(' ', ':').replace(',:', ', ')}>")
    points = spark.createDataFrame([("a", 0.5, 0.5), ("b", 1.2, 1.2), ("c", 9.0, 9.0), ("d", None, None), ("a", 0.5, 0.5)], "id string, la double, lo double")
    assert rows(proximity.regions_of(points, regions, "id", "la", "lo", "region", "ring")) == [("a", "r"), ("b", "r"), ("b", "s"), ("c", None), ("d", None)]


# --- profiles -------------------------------------------------------------------------------------


def load_table(spark, n=12, size=60):
    random.seed(5)
    data = []
    for i in range(n):
        for j in range(size):
            phone = None if (i == 3 and j % 10) or j % 7 == 0 else f"{random.randint(200, 999)}-555-{random.randint(0, 9999):04d}"
            code = "ontario" if i == 5 and j % 5 else random.choice(["ON", "QC", "BC"])
            mail = "x@y.test" if i == 8 and j % 4 else f"u{random.randint(0, 10**6)}@m.test"
            data.append((f"l{i}", phone, code, mail, "clash"))
    return spark.createDataFrame(data, "load string, phone string, province string, email string, n string")


def test_a_hot_cell_of_points_is_dealt_out(spark, rows):
    points = spark.createDataFrame([(i, 10.01 + i / 1e5, 20.01) for i in range(60)] + [(99, None, 1.0)], "id int, lat double, lng double")
    ring = lambda a, b: [(a, b), (a, b + 0.1), (a + 0.0004, b + 0.1), (a + 0.0004, b)]
    regions = spark.createDataFrame([("r", ring(10.01, 20.0)), ("far", ring(50.0, 20.0))], "name string, ring array<struct<lat:double,lng:double>>")
    of = lambda **k: rows(proximity.regions_of(points, regions, "id", "lat", "lng", "name", "ring", **k))
    assert of(hot_cell=7) == of() and sum(r is not None for _, r in of()) in (40, 41) and (99, None) in of()


def test_departed_loads(spark, rows):
    df = load_table(spark)
    assert rows(quality.departed_loads(df, "load", ["phone", "province", "email"]).select("load_id", "column_name")) == [("l3", "phone"), ("l5", "province"), ("l8", "email")]


def test_loads_a_tenth_of_whose_values_depart(spark, rows):
    """A fifth of one load's addresses is written in another way; nothing else differs."""
    random.seed(4)
    data = [(f"l{k}", f"{random.choice('abcdef')}{i}@{random.choice(['x', 'y', 'z'])}.ca" if not (k == 3 and i % 5 == 0) else f"MAIL TO {i} AT X") for k in range(12) for i in range(400)]
    df = spark.createDataFrame(data, "load string, email string")
    assert rows(quality.departed_loads(df, "load", ["email"]).select("load_id", "column_name")) == [("l3", "email")]


def test_aggregates(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", " "), ("a", None), (None, "yy"), ("b", None)], "load string, v string")
    assert rows(quality.aggregates(df, "load", ["v"])) == sorted([("a", "v", 4, 2, 1, "x", "x", 1, 1, "x", 2), (None, "v", 1, 0, 1, "yy", "yy", 2, 2, "yy", 1), ("b", "v", 1, 1, 0, None, None, None, None, None, None)], key=repr)
    assert quality.aggregates(df.limit(0), "load", ["v"]).count() == 0


def test_profile(spark):
    got = {(r.load_id, r.column_name): r for r in quality.profile(load_table(spark), "load", ["phone", "province"]).collect()}
    assert got["l3", "phone"].n_rows == 60 and got["l3", "phone"].n_missing > 50
    assert got["l0", "province"].n_distinct == 3 and (got["l0", "province"].min_value, got["l0", "province"].max_value) == ("BC", "QC")
    assert got["l0", "phone"].n_nonconforming == 0 and got["l0", "phone"].n_patterns == 1


def test_patterns(spark):
    values = [("p", f"{i:03d}-555-{i:04d}") for i in range(100, 160)] + [("p", "x" * i + "@" + "y" * (i % 9 + 1)) for i in range(1, 60)]
    got = {r.pattern for r in quality.induce_patterns(spark.createDataFrame(values, "column string, value string")).collect()}
    assert "999-999-9999" in got


def test_profile_edge_cases(spark):
    df = spark.createDataFrame([("a", None), ("a", " "), (None, "v"), ("a", "z" * 5000)], "load string, c string")
    got = {r.load_id: r for r in quality.profile(df, "load", ["c"]).collect()}
    assert (got["a"].n_rows, got["a"].n_missing, got["a"].max_length) == (3, 2, 5000) and got[None].n_rows == 1
    assert quality.profile(df.limit(0), "load", ["c"]).count() == 0 and quality.departed_loads(df.limit(0), "load", ["c"]).count() == 0
    assert quality.departed_loads(df, "load", ["c"]).count() == 0


def test_salted_join_and_totals(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k int, x string")
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 7), (2, 7), (None, 9)], "k int, y int")
    want = rows(left.join(right, ["k"]))
    assert rows(skew.salted_join(left, right, ["k"], hot=6)) == want and rows(skew.salted_join(left, right, ["k"])) == want
    assert skew.salted_join(left.limit(0), right, ["k"], hot=6).count() == 0
    large = skew.large_groups(right, ["k"], 10)
    assert rows(large) == [(1,)] and skew.large_groups(right, ["k"], 60) is None
    assert rows(skew.salted_join(left, right, ["k"], hot=6, counted=right.join(large, "k", "left_semi"))) == want
    assert rows(skew.with_total(right.filter("k is null or k = 2"), ["k"], "y", "t")) == [(2, 7, 14), (2, 7, 14), (None, 9, 9)]


def test_contained_equals_the_loop():
    random.seed(5)
    word = lambda a, b: "".join(random.choice("abé") for _ in range(random.randint(a, b)))
    needles, hays = list({word(1, 14) for _ in range(150)} | {""}), [word(0, 60) for _ in range(60)] + ["", "x" + "ab" * 30]
    hays += [random.choice(hays) + random.choice(needles) for _ in range(30)]
    want = [sorted(n for n in needles if n and n in h) for h in hays]
    assert [sorted(x) for x in contained.contained(needles, hays)] == want and any(len(n) > 8 for x in want for n in x)
    assert contained.contained(needles, ["", ""]) == [[], []] and contained.contained([], ["a"]) == [[]]


def site_tables(spark, at, organisations, documents):
    spark.createDataFrame(organisations, "id string, name string, website string").write.parquet(f"{at}/organizations.parquet")
    spark.createDataFrame(documents, "doc_id long, domain string, text string").write.parquet(f"{at}/documents.parquet")


def test_names_on_a_domain_of_many(spark, rows, tmp_path):
    """Names are searched for once in each document, not pair by pair, and no pair is lost."""
    names = [f"Centre {i} of Place" for i in range(250)] + ["!?", None]
    organisations = [(f"o{i}", n, "https://www.p.example/x") for i, n in enumerate(names)] + [("q1", "Small", "http://q.example"), ("q2", "!", "http://q.example")]
    documents = [(1, "p.example", "centre-7 of pla-ce, CENTRE 123 OF PLACE"), (2, "p.example", ""), (3, "p.example", None), (4, "q.example", "a S-mall one"), (5, "r.example", "x")]
    site_tables(spark, tmp_path, organisations, documents)
    got = expressions.REGISTRY.queries["verbatim_names"](spark, str(tmp_path))
    assert "array_contains" in got._jdf.queryExecution().optimizedPlan().toString()
    want = [(f"o{i}", d, d == 1 and i in (7, 123)) for i in range(251) for d in (1, 2)] + [("q1", 4, True), ("q2", 4, False)]
    assert rows(got) == sorted(want, key=repr)


def test_sites_on_a_domain_of_many(spark, rows, tmp_path):
    """Sites are searched for once in each document, not pair by pair, and no pair is lost."""
    sites = [f"https://p.example/{i}/?k={i}&amp;l=2" for i in range(250)] + ["p.example", "HTTPS://P.example/7", "http://www.p.example/a#b"]
    organisations = [(f"o{i}", "n", w) for i, w in enumerate(sites)] + [("e1", "n", ""), ("q1", "n", "http://q.example/z")] + [(f"e{i + 2}", "n", "") for i in range(205)]
    texts = ["see https://p.example/7?k=7&l=25 and https://P.example/8/?k=8", "https://p.example/9/?k=9&amp;l=2", "", "http://www.P.example/A/ p.example"]
    documents = [(i, "p.example", t) for i, t in enumerate(texts)] + [(9, "q.example", "at http://q.example/z?x"), (10, "", "none")]
    site_tables(spark, tmp_path, organisations, documents)
    got = expressions.REGISTRY.queries["named_sites"](spark, str(tmp_path))
    assert "array_contains" in got._jdf.queryExecution().optimizedPlan().toString()
    o, t = [spark.read.parquet(f"{tmp_path}/{x}.parquet") for x in ("organizations", "documents")]
    pairs = o.withColumn("domain", url.site_host(F.col("website"))).join(t, "domain")
    want = rows(pairs.select("id", "doc_id", text.contains_url(F.col("website"), F.col("text")), text.contains_exact(F.col("website"), F.col("text"))))
    assert rows(got) == want and {r[2:] for r in want} == {(True, True), (True, False), (False, True), (False, False)} and len(want) == 253 * 4 + 1 + 206


def test_resolve_compares_equal_rows_once_and_names_by_bits(spark, rows, monkeypatch):
    """Against the loop over all pairs, with cells dealt out, equal rows on both sides, nulls and names that are nearly alike."""
    monkeypatch.setattr(resolve, "HOT_CELL", 3)
    random.seed(11)
    names = ["Masjid Al Noor", "Masjid An Noor", "Al Noor Centre", "Islamic Society of Place", "Islamic Society of Palace", "", None]
    sites = [None, "", "https://a.example", "http://www.A.example/", "a.example/x", "b.example", "b.example"]
    pick = lambda p: (random.choice(names), random.choice(sites), *random.choice([(45.0, -75.0), (45.002, -75.002), (45.01, -75.0), (0.0, 0.0), (None, -75.0), (45.0, None)]))
    cand, orgs = [(f"c{i}", *pick(0)) for i in range(80)], [(f"o{i}", *pick(0)) for i in range(12)]
    orgs += [(f"p{i}", *o[1:]) for i, o in enumerate(orgs[:4])]
    cand.append(("d1", "Masjid Al Noor", "d.example/x", 50.0, -80.0))
    orgs.append(("d2", "Masjid Al Noor", "d.example/y", 50.01, -80.0))
    schema = "id string, name string, website string, lat double, lng double"
    got = resolve.resolve(spark.createDataFrame(cand, schema), spark.createDataFrame(orgs, schema))
    pieces = lambda n: {f"  {w} "[i : i + 3] for w in (n or "").lower().split() for i in range(len(w) + 1)}
    site = lambda w: (w or "").lower().replace("https://", "").replace("http://", "").replace("www.", "")

    def one(c):
        found, near = [], set()
        for o in orgs:
            a, b, known = pieces(c[1]), pieces(o[1]), None not in (*c[3:], *o[3:])
            like = len(a & b) / len(a | b) if a | b else 0.0
            close = known and 111.32 * math.hypot(o[3] - c[3], (o[4] - c[4]) * math.cos(math.radians(c[3]))) <= 2 and like >= 0.45
            s, t = site(c[2]), site(o[2])
            found += [(1, -1.0, o[0])] if s and s == t and ("/" in s or close) else []
            near |= {o[0]} if s and s.split("/")[0] == t.split("/")[0] and close else set()
            found += [(3, -like, o[0])] if known and abs(o[3] - c[3]) <= 0.0023 and abs(o[4] - c[4]) <= 0.0031 and like >= 0.55 else []
        return min(found + [(2, -0.9, o) for o in near if len(near) == 1], default=None)

    want = [(c[0], w[2], ["exact", "domain", "geoname"][w[0] - 1], -w[1]) for c in cand if (w := one(c))]
    assert rows(got.select("candidate_id", "org_id", "tier", "score")) == sorted(want, key=repr) and {w[2] for w in want} == {"exact", "domain", "geoname"}


def test_tier_counts_bound_names_by_bits(spark, rows, tmp_path):
    schema = "id string, name string, website string, lat double, lng double"
    spark.createDataFrame([("c1", "Masjid Noor", None, 45.0, -75.0), ("c2", "Masjid Noor", None, 45.0, -75.0), ("c3", "Other", "a.ca/x", None, None)], schema).write.parquet(f"{tmp_path}/org_candidates.parquet")
    spark.createDataFrame([("o1", "Masjid Noor", None, 45.001, -75.0, None), ("o2", "Else", "a.ca/x", None, None, None), ("o3", "Else", "a.ca/x", None, None, "o2")], schema + ", merged_into string").write.parquet(f"{tmp_path}/organizations.parquet")
    got = catalogue.QUERIES["tier_counts"](spark, str(tmp_path))
    assert rows(got) == [("exact", 1), ("geoname", 2)] and "bit_count" in got._jdf.queryExecution().optimizedPlan().toString()


def test_tier_counts_on_an_address_of_many(spark, rows, tmp_path):
    """No join makes a row for each pair of candidates and organisations that give one address with a path; the smallest id is kept."""
    schema = "id string, name string, website string, lat double, lng double"
    cand = [(f"c{i:03}", f"Candidate {i}", random.choice(["n/a", "N/A"]), None, None) for i in range(300)] + [("d1", "Other", "a.ca/x", None, None), ("d2", "Other", "b.ca/", None, None), ("d3", "Other", "n", None, None)]
    orgs = [(f"o{i:03}", f"Organisation {i}", "n/a", None, None, None if i else "o001") for i in range(200)] + [("p2", "Else", "A.ca/x", None, None, None), ("p1", "Else", "http://a.ca/x", None, None, None), ("p3", "Else", "b.ca", None, None, None)]
    spark.createDataFrame(cand, schema).write.parquet(f"{tmp_path}/org_candidates.parquet")
    spark.createDataFrame(orgs, schema + ", merged_into string").write.parquet(f"{tmp_path}/organizations.parquet")

    def joined(plan):
        """The most rows that a join of a plan has made, in its last form."""
        inner = "executedPlan" if plan.nodeName() == "AdaptiveSparkPlan" else "plan" if plan.nodeName().endswith("QueryStage") else None
        below = [getattr(plan, inner)()] if inner else [plan.children().apply(i) for i in range(plan.children().size())]
        made = plan.metrics().get("numOutputRows")
        return max([made.get().value() if "Join" in plan.nodeName() and made.isDefined() else 0, *map(joined, below)])

    got = catalogue.QUERIES["resolve_tiers"](spark, str(tmp_path))
    assert rows(got) == [*[(c[0], "o001", "exact") for c in cand[:300]], ("d1", "p1", "exact")]
    assert 0 < joined(got._jdf.queryExecution().executedPlan()) <= len(cand)
    assert rows(catalogue.QUERIES["tier_counts"](spark, str(tmp_path))) == [("exact", 301)]


def test_tier_cells_lose_and_double_no_pair(spark, rows):
    """Against all pairs, around borders of cells, the pole and the zero point; an organisation is copied to few cells."""
    random.seed(5)
    spots = [(45.0, -75.0), (0.0, 0.0), (83.99, 10.0), (84.02, 10.0), (89.99, -179.0), (-60.0, 30.0), (-84.0, 5.0)]
    at = lambda x: (x[0] + random.uniform(-0.02, 0.02), x[1] + random.uniform(-0.02, 0.02) / max(math.cos(math.radians(x[0])), 0.001))
    close = lambda x: (x[0] + random.uniform(-0.004, 0.004), x[1] + random.uniform(-0.004, 0.004))
    cand, orgs = [[(f"{s}{i}", "Noor", "a.ca", *(at if i % 2 else close)(spots[i % 7])) for i in range(210)] for s in "co"]
    schema = "id string, name string, website string, lat double, lng double"
    c, o = resolve._side(spark.createDataFrame(cand, schema), "c"), resolve._side(spark.createDataFrame(orgs, schema), "o")
    km = lambda a, b: 111.32 * math.hypot(b[3] - a[3], (b[4] - a[4]) * math.cos(math.radians(a[3])))
    near = resolve._near_pairs(c.drop("site"), o.drop("site"), "host", 2.0, 0.45)
    assert rows(near.select("c_id", "o_id")) == sorted((a[0], b[0]) for a in cand for b in orgs if km(a, b) <= 2)
    band = resolve._within_band(c, o, 0.55)
    assert rows(band.select("c_id", "o_id")) == sorted((a[0], b[0]) for a in cand for b in orgs if abs(a[3] - b[3]) <= resolve.BAND_LAT and abs(a[4] - b[4]) <= resolve.BAND_LNG)

    def exploded(plan):
        inner = "executedPlan" if plan.nodeName() == "AdaptiveSparkPlan" else "plan" if plan.nodeName().endswith("QueryStage") else None
        below = [getattr(plan, inner)()] if inner else [plan.children().apply(i) for i in range(plan.children().size())]
        return max([plan.metrics().get("numOutputRows").get().value() if plan.nodeName() == "Generate" else 0, *map(exploded, below)])

    band.collect()
    assert 0 < exploded(band._jdf.queryExecution().executedPlan()) < 6 * len(orgs)
