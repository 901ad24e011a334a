"""Expressions against literal cases."""

import pytest
from pyspark.sql import functions as F

from orgloom.functions import geo, outcomes, text, url


def one(spark, values, *columns):
    """The columns over one row of string values a, b, c, ..."""
    names = "abcdefgh"[: len(values)]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
    out = df.select(*[c.alias(f"x{i}") for i, c in enumerate(columns)]).first()
    return out[0] if len(columns) == 1 else tuple(out)


@pytest.mark.parametrize(
    "seed, candidate, inside",
    [
        ("https://example.com/", "https://example.com/about", True),
        ("https://example.com/", "https://deep.sub.example.com/x", True),
        ("https://example.com/", "https://notexample.com/", False),
        ("https://example.com/", "https://example.com.evil.org/", False),
        ("https://masjid.example.ca/", "https://news.example.ca/posts", True),
        (None, "https://a.ca/", False),
        ("", "", False),
    ],
)
def test_scope(spark, seed, candidate, inside):
    assert one(spark, [seed, candidate], url.in_scope(F.col("a"), F.col("b"))) is inside


@pytest.mark.parametrize(
    "raw, seed",
    [("example.com", "https://example.com/"), ("http://example.com#top", "http://example.com/"), ("https://example.com/a?b=1#c", "https://example.com/a?b=1"), (" HTTPS://example.com ", "https://example.com/"), (None, None)],
)
def test_canonical_seed(spark, raw, seed):
    assert one(spark, [raw], url.canonical_seed(F.col("a"))) == seed


def test_hosts(spark):
    assert one(spark, ["https://user@www.A.Example.com:8080/p?q#f"], url.host(F.col("a")), url.apex(url.host(F.col("a")))) == ("a.example.com", "example.com")
    assert one(spark, ["localhost"], url.apex(F.col("a"))) == "localhost"
    assert one(spark, ["news.a.org"], url.host_suffixes(F.col("a"))) == ["news.a.org", "a.org", "org"]
    assert one(spark, [None], url.host(F.col("a"))) is None
    assert one(spark, ["HTTPS://WWW.x.ca/a/"], url.without_scheme(F.col("a"))) == "x.ca/a/"
    assert one(spark, [None, "d.ca"], url.site_slug(F.col("a"), F.col("b"))) == "d.ca"
    assert one(spark, ["https://", ""], url.site_slug(F.col("a"), F.col("b"))) is None


@pytest.mark.parametrize("u, ok", [("https://a.ca/x.pdf", False), ("https://a.ca/x.PNG", False), ("ftp://a.ca/x", False), ("https://a.ca/x?f=.pdf", True), (None, False)])
def test_crawlable(spark, u, ok):
    assert one(spark, [u], url.crawlable(F.col("a"))) is ok


def test_lists_of_hosts(spark):
    blocked = lambda u: one(spark, [u], url.host_matches(url.host(F.col("a")), url.BLOCKED_HOSTS))
    assert blocked("https://moonode.com/a") and blocked("https://www.facebook.com/x") and not blocked("https://notfacebook.com/")
    assert one(spark, ["centres.macnet.ca"], url.host_matches(F.col("a"), url.SHARED_HOSTS))
    assert one(spark, ["myx.com"], url.host_contains(F.col("a"), ["x.com"]))


@pytest.mark.parametrize(
    "u, public",
    [
        ("https://example.com/", True),
        ("http://10.0.0.1/", False),
        ("http://172.20.1.1/", False),
        ("http://172.32.1.1/", True),
        ("http://169.254.169.254/latest", False),
        ("http://[::1]/", False),
        ("http://localhost:80/", False),
        ("http://db.internal/", False),
        ("file:///etc/passwd", False),
        ("http://8.8.8.8/", True),
        (None, False),
    ],
)
def test_public(spark, u, public):
    assert one(spark, [u], url.is_public_literal(F.col("a"))) is public


def test_links(spark):
    html = '<a href="/about">a</a><a href="https://off.org/">b</a><A HREF=\'/about\'>c</A><a href="mailto:x@y.ca">d</a><a href="#s">e</a><a href="news/#x">f</a>'
    found = spark.createDataFrame([(html,)], "h string").select(F.explode(url.hrefs(F.col("h"))).alias("t"))
    joined = [r.u for r in found.select(url.join_url(F.lit("https://e.com/a/"), F.col("t")).alias("u")).collect()]
    assert joined == ["https://e.com/about", "https://off.org/", None, "https://e.com/a/", "https://e.com/a/news/"]
    more = '<a class=x href=plain>1</a><a href="/q?a=1&amp;b=2">2</a><a data-x="a>b" href="">3</a><a href="tel:1">4</a><abbr href="no">5</abbr><a href="javascript:x()">6</a><a href="plain#top">7</a>'
    assert one(spark, ["https://e.com/a/", more], url.links(F.col("a"), F.col("b"))) == ["https://e.com/a/plain", "https://e.com/q?a=1&b=2", "https://e.com/a/"]
    assert one(spark, [None, None], url.links(F.col("a"), F.col("b"))) in ([], None)


def test_emails(spark):
    clean = lambda t: one(spark, [t], text.clean_emails(F.col("a")))
    assert clean("masjid.iqaluit@gmail.comemail or 5 info@x.ca") == ["info@x.ca", "masjid.iqaluit@gmail.com"]
    assert clean("a:b@mosque.co.uk") == ["b@mosque.co.uk"]
    assert clean("build jquery@3.7.1 noreply@a.ca wixpress stuff admin@masjid.ca info@masjid.ca info@masjid.ca") == ["info@masjid.ca", "admin@masjid.ca"]
    assert clean("logo@x.svg a@b.jpeg c@d.jpg real@noor.ca") == ["real@noor.ca"]
    assert clean(None) == [] and clean("") == []


def test_older_rules(spark):
    got = one(spark, ["imam@noor.ca office@noor.ca x@noor.comcall 212-555-1234 M2N 7J8 Guelph, ON"], text.plain_fields(F.col("a")))
    assert (got.email, got.phone, got.postal_area, got.city, got.province) == ("office@noor.ca", "212-555-1234", "M2N", "Guelph", "ON")
    assert one(spark, [None], text.plain_fields(F.col("a"))).email is None


def test_formats(spark):
    stamp = F.lit("2026-03-05 14:00:00").cast("timestamp_ntz")
    assert one(spark, ["x"], text.long_date(stamp), text.run_stamp(stamp), text.percent(F.lit(1), F.lit(8)), text.percent(F.lit(1), F.lit(0))) == ("March 5, 2026", "20260305T140000Z", "12%", "0%")
    assert one(spark, ["a@b@c.ca"], text.email_domain(F.col("a")), text.last_email_domain(F.col("a"))) == ("b", "c.ca")


def test_own_pages(spark):
    apex = lambda w, d: one(spark, [w, d], url.org_apex(F.col("a"), F.col("b")))
    assert (apex("https://www.news.noor.ca/x", None), apex("", "noor.ca"), apex("noor.ca:80/x", None), apex(None, ""), apex(None, None)) == ("noor.ca", "noor.ca", "noor.ca:80", None, None)
    own = lambda u, a: one(spark, [u, a], url.on_org_page(F.col("a"), F.col("b")))
    assert own("https://shop.noor.ca/p", "noor.ca") and not own("https://noor.ca.evil.org/", "noor.ca") and own("https://noor.ca", None) is False and own("x", "") is False


def test_phones_and_places(spark):
    assert one(spark, ["call 212-555-1234 or (416) 555-9876"], text.first_phone(F.col("a"))) == "416-555-9876"
    assert one(spark, ["9999999999999"], text.first_phone(F.col("a"))) is None
    assert one(spark, ["at M2N 7J8, Toronto"], text.first_postal_area(F.col("a"))) == "M2N"
    place = one(spark, ["in saint-laurent; St. John's Town, NL"], text.first_city_province(F.col("a")))
    assert place.city == "St. John'S Town" and place.province == "NL"
    got = one(spark, ["t", None, "info@masjidnoor.ca 416-555-1234, M2N 7J8, Toronto, ON"], text.fields(F.col("a"), F.col("b"), F.col("c")))
    assert (got.emails, got.phone, got.postal_area, got.city, got.province) == (["info@masjidnoor.ca"], "416-555-1234", "M2N", "Toronto", "ON")


@pytest.mark.parametrize(
    "needle, hay, found",
    [
        ("https://a.ca/x", "see https://A.ca/X/ now", True),
        ("https://a.ca/x?a=1", "https://a.ca/x?a=1&amp;b=2", True),
        ("https://a.ca/x?b=1", "https://a.ca/x?a=1", False),
        ("mailto:x", "mailto:x", False),
        (None, "https://a.ca", False),
    ],
)
def test_contains_url(spark, needle, hay, found):
    assert one(spark, [needle, hay], text.contains_url(F.col("a"), F.col("b"))) is found


def test_verbatim(spark):
    assert one(spark, ["9055551234", "call (905) 555-1234"], text.contains_bare(F.col("a"), F.col("b")))
    assert not one(spark, ["+19055551234", "call (905) 555-1234"], text.contains_bare(F.col("a"), F.col("b")))
    assert not one(spark, ["", "x"], text.contains_bare(F.col("a"), F.col("b")))


def test_small_texts(spark):
    assert one(spark, ["https://fb.com/x"], text.platform(F.col("a"))) == "facebook"
    assert one(spark, ["https://x.com/x"], text.platform(F.col("a"))) == "x"
    assert one(spark, ["https://a.ca"], text.platform(F.col("a"))) is None
    assert one(spark, ['```json\n{"a": 1}\n```'], text.without_fence(F.col("a"))) == '{"a": 1}'
    assert one(spark, ["  A  b​ c "], text.squeeze(F.col("a"))) == "A b c"
    assert one(spark, ["École Nür – 5"], text.slug(F.col("a"))) == "ecole-nur-5"
    assert one(spark, [" A, b,, C "], text.csv_list(F.col("a"))) == ["a", "b", "c"]
    assert one(spark, ["<a&\">"], text.escape(F.col("a"))) == "&lt;a&amp;&quot;&gt;"
    assert one(spark, [" Query "], text.query_key(F.col("a"))) == one(spark, ["query"], text.query_key(F.col("a")))
    assert one(spark, ["i@mail.a.ca", "a.ca"], text.email_on_site(F.col("a"), F.col("b")))
    assert not one(spark, ["i@a.ca", None], text.email_on_site(F.col("a"), F.col("b")))


def test_geo(spark):
    assert one(spark, [" m5v 2t6"], geo.province_from_postal(F.col("a"))) == "ON"
    assert one(spark, [" ontario "], geo.province_code(F.col("a"))) == "ON"
    assert one(spark, ["zz"], geo.province_code(F.col("a"))) is None
    assert one(spark, ["Newfoundland"], geo.province_code(F.col("a"))) == "NL" and one(spark, ["ca-on"], geo.region_code(F.col("a"))) == "ON" and one(spark, ["CA-XX"], geo.region_code(F.col("a"))) is None
    derived = lambda *v: tuple(one(spark, list(v), geo.derived_province(F.col("a"), F.col("b"), F.col("c"))))
    assert derived("on", "QC", "QC") == ("ON", "own", False, False) and derived(None, "QC", "ON") == ("QC", "postal", True, False)
    assert derived("Ontario", None, "ON") == ("ON", "city", False, False) and derived(None, None, None) == (None, None, False, True)
    sim = lambda a, b: one(spark, [a, b], geo.trigram_similarity(geo.trigrams(F.col("a")), geo.trigrams(F.col("b"))))
    assert sim("word", "two words") == pytest.approx(0.363636, abs=1e-5)
    assert sim("", "") == 0.0 and sim("a", "a") == 1.0


@pytest.mark.parametrize(
    "reason, kind",
    [("status 429", "retryable"), ("status 503", "retryable"), ("status 404", "permanent"), ("status 451", "permanent"), ("blocked unsafe redirect: loopback", "blocked"), ("error: connection reset", "retryable"), ("read timeout", "retryable"), ("content too short (120 chars)", "thin"), (None, "permanent"), ("crawl failed: status 403", "blocked"), ("crawl failed: blocked by robots.txt", "blocked"), ("crawl failed: blocked by url_guard: dns resolution failed", "blocked")],
)
def test_failures(spark, reason, kind):
    assert one(spark, [reason], outcomes.failure_kind(F.col("a"))) == kind


def test_fetches(spark):
    problem = lambda status, kind, html: one(spark, [status, kind, html], outcomes.fetch_problem(F.col("a").cast("int"), F.col("b"), F.col("c")))
    assert problem("404", "text/html", "x" * 900) == "status 404"
    assert problem("200", "application/pdf", "x" * 900) == "not html: application/pdf"
    assert problem("200", "text/html", "é" * 200) == "content too short: 200 bytes"
    assert problem("200", "Text/HTML; charset=utf-8", "é" * 250) is None
