"""Text expressions: contacts in free text, verbatim checks, keys and small clean-ups, in columns."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What an address, a number, a postal code and a place look like in free text, as in the data source.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?:\+?1[\s.-]?)?\(?([2-9]\d{2})\)?[\s.-]?(\d{3})[\s.-]?(\d{4})"
POSTAL_AREA = r"\b([A-PR-Wa-pr-w]\d[A-PR-Za-pr-w])\s?\d[A-PR-Za-pr-w]\d\b"
CITY_PROVINCE = r"\b([A-Z][A-Za-z'.\- ]{2,28}?),\s*(ON|BC|AB|SK|MB|QC|NS|NB|NL|PE|YT|NT|NU)\b"
#: Known last labels of domains.
TOP_LABELS = ["com", "ca", "org", "net", "edu", "gov", "io", "us", "uk", "co", "info", "biz", "me", "dev", "app", "xyz", "online", "site", "live", "store", "email", "church", "islam", "mosque", "de", "fr", "nl", "au", "in", "pk", "ir", "sa", "eg", "tr", "my", "id", "eu", "ch", "it", "es", "pl"]
#: Parts of addresses that aren't contacts, and first parts that are preferred.
JUNK_PARTS = ["example.", "sentry", "wixpress", ".png", ".jpg", ".gif", ".webp", ".css", ".js", "yourdomain", "domain.com", "email.com", "sentry.io", "@2x", "no-reply", "noreply", "@duckduckgo.com", "@google.com", "wixpress.com"]
ASSET = r"\.(?:png|jpe?g|gif|webp|css|js|svg)$"
PREFERRED_MAILBOXES = ["info", "admin", "contact", "office", "masjid", "administrator", "secretary", "imam"]
#: Area codes of another country that are left out, as in the data source; its two entries of two digits can't be an area code and aren't here.
FOREIGN_AREA_CODES = ["201", "212", "213", "214", "305", "310", "312", "323", "404", "415", "469", "512", "602", "614", "617", "619", "646", "702", "704", "713", "718", "727", "971"]
#: What tells a platform from an address, in the order in which they are tried.
PLATFORMS = {"facebook": ["facebook.com", "fb.com"], "instagram": ["instagram.com", "instagr.am"], "youtube": ["youtube.com", "youtu.be"], "whatsapp": ["whatsapp.com", "wa.me"], "tiktok": ["tiktok.com"], "linkedin": ["linkedin.com", "lnkd.in"], "twitter": ["twitter.com"], "x": ["x.com"]}


def emails(text: Column) -> Column:
    """Every address in a text, in small letters, in order; empty for null."""
    return F.coalesce(F.transform(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)), lambda e: F.lower(e)), F.array().cast("array<string>"))


def without_run_on(email: Column) -> Column:
    """An address whose last label runs on into the next word, cut to the longest known label it starts with."""
    longest = sorted(TOP_LABELS, key=lambda t: (-len(t), t))
    last = F.element_at(F.split(email, r"\."), -1)
    cut = F.regexp_replace(email, r"\.(" + "|".join(longest) + r")[a-z]+$", ".$1")
    return F.when(last.isin(TOP_LABELS), email).otherwise(cut)


def clean_emails(text: Column, junk: Iterable[str] = JUNK_PARTS) -> Column:
    """Contact addresses of a text: run-ons cut, junk out, each once; preferred mailboxes first, then the shorter, then the earlier."""
    junk = F.array(*[F.lit(j) for j in junk]) if junk else F.array().cast("array<string>")
    found = F.array_distinct(F.filter(F.transform(emails(text), without_run_on), lambda e: ~F.exists(junk, lambda j: e.contains(j)) & ~e.rlike(ASSET)))
    ranked = F.transform(found, lambda e, i: F.struct((~F.split_part(e, F.lit("@"), F.lit(1)).isin(PREFERRED_MAILBOXES)).alias("other"), F.length(e).alias("n"), i.alias("i"), e.alias("email")))
    return F.transform(F.array_sort(ranked), lambda r: r.email)


def phones(text: Column, without: Iterable[str] = FOREIGN_AREA_CODES) -> Column:
    """Ten-digit numbers of a text as AAA-BBB-CCCC, in order, without those of some area codes."""
    bounded = r"(?<!\d)" + PHONE + r"(?!\d)"
    group = lambda i: F.regexp_extract_all(text, F.lit(bounded), F.lit(i))
    zipped = F.transform(F.arrays_zip(group(1).alias("a"), group(2).alias("b"), group(3).alias("c")), lambda p: F.concat_ws("-", p["a"], p["b"], p["c"]))
    return F.coalesce(F.filter(zipped, lambda p: ~F.substring(p, 1, 3).isin(list(without))), F.array().cast("array<string>"))


def first_phone(text: Column, without: Iterable[str] = FOREIGN_AREA_CODES) -> Column:
    return F.get(phones(text, without), F.lit(0))


def first_postal_area(text: Column) -> Column:
    """The first three signs of the first postal code, in capitals; null without one."""
    found = F.upper(F.regexp_extract(text, POSTAL_AREA, 1))
    return F.when(found != "", found)


def title_case(text: Column) -> Column:
    """Every letter after something that isn't a letter in capitals, the others small."""
    low = F.lower(text)
    signs = F.split(low, "")
    return F.array_join(F.transform(signs, lambda c, i: F.when((i == 0) | ~F.coalesce(F.get(signs, i - 1), F.lit(" ")).rlike(r"\p{L}"), F.upper(c)).otherwise(c)), "")


def first_city_province(text: Column) -> Column:
    """``struct<city, province>`` of the first 'City, XX' whose city has more than two letters; null without one."""
    cities, codes = F.regexp_extract_all(text, F.lit(CITY_PROVINCE), F.lit(1)), F.regexp_extract_all(text, F.lit(CITY_PROVINCE), F.lit(2))
    pairs = F.transform(F.arrays_zip(cities.alias("a"), codes.alias("b")), lambda p: F.struct(title_case(F.trim(p["a"])).alias("city"), p["b"].alias("province")))
    return F.get(F.filter(pairs, lambda p: F.length(p.city) > 2), F.lit(0))


def fields(title: Column, url: Column, content: Column) -> Column:
    """All contact fields of a search hit: ``emails, phone, postal_area, city, province``."""
    text = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in (title, url, content)])
    place = first_city_province(text)
    return F.struct(clean_emails(text).alias("emails"), first_phone(text).alias("phone"), first_postal_area(text).alias("postal_area"), place.city.alias("city"), place.province.alias("province"))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def bare(text: Column) -> Column:
    """Small letters and digits only."""
    return F.regexp_replace(F.lower(text), r"[^a-z0-9]", "")


def contains_bare(needle: Column, hay: Column) -> Column:
    """Whether a text holds a value, whatever stands between its letters and digits; false for values without any."""
    n = bare(needle)
    return F.coalesce((n != "") & bare(hay).contains(n), F.lit(False))


def contains_exact(needle: Column, hay: Column) -> Column:
    return F.coalesce(hay.contains(needle), F.lit(False))


def unescape(text: Column) -> Column:
    """The HTML entities that occur in addresses read back: the core ones by name and number, and the fixed space."""
    for entity, sign in (("&(?:lt|#0*60|#[xX]0*3[cC]);", "<"), ("&(?:gt|#0*62|#[xX]0*3[eE]);", ">"), ("&(?:quot|#0*34|#[xX]0*22);", '"'), ("&(?:apos|#0*39|#[xX]0*27);", "'"), ("&(?:nbsp|#0*160|#[xX]0*[aA]0);", "\u00a0"), ("&(?:amp|#0*38|#[xX]0*26);", "&")):
        text = F.regexp_replace(text, entity, sign)
    return text


def escape(text: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def url_parts(url: Column) -> Column:
    """``struct<path, query>`` for comparison: entities read back, no fragment, path in small letters without trailing slashes."""
    u = F.regexp_replace(unescape(url), r"#.*$", "")
    return F.struct(F.lower(F.regexp_replace(F.regexp_extract(u, r"^([^?]*)", 1), r"/+$", "")).alias("path"), F.regexp_extract(u, r"\?(.*)$", 1).alias("query"))


def urls(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"https?://[^\s\"'<>\\]+"), F.lit(0))


def contains_url(needle: Column, hay: Column) -> Column:
    """Whether a text holds a URL of the same path, whose query begins with that of the URL looked for."""
    return among_urls(needle, url_parts(needle), urls_parts(hay))


def urls_parts(text: Column) -> Column:
    """``url_parts`` of every URL in a text."""
    return F.transform(urls(text), url_parts)


def among_urls(needle: Column, want: Column, found: Column) -> Column:
    """``contains_url`` where the parts of the URL looked for and of those in the text are columns already."""
    same = F.exists(found, lambda u: (u.path == want.path) & u.query.startswith(want.query))
    return F.coalesce(needle.rlike("^https?://") & same, F.lit(False))


def platform(url: Column) -> Column:
    """The platform an address belongs to, the first whose name stands in it; null for none."""
    low = F.lower(url)
    picked = F.lit(None).cast("string")
    for name, parts in reversed(PLATFORMS.items()):
        hit = F.lit(False)
        for p in parts:
            hit = hit | low.contains(p)
        picked = F.when(hit, F.lit(name)).otherwise(picked)
    return picked


def without_fence(text: Column) -> Column:
    """The inside of a text that is one fenced code block; others trimmed."""
    t = F.trim(text)
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"^```[A-Za-z]*\s*", ""), r"\s*```$", ""))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def short_hash(value: Column, length: int = 8) -> Column:
    return F.substring(F.sha2(value, 256), 1, length)


def query_key(query: Column) -> Column:
    """The key under which a query's answers are kept, the same for any capitals and spaces around it."""
    return F.substring(F.sha2(F.lower(F.trim(query)), 256), 1, 32)


def squeeze(text: Column) -> Column:
    """Without marks of direction and zero width, every run of white space one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "[‎​]", ""), r"(?U)\s+", " "))


def slug(text: Column, longest: int = 60) -> Column:
    """Small ASCII letters and digits with hyphens between; letters with marks lose them, others are dropped."""

    def of(values: pd.Series) -> pd.Series:
        import re
        import unicodedata

        def one(v):
            if v is None:
                return None
            plain = unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().lower()
            return re.sub(r"[^a-z0-9]+", "-", plain).strip("-")[:longest].rstrip("-")

        return values.map(one)

    return F.pandas_udf(of, "string")(text)


def csv_list(text: Column) -> Column:
    """The entries of a comma list, trimmed, in small letters, without empty ones."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")


def email_on_site(email: Column, site: Column) -> Column:
    """Whether an address' domain is a site's host, or one is below the other."""
    d = F.lower(F.split_part(email, F.lit("@"), F.lit(2)))
    return F.coalesce((d != "") & (site != "") & ((d == site) | site.endswith(F.concat(F.lit("."), d)) | d.endswith(F.concat(F.lit("."), site))), F.lit(False))


def email_domain(email: Column) -> Column:
    """What stands behind the first sign @, '' where there is none."""
    return F.split_part(email, F.lit("@"), F.lit(2))


def last_email_domain(email: Column) -> Column:
    """What stands behind the last sign @, the whole text where there is none."""
    return F.element_at(F.split(email, "@"), -1)


def plain_fields(text: Column, junk: Iterable[str] = JUNK_PARTS) -> Column:
    """``struct<email, phone, postal_area, city, province>`` of a text by the older rules: run-ons aren't cut, no area code is left out, one address."""
    junk = F.array(*[F.lit(j) for j in junk])
    found = F.array_distinct(F.filter(emails(text), lambda e: ~F.exists(junk, lambda j: e.contains(j)) & ~e.rlike(ASSET)))
    preferred = [m for m in PREFERRED_MAILBOXES if m != "imam"]
    ranked = F.transform(found, lambda e, i: F.struct((~F.split_part(e, F.lit("@"), F.lit(1)).isin(preferred)).alias("other"), F.length(e).alias("n"), i.alias("i"), e.alias("email")))
    first = F.regexp_extract_all(text, F.lit(CITY_PROVINCE), F.lit(1)), F.regexp_extract_all(text, F.lit(CITY_PROVINCE), F.lit(2))
    city = title_case(F.trim(F.get(first[0], F.lit(0))))
    told = F.length(city) > 2
    best = F.get(F.transform(F.array_sort(ranked), lambda r: r.email), F.lit(0))
    return F.struct(best.alias("email"), first_phone(text, ()).alias("phone"), first_postal_area(text).alias("postal_area"), F.when(told, city).alias("city"), F.when(told, F.get(first[1], F.lit(0))).alias("province"))


def percent(part: Column, whole: Column) -> Column:
    """A share as whole per cent, ties to even; of nothing it is 0."""
    return F.concat(F.bround(100 * F.coalesce(F.try_divide(part, whole), F.lit(0.0))).cast("int").cast("string"), F.lit("%"))


def long_date(at: Column) -> Column:
    """'March 5, 2026'."""
    return F.date_format(at, "MMMM d, yyyy")


def run_stamp(at: Column) -> Column:
    """'20260305T140000Z'."""
    return F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")
