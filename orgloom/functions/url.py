"""URL expressions: hosts, scope, canonical forms and links. All are columns; nothing runs row by row in Python but ``join_url``."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from orgloom.functions.text import unescape

#: Endings of files that aren't pages.
FILE_ENDINGS = ["pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "zip", "gz", "rar", "7z", "exe", "dmg", "jpg", "jpeg", "png", "gif", "webp", "svg", "ico", "css", "js", "mp3", "mp4", "avi", "mov", "mkv", "woff", "woff2", "ttf", "eot", "rss", "atom", "xml", "json"]
#: Hosts that are never crawled, and hosts of which only the named page is.
BLOCKED_HOSTS = ["moonode.com", "islaminfo.com", "google.com", "docs.google.com", "facebook.com", "instagram.com", "twitter.com", "x.com", "youtube.com", "wa.me", "whatsapp.com", "linkedin.com", "yellowpages.ca", "yelp.ca"]
SHARED_HOSTS = ["centres.macnet.ca", "macnet.ca", "ahmadiyya.ca", "ahmadiyya.org"]
#: Host names that are private without being looked up.
INTERNAL_NAMES = ["localhost", "localhost.localdomain", "metadata", "metadata.google.internal"]
INTERNAL_ENDINGS = [".local", ".internal", ".localhost", ".lan", ".home", ".corp"]


def netloc(url: Column) -> Column:
    """The authority of a URL with a scheme, as written; '' without one."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def host(url: Column) -> Column:
    """Host in small letters, without user, port and one leading www.; '' where there is no scheme and authority; null for null."""
    h = F.regexp_replace(F.regexp_replace(F.lower(netloc(url)), r"^.*@", ""), r":\d*$", "")
    return F.regexp_replace(h, r"^www\.", "")


def apex(name: Column) -> Column:
    """The last two labels of a host, or the host where it has fewer."""
    two = F.regexp_extract(name, r"([^.]+\.[^.]+)$", 1)
    return F.when(two == "", name).otherwise(two)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def without_scheme(url: Column) -> Column:
    """Small letters, without http(s):// and a following www.; a trailing slash stays."""
    return F.lower(F.regexp_replace(url, r"(?i)^https?://(www\.)?", ""))


def without_scheme_and_slash(url: Column) -> Column:
    """Like ``without_scheme`` for small-letter schemes only, without trailing slashes; '' for null."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^https?://(www\.)?", ""), r"/+$", ""))


def site_host(url: Column) -> Column:
    """The part of ``without_scheme`` before the first slash."""
    return F.split_part(without_scheme(url), F.lit("/"), F.lit(1))


def site_slug(website: Column, domain: Column) -> Column:
    """Website, or else domain, without scheme, www. and slashes at either end; null where nothing is left."""
    site = F.coalesce(F.when(website != "", website), F.concat(F.lit("https://"), F.when(domain != "", domain)))
    bare = F.regexp_replace(F.regexp_replace(site, r"^https?://(www\.)?", ""), r"^/+|/+$", "")
    return F.when(bare != "", bare)


def canonical_seed(url: Column) -> Column:
    """A crawl seed: trimmed, https where no scheme is given, no fragment, one slash after a bare origin."""
    u = F.trim(url)
    u = F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), u).otherwise(F.concat(F.lit("https://"), u))
    u = F.regexp_replace(u, r"#.*$", "")
    u = F.concat(F.lower(F.regexp_extract(u, r"^([^:]*)", 1)), F.regexp_extract(u, r"^[^:]*(:.*)$", 1))
    return F.when(u.rlike(r"^[a-z][a-z0-9+.-]*://[^/?]*$"), F.concat(u, F.lit("/"))).otherwise(u)


def in_scope(seed: Column, candidate: Column) -> Column:
    """True where the candidate's host is the seed's apex or below it; false where either has none."""
    top = apex(host(seed))
    mine = host(candidate)
    return F.coalesce((top != "") & (mine != "") & ((mine == top) | mine.endswith(F.concat(F.lit("."), top))), F.lit(False))


def host_matches(name: Column, hosts: Iterable[str]) -> Column:
    """True where a host is in a short fixed list or below one of it."""
    known = F.array(*[F.lit(h) for h in hosts])
    return F.coalesce(F.exists(known, lambda h: (name == h) | name.endswith(F.concat(F.lit("."), h))), F.lit(False))


def host_contains(name: Column, parts: Iterable[str]) -> Column:
    """True where a host contains any of a short fixed list anywhere."""
    return F.coalesce(F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: name.contains(p)), F.lit(False))


def host_suffixes(name: Column) -> Column:
    """A host and all domains above it: the keys on which a long host list joins by equality."""
    labels = F.split(name, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def crawlable(url: Column) -> Column:
    """An http(s) URL whose path doesn't end like a file."""
    return F.coalesce(scheme(url).isin("http", "https") & ~F.lower(path(url)).rlike(r"\.(?:" + "|".join(FILE_ENDINGS) + ")$"), F.lit(False))


def is_public_literal(url: Column) -> Column:
    """False for URLs that can't be public by their text alone: other schemes, no host, internal names, private or reserved IP literals.

    Names are not looked up here; that is the live fetcher's task.
    """
    name = F.regexp_replace(F.regexp_replace(F.lower(netloc(url)), r"^.*@", ""), r"^(\[[^\]]*\]|[^:]*).*$", "$1")
    internal = name.isin(INTERNAL_NAMES) | F.exists(F.array(*[F.lit(e) for e in INTERNAL_ENDINGS]), lambda e: name.endswith(e))
    octet = lambda i: F.try_element_at(F.split(name, r"\."), F.lit(i)).try_cast("int")
    a, b, c = octet(1), octet(2), octet(3)
    private = a.isin(0, 10, 127) | (a >= 224) | ((a == 100) & b.between(64, 127)) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168))
    private = private | ((a == 192) & (b == 0) & c.isin(0, 2)) | ((a == 198) & b.isin(18, 19)) | ((a == 198) & (b == 51) & (c == 100)) | ((a == 203) & (b == 0) & (c == 113))
    v4 = name.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$") & private
    v6 = name.rlike(r"^\[(?:::1?|f[cd][0-9a-f]{2}:.*|fe[89ab][0-9a-f]:.*|ff[0-9a-f]{2}:.*|::ffff:.*|2001:db8:.*)\]$")
    return F.coalesce(scheme(url).isin("http", "https") & (name != "") & ~internal & ~v4 & ~v6, F.lit(False))


def hrefs(html: Column) -> Column:
    """Targets of the anchors of a page in the order of the page, quoted or not, entities read back; repeated ones once."""
    pattern = F.lit(r"(?is)<a\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*?\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
    quoted, single, bare = (F.regexp_extract_all(html, pattern, F.lit(i)) for i in (1, 2, 3))
    found = F.transform(F.arrays_zip(quoted.alias("a"), single.alias("b"), bare.alias("c")), lambda t: F.trim(unescape(F.concat(t["a"], t["b"], t["c"]))))
    return F.array_distinct(found)


def _resolved(base: str | None, target: str | None) -> str | None:
    from urllib.parse import urldefrag, urljoin

    if base is None or target is None or target.strip().lower().startswith(("mailto:", "tel:", "javascript:", "data:")):
        return None
    try:
        u = urldefrag(urljoin(base, target.strip())).url
    except ValueError:
        return None
    return u if u.startswith(("http://", "https://")) else None


def join_url(base: Column, target: Column) -> Column:
    """A link resolved against its page, without fragment; null for other than http(s). An empty target or a bare fragment is the page itself."""

    def of(bases: pd.Series, targets: pd.Series) -> pd.Series:
        return pd.Series([_resolved(b, t) for b, t in zip(bases, targets)], dtype=object)

    return F.pandas_udf(of, "string")(base, target)


def links(base: Column, html: Column) -> Column:
    """The pages a page leads to, absolute, in the order of the page, each once; ``base`` is where the page was found in the end, after redirects."""

    def of(bases: pd.Series, targets: pd.Series) -> pd.Series:
        return pd.Series([list(dict.fromkeys(u for t in (ts if ts is not None else ()) if (u := _resolved(b, t)))) for b, ts in zip(bases, targets)], dtype=object)

    return F.pandas_udf(of, "array<string>")(base, hrefs(html))


def page_apex(url: Column) -> Column:
    """The last two labels of a URL's authority, port and all, without www."""
    return apex(F.regexp_replace(F.lower(netloc(url)), r"^www\.", ""))


def org_apex(website: Column, domain: Column) -> Column:
    """The apex of an organisation's website, else of its domain; null without either."""
    site = F.coalesce(F.when(website != "", website), F.when(domain != "", F.concat(F.lit("https://"), domain)))
    site = F.when(site.contains("://"), site).otherwise(F.concat(F.lit("https://"), site))
    top = page_apex(site)
    return F.when(top != "", top)


def on_org_page(url: Column, top: Column) -> Column:
    """Whether a page is on the site of an ``org_apex``; false where that is null or ''."""
    return F.coalesce((top != "") & (page_apex(url) == top), F.lit(False))
