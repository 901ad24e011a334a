"""Answers of an extraction model: parsed, put into shape, checked against a strict contract and word by word against their pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.functions.text import contains_bare, contains_url, platform, without_fence

#: The parts an answer may have, and the keys an item of each must have, no more and no less.
PARTS = {"emails": ["value", "source_url"], "phones": ["value", "source_url"], "socials": ["platform", "value", "source_url"], "contact_forms": ["value", "source_url"], "raw_context": ["text", "source_url"]}
#: Platforms an answer may name.
ALLOWED_PLATFORMS = ["facebook", "instagram", "twitter", "x", "youtube", "tiktok", "whatsapp", "linkedin"]
KINDS = [k for k in PARTS if k != "raw_context"]
#: Characters of all pages of a key together that the model is shown, and values are looked for in.
CORPUS_CAP = 350_000


def parse(responses: DataFrame, key: str, text: str) -> DataFrame:
    """``key, kind, seq, item, error`` of every answer: one row for each item (an object as JSON, or a bare string).

    An answer that isn't JSON, isn't an object, or has unknown parts, parts
    that aren't lists, or items of other keys than ``PARTS`` names, gives one
    row with an ``error`` and no items, instead of failing the job. A bare string is no error where it can be
    put into shape; in ``raw_context`` it is, as it has no ``text``.
    """
    body = without_fence(F.col(text))
    rows = responses.select(key, body.alias("__body")).withColumn("__keys", F.json_object_keys("__body"))
    part = lambda k: F.get_json_object("__body", f"$.{k}")
    items = lambda k: F.from_json(part(k), "array<string>")

    def wrong(k: str) -> Column:
        keys = F.array(*[F.lit(x) for x in PARTS[k]])
        fits = lambda i: F.coalesce(F.sort_array(F.json_object_keys(i)) == F.sort_array(keys), F.lit(False))
        good = (lambda i: fits(i) & F.coalesce(F.get_json_object(i, "$.platform").isin(ALLOWED_PLATFORMS), F.lit(False))) if k == "socials" else fits
        bare = F.lit(k != "raw_context")
        not_list = part(k).isNotNull() & ~part(k).startswith("[")
        return not_list | F.coalesce(F.exists(items(k), lambda i: ~(good(i) | (bare & ~i.startswith("{")))), F.lit(False))

    error = F.when(F.try_parse_json("__body").isNull(), F.lit("not JSON")).when(F.col("__keys").isNull(), F.lit("not an object"))
    error = error.when(F.size(F.array_except("__keys", F.array(*[F.lit(k) for k in PARTS]))) > 0, F.lit("unknown part"))
    for k in PARTS:
        error = error.when(wrong(k), F.lit(f"{k} out of shape"))
    rows = rows.withColumn("error", error)
    parts = F.array(*[F.struct(F.lit(k).alias("kind"), items(k).alias("items")) for k in PARTS])
    nothing = F.lit(None)
    bad = rows.filter("error is not null").select(key, nothing.cast("string").alias("kind"), nothing.cast("int").alias("seq"), nothing.cast("string").alias("item"), "error")
    good = rows.filter("error is null").select(key, F.explode(parts).alias("p")).select(key, "p.kind", F.posexplode("p.items").alias("seq", "item"))
    return good.withColumn("error", nothing.cast("string")).unionByName(bad)


def corpus_pages(pages: DataFrame, key: str, order: str, url: str, html: str, cap: int = CORPUS_CAP) -> DataFrame:
    """``key, ord, url, html, shown``: pages with what the model is shown of each, behind a line that names it, up to ``cap`` characters of a key's pages in order."""
    head = F.concat(F.lit("--- page: "), F.coalesce(F.col(url), F.lit("")), F.lit(" ---\n"), F.coalesce(F.col(html), F.lit("")))
    rows = pages.select(key, F.col(order).alias("ord"), F.col(url).alias("url"), F.col(html).alias("html"), head.alias("shown"))
    before = F.sum(F.length("shown") + 1).over(W.partitionBy(key).orderBy("ord").rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn("shown", F.substring("shown", F.lit(1), F.greatest(F.lit(cap) - F.coalesce(before, F.lit(0)), F.lit(0)).cast("int")))


def shape(items: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """``key, kind, seq, value, source_url, platform`` of items without an error; ``pages`` as of ``corpus_pages``.

    A bare string becomes a value whose page is the first that holds it, as it
    is or with ``&amp;``, else the first page. A bare social gets the platform of its address, and is left
    out where that is unknown. Pages and items meet by their key, all of a key's
    items beside each page, so a page is moved once.
    """
    is_object = F.col("item").startswith("{")
    of = lambda name: F.when(is_object, F.get_json_object("item", f"$.{name}"))
    value = F.when(is_object, F.coalesce(of("value"), of("text"))).otherwise(F.col("item"))
    shaped = items.filter("error is null").select(key, "kind", "seq", value.alias("value"), of("source_url").alias("told"), (~is_object).alias("bare"), of("platform").alias("platform"))
    shaped = shaped.withColumn("platform", F.when(F.col("kind") == "socials", F.when(F.col("bare"), platform(F.col("value"))).otherwise(F.col("platform"))))
    shaped = shaped.filter((F.col("kind") != "socials") | F.col("platform").isNotNull())
    wanted = shaped.filter("bare").groupBy(key).agg(F.collect_set("value").alias("__values"))
    met = pages.select(key, "ord", "url", "html").join(wanted, key)
    holds = lambda v: F.col("html").contains(v) | F.col("html").contains(F.replace(v, F.lit("&"), F.lit("&amp;")))
    hits = met.select(key, "ord", "url", F.explode(F.filter("__values", holds)).alias("value")).groupBy(key, "value").agg(F.min_by("url", "ord").alias("__hit"))
    first = met.groupBy(key).agg(F.min_by("url", "ord").alias("__first"))
    out = shaped.join(hits, [key, "value"], "left").join(first, key, "left")
    return out.select(key, "kind", "seq", "value", F.when(F.col("bare"), F.coalesce("__hit", "__first", F.lit(""))).otherwise(F.col("told")).alias("source_url"), "platform")


def verified(items: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """Adds ``verbatim``: whether any page of the key shows the value (addresses by path and query, others by their letters and digits); context always is.

    The values of a key go to its pages, and only what is found comes back.
    """
    by_url = F.col("kind").isin("socials", "contact_forms")
    checked = items.filter("kind <> 'raw_context'").select(key, F.struct(by_url.alias("by_url"), "value").alias("v")).groupBy(key).agg(F.collect_set("v").alias("__values"))
    shown = F.col("shown")
    found = pages.select(key, "shown").join(checked, key)
    found = found.select(key, F.explode(F.filter("__values", lambda v: F.when(v.by_url, contains_url(v.value, shown)).otherwise(contains_bare(v.value, shown)))).alias("v")).distinct()
    found = found.select(key, F.col("v.by_url").alias("__by_url"), F.col("v.value").alias("value"), F.lit(True).alias("verbatim"))
    out = items.withColumn("__by_url", by_url).join(found, [key, "__by_url", "value"], "left")
    return out.select(*items.columns, ((F.col("kind") == "raw_context") | F.coalesce("verbatim", F.lit(False))).alias("verbatim"))


def distinct_items(items: DataFrame, key: str) -> DataFrame:
    """The first of items that differ only in capitals and spaces around them; socials of two platforms are two; context stays."""
    w = W.partitionBy(key, "kind", F.lower(F.trim("value")), "platform", F.when(F.col("kind") == "raw_context", F.col("seq"))).orderBy("seq")
    return items.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def extracted(responses: DataFrame, pages: DataFrame, key: str, text: str, order: str, url: str, html: str, cap: int = CORPUS_CAP) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept items, items found on no page, errors) of the answers of an extraction model: parse, shape, verify, distinct."""
    read = parse(responses, key, text)
    shown = corpus_pages(pages, key, order, url, html, cap)
    checked = verified(shape(read, shown, key), shown, key)
    return distinct_items(checked.filter("verbatim").drop("verbatim"), key), checked.filter(~F.col("verbatim")).drop("verbatim"), read.filter("error is not null").select(key, "error")


def dropped_counts(items: DataFrame) -> DataFrame:
    """How many items of each kind weren't found on any page: ``kind, n``."""
    return items.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def shrunk_budgets(reported: Column, chars: Column, window: int, tries: int = 4, floor: int = 20_000) -> Column:
    """The sizes a corpus is cut to when a model reports too many tokens, try by try: an array that ends before the first size below the floor.

    Each try keeps the lesser of nine tenths and of four fifths of what fits.
    """
    factor = F.least(F.lit(0.8) * window / reported, F.lit(0.9))
    step = lambda acc, _: F.concat(acc, F.array(F.floor(F.element_at(acc, -1) * factor).cast("long")))
    sizes = F.aggregate(F.sequence(F.lit(1), F.lit(tries - 1)), F.array(chars.cast("long")), step)
    return F.filter(sizes, lambda x, i: (i == 0) | (x >= floor))


def usage(responses: DataFrame, content: str, prompt: str, completion: str, latency: str) -> DataFrame:
    """Totals of a run's answers: ``n, prompt_tokens, completion_tokens, latency_ms, characters``."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return responses.agg(F.count(F.lit(1)).alias("n"), total(prompt), total(completion), total(latency), F.coalesce(F.sum(F.length(content)), F.lit(0)).alias("characters"))
