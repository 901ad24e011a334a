"""Search slots for targets and proposals from hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.functions.geo import province_from_postal
from orgloom.functions.text import fields, query_key
from orgloom.functions.url import site_slug
from orgloom.operators.first import running_sum
from orgloom.operators.upsert import fill_nulls


def query_slots(name: Column, website: Column, domain: Column, city: Column, subject: str, country: str, most: int = 3) -> Column:
    """Up to ``most`` ``struct<template, query>`` by expected yield: on the site, by the name, by the name with its city or else the country."""
    site, plain = site_slug(website, domain), F.trim(name)
    named, quoted = F.coalesce(plain != "", F.lit(False)), F.concat(F.lit('"'), plain, F.lit('"'))
    slot = lambda when, template, query: F.when(when, F.struct(F.lit(template).alias("template"), query.alias("query")))
    has_city = F.coalesce(city != "", F.lit(False))
    slots = F.array(
        slot(site.isNotNull(), "site_contact", F.concat(site, F.lit(" contact email phone"))),
        slot(named, "name_contact", F.concat(quoted, F.lit(f" {subject} contact"))),
        slot(named & has_city, "name_city", F.concat_ws(" ", quoted, city, F.lit(subject))),
        slot(named & ~has_city, "name_country", F.concat(quoted, F.lit(f" {subject} {country}"))),
    )
    return F.slice(F.filter(slots, lambda s: s.isNotNull()), 1, most)


def slots_of(targets: DataFrame, key: str, subject: str, country: str) -> DataFrame:
    """``key, slot, template, query, query_hash`` of every target's slots."""
    slots = query_slots(F.col("name"), F.col("website"), F.col("domain"), F.col("city"), subject, country)
    rows = targets.select(key, F.posexplode(slots).alias("slot", "s")).select(key, "slot", "s.template", "s.query")
    return rows.withColumn("query_hash", query_key(F.col("query")))


def term_score(weights: dict[str, tuple[Column, int]]) -> Column:
    """A sum of weights of the terms that stand in a text: ``{term: (text, weight)}``."""
    return sum((F.when(text.contains(term), w).otherwise(0) for term, (text, w) in weights.items()), F.lit(0))


def proposals_of(hits: DataFrame, key: str, evidence_length: int = 300) -> DataFrame:
    """``key, field, value, source_url, evidence`` proposed by search hits (``key, title, url, content``).

    Each hit proposes at most two addresses, a phone, the province and postal area of its first
    postal code, and its first 'City, XX'.
    """
    found = fields(F.col("title"), F.col("url"), F.col("content"))
    rows = hits.select(key, F.col("url").alias("source_url"), F.substring(F.coalesce(F.when(F.col("content") != "", F.col("content")), "title"), 1, evidence_length).alias("evidence"), found.alias("f"))
    one = lambda field, value: F.when(value.isNotNull(), F.struct(F.lit(field).alias("field"), value.alias("value")))
    f = F.col("f")
    single = F.array(one("phone", f.phone), one("province", province_from_postal(f.postal_area)), one("postal_code", f.postal_area), one("city", f.city), one("province", F.when(f.postal_area.isNull(), f.province)))
    mails = F.transform(F.slice(f.emails, 1, 2), lambda e: F.struct(F.lit("email").alias("field"), e.alias("value")))
    proposed = F.filter(F.concat(mails, single), lambda p: p.isNotNull())
    return rows.select(key, F.explode(proposed).alias("p"), "source_url", "evidence").select(key, "p.field", "p.value", "source_url", "evidence")


def answered(slots: DataFrame, order: list[str], kept: DataFrame, live: DataFrame, budget: int, offline: bool = False) -> DataFrame:
    """The slots of one run (``query_hash`` and others) with ``source`` (cache, live, none) of their answer and the run's ``credits`` before each.

    ``kept`` and ``live`` have a row for each ``query_hash`` that is answered from the
    cache, or would be by a search. A kept answer is free; a search takes one credit if it is
    answered, and none is begun once ``budget`` are used, or ``offline``.
    Credits are counted by a two-level sum over the order, see ``running_sum``.
    """
    flagged = lambda d, name: d.select("query_hash").distinct().withColumn(name, F.lit(True))
    rows = slots.join(flagged(kept, "__kept"), "query_hash", "left").join(flagged(live, "__live"), "query_hash", "left")
    cost = F.when(F.col("__kept").isNull() & F.col("__live").isNotNull(), 1).otherwise(0)
    rows = running_sum(rows.withColumn("__cost", cost), [], order, "__cost", "credits")
    may = F.col("__live").isNotNull() & (F.col("credits") < budget) & F.lit(not offline)
    source = F.when(F.col("__kept").isNotNull(), "cache").when(may, "live").otherwise("none")
    return rows.select(*slots.columns, source.alias("source"), F.least("credits", F.lit(budget)).alias("credits"))


def key_pool(states: Column, keys: int) -> Column:
    """``struct<credits, dropped, calls, stopped>`` of a pool of keys used in turn, by what each call is answered (200, 429, 432, other).

    200 takes a credit, 432 drops the key it was made with, any other only moves on
    to the next; the pool stops once all keys are dropped.
    """
    start = F.struct(F.lit(0).alias("credits"), F.array().cast("array<int>").alias("dropped"), F.lit(0).alias("calls"), F.lit(-1).alias("at"))
    every = F.sequence(F.lit(1), F.lit(keys))

    def call(p: Column, state: Column) -> Column:
        # the next key that isn't dropped, going round
        turn = F.get(F.filter(F.transform(every, lambda i: F.pmod(p.at + i, F.lit(keys))), lambda k: ~F.array_contains(p.dropped, k)), F.lit(0))
        done = F.struct((p.credits + F.when(state == 200, 1).otherwise(0)).alias("credits"), F.when(state == 432, F.array_append(p.dropped, turn)).otherwise(p.dropped).alias("dropped"), (p.calls + 1).alias("calls"), turn.cast("int").alias("at"))
        return F.when(F.size(p.dropped) >= keys, p).otherwise(done)

    return F.aggregate(states, start, call, lambda p: F.struct(p.credits.alias("credits"), F.size(p.dropped).alias("dropped"), p.calls.alias("calls"), (F.size(p.dropped) >= keys).alias("stopped")))


def applied(proposals: DataFrame, organizations: DataFrame, fields: list[str], order: list[str], pair_rule: str) -> tuple[DataFrame, DataFrame]:
    """(organisations with nulls filled, ``id`` of the proposals applied) by open, verified proposals (``id, org_id, field, proposed_value, vet_rule``).

    The first of each field fills its null and nothing else; a city brings the province that was
    verified with it by ``pair_rule``. Proposals of organisations that exist count as applied, whether or not the field was null.
    """
    own = proposals.join(organizations.select(F.col("id").alias("org_id")), "org_id", "left_semi")
    pair = paired(own, "org_id", "province", pair_rule, order)
    values = first_values(own, "org_id", fields, order).join(pair.withColumnRenamed("value", "__pair"), "org_id", "left")
    if "province" in fields:
        values = values.withColumn("province", F.when(F.col("city").isNotNull() if "city" in fields else F.lit(False), F.coalesce("province", "__pair")).otherwise(F.col("province")))
    filled = fill_nulls(organizations, "id", values.withColumnRenamed("org_id", "id"), fields)
    return filled, own.select("id")


def paired(proposals: DataFrame, key: str, field: str, rule: str, order: list[str]) -> DataFrame:
    """``key, value``: for each key, null being one, the first proposal of a field made under a rule."""
    rows = proposals.filter((F.col("field") == field) & (F.col("vet_rule") == rule))
    return rows.groupBy(key).agg(F.min_by("proposed_value", F.struct(*order)).alias("value"))


def ranked_hits(hits: DataFrame, by: list[str], score: str, seq: str) -> DataFrame:
    """Adds ``place``: hits of each query by score, best first, then as they came."""
    return hits.withColumn("place", F.row_number().over(W.partitionBy(*by).orderBy(F.desc(score), seq)))


def still_missing(targets: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Targets whose ``missing`` fields aren't all among the ``field``s found; a postal code counts as a province."""
    got = found.groupBy(key).agg(F.collect_set(F.when(F.col("field") == "postal_code", "province").otherwise(F.col("field"))).alias("__got"))
    left = F.size(F.array_except("missing", F.coalesce("__got", F.array().cast("array<string>"))))
    return targets.join(got, key, "left").filter(left > 0).drop("__got")


def first_values(proposals: DataFrame, key: str, fields: list[str], order: list[str]) -> DataFrame:
    """One row for each key with the first proposed value of every field."""
    return proposals.groupBy(key).agg(*[F.min_by("proposed_value", F.when((F.col("field") == f) & F.col("proposed_value").isNotNull(), F.struct(*order))).alias(f) for f in fields])
