"""One surviving value for each field of a group of records of one organisation.

Currency reasoning. Every record is a sighting of values by a source. From the
dated sightings is learnt how often each source shows a value that isn't the
organisation's (one between two sightings that agree against it), and which
kinds of values follow which: the precedence. The values of a group and field
are nodes of a partial order: an edge leads from a value to each that
is sighted after its own last sighting, weighing what that sighting's source is worth,
and, where a date is missing, to each whose kind follows its kind, weighing the
other's worth times the learnt share of transitions in that direction. The
present value is the topologically latest: of all values that could end
the order, the one for which the edges that lead on from it, and have to be
cut as they then close a cycle, weigh least against what speaks for it.

Edges are never listed in pairs: what leads on from a dated value is a running
sum over the group's sightings from the latest back, what leads on from an undated one a
sum over the kinds of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.session import cut, small

#: What is typed in place of an email's first part, and of a social account.
NO_MAILBOX = ["test", "none", "noemail", "no-email", "email", "xxx", "example", "na", "n.a", "null", "name", "user"]
NO_ACCOUNT = ["", "share", "sharer", "home", "login", "pages", "groups", "profile.php", "watch", "channel", "user", "none", "null", "n/a", "#"]
#: Area codes in use, by province.
AREA_CODES = {
    "AB": "368 403 587 780 825",
    "BC": "236 250 257 604 672 778",
    "MB": "204 431 584",
    "NB": "428 506",
    "NL": "709 879",
    "NS": "782 902",
    "NT": "867",
    "NU": "867",
    "ON": "226 249 289 343 365 382 416 437 519 548 613 647 683 705 742 753 807 905 942",
    "PE": "782 902",
    "QC": "263 354 367 418 438 450 468 514 579 581 819 873",
    "SK": "306 474 639",
    "YT": "867",
}
#: Provinces by the first letter of a postal code.
POSTAL_PROVINCES = {"A": "NL", "B": "NS", "C": "PE", "E": "NB", "G": "QC", "H": "QC", "J": "QC", "K": "ON", "L": "ON", "M": "ON", "N": "ON", "P": "ON", "R": "MB", "S": "SK", "T": "AB", "V": "BC", "X": "NT", "Y": "YT"}
#: Email domains at which more groups than this have an address are a provider's; this tells the kind of a value only.
PROVIDER_OF = 10
#: A value that others hold too counts less by the log of its share of the groups, in parts of so many; a small table counts as this many groups more.
SHARED = 1000
#: Log-odds: another source that agrees; a value without the organisation's words or against its place; the cost of a change; and what makes a value fully credible.
AGREED, FOREIGN, CHANGE, CREDIBLE = 2.0, -1.0, 1.9, 4.0


def clean_email(raw: Column) -> Column:
    """Small letters without anything around; null where it is ill-formed or a placeholder."""
    e = F.regexp_replace(F.regexp_replace(F.lower(F.trim(raw)), r"^[\s<(\"']*(?:mailto:)?\s*", ""), r"[\s>)\"',;.]+$", "")
    local, label = F.regexp_extract(e, r"^([^@]*)@", 1), F.regexp_extract(e, r"@([^.]*)", 1)
    return F.when(e.rlike(r"^[a-z0-9][a-z0-9._%+-]*@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}$") & ~local.isin(NO_MAILBOX) & (local != label), e)


def clean_phone(raw: Column) -> Column:
    """Ten digits without country code and extension; null where it is incomplete or a placeholder."""
    d = F.regexp_replace(F.regexp_replace(F.lower(raw), r"(?:ext|x|poste)\.?\s*\d*\s*$", ""), r"\D", "")
    ten = F.regexp_extract(d, r"^1?([2-9]\d{9})$", 1)
    return F.when((ten != "") & ~ten.rlike(r"^(\d)\1{9}$") & (ten != "2345678901") & ~d.isin("1234567890", "11234567890") & ~F.regexp_replace(F.lower(raw), r"ext.*$", "").contains("xxx"), ten)


def clean_postal(raw: Column) -> Column:
    """Six capitals and digits; null for anything else."""
    p = F.regexp_replace(F.upper(raw), r"[\s-]", "")
    return F.when(p.rlike(r"^[ABCEGHJ-NPRSTVXY]\d[A-Z]\d[A-Z]\d$"), p)


def clean_account(raw: Column, platform: str) -> Column:
    """The account's name in small letters without address, @, slashes and query; null where none is told."""
    a = F.regexp_replace(F.regexp_replace(F.lower(F.trim(raw)), r"^(?:[a-z]+:)?//", ""), r"[?#].*$", "")
    a = F.regexp_replace(a, rf"^(?:[a-z]+\.)?{platform}\.[a-z]+(?:\.[a-z]+)?(?:/|$)", "")
    a = F.regexp_replace(F.regexp_replace(a, r"^[/@\s]+", ""), r"[/\s]+$", "")
    return F.when(a.rlike(r"^[a-z0-9._-]{2,}$") & ~a.isin(NO_ACCOUNT), a)


SOCIAL = ["facebook", "instagram", "youtube"]


def group_roots(rows: DataFrame) -> DataFrame:
    """``id, root``: the row with null ``merged_into`` each row leads to, by doubling the steps.

    Rows that lead to a missing row, or round in a circle, have no root.
    """
    rows = rows.select("id", "merged_into").filter("id is not null").dropDuplicates(["id"])
    done = rows.filter("merged_into is null").select("id", F.col("id").alias("root"))
    step = cut(rows.filter("merged_into is not null").select("id", F.col("merged_into").alias("to")))
    roots = cut(done)
    left = step.count()
    while left:
        found = step.join(roots.withColumnRenamed("id", "to"), "to").select("id", "root")
        onward = step.join(roots.select(F.col("id").alias("to")), "to", "left_anti")
        onward = onward.join(step.select(F.col("id").alias("to"), F.col("to").alias("further")), "to").select("id", F.col("further").alias("to"))
        roots, step = cut(roots.unionByName(found)), cut(onward)
        before, left = left, step.count()
        if left == before:
            break
    return roots


def sightings(organizations: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``grp, field, value, at, source`` of well-formed values, ``grp, words, province`` of groups of two or more rows)."""
    roots = group_roots(organizations)
    social = [F.col("social")[k].alias(k) for k in SOCIAL]
    o = organizations.select("id", "email", "phone", "postal_code", *social, F.col("created_at").alias("at"), F.lit("organizations").alias("source")).join(roots, "id")
    c = candidates.filter("resolved_org_id is not null").select(F.col("resolved_org_id").alias("id"), "email", "phone", "postal_code", *social, F.col("created_at").alias("at"), F.col("source_id").alias("source")).join(roots, "id")
    rows = o.unionByName(c).withColumnRenamed("root", "grp")
    values = [("email", clean_email(F.col("email"))), ("phone", clean_phone(F.col("phone"))), ("postal_code", clean_postal(F.col("postal_code")))] + [(k, clean_account(F.col(k), k)) for k in SOCIAL]
    pairs = F.array(*[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in values])
    rows = rows.select("grp", "at", "source", F.filter(pairs, lambda p: p.value.isNotNull()).alias("pairs"))
    members = candidates.filter("resolved_org_id is not null").select(F.col("resolved_org_id").alias("id")).join(roots, "id").select("root")
    sizes = roots.select("root").unionByName(members).groupBy(F.col("root").alias("grp")).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("grp")
    seen = rows.join(sizes, "grp").select("grp", "at", "source", F.explode("pairs").alias("p")).select("grp", "p.field", "p.value", "at", "source")
    plain = F.split(F.regexp_replace(F.lower(F.concat_ws(" ", F.regexp_replace("slug", r"-[^-]*-[^-]*$", ""), "name")), r"[^a-z ]", " "), r"\s+")
    general = F.array(*[F.lit(w) for w in GENERAL_WORDS])
    words = F.array_except(F.array_distinct(F.filter(plain, lambda w: F.length(w) >= 4)), general)
    by_postal = F.create_map(*[F.lit(x) for kv in POSTAL_PROVINCES.items() for x in kv])
    about = organizations.select(F.col("id").alias("grp"), words.alias("words"), by_postal[F.substring(clean_postal(F.col("postal_code")), 1, 1)].alias("place"), F.upper(F.regexp_replace("province", r"[^A-Za-z]", "")).alias("typed"))
    about = about.select("grp", "words", F.when(F.col("typed").isin(list(AREA_CODES)), F.col("typed")).otherwise(F.col("place")).alias("province"))
    return seen, about.dropDuplicates(["grp"])


#: Words of names that many organisations share.
GENERAL_WORDS = ["masjid", "mosque", "musalla", "musallah", "islamic", "centre", "center", "cntr", "society", "muslim", "association", "assoc", "assn", "youth", "club", "foundation", "fndn", "academy", "acad", "school", "ecole", "prayer", "hall", "jamia", "fondation", "mosquee", "islamique", "club"]


def value_kind(field: Column, value: Column, shared: Column) -> Column:
    """The kind of a value, of which one tends to follow another: an address at a provider or a domain of one's own, an area, a style of account name."""
    return (
        F.when(field == "email", F.when(shared, "provider").otherwise("own domain"))
        .when(field == "phone", F.substring(value, 1, 3))
        .when(field == "postal_code", F.substring(value, 1, 3))
        .otherwise(F.when(value.contains("."), "dotted").otherwise("joined"))
    )


def with_kinds(seen: DataFrame, about: DataFrame) -> DataFrame:
    """Distinct values by source: ``grp, field, value, source, first, last`` with ``kind``, ``belongs`` (own, foreign or unknown), and by how many ``groups`` the value is held and how ``common`` that is."""
    seen = seen.withColumn("source", F.coalesce("source", F.lit("")))
    by_source = cut(seen.groupBy("grp", "field", "value", "source").agg(F.min("at").alias("first"), F.max("at").alias("last")))
    held = by_source.groupBy("field", "value").agg(F.approx_count_distinct("grp").alias("groups"))
    of_field = by_source.groupBy("field").agg(F.approx_count_distinct("grp").alias("of"))  # one row for each field
    share = F.greatest(F.col("groups") - 2, F.lit(0)) / (F.col("of") + SHARED)
    held = held.join(F.broadcast(of_field), "field").select("field", "value", "groups", F.when(F.col("field") == "postal_code", 0.0).otherwise(F.log1p(share * SHARED)).alias("common"))
    by_source = by_source.join(held, ["field", "value"])
    # only addresses meet the providers, so the other fields don't gather under one empty key
    domain = F.regexp_extract("value", "@(.*)$", 1)
    mails, others = by_source.filter("field = 'email'").withColumn("domain", domain), by_source.filter("field <> 'email'")
    providers = mails.groupBy("domain").agg(F.approx_count_distinct("grp").alias("n")).filter(F.col("n") > PROVIDER_OF).select("domain", F.lit(True).alias("shared"))
    mails = mails.join(small(cut(providers)), "domain", "left").drop("domain")
    by_source = mails.unionByName(others.withColumn("shared", F.lit(False)))
    # whether a value has the organisation's words, or is at home in its province
    by_source = by_source.join(about, "grp", "left")
    letters = F.regexp_replace("value", "[^a-z0-9]", "")
    worded = F.size(F.filter(F.coalesce("words", F.array()), lambda w: letters.contains(w) | ((F.length(w) > 5) & letters.contains(F.substring(w, 1, 5))))) > 0
    by_province = F.create_map(*[x for p, codes in AREA_CODES.items() for x in (F.lit(p), F.array(*[F.lit(c) for c in codes.split()]))])
    at_home = F.array_contains(F.try_element_at(by_province, F.col("province")), F.substring("value", 1, 3))
    at_post = F.create_map(*[F.lit(x) for kv in POSTAL_PROVINCES.items() for x in kv])[F.substring("value", 1, 1)] == F.col("province")
    no_words = F.size(F.coalesce("words", F.array())) == 0
    belongs = (
        F.when(F.col("field").isin("email", *SOCIAL), F.when(worded, "own").when(~no_words, "foreign"))
        .when(F.col("field") == "phone", F.when(at_home, "own").when(~at_home, "foreign"))
        .otherwise(F.when(at_post, "own").when(~at_post, "foreign"))
    )
    by_source = by_source.withColumns({"kind": value_kind(F.col("field"), F.col("value"), F.coalesce("shared", F.lit(False))), "belongs": F.coalesce(belongs, F.lit("unknown"))})
    return cut(by_source.drop("words", "province", "shared"))


def learnt(by_source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``field, source, belongs, odds`` that a sighting is right, ``field, kind, later_kind, lean``), both from dated sightings.

    ``lean`` is the share of transitions between two kinds that run from
    ``kind`` to ``later_kind``, less a half: -0.5 to 0.5, shrunk towards 0
    where few were seen. There is at most one row for each pair of kinds that were seen
    to follow one another.
    """
    timed = by_source.filter("last is not null")
    order = W.partitionBy("grp", "field").orderBy("last", "value", "source")
    between = timed.withColumns({"before": F.lag("value").over(order), "after": F.lead("value").over(order), "kind_before": F.lag("kind").over(order)})
    wrong = F.when(F.col("before") == F.col("after"), (F.col("value") != F.col("before")).cast("int"))
    met = between.groupBy("field", "source", "belongs", "kind_before", "kind").agg(F.sum(wrong).alias("wrong"), F.count(wrong).alias("all"), F.count_if((F.col("value") != F.col("before")) & (F.col("kind") != F.col("kind_before"))).alias("steps"))
    met = cut(met)  # one window for both
    trust = met.groupBy("field", "source", "belongs").agg(F.sum("wrong").alias("wrong"), F.sum("all").alias("all"))
    rate = F.least(F.greatest((F.coalesce("wrong", F.lit(0)) + 0.5) / (F.col("all") + 6), F.lit(0.01)), F.lit(0.97))
    trust = trust.select("field", "source", "belongs", F.log((1 - rate) / rate).alias("odds"))
    steps = met.filter("steps > 0").groupBy("field", F.col("kind_before").alias("kind"), F.col("kind").alias("later_kind")).agg(F.sum("steps").alias("n"))
    both = steps.select("field", "kind", "later_kind", "n", F.lit(0).alias("back")).unionByName(steps.select("field", F.col("later_kind").alias("kind"), F.col("kind").alias("later_kind"), F.lit(0).alias("n"), F.col("n").alias("back")))
    lean = (F.sum("n") + 1.0) / (F.sum("n") + F.sum("back") + 2.0) - 0.5
    return trust, both.groupBy("field", "kind", "later_kind").agg(lean.alias("lean")).filter("lean <> 0")


def _undated_edges(rows: DataFrame, precedence: DataFrame) -> DataFrame:
    """``grp, field, value, adds``: what edges to and from values without any date add to the weight that leads on from a value.

    Between two values of which one has no date, the edge from the one to the
    other weighs the other's weight times the share of transitions that run that
    way: a half, and ``lean`` for kinds that are known to follow one another.
    Kinds of a group meet by the learnt pairs, an equality join, so neither
    values nor kinds of a group are paired with all others of it.
    """
    undated = rows.filter("placed is null")
    groups = undated.select("grp", "field").distinct()
    rows = rows.join(groups, ["grp", "field"], "left_semi")  # nothing is left where all values have dates
    values = cut(rows.groupBy("grp", "field", "kind", "value").agg(F.sum("weight").alias("weight"), F.max("placed").isNull().alias("undated")))
    loose = F.sum(F.when(F.col("undated"), F.col("weight")).otherwise(0.0))
    by_kind = values.groupBy("grp", "field", "kind").agg(loose.alias("loose"), F.sum("weight").alias("all"))
    total = by_kind.groupBy("grp", "field").agg(F.sum("loose").alias("loose"), F.sum("all").alias("all"))
    pairs = by_kind.select("grp", "field", "kind").join(precedence, ["field", "kind"]).join(by_kind.select("grp", "field", F.col("kind").alias("later_kind"), "loose", "all"), ["grp", "field", "later_kind"])
    leaning = pairs.groupBy("grp", "field", "kind").agg(F.sum(F.col("lean") * F.col("loose")).alias("to_loose"), F.sum(F.col("lean") * F.col("all")).alias("to_all"))
    led = values.join(total, ["grp", "field"]).join(leaning, ["grp", "field", "kind"], "left")
    zero = F.lit(0.0)
    adds = F.when(F.col("undated"), 0.5 * (F.col("all") - F.col("weight")) + F.coalesce("to_all", zero)).otherwise(0.5 * F.col("loose") + F.coalesce("to_loose", zero))
    return led.select("grp", "field", "value", F.greatest(adds, zero).alias("adds"))


def best_values(seen: DataFrame, about: DataFrame) -> DataFrame:
    """``grp, field, value``: the present value of each group and field that has any.

    ``seen``: ``grp, field, value, at, source`` (null values left out by the
    caller; ``at`` and ``source`` may be null). ``about``: ``grp, words,
    province`` (both may be null). Repeated sightings by one source count
    once, so a group of any size shrinks to its distinct values by source
    before it is ordered. A sighting without a date of a value that has one elsewhere
    counts as of that date; groups without any date are ordered by precedence
    alone. A value that other groups hold too counts less, but
    is kept where there is no better one. Ties go to the later, then the smaller value.
    """
    by_source = with_kinds(seen, about)
    trust, precedence = learnt(by_source)
    # a row for each field and source, and one for each pair of kinds
    rows = by_source.join(small(cut(trust)), ["field", "source", "belongs"], "left").withColumn("odds", F.coalesce("odds", F.lit(0.2)))
    # what many hold says little against other values
    rows = rows.withColumn("odds", F.when(F.col("odds") > 0, F.greatest(F.col("odds") - F.col("common"), F.lit(0.0))).otherwise(F.col("odds")))
    in_group, of_value = W.partitionBy("grp", "field"), W.partitionBy("grp", "field", "value")
    rows = rows.withColumn("value_last", F.max("last").over(of_value)).withColumn("placed", F.coalesce("last", "value_last"))
    newest_first = of_value.orderBy(F.col("placed").desc(), "source")
    rows = rows.withColumn("weight", F.col("odds") + F.when(F.row_number().over(newest_first) > 1, AGREED).otherwise(0.0))
    rows = cut(rows.select("grp", "field", "value", "kind", "groups", "common", "belongs", "placed", "value_last", "weight"))
    upto = in_group.orderBy(F.col("placed").desc()).rangeBetween(W.unboundedPreceding, W.currentRow)
    # the edges that lead on from a dated value: sightings after its last one
    led = rows.withColumn("since", F.sum("weight").over(upto)).withColumn("since", F.col("since") - F.sum("weight").over(W.partitionBy("grp", "field", "placed")))
    led = led.withColumn("all_weight", F.sum("weight").over(in_group))
    values = led.groupBy("grp", "field", "value").agg(
        F.sum("weight").alias("weight"), F.max("placed").alias("placed"), F.max("groups").alias("groups"), F.max("common").alias("common"), F.max("belongs").alias("belongs"), F.max("all_weight").alias("all_weight"),
        F.coalesce(F.min(F.when(F.col("placed") == F.col("value_last"), F.col("since"))), F.lit(0.0)).alias("later"),
    )
    values = values.join(_undated_edges(rows, small(cut(precedence))), ["grp", "field", "value"], "left").withColumn("later", F.col("later") + F.coalesce("adds", F.lit(0.0)))
    # the values before it had to be given up for it, which is rare, unless they weren't credible
    earlier = F.greatest(F.col("all_weight") - F.col("weight") - F.col("later"), F.lit(0.0))
    score = F.least(F.col("weight"), F.lit(CREDIBLE)) + F.when(F.col("belongs") == "foreign", FOREIGN).otherwise(0.0) - F.col("later") - F.least(earlier, F.lit(CHANGE)) - F.when((F.col("groups") > 1) & (F.col("field") != "postal_code"), 1.0 + F.col("common")).otherwise(0.0)
    return values.groupBy("grp", "field").agg(F.max_by("value", F.struct(F.round(score, 6), "placed", F.translate("value", "0123456789abcdefghijklmnopqrstuvwxyz", "zyxwvutsrqponmlkjihgfedcba9876543210"))).alias("value"))


def surviving_records(organizations: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row for each group of two or more rows and field with a well-formed value: ``org_id, field, value``.

    A group is an organisation with null ``merged_into``, the rows that lead to
    it and the candidates resolved to any of these. Rows of broken or circular
    chains and candidates resolved to missing rows belong to no group; fields
    in which a group has only nulls, blanks, placeholders or ill-formed values
    give no row; empty tables give none. Other columns are ignored.
    """
    return best_values(*sightings(organizations, candidates)).select(F.col("grp").alias("org_id"), "field", "value")
