"""Directory relations: contacts, suppression, evidence, queues, facets, bands and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgloom.functions.text import digits
from orgloom.operators.skew import salted_join


def contacts_of(organizations: DataFrame) -> DataFrame:
    """``org_id, kind, value`` of every contact that isn't blank."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in (("email", "email"), ("phone", "phone"), ("contact_form", "website"))])
    rows = organizations.select(F.col("id").alias("org_id"), F.explode(kinds).alias("c")).select("org_id", "c.kind", "c.value")
    return rows.filter(F.trim("value") != "")


def live_contacts(contacts: DataFrame, suppressed: DataFrame) -> DataFrame:
    """Contacts that no suppressed value (``kind, value``) stands for: emails in small letters, phones by their digits."""
    norm = lambda k, v: F.when(k == "email", F.lower(v)).when(k == "phone", digits(v))
    gone = suppressed.select("kind", norm(F.col("kind"), F.col("value")).alias("norm")).filter("norm <> ''").distinct()
    keyed = contacts.withColumn("norm", norm(F.col("kind"), F.col("value")))
    return keyed.join(gone, ["kind", "norm"], "left_anti").drop("norm").select(*contacts.columns)


def contact_rollup(contacts: DataFrame) -> DataFrame:
    """Which channels an organisation has, and how many kinds."""
    has = lambda k: F.bool_or(F.col("kind") == k)
    return contacts.groupBy("org_id").agg(has("email").alias("has_email"), has("phone").alias("has_phone"), has("contact_form").alias("has_form"), F.count_distinct("kind").alias("n_kinds"))


def evidence(records: DataFrame, key: str, source: str, url: str, at: str) -> DataFrame:
    """Sources of each key joined in order, whether any page looks like a contact page, and the latest sighting."""
    return records.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.array_join(F.array_sort(F.collect_set(source)), ",").alias("methods"), F.coalesce(F.bool_or(F.lower(url).contains("contact")), F.lit(False)).alias("from_contact_page"), F.max(at).alias("last_seen"), F.count(F.lit(1)).alias("n_records")
    )


def flagged(df: DataFrame, keys: DataFrame, on: str, flag: str) -> DataFrame:
    """Adds whether a row's key is in another table: an existence join."""
    return df.join(keys.select(on).distinct().withColumn("__in", F.lit(True)), on, "left").withColumn(flag, F.col("__in").isNotNull()).drop("__in")


def blanked(df: DataFrame, column: str, suppressed: DataFrame, kind: str) -> DataFrame:
    """A column with the values blanked that a suppressed value of the kind stands for: addresses in small letters, numbers by their digits."""
    norm = lambda c: digits(F.col(c)) if kind == "phone" else F.lower(c)
    gone = suppressed.filter(F.col("kind") == kind).select(norm("value").alias("__norm")).filter("__norm <> ''")
    marked = flagged(df.withColumn("__norm", norm(column)), gone, "__norm", "__gone")
    return marked.withColumn(column, F.when(~F.col("__gone"), F.col(column))).drop("__norm", "__gone")


def contact_origin(contacts: DataFrame, provenance: DataFrame, method: str, page: str, kind: str) -> DataFrame:
    """``org_id, methods, from_contact``: how the contacts of a kind were found, joined in order, and whether on a page that looks like a contact page; organisations with such contacts and provenance only."""
    found = provenance.filter(F.col("kind") == kind).groupBy("org_id").agg(F.array_join(F.array_sort(F.collect_set(method)), ",").alias("methods"), F.coalesce(F.bool_or(F.lower(page).contains("contact")), F.lit(False)).alias("from_contact"))
    return found.join(contacts.filter(F.col("kind") == kind).select("org_id"), "org_id", "left_semi")


def containing(texts: DataFrame, text: str, parts: DataFrame, part: str, size: int = 6) -> DataFrame:
    """Rows of ``texts`` whose text contains a row of ``parts``' part: both tables' columns, a pair once.

    A part of at least ``size`` characters is looked up by its first ones among
    all pieces of that length of the texts, then compared exactly; shorter
    ones are looked up by all they have. So the join is one of equality, not
    of all with all, and hot pieces are dealt to several tasks. Null and empty parts are contained in nothing.
    """
    parts = parts.filter(F.length(part) > 0).withColumn("__size", F.least(F.length(part), F.lit(size))).withColumn("__piece", F.substring(F.col(part), F.lit(1), F.col("__size")))
    sizes = parts.select("__size").distinct()
    piece = lambda t, n: F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda i: F.substring(t, i, n))
    cut = texts.join(sizes, F.length(text) >= F.col("__size")).withColumn("__piece", F.explode(F.array_distinct(piece(F.col(text), F.col("__size")))))
    # pieces that most texts have, such as the beginning of an address, are hot
    return salted_join(parts, cut, ["__size", "__piece"]).filter(F.col(text).contains(F.col(part))).select(*texts.columns, *[c for c in parts.columns if not c.startswith("__")])


def bands(df: DataFrame, value: str, edges: list[int]) -> DataFrame:
    """Rows in each band ``[edge, next edge)`` from below the first to above the last, empty bands too: ``band, n``."""
    names = [f"<{edges[0]}", *[f"{a}-{b - 1}" for a, b in zip(edges, edges[1:])], f"{edges[-1]}+"]
    label = F.when(F.col(value) < edges[0], names[0])
    for name, b in zip(names[1:], edges[1:]):
        label = label.when(F.col(value) < b, name)
    label = label.otherwise(names[-1])
    n = df.filter(F.col(value).isNotNull()).groupBy(label.alias("band")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.createDataFrame([(x,) for x in names], "band string")
    return every.join(n, "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("n"))


def facets(df: DataFrame, key: Column) -> DataFrame:
    """How often each key occurs, in capitals: ``key, n``, most frequent first, ties by the key."""
    return df.filter(key != "").groupBy(F.upper(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key")


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Of each column: rows that aren't null or empty and their share: ``field, n_known, share``; shares of an empty table are 0."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "").alias(c) for c in columns])
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n_known")) for c in columns]))
    return counted.select("rows", long.alias("x")).select("x.field", "x.n_known", F.round(F.coalesce(F.try_divide(F.col("x.n_known"), F.col("rows")), F.lit(0.0)), 6).alias("share"))


def page(df: DataFrame, condition: Column, order: list[Column], number: int, size: int) -> DataFrame:
    """One page of a filtered, sorted list; numbers below 1 give the first page."""
    return df.filter(condition).orderBy(*order).offset(max(number - 1, 0) * size).limit(size)


def missing_fields(columns: dict[str, Column]) -> Column:
    """Names of the fields that are null or empty, in the order given, joined by commas."""
    return F.array_join(F.filter(F.array(*[F.when(F.coalesce(c, F.lit("")) == "", F.lit(k)) for k, c in columns.items()]), lambda x: x.isNotNull()), ",")


def topped_up(first: DataFrame, second: DataFrame, order: list[str], n: int) -> DataFrame:
    """``n`` rows: all of ``first`` in order, then of ``second`` in order as far as there is room."""
    both = first.withColumn("__from", F.lit(0)).unionByName(second.withColumn("__from", F.lit(1)))
    return both.orderBy("__from", *order).limit(n).drop("__from")
