"""Column profiles with induced patterns, and loads that depart from the others.

All heavy work is one aggregation of the table to (load, column, value) counts.
Patterns are induced from the distinct values by minimum description length:
every value has a chain of ever more general shapes (exact characters' classes,
runs of them, words, anything), and each shape is kept or split into its more
special ones, whichever describes the values in fewer bits. The choice is made
bottom-up by three aggregations, so no list of values reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgloom.operators.skew import with_total
from orgloom.session import cut

MISSING, RARE = "(missing)", "(rare)"


def _shapes(value: Column) -> dict[str, Column]:
    """The chain of shapes of a value. A: capital, a: small letter, x: other letter, 9: digit; signs stand for themselves, + \\ behind a backslash."""
    exact = F.regexp_replace(value, r"([\\+])", r"\\$1")
    for cls, sign in ((r"\p{Lu}", "A"), (r"\p{Ll}", "a"), (r"[\p{L}\p{M}&&[^\p{Lu}\p{Ll}]]", "x"), (r"\p{Nd}", "9"), (r"\s", " ")):
        exact = F.regexp_replace(exact, cls, sign)
    runs = exact
    for sign in "Aax9 ":
        runs = F.regexp_replace(runs, f"{sign}+", f"{sign}+")
    words = F.regexp_replace(runs, r"(?:[Aax9]\+)+(?:[._-](?:[Aax9]\+)+)*", "W+")
    return {"exact": exact, "runs": runs, "words": words}


def _gamma(n: Column) -> Column:
    return 2 * F.log2(n + 1) + 1


def induce_patterns(values: DataFrame) -> DataFrame:
    """Chosen patterns of (column, value, n): ``column, exact, pattern``, one row for each exact shape.

    ``values`` must hold each value of a column once; nulls are left out by the
    caller. The pattern ``.+`` stands where no shape shortens the description.
    """
    shaped = values.select("column", "value", *[c.alias(k) for k, c in _shapes(F.col("value")).items()])
    size = F.length("value")
    digits, letters = F.length(F.regexp_replace("exact", "[^9]", "")), F.length(F.regexp_replace("exact", "[^Aax]", ""))
    run_count = F.greatest(F.length(F.regexp_replace("runs", r"[^Aax9]", "")), F.lit(1))
    fixed = digits * 3.33 + letters * 4.7
    bits = {"exact": fixed, "runs": fixed + run_count * _gamma((digits + letters) / run_count), "words": size * 6.0 + _gamma(size), "any": size * 7.0 + _gamma(size)}
    shaped = shaped.withColumn("any", F.lit(".+")).withColumns({f"bits_{k}": b for k, b in bits.items()})
    model = lambda c: F.length(c) * 6.0 + 16
    level = shaped.groupBy("column", "any", "words", "runs", "exact").agg(*[F.sum(f"bits_{k}").alias(f"bits_{k}") for k in bits], F.count(F.lit(1)).alias("n")).withColumn("best", F.col("bits_exact") + model("exact"))
    level = cut(level)  # read by every step below
    chosen = level.select("column", "any", "words", "runs", "exact")
    upper = level
    for k, above in (("runs", ["any", "words"]), ("words", ["any"]), ("any", [])):
        keys = ["column", *above, k]
        # to be split costs, beside the parts, the bits that name each value's part
        named = F.sum("n") * F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n"))
        upper = upper.groupBy(*keys).agg(*[F.sum(f"bits_{j}").alias(f"bits_{j}") for j in bits if j != "exact"], (F.sum("best") + named).alias("split"), F.sum("n").alias("n"))
        upper = upper.withColumn("own", F.col(f"bits_{k}") + model(k)).withColumn("best", F.least("own", "split"))
        chosen = chosen.join(upper.select(*keys, (F.col("own") < F.col("split")).alias(f"keep_{k}")), keys)
    picked = F.when(F.col("keep_any"), F.col("any")).when(F.col("keep_words"), F.col("words")).when(F.col("keep_runs"), F.col("runs")).otherwise(F.col("exact"))
    return chosen.select("column", "exact", picked.alias("pattern"))


def value_counts(df: DataFrame, load_col: str, columns: list[str]) -> DataFrame:
    """``load, column, value, n``; null and blank values are one value, null."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.when(F.trim(F.col(f"`{c}`").cast("string")) != "", F.col(f"`{c}`").cast("string")).alias("value")) for c in columns]))
    long = df.select(F.col(f"`{load_col}`").cast("string").alias("load"), pairs.alias("p")).select("load", "p.column", "p.value")
    return long.groupBy("load", "column", "value").agg(F.count(F.lit(1)).alias("n"))


def with_patterns(counts: DataFrame, min_share: float = 0.01) -> DataFrame:
    """``value_counts`` with the induced ``pattern`` of each value and whether it ``conforms``.

    A pattern that covers less than ``min_share`` of a column's present values
    over all loads doesn't describe the column; its rows don't conform.
    """
    counts = cut(counts)  # the one pass over the table
    present = counts.filter(F.col("value").isNotNull())
    patterns = cut(induce_patterns(present.select("column", "value").distinct()))
    shaped = counts.withColumn("exact", _shapes(F.col("value"))["exact"]).join(patterns, ["column", "exact"], "left").drop("exact")
    totals = shaped.filter(F.col("value").isNotNull()).groupBy("column", "pattern").agg(F.sum("n").alias("covered"))
    totals = with_total(totals, ["column"], "covered", "of_column")
    totals = totals.withColumn("conforms", (F.col("pattern") != ".+") & (F.col("covered") >= min_share * F.col("of_column"))).drop("covered", "of_column")
    return shaped.join(totals, ["column", "pattern"], "left")


def profile(df: DataFrame, load_col: str, columns: list[str], min_share: float = 0.01) -> DataFrame:
    """Standard aggregates and pattern coverage of each load and column.

    Columns: ``load_id, column_name, n_rows, n_missing, n_distinct, min_value,
    max_value, min_length, max_length, n_nonconforming, n_patterns, top_value,
    top_n``. Blank values count as missing; a column with no present value has
    null ranges. Equal top counts are decided by the smaller value. An empty
    table gives no rows; rows without a load form a load of their own (null).
    """
    held = with_patterns(value_counts(df, load_col, columns), min_share)
    there = F.col("value").isNotNull()
    n = F.col("n")
    return held.groupBy(F.col("load").alias("load_id"), F.col("column").alias("column_name")).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(~there, n).otherwise(0)).alias("n_missing"),
        F.count("value").alias("n_distinct"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.min(F.length("value")).alias("min_length"),
        F.max(F.length("value")).alias("max_length"),
        F.sum(F.when(there & ~F.col("conforms"), n).otherwise(0)).alias("n_nonconforming"),
        F.countDistinct(F.when(F.col("conforms"), F.col("pattern"))).alias("n_patterns"),
        F.max_by("value", F.when(there, F.struct(n, F.translate(F.col("value"), "", "")))).alias("top_value"),
        F.max(F.when(there, n)).alias("top_n"),
    )


def aggregates(df: DataFrame, load_col: str, columns: list[str]) -> DataFrame:
    """Standard aggregates of each load and column: ``load_id, column_name, n_rows, n_missing, n_distinct, min_value, max_value, min_length, max_length, top_value, top_n``.

    As in ``profile``, without patterns; equal top counts are decided by the greater value.
    """
    n, there = F.col("n"), F.col("value").isNotNull()
    return value_counts(df, load_col, columns).groupBy(F.col("load").alias("load_id"), F.col("column").alias("column_name")).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(~there, n).otherwise(0)).alias("n_missing"),
        F.count("value").alias("n_distinct"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.min(F.length("value")).alias("min_length"),
        F.max(F.length("value")).alias("max_length"),
        F.max_by("value", F.when(there, F.struct(n, F.col("value")))).alias("top_value"),
        F.max(F.when(there, n)).alias("top_n"),
    )


def pattern_coverage(df: DataFrame, load_col: str, columns: list[str], min_share: float = 0.01) -> DataFrame:
    """Rows of each load that each pattern of a column covers: ``load_id, column_name, pattern, n_rows``."""
    held = with_patterns(value_counts(df, load_col, columns), min_share).filter(F.col("value").isNotNull())
    return held.groupBy(F.col("load").alias("load_id"), F.col("column").alias("column_name"), F.when(F.col("conforms"), F.col("pattern")).otherwise(RARE).alias("pattern")).agg(F.sum("n").alias("n_rows"))


def _kind(column: Column, value: Column) -> Column:
    """What a value says apart from how it is written: the area code of a phone, the domain of an email, any other value in small letters."""
    digits = F.regexp_replace(F.regexp_replace(F.lower(value), r"(?:ext|x)\.?\s*\d+\s*$", ""), r"\D", "")
    area = F.regexp_extract(digits, r"^1?(\d{3})\d{7}$", 1)
    domain = F.regexp_extract(F.lower(value), r"@([a-z0-9.-]+)", 1)
    return F.when(area != "", area).when(domain != "", domain).otherwise(F.lower(F.trim(value)))


def load_departures(df: DataFrame, load_col: str, columns: list[str], min_share: float = 0.01, least_kind: float = 0.004) -> DataFrame:
    """How far each load is from all the others, by aspect: ``load_id, column_name, aspect, n, distance, expected``.

    Aspects: ``missing`` (share of null or blank values), ``pattern`` (which
    induced patterns the present values have), ``kind`` (which values occur,
    apart from their notation), ``repeat`` (the share of the one value that is
    commoner here than elsewhere). The distance is the total variation distance
    between the load and the other loads together; ``expected`` is about what
    it is by chance for a load of ``n`` values.
    """
    held = cut(with_patterns(value_counts(df, load_col, columns), min_share))
    there = held.filter(F.col("value").isNotNull())
    missing = held.select("load", "column", F.lit("missing").alias("aspect"), F.when(F.col("value").isNull(), MISSING).otherwise("present").alias("category"), "n")
    pattern = there.select("load", "column", F.lit("pattern").alias("aspect"), F.when(F.col("conforms"), F.col("pattern")).otherwise(RARE).alias("category"), "n")
    kinds = there.select("load", "column", F.lit("kind").alias("aspect"), _kind(F.col("column"), F.col("value")).alias("category"), "n").groupBy("load", "column", "aspect", "category").agg(F.sum("n").alias("n"))
    common = with_total(kinds.groupBy("column", "category").agg(F.sum("n").alias("all")), ["column"], "all", "of_column").withColumn("share", F.col("all") / F.col("of_column"))
    common = common.filter(F.col("share") >= least_kind).select("column", "category", F.lit(True).alias("common"))
    kinds = kinds.join(common, ["column", "category"], "left").withColumn("category", F.when(F.col("common"), F.col("category")).otherwise(RARE)).select("load", "column", "aspect", "category", "n")
    shares = cut(missing.unionByName(pattern).unionByName(kinds).groupBy("load", "column", "aspect", "category").agg(F.sum("n").alias("n")))
    for by, total in ((["load", "column", "aspect"], "of_load"), (["column", "aspect", "category"], "of_category"), (["column", "aspect"], "of_all")):
        shares = with_total(shares, by, "n", total)
    shares = cut(shares)
    elsewhere = F.coalesce(F.try_divide(F.col("of_category") - F.col("n"), F.col("of_all") - F.col("of_load")), F.col("n") / F.col("of_load"))
    spread = shares.select("column", "aspect", "category", (F.col("of_category") / F.col("of_all")).alias("q")).distinct().groupBy("column", "aspect").agg((0.4 * F.sum(F.sqrt(F.col("q") * (1 - F.col("q"))))).alias("spread"))
    far = shares.groupBy("load", "column", "aspect").agg(F.max("of_load").alias("n"), F.sum(F.greatest(F.col("n") / F.col("of_load") - elsewhere, F.lit(0.0))).alias("distance"))
    far = far.join(spread, ["column", "aspect"])
    repeat = there.select("load", "column", "value", "n")
    repeat = with_total(with_total(repeat, ["load", "column"], "n", "of_load"), ["column", "value"], "n", "of_value")
    repeat = repeat.join(there.groupBy("column").agg(F.sum("n").alias("of_all")), "column")
    over = F.col("n") / F.col("of_load") - F.coalesce(F.try_divide(F.col("of_value") - F.col("n"), F.col("of_all") - F.col("of_load")), F.col("n") / F.col("of_load"))
    # one copy of a value in a load says nothing of repetition
    repeat = repeat.groupBy("load", "column").agg(F.max("of_load").alias("n"), F.max(F.when(F.col("n") > 1, over).otherwise(0.0)).alias("distance")).select("load", "column", F.lit("repeat").alias("aspect"), "n", "distance", F.lit(0.4).alias("spread"))
    result = far.select("load", "column", "aspect", "n", "distance", "spread").unionByName(repeat)
    return result.select(F.col("load").alias("load_id"), F.col("column").alias("column_name"), "aspect", "n", "distance", (F.col("spread") / F.sqrt("n")).alias("expected"))


def departed_loads(df: DataFrame, load_col: str, columns: list[str], least: float = 0.1, strictness: float = 6.0, **settings) -> DataFrame:
    """Loads and columns that clearly depart: ``load_id, column_name, aspects``.

    A load departs in an aspect if its distance, less what chance gives a load
    of its size (three times over), is at least ``least`` and lies ``strictness``
    median deviations above the median of all loads of that column and aspect.
    A table with a single load departs from nothing; nor does an empty one.
    Loads with a null id aren't reported.
    """
    far = cut(load_departures(df, load_col, columns, **settings).withColumn("excess", F.col("distance") - 3 * F.col("expected")))
    usual = far.groupBy("column_name", "aspect").agg(F.median("excess").alias("usual"))
    far = far.join(usual, ["column_name", "aspect"])
    off = far.groupBy("column_name", "aspect").agg(F.median(F.abs(F.col("excess") - F.col("usual"))).alias("off"))
    far = far.join(off, ["column_name", "aspect"]).filter((F.col("excess") >= least) & (F.col("excess") >= F.col("usual") + strictness * F.col("off")))
    return far.filter(F.col("load_id").isNotNull()).groupBy("load_id", "column_name").agg(F.array_join(F.array_sort(F.collect_set("aspect")), ",").alias("aspects"))
