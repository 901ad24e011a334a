"""The next state of a table after an upsert, with a policy for each column.

There is no MERGE on plain Parquet; the next snapshot is computed by a full
outer join on the key. Keys compare null-safely where asked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Policy = str | Callable[[Column, Column], Column]


def upsert(old: DataFrame, new: DataFrame, keys: list[str], policies: dict[str, Policy], when: Callable[[str, str], Column] | None = None, null_keys: bool = False) -> DataFrame:
    """Rows of ``old`` changed and completed by ``new``, in ``old``'s columns.

    Policies of columns, where both have the row: ``keep`` the old value (also
    for columns not named), ``replace`` it, ``coalesce_new`` (new unless null),
    ``coalesce_old`` (old unless null), or a function of the old and the new
    column. ``when(o, n)``, given the aliases of both sides, may restrict which rows are
    changed. Keys must be unique in either table; with ``null_keys`` null
    equals null, otherwise rows of a null key never meet.
    """
    o, n = "__o", "__n"
    on = [F.col(f"{o}.{k}").eqNullSafe(F.col(f"{n}.{k}")) if null_keys else F.col(f"{o}.{k}") == F.col(f"{n}.{k}") for k in keys]
    left, right = old.withColumn("__in", F.lit(True)).alias(o), new.withColumn("__in", F.lit(True)).alias(n)
    both = left.join(right, on, "full")
    had, has = F.col(f"{o}.__in").isNotNull(), F.col(f"{n}.__in").isNotNull()
    change = F.coalesce(when(o, n), F.lit(False)) if when else F.lit(True)
    out = []
    for c in old.columns:
        a = F.col(f"{o}.{c}")
        if c not in new.columns:
            out.append(a.alias(c))
            continue
        b, policy = F.col(f"{n}.{c}"), policies.get(c, "keep")
        merged = {"keep": a, "replace": b, "coalesce_new": F.coalesce(b, a), "coalesce_old": F.coalesce(a, b)}[policy] if isinstance(policy, str) else policy(a, b)
        out.append(F.when(had & has & change, merged).when(had, a).otherwise(b).alias(c))
    return both.select(*out)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` whose key it hasn't; rows of a known key are left as they are."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti").select(*old.columns))


def fill_nulls(table: DataFrame, key: str, values: DataFrame, columns: list[str]) -> DataFrame:
    """``table`` with nulls of some columns filled from ``values``, which has one row for each key."""
    v = values.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in columns])
    filled = table.join(v, key, "left")
    return filled.select(*[F.coalesce(c, f"__{c}").alias(c) if c in columns else F.col(c) for c in table.columns])


def changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """What a write would do, without doing it: keys with ``change`` (insert, update, delete) of two snapshots."""
    cols = [c for c in old.columns if c not in keys]
    a = old.select(*keys, F.struct(*cols).alias("__old"), F.lit(True).alias("__a"))
    b = new.select(*keys, F.struct(*cols).alias("__new"), F.lit(True).alias("__b"))
    both = a.join(b, keys, "full")
    kind = F.when(F.col("__a").isNull(), "insert").when(F.col("__b").isNull(), "delete").when(~F.col("__old").eqNullSafe(F.col("__new")), "update")
    return both.select(*keys, kind.alias("change")).filter("change is not null")
