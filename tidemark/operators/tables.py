"""Merges, scoped replacement, fingerprints and differences of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.exprs import differs, names_where

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str] | None = None) -> DataFrame:
    """Rows of ``new`` over those of ``old`` with the same key; columns ``keep`` stay as they were."""
    if not keep:
        return old.join(new, keys, "left_anti").unionByName(new.select(*old.columns))
    o, n = old.withColumn("_old", F.lit(True)).alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    joined = o.join(n, keys, "full_outer")
    columns = []
    for c in old.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c not in new.columns:
            columns.append(F.col(f"o.{c}").alias(c))
        elif c in keep:
            columns.append(F.when(F.col("_old"), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
        else:
            columns.append(F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return joined.select(*columns)


def replace_where(old: DataFrame, new: DataFrame, scope: Column) -> DataFrame:
    """``old`` outside the scope, and ``new``."""
    return old.where(~F.coalesce(scope, F.lit(False))).unionByName(new.select(*old.columns))


def replace_keys(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` without the keys of ``new``, and ``new``; the keys must have no nulls."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.select(*old.columns))


def update_from(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``target`` with ``columns`` taken from ``source`` where it has the key; other rows stay as they were.

    ``source`` must have a key once at most; a column that ``target`` lacks is null where ``source`` lacks the key.
    """
    fresh = source.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_hit"))
    joined = target.join(fresh, keys, "left")
    old = lambda c: F.col(c) if c in target.columns else F.lit(None)
    taken = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(old(c)) for c in columns}
    rest = [c for c in columns if c not in target.columns]
    return joined.select(*(taken[c].alias(c) if c in taken else F.col(c) for c in target.columns), *(taken[c].alias(c) for c in rest))


def first_rows(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row of each key: the first by ``order``, then by all other columns, so that reruns keep the same."""
    rest = [c for c in df.columns if c not in keys and c not in (order or [])]
    if not (order or rest):
        return df.distinct()
    place = Window.partitionBy(*keys).orderBy(*(order or []), *rest)
    return df.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """(rows beyond the first of each key), one row."""
    return df.groupBy(*keys).count().where("count > 1").agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def require_unique(df: DataFrame, keys: list[str]) -> None:
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"not unique by {keys}")


def fingerprint(df: DataFrame, columns: list[str] | None = None, digits: int | None = 9) -> DataFrame:
    """Row count and sum, least and greatest of row hashes, whatever the order; doubles are rounded.

    A row's hash is the first 60 bits of the MD5 of its values' texts, each after its length,
    by name; times count in microseconds, doubles have ``digits`` places. Any engine can repeat it.
    """
    types = dict(df.dtypes)

    def text(c: str) -> Column:
        if types[c] == "double" and digits is not None:
            return F.coalesce(F.expr(f"cast(try_cast(round(`{c}`, {digits}) as decimal(38, {digits})) as string)"), F.col(c).cast("string"))
        if types[c].startswith("timestamp"):
            return F.unix_micros(F.col(c).cast("timestamp")).cast("string")
        return F.col(c).cast("string")

    parts = [F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("null")) for c in sorted(columns or df.columns)]
    h = F.conv(F.substring(F.md5(F.concat_ws(",", *parts).cast("binary")), 1, 15), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.min(h).alias("hash_min"), F.max(h).alias("hash_max"))


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side beyond those of the other, with ``side``."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("left_only")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right_only")))


def compare(expected: DataFrame, actual: DataFrame, keys: list[str], columns: list[str], tolerance: float = 1e-12) -> DataFrame:
    """Outer comparison: keys, ``side`` (left_only, right_only, both) and ``mismatch``, the names of differing columns."""
    types = dict(expected.dtypes)
    e = expected.select(*keys, *(F.col(c).alias(f"e_{c}") for c in columns), F.lit(True).alias("_e"))
    a = actual.select(*keys, *(F.col(c).alias(f"a_{c}") for c in columns), F.lit(True).alias("_a"))
    side = F.when(F.col("_a").isNull(), "left_only").when(F.col("_e").isNull(), "right_only").otherwise("both")
    joined = e.join(a, keys, "full_outer").withColumn("side", side)
    flags = {c: (F.col("side") == "both") & differs(F.col(f"e_{c}"), F.col(f"a_{c}"), types[c] in _NUMBERS, tolerance) for c in columns}
    return joined.withColumn("mismatch", names_where(flags)).drop("_e", "_a")


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
