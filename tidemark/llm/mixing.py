"""Mixing sources to target weights by Pareto order sampling.

Target sizes come from water-filling the weights under a cap of ``most`` times a
source's size. A source first takes every document as many whole times as fit;
the rest is a sample: each document gets a uniform number u from the MD5 of its id
and the seed, is ranked by odds(u) / odds(p), p its inclusion probability, and the
ranks are taken while they fit into the remaining words. Inclusion is in proportion
to the square root of the size unless another weight is given, so that long
documents, which hold most words, are likelier than short ones. The last place goes to
the document behind the cut, in the cut's bin, whose size comes nearest to the
words still missing, if that brings the total nearer.

The cut is found from word totals of rank bins, so that no source is sorted in
one task, and only the bin holding the cut is ordered. Whether a document is
taken then depends on its own row and one row for its source.

Null texts and empty ones have size 0. A null source is a source of its own,
last in order. Rows that repeat a doc_id share a rank and are taken together;
null ids too. With an empty table the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.store import save

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
SEED = 20_240_501
DOCS_PER_BIN = 2_000
#: Source rows, of some 200 bytes each, that may be sent to every executor.
BROADCAST_SOURCES = 20_000
#: Stands for a null id where ids are compared.
NO_ID = -(1 << 63)
WORD = r"[^\\x20\\x09-\\x0D]+"


def size_of(text: str = "text") -> Column:
    return F.expr(f"cast(coalesce(regexp_count(`{text}`, '{WORD}'), 0) as long)")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: int = MOST_COPIES) -> DataFrame:
    """One row (source, source_size, ...) for each source, with ``target``."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)).withColumn("cap", F.col("source_size") * float(most))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("w").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    # the level left for the rest rises while sources are capped, and falls behind the first that is not
    leveled = ranked.withColumn("level", level).withColumn("final", F.max("level").over(every))
    return leveled.select(*sizes.columns, F.least("cap", F.col("final") * F.col("w")).alias("target"))


def _to_sources(docs: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    right = sources.withColumnRenamed("source", "_source")
    right = F.broadcast(right) if n_sources <= BROADCAST_SOURCES else right
    return docs.join(right, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _ranked(docs: DataFrame, weight: Column, seed: int) -> DataFrame:
    """Adds _key, increasing with the Pareto rank and within 0 to 1, where a sample of the source is due."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))
    u = (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    p = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-12), F.col("_part") * weight / F.col("_mean")))
    rank = u / (1 - u) / (p / (1 - p))
    flat = rank * F.col("_part") / (1 - F.col("_part"))
    return docs.withColumn("_key", F.when(F.col("_part") > 0, flat / (1 + flat)))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: int = MOST_COPIES, seed: int = SEED, inclusion: Column | None = None) -> DataFrame:
    """All columns of ``docs`` with size, source_size, target, copies and taken.

    Inclusion probabilities in a source's sample are in proportion to ``inclusion``, over the
    columns of ``docs`` and size; by default to the root of the size. Columns of ``docs``
    with one of the added names are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    weight = F.sqrt("size") if inclusion is None else inclusion
    sized = docs.withColumn("size", size_of())
    slim = save(sized.select("doc_id", "source", "size", weight.alias("_weight")), "sizes")
    # in decimals, whose sum does not depend on the order of rows
    weighted = F.sum((F.col("size") * F.col("_weight")).cast("decimal(30,6)")).cast("double")
    mean = F.coalesce(F.try_divide(weighted, F.sum("size")), F.lit(1.0))
    sums = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"), mean.alias("_mean"))
    plan = targets(sums, weights, share, most).withColumn("_ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    plan = save(plan.withColumn("_whole", F.floor("_ratio")).withColumn("_part", F.col("_ratio") - F.col("_whole")).drop("_ratio"), "targets")
    n_sources = plan.count()

    keyed = _ranked(_to_sources(slim, plan, n_sources), F.col("_weight"), seed).where("_key is not null")
    keyed = keyed.withColumn("_bin", F.floor(F.col("_key") * F.ceil(F.col("n_docs") / DOCS_PER_BIN)))
    bins = keyed.groupBy("source", "_bin").agg(F.sum("size").alias("words"), F.first(F.col("_part") * F.col("source_size")).alias("due"))
    upto = Window.partitionBy("source").orderBy("_bin")
    bins = bins.withColumn("before", F.sum("words").over(upto) - F.col("words")).where("before <= due and due <= before + words")
    cut_bin = bins.groupBy("source").agg(F.min("_bin").alias("_cut_bin"), F.min_by("before", "_bin").alias("before"), F.first("due").alias("due"))
    edge = _to_sources(keyed.drop("due"), cut_bin, n_sources).where("_bin = _cut_bin")
    edge = edge.groupBy("source", "_key", "doc_id").agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("due").alias("due"))
    place = Window.partitionBy("source").orderBy("_key", "doc_id")
    edge = edge.withColumn("upto", F.col("before") + F.sum("words").over(place)).withColumn("fits", F.col("upto") <= F.col("due"))
    edge = edge.withColumn("rest", F.col("due") - F.coalesce(F.max(F.when(F.col("fits"), F.col("upto"))).over(Window.partitionBy("source")), F.col("before")))
    own = F.struct("_key", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"))
    off = F.abs(F.col("words") - F.col("rest"))
    cut = edge.groupBy(F.col("source").alias("_s")).agg(F.max(F.when(F.col("fits"), own)).alias("_cut"), F.min(F.when(~F.col("fits") & (off < F.col("rest")), F.struct(off, own))).getField("col2").alias("_last"))
    ends = cut_bin.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").select(F.col("source").alias("_s"), "_cut_bin", "_cut", "_last")
    whole = save(plan.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "cuts")

    placed = _ranked(_to_sources(sized, whole, n_sources), weight, seed)
    own_bin = F.floor(F.col("_key") * F.ceil(F.col("n_docs") / DOCS_PER_BIN))
    drawn = F.col("_key").isNotNull() & ((own_bin < F.col("_cut_bin")) | ((own_bin == F.col("_cut_bin")) & F.coalesce((own <= F.col("_cut")) | (own == F.col("_last")), own == F.col("_last"), own <= F.col("_cut"), F.lit(False))))
    copies = (F.col("_whole") + F.when(drawn, 1).otherwise(0)).cast("int")
    return placed.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).select(*docs.columns, "size", "source_size", "target", "copies", "taken")
