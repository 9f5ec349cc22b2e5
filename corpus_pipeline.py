"""Corpus pipeline: five stages over documents, each written as Parquet and read by the next.

1. quality classifier: documents that it rejects go;
2. n-gram Jaccard join: the smallest document of each group of near copies stays;
3. substring dedup: repeated passages go from texts, and texts left without a word;
4. benchmark decontamination: documents that contain an item go;
5. mixing: documents are repeated or left out so that sources meet their targets.

All but the last stage return the columns of documents; the last adds ``copy``, from 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import decontaminate, mixing, ngram_jaccard, quality_qda, substring_dedup
from tidemark.llm.store import save


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not reject, unchanged; all of them if the labels can't teach it.

    Null and empty texts are judged by their statistics, repeated rows alike.
    """
    return quality_qda.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group, unchanged; rows without an id stay all.

    Of rows that repeat a doc_id the one whose hash is smallest stays, so reruns keep the same.
    Null and empty texts are like nothing else and stay.
    """
    groups = ngram_jaccard.similar_groups(docs)
    stay = groups.where("doc_id = component_id").select("doc_id").distinct()
    place = Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns))
    kept = docs.where("doc_id is not null").join(stay, "doc_id", "left_semi").withColumn("_place", F.row_number().over(place)).where("_place = 1")
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a smaller document has; documents of nothing else go.

    A text that loses nothing stays as it is, so do null and empty ones and those without an id;
    ``n_chars``, if there, follows the text.
    """
    cut = substring_dedup.remove_repeats(docs, with_text=True)
    cut = cut.where("n_removed = 0 or n_removed < n_words").withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item is found, unchanged; all of them if the benchmark is empty."""
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered by ``copy``; documents without words follow their source."""
    mixed = mixing.mix_sources(docs).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns, "copy")


STAGES = [("quality", quality), ("near_copies", near_copies), ("substrings", substrings), ("benchmark", benchmark), ("mix", mix)]
#: No stage but the mix can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
