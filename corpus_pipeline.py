"""From raw documents to a weighted training mix: five stages, each over all that the one before kept."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sellthrough.llm.decontaminate import clean_documents
from sellthrough.llm.langid import UNKNOWN, identify, train
from sellthrough.llm.line_dedup import drop_recurring_lines
from sellthrough.llm.mixing import mix
from sellthrough.llm.near_dedup import near_duplicates
from sellthrough.llm.queries import quality_weights
from sellthrough.session import work_folder

# The share of the likelihood that a language must reach; below it a text is no language that the model knows.
LEAST_SCORE = 0.5


def _given(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """The documents with their own columns of these names under other ones while an operator adds its own, and the way back."""
    other = {c: f"{c}_given" for c in names if c in docs.columns}
    while set(other.values()) & set(docs.columns):
        other = {c: f"{new}_" for c, new in other.items()}
    return docs.withColumnsRenamed(other), {new: c for c, new in other.items()}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without letters, null texts and undecided ones go."""
    rows, back = _given(docs, "lang_pred", "score")
    found = identify(rows, train(docs))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*rows.columns).withColumnsRenamed(back)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that recur across documents; n_chars follows the text."""
    rows, back = _given(docs, "n_lines", "n_dropped")
    found = drop_recurring_lines(rows)
    changed = F.col("n_dropped") > 0
    return found.select(*[F.when(changed, F.length("text")).otherwise(F.col(c)).cast(rows.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
                          for c in rows.columns]).withColumnsRenamed(back)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id; a repeated row stays once."""
    gone = near_duplicates(docs).filter(F.col("doc_id").isNotNull() & ~F.col("kept")).select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti")
    left = left.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct(*docs.columns).alias("row"))
    return left.dropDuplicates(["doc_id", "text_hash"]).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage of weight."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the number of their copies and the words that these take."""
    docs = docs.drop("copies", "taken")
    found = mix(docs, quality=quality_weights(spark, sf_dir)).filter("copies > 0")
    found = found.select("doc_id", "text_hash", "copies", "taken").dropDuplicates(["doc_id", "text_hash"]).alias("m")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("k"), F.xxhash64("text").alias("t")).alias("d")
    rows = rows.join(found, F.col("d.k").eqNullSafe(F.col("m.doc_id")) & (F.col("d.t") == F.col("m.text_hash")))
    return rows.select("row.*", "m.copies", "m.taken")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("mixing", mixing)]

# Language identification and signatures can't be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
