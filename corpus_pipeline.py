"""Corpus pipeline: five stages over documents, each one of the operators in tidemark.llm.

Every stage is written as Parquet and read again before the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import without_contaminated
from tidemark.llm.language import UNKNOWN, identify, learn
from tidemark.llm.ngram_join import similar_groups
from tidemark.llm.tables import table
from tidemark.llm.token_codec import read_ids, write_ids
from tidemark.llm.token_mix import mix_sources, word_count
from tidemark.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_CERTAINTY = 0.5  # of the languages of a document's spans
BATCH_ROWS = "1000"  # of an Arrow batch; texts are long, and a task holds a few batches at once


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: without letters, or with no span whose language is more likely than another.

    A text in several languages stays, however its letters are shared among them.
    """
    bounded_batches(spark)
    found = identify(docs, learn(docs), COLUMNS)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("certainty") >= LEAST_CERTAINTY)).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of alike ones: the one with the smallest doc_id.

    Rows that repeat count as one. Rows without an id stay, unless they repeat or a document with an id is like them.
    """
    bounded_batches(spark)
    docs = docs.select(*COLUMNS)
    groups = similar_groups(docs)
    own = F.col("component_id").eqNullSafe(F.col("doc_id"))
    kept = groups.groupBy("doc_id").agg(F.max(own).alias("own"), F.count(F.lit(1)).alias("copies")).filter("own")
    kept = kept.select(F.col("doc_id").alias("kept_id"), "copies")
    rows = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")))
    several = rows.filter("copies > 1").select(*COLUMNS).dropDuplicates(["doc_id", "text"])
    return rows.filter("copies = 1").select(*COLUMNS).union(several)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    bounded_batches(spark)
    return without_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that the sources reach their target weights in words."""
    docs = docs.select(*COLUMNS)
    mixed = mix_sources(docs).groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies"))
    mixed = mixed.filter("copies > 0").select(
        F.col("doc_id").alias("mixed_id"), F.col("source").alias("mixed_source"), F.col("size").alias("mixed_size"), "copies"
    )
    same = F.col("doc_id").eqNullSafe(F.col("mixed_id")) & F.col("source").eqNullSafe(F.col("mixed_source"))
    same = same & (word_count(F.col("text")) == F.col("mixed_size"))
    taken = docs.join(mixed, same)
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the documents' token ids in binary blocks and reads them back."""
    bounded_batches(spark)
    import public_tokenizers

    return read_ids(write_ids(docs, public_tokenizers.path("word_bpe_49k.json")), with_ids=False)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]
# Language learning, balancing and coding have no SQL form; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
