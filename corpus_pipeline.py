"""The corpus pipeline: five stages over documents, each written as Parquet and read again for the next.

Language ID drops documents without a language, toxicity drops toxic ones, the n-gram join keeps one document of each group
of near duplicates, the secret scan redacts secrets, packing gives the token sequences of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.llm import inputs, jaccardjoin, langid, packing, secretscan, toxicity
from fleetmart.llm.staging import staged

#: A document goes if the flat background explains more than this share of its trigrams.
MOST_UNEXPLAINED = 0.9
#: Ids and text hashes of near duplicates up to which they are broadcast (16 bytes each).
BROADCAST_IDS = 1_000_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with text in a language: those without a letter go, and those that no learned language explains."""
    inputs.importable(spark)
    return langid.keep_identified(docs, langid.learn(docs), MOST_UNEXPLAINED)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't toxic; the chain learns from the labels table."""
    inputs.importable(spark)
    labels = toxicity.with_categories(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, toxicity.learn(docs, labels, toxicity.CATEGORIES))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates: the one with the smallest doc_id, or with none if no row of the class has
    one; of several texts with that doc_id the one with the smallest hash, of rows equal in both any one.

    Texts without words are in no class and all stay. Only ids and text hashes of rows that go are sent to the texts, by
    broadcast up to a bound; texts move only beyond it, or where both are repeated.
    """
    inputs.importable(spark)
    found = staged(jaccardjoin.classed(docs).where(F.col("root").isNotNull()).groupBy("doc_id", "node").agg(
        F.min("root").alias("root"), F.min("class_id").alias("class_id"), F.count(F.lit(1)).alias("rows")))
    named = F.col("doc_id").eqNullSafe(F.col("class_id"))
    first = staged(found.where(named).groupBy("root").agg(F.min("node").alias("node")))
    gone = (found.where(~named).select("doc_id", "node")
            .unionByName(found.where(named).join(first, ["root", "node"], "left_anti").select("doc_id", "node")))
    kept = _matched(docs, gone, "left_anti")
    repeated = found.where(named & (F.col("rows") > 1)).join(first, ["root", "node"], "left_semi").select("doc_id", "node")
    if not repeated.limit(1).count():
        return kept
    once = _matched(kept, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return _matched(kept, repeated, "left_anti").unionByName(once)


def _matched(docs: DataFrame, named: DataFrame, how: str) -> DataFrame:
    """Rows of docs joined with (doc_id, hash of text) in named."""
    if named.count() <= BROADCAST_IDS:
        named = F.broadcast(named)
    named = named.select(F.col("doc_id").alias("_named_id"), F.col("node").alias("_named_text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_named_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_named_text"))
    return docs.join(named, same, how)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark and n_chars counted anew where that changes a text."""
    inputs.importable(spark)
    redacted = secretscan.redact(docs, secretscan.learn(docs))
    if "n_chars" not in docs.columns:
        return redacted
    changed = F.col("text").contains(secretscan.REDACTED)
    kind = docs.schema["n_chars"].dataType
    return redacted.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    inputs.importable(spark)
    return packing.pack_sequences(docs, inputs.BYTE_BPE)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic_documents),
    ("jaccard_join", near_duplicates),
    ("secret_scan", secrets),
    ("packing", packed),
]
#: The stages learn models and follow links, which SQL doesn't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, from the documents table."""
    docs = inputs.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
