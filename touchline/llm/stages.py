"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and works on all rows of ``docs``.

All but the last return rows of ``docs`` with its columns, whatever their names:
columns a stage needs for itself get names that ``docs`` does not have.

Defined cases: a NULL text is an empty one; rows that repeat an id, or have none,
are rows of their own, told apart by their texts; of equal rows one stays after
``simhash_near_dedup``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.decontamination import find_items
from touchline.llm.mixing import mix_documents
from touchline.llm.simhash import near_duplicates
from touchline.llm.token_records import default_tokenizer, token_records
from touchline.llm.toxicity import score_toxicity, train_toxicity
from touchline.session import written

TOXIC_FROM = 0.5


def free_name(df: DataFrame, base: str) -> str:
    """``base`` with as many underscores before it as ``df`` asks for; names count without case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a model learned from the labels of these documents."""
    score = free_name(docs, "_toxicity")
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model, score_col=score).where(F.col(score) < TOXIC_FROM).drop(score)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the row with the smallest id, and of its rows the text that hashes least.

    Groups are those of op1: shingles of four words, at most four of 64 bits apart.
    """
    key = free_name(docs, "_row")
    keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.col(key).alias("row"))
    groups = near_duplicates(keyed, id_col=key).select(F.col("doc_id").alias(key), "component_id")
    placed = keyed.select(key, order.alias("_order")).join(groups, key)
    first = placed.groupBy("component_id").agg(F.min("_order").alias("_order")).select(F.col("_order.row").alias(key))
    # Texts are dealt by key whatever the number of groups, so that the plan, and its disk, grow with the input alone.
    return keyed.join(written(first, "first").hint("merge"), key, "left_semi").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; rows are told apart by id and text, so that a NULL id is searched too."""
    key = free_name(docs, "_row")
    row = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.xxhash64("text"))
    keyed = docs.withColumn(key, row)
    found = find_items(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key)
    held = written(found.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return keyed.join(held, key, "left_anti").select(docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the target shares of sources, languages and topics."""
    # Names that mixing adds are kept apart from those of the documents.
    names = [c if c in ("doc_id", "text", "source", "lang") else f"doc_{i}" for i, c in enumerate(docs.columns)]
    return mix_documents(docs.toDF(*names)).where("kept").select(*names).toDF(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, and where each lies in them."""
    return token_records(docs, default_tokenizer())
