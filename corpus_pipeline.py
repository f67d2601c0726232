"""From raw documents to token files, in stages that each read what the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the documents it keeps, with their columns, or, the last one, a row per
document in the token files. ``run`` writes every stage as Parquet in the shared
folder and reads it again, so a lost executor costs at most a stage's tasks.
Stages decide row by row, so a NULL or repeated id costs no text its turn; an
empty table passes all stages and gives no rows; columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import stages
from touchline.session import written

STAGES = [
    ("toxicity", stages.toxicity),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("benchmark_decontamination", stages.benchmark_decontamination),
    ("source_mixing", stages.source_mixing),
    ("token_output", stages.token_output),
]

# Trained scores, 64-bit hashes and a tokenizer have no SQL form; tests compare with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
