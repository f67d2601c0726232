"""Season folders, history files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import written
from touchline.sources.schemas import RAW_FILES, schema_of


def read_season_files(spark: SparkSession, root: str, file_name: str, schema: T.StructType | str) -> DataFrame:
    """All files of one name below ``root``, by position: header names are skipped, types are ours."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_name)
        .csv(root)
    )


def read_csv_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """CSV written by Spark at ``path``, which may hold wildcards; columns by position."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def load_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A raw table from every season's folder."""
    return read_season_files(spark, root, RAW_FILES[table], schema_of(table))


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns and types of ``schema``, in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def replace_table(df: DataFrame, name: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()) -> None:
    """Create or replace a table of fixed types; ``df`` may read the table itself.

    The new rows are written beside the table first and only then put in its
    place, so a step that fails on the way leaves the table as it was.
    """
    spark = df.sparkSession
    out = df if schema is None else typed(df, schema)
    if spark.catalog.tableExists(name):
        out = written(out, "replacement")
    out.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)
    spark.catalog.refreshTable(name)


def publish(df: DataFrame, name: str, table: bool) -> DataFrame:
    """Keep a result under a name, written as a table or as a view."""
    if table:
        replace_table(df, name)
    else:
        df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def path_number(pattern: str) -> Column:
    """The number that ``pattern``'s first group finds in the row's file path."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast("int")


def read_histories(
    spark: SparkSession, path: str, schema: T.StructType | str, id_col: str = "element", pattern: str = r"_(\d+)/"
) -> DataFrame:
    """Per-entity history files with the entity's id taken from its folder's name."""
    df = read_csv_table(spark, path, schema)
    return df.select(path_number(pattern).alias(id_col), *df.columns)


def read_periods(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    start: int,
    end: int,
    period: str = "GW",
    pattern: str = r"gw_(\d+)",
) -> tuple[DataFrame, DataFrame]:
    """Period files as one table with their period, and the periods without a file.

    Reads on past missing periods; the caller decides what a gap means.
    """
    df = read_csv_table(spark, path, schema)
    merged = df.withColumn(period, path_number(pattern)).where(F.col(period).between(start, end))
    wanted = spark.range(start, end + 1).select(F.col("id").cast("int").alias(period))
    return merged, wanted.join(merged.select(period).distinct(), period, "left_anti")


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, partition_by: Sequence[str] = ()) -> None:
    """CSV with a header of the wanted columns, all of them in name order by default."""
    columns = sorted(c for c in df.columns if c not in partition_by) if columns is None else list(columns)
    out = df.select(*columns, *partition_by)
    out.write.mode("overwrite").partitionBy(*partition_by).option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_id_map(final: DataFrame, missing: DataFrame, path: str) -> None:
    """Matched people as CSV, names without a match as JSON."""
    write_csv(final, f"{path}/player_compiled_ids.csv", final.columns)
    write_json(missing, f"{path}/missing_fbref_ids.json")
