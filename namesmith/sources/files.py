"""File sources and sinks: CSV (plain or gzip), JSON, Parquet; optional inputs; a driver-side export with byte-order mark."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..storage import shared_folder

NAMES = "idx long, nombre_original string"


def write_csv(df: DataFrame, path: str, gzip: bool = True) -> None:
    """Header, quotes doubled inside quotes; empty texts stay apart from nulls."""
    df.write.csv(path, header=True, compression="gzip" if gzip else "none", escape='"', emptyValue="", nullValue="", quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Lazy rows under a fixed schema; the header must agree with it."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, escape='"', multiLine=True, mode="FAILFAST")


def read_names(spark: SparkSession, path: str, header: str = "nombre_original") -> DataFrame:
    """One text column from CSV or Parquet; a null cell becomes an empty text; the header is checked."""
    df = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.csv(path, header=True, escape='"')
    if header not in df.columns:
        raise ValueError(f"column {header} expected, found {df.columns}")
    key = F.col("idx").cast("long") if "idx" in df.columns else F.monotonically_increasing_id()
    return df.select(key.alias("idx"), F.coalesce(F.col(header).cast("string"), F.lit("")).alias("nombre_original"))


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, or no rows of its schema if there is no such path."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def export_csv(df: DataFrame, path: str, limit: int) -> int:
    """A single file with byte-order mark for spreadsheets, for small reports: at most ``limit`` rows, else an error."""
    rows = df.limit(limit + 1).toPandas()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; write_csv is for tables")
    rows.to_csv(path, index=False, encoding="utf-8-sig")
    return len(rows)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, a file a task; nulls are written, so that every row has all keys."""
    df.write.option("ignoreNullFields", "false").json(path)


def read_json_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines by a given schema; a line that isn't JSON fails."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def export_json(df: DataFrame, path: str) -> None:
    """One-row reports as a JSON document, keys sorted."""
    row = df.first()
    with open(path, "w", encoding="utf-8") as file:
        json.dump(row.asDict(recursive=True) if row else {}, file, indent=2, sort_keys=True, ensure_ascii=False)


def read_json(path: str, default=None):
    """A JSON document, or the default if there is no such file."""
    if not os.path.exists(path):
        return default
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def csv_round_trip(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/namesmith/csv-{uuid.uuid4().hex}"
    write_csv(df, path)
    return read_csv(spark, path, NAMES).select("idx", F.coalesce("nombre_original", F.lit("")).alias("nombre_original"))
