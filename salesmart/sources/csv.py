"""Landed CSV files (one file or a folder of same-schema parts).

No schema inference pass: every column is read as text, the header is
normalised (BOM, tabs and blanks trimmed, words joined by ``_``), ``* Id``
columns are cast to int (bad text gives NULL and is counted by
``rejected_ids``), text values
are cleaned (``functions.text.clean_value``) and the source file name is kept
as lineage.  Spark splits large files and reads the parts in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.text import clean_header, clean_value


def is_id_column(name: str) -> bool:
    return name == "Id" or name.endswith("_Id")


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """All files as text under normalised names.  Every file must have the same
    header, in the same order: a part with another one fails the read."""
    first = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in first.columns])
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("encoding", "UTF-8").csv(path)
    return raw.select(*[F.col(f"`{c}`").alias(clean_header(c)) for c in raw.columns], F.col("_metadata.file_name").alias("source_file"))


def read_landed_csv(
    spark: SparkSession, path: str, with_source: bool = False, id_type: str = "int"
) -> DataFrame:
    """Read CSV with a header; normalise names, cast ids (``int`` as declared,
    ``bigint`` for key ranges beyond it; see ``rejected_ids``), clean text values."""
    raw = _raw(spark, path)
    cols = [
        F.trim(F.col(n)).try_cast(id_type).alias(n) if is_id_column(n) else clean_value(n).alias(n)
        for n in raw.columns
        if n != "source_file"
    ]
    return raw.select(*cols, *(["source_file"] if with_source else []))


def rejected_ids(spark: SparkSession, path: str, id_type: str = "int") -> DataFrame:
    """``(source_file, column_name, n_rejected)``: ids that are present but not of the type, by file and column."""
    raw = _raw(spark, path)
    ids = [n for n in raw.columns if is_id_column(n)]
    bad = [F.count_if(F.col(n).isNotNull() & F.trim(F.col(n)).try_cast(id_type).isNull()).alias(n) for n in ids]
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("n_rejected")) for n in ids])
    return raw.groupBy("source_file").agg(*bad).select("source_file", F.inline(rows))


def combine_folder(spark: SparkSession, folder: str, id_type: str = "int") -> DataFrame:
    """All same-schema CSV parts of a folder as one frame, with the file of each row."""
    return read_landed_csv(spark, folder, with_source=True, id_type=id_type)


def land_csv(df: DataFrame, folder: str, max_rows_per_file: int = 1_000_000) -> None:
    """Write ``df`` as a folder of CSV parts with a header line (overwrite);
    every task writes its own files of at most ``max_rows_per_file`` rows."""
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", max_rows_per_file).csv(folder)
