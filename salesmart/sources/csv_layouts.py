"""A folder of CSV parts whose headers differ: other columns, another order, columns that only some parts have.

1. *Inventory*: one job reads the first line of every file.  Files with the same
   header are a layout; a folder has few of them.
2. *Union*: each layout is read with its own header and the layouts are united
   by normalised name; a column that a part lacks is NULL there.
3. *Types*: one aggregate over the united text counts, per column, the values
   that each type of a promotion lattice can hold; the narrowest type that
   holds all of them is the column's.

No row is lost: parts are read as text, and a column takes a type only where
every value fits.  ``explain_types`` shows the counts behind each choice.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.text import clean_header

# The promotion lattice as two chains below text, narrowest first: a column is of the first type that holds all its
# values.  Numbers with leading zeros are text (codes keep their digits).
LATTICE = ("boolean", "int", "bigint", "decimal(38,10)", "double", "date", "timestamp_ntz")
_NUMBERS = frozenset(("int", "bigint", "decimal(38,10)", "double"))
MOST_LAYOUTS = 1000
FILE = "source_file"


@dataclass(frozen=True)
class Layout:
    """Files that share a header, and the normalised names of its columns in order."""

    names: tuple[str, ...]
    files: tuple[str, ...]


def header_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, header)``: the first line of every CSV file of a folder that has one."""
    lines = spark.read.text(folder, pathGlobFilter="*.csv").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")
    )
    # Only the split that begins a file has its first line; a task gives one row per file.
    return lines.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))


def split_header(header: str, sep: str = ",") -> tuple[str, ...]:
    """Normalised column names of a header line; quoted names may hold the separator."""
    names = tuple(clean_header(n) for n in next(csv.reader([header.replace("﻿", "").rstrip("\r")], delimiter=sep), []))
    lowered = [n.lower() for n in names]
    if len(set(lowered)) != len(lowered) or "" in names:
        raise ValueError(f"a header has an empty or a repeated name: {header!r}")
    if FILE in lowered:
        raise ValueError(f"a header has the reserved name {FILE!r}")
    return names


def layouts(spark: SparkSession, folder: str, sep: str = ",") -> list[Layout]:
    """The layouts of a folder (a row per file on the driver, as the file listing itself), in order of their first file."""
    files: dict[tuple[str, ...], list[str]] = {}
    for row in header_inventory(spark, folder).orderBy("file").collect():
        files.setdefault(split_header(row["header"], sep), []).append(row["file"])
    if len(files) > MOST_LAYOUTS:
        raise ValueError(f"{len(files)} different headers: the parts of {folder} hardly belong together")
    return [Layout(names, tuple(found)) for names, found in files.items()]


def read_layout(spark: SparkSession, layout: Layout, sep: str = ",") -> DataFrame:
    """The rows of a layout's files as text, with the file of each."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in layout.names])
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("enforceSchema", True).option("encoding", "UTF-8")
    return reader.csv(list(layout.files)).select("*", F.col("_metadata.file_name").alias(FILE))


def combine_as_text(spark: SparkSession, folder: str, sep: str = ",") -> DataFrame:
    """All parts united by name (case ignored; the first part's spelling stays), every column as trimmed text; '' is
    NULL.  Columns are in the order in which the parts, by name, introduce them."""
    spelled: dict[str, str] = {}
    parts = []
    for layout in layouts(spark, folder, sep):
        own = [spelled.setdefault(n.lower(), n) for n in layout.names]
        rows = read_layout(spark, layout, sep)
        parts.append(rows.select(*[F.nullif(F.trim(F.col(f"`{n}`")), F.lit("")).alias(o) for n, o in zip(layout.names, own)], FILE))
    if not parts:
        raise ValueError(f"no CSV part with a header in {folder}")
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.select(*[f"`{n}`" for n in spelled.values()], FILE)


def _fits(value: Column, data_type: str) -> Column:
    if data_type == "boolean":
        return F.lower(value).isin("true", "false")
    fits = value.try_cast(data_type).isNotNull()
    if data_type in _NUMBERS:
        fits = fits & ~value.rlike(r"^[+-]?0[0-9]") & value.rlike(r"^[+-]?[0-9.]")
        if data_type == "decimal(38,10)":
            # Exactly: neither digits nor an exponent beyond the scale.
            fits = fits & value.rlike(r"^[+-]?[0-9]{0,28}([.][0-9]{0,10})?$")
        elif data_type != "double":
            fits = fits & value.rlike(r"^[+-]?[0-9]+$")
    elif data_type == "date":
        fits = fits & value.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
    else:
        fits = fits & value.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}")
    return fits


def explain_types(text: DataFrame) -> DataFrame:
    """``(column_name, n_values, fits, data_type)`` of a frame of text columns: how many values there are, how many of
    them each type of the lattice holds (a map), and the type chosen.  A column without values stays text."""
    columns = [c for c in text.columns if c != FILE]
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.col(f"`{c}`")).alias("n_values"),
            F.create_map(*[x for t in LATTICE for x in (F.lit(t), F.count_if(_fits(F.col(f"`{c}`"), t)))]).alias("fits"),
        )
        for c in columns
    ]
    rows = text.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    chosen = F.lit("string")
    for t in reversed(LATTICE):
        chosen = F.when((F.col("n_values") > 0) & (F.col("fits")[t] == F.col("n_values")), F.lit(t)).otherwise(chosen)
    return rows.withColumn("data_type", chosen)


def combine_layouts(spark: SparkSession, folder: str, sep: str = ",") -> DataFrame:
    """All CSV parts of a folder as one typed frame, whatever columns each has, with the file of each row.

    Two passes over the files and one over their first splits; see
    ``explain_types`` for how the types are chosen.  A folder without any header
    is an error, as are repeated or empty names; parts with a header and no rows
    only add columns.
    """
    text = combine_as_text(spark, folder, sep)
    types = {r["column_name"]: r["data_type"] for r in explain_types(text).collect()}
    return text.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c != FILE else F.col(c) for c in text.columns])
