"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import shared_dir


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did.

    On a cluster the package is shipped as usual (``--py-files`` or an
    installed wheel); a folder that is absent there changes nothing.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to a folder of its own in the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the table instead of repeating
    the work, and every later pass over it costs a scan only.
    """
    path = f"{shared_dir(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lane(id_col: Column, lanes: int) -> Column:
    """A stable lane in [0, lanes) for a row: rows of one hot key fall into many lanes."""
    return F.pmod(F.xxhash64(id_col), F.lit(lanes)).cast("int")


def utf8(text: Column) -> Column:
    """The text as bytes, null as empty."""
    return F.coalesce(text.cast("binary"), F.lit(b"").cast("binary"))


def values(array: pa.Array) -> list:
    """Python values of an Arrow array."""
    return array.to_pylist()


class Cache(dict):
    """Bounded memo of ``make(key)`` with two generations.

    When the young generation is full it becomes the old one, so frequent keys
    survive and memory stays below two generations of ``limit`` entries.  Keys
    longer than ``longest`` are computed each time and never stored.
    """

    def __init__(self, make, limit: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def looked_up(rows: DataFrame, table_: DataFrame, key: list[str], salt: Column, lanes: int) -> DataFrame:
    """Inner join of ``rows`` with ``table_`` on ``key``, also where one key holds a large share of the rows.

    A key is looked up once per lane (a part of the rows, by ``salt``), so that its rows meet in many tasks.  ``rows``
    is read twice: land what is dear to compute.
    """
    salted = rows.withColumn("_lane", lane(salt, lanes))
    near = salted.select(*key, "_lane").distinct().join(table_, key)
    return salted.join(near, [*key, "_lane"]).drop("_lane")
