"""What the text operators share: shared tables, Arrow maps, deterministic hash splits."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import ship_package

_own_dirs: dict[str, str] = {}
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where it is unset and everything runs on this machine (tests) a temporary folder is taken.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="barloom-")
        where = _own_dirs[app]
    return where


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/barloom-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables made by stored, which nothing reads any more."""
    for df in tables:
        path = _paths.pop(df, None)
        if path is not None:
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def id_bucket(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus: the split into training and held-out rows."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(modulus))


def narrow(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the operator's own names: other columns can't clash."""
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in cols.items()))


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """fn over each Arrow batch. Row order and partitioning of the input don't matter to the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column with null read as empty, as plain 32-bit UTF-8."""
    col = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(col if col.type == pa.string() else col.cast(pa.string()), "")
