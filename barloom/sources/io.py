"""Readers and writers: scans with filters, JSON lines, literal rows, replacing writers, text sinks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Comparison operators of filter lists.
_OPS = {
    "=": lambda c, v: c == v,
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)),
    "not in": lambda c, v: ~c.isin(list(v)),
}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one that spark.checkpoint.dir names; a temporary one where it is unset and all runs here."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="barloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def dnf(filters: list) -> Column:
    """[(column, op, value), ...] all of which hold, or a list of such lists, any of which holds."""
    groups = [filters] if filters and isinstance(filters[0], tuple) else filters
    return reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (_OPS[op](F.col(c), v) for c, op, v in g)) for g in groups))


def read_table(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    filters: list | None = None,
    limit: int | None = None,
    require_bound: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """A table with pruned columns and pushed filters. require_bound: a filter or a limit must be given."""
    if require_bound and not filters and limit is None:
        raise ValueError(f"{path} may only be read with a filter or a limit")
    df = spark.read.format(fmt).load(path)
    if filters:
        df = df.where(dnf(filters))
    if columns:
        df = df.select(*columns)
    return df.limit(limit) if limit is not None else df


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return spark.read.schema(schema).json(path) if schema is not None else spark.read.json(path)


def from_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def from_values(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """Literal rows as a VALUES relation."""

    def literal(v: Any) -> str:
        return "NULL" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS v({', '.join(names)})")


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None, files: int | None = None) -> None:
    out = df.coalesce(files) if files else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """New columns are allowed: read with read_merged."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def _files(spark: SparkSession, path: str) -> tuple[Any, Callable[[str], Any]]:
    """The file system of path, and how its paths are made."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def promote(spark: SparkSession, staged: str, path: str, backup: str) -> None:
    """The table at path moves to backup, which mustn't exist, and the staged one takes its place; if that fails it is put back.

    Between the two renames there is no table at path for a moment. Raises OSError.
    """
    fs, at = _files(spark, path)
    if fs.exists(at(backup)) or not fs.exists(at(staged)):
        raise OSError(f"{backup} must not exist, and {staged} must")
    had = fs.exists(at(path))
    if had and not fs.rename(at(path), at(backup)):
        raise OSError(f"{path} could not be moved aside; it is as it was")
    if not fs.rename(at(staged), at(path)):
        back = not had or fs.rename(at(backup), at(path))
        raise OSError(f"{path} could not be replaced; " + ("it is as it was" if back else f"its former content is in {backup}"))


def replace_whole(df: DataFrame, path: str) -> None:
    """Write beside path, then promote: the old table is only deleted once the new one is in its place. df may read path."""
    spark = df.sparkSession
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(new)
    promote(spark, new, path, old)
    fs, at = _files(spark, path)
    fs.delete(at(old), True)


def migrate_layout(spark: SparkSession, path: str, keys: list[str], latest: list[str], partition: dict[str, Column], staged: str, backup: str) -> dict[str, int]:
    """Lay the table at path out anew: one row per key (the last by latest), partitioned by new columns; staged, validated, promoted.

    Validation reads the staged table: as many rows as the source has keys, no key twice, every key there. If it fails nothing
    is promoted and ValueError is raised. Returns source_rows, rows and dropped.
    """
    source = spark.read.parquet(path)
    row = F.max_by(F.struct(*(c for c in source.columns if c not in keys)), F.struct(*latest))
    one = source.groupBy(*keys).agg(row.alias("_r")).select(*keys, "_r.*")
    one.withColumns(partition).repartition(*partition).write.partitionBy(*partition).parquet(staged)
    written = spark.read.parquet(staged)
    n, m = source.count(), written.count()
    wanted = source.select(*keys).distinct()
    lost = wanted.join(written.select(*(F.col(k).alias(f"_{k}") for k in keys)), reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys)), "left_anti").count()
    if lost or wanted.count() != m:
        raise ValueError(f"{staged} has {m} rows and lacks {lost} keys of {path}")
    promote(spark, staged, path, backup)
    return {"source_rows": n, "rows": m, "dropped": n - m}


def content_fingerprint(df: DataFrame) -> DataFrame:
    """n_rows and an order-free sum of row hashes: equal tables have equal fingerprints."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).cast("string").alias("hash_sum"))


def exposition_lines(df: DataFrame, metric: str, value: str, labels: list[str]) -> DataFrame:
    """Prometheus text lines."""
    pairs = F.concat_ws(",", *(F.format_string(f'{k}="%s"', F.col(k)) for k in labels))
    return df.select(F.concat(F.lit(metric + "{"), pairs, F.lit("} "), F.col(value).cast("string")).alias("line"))


def json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("line"))


def page(df: DataFrame, order_by: str, descending: bool = True, limit: int = 100, filters: list | None = None) -> DataFrame:
    """The first rows by a column: limit is 1 to 500, nulls come last."""
    own = df.where(dnf(filters)) if filters else df
    key = F.col(order_by).desc_nulls_last() if descending else F.col(order_by).asc_nulls_last()
    return own.orderBy(key).limit(min(max(limit, 1), 500))


def options(layers: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """layer, column_name, value: the distinct values of the columns that each layer's page can be filtered by, as text."""
    parts = [df.select(F.lit(name).alias("layer"), F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns[name]))).alias("o")) for name, df in layers.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).select("layer", "o.*").where("value IS NOT NULL").distinct()
