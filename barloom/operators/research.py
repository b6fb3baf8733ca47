"""Parameter grids, continuous series, signals, sizing, scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parameter_grid(spark: SparkSession, values: dict[str, list], constraints: list[str]) -> DataFrame:
    """All combinations of a few listed values that satisfy the constraints."""
    grid = None
    for name, choices in values.items():
        own = spark.createDataFrame([(v,) for v in choices], f"{name} {'string' if isinstance(choices[0], str) else 'double' if isinstance(choices[0], float) else 'int'}")
        grid = own if grid is None else grid.crossJoin(F.broadcast(own))  # literal lists
    for c in constraints:
        grid = grid.where(c)
    return grid
