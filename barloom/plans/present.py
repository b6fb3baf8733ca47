"""One shape for results of Spark and of the SQL they are compared to.

A spec names the columns in order, each with what it is: `:d` a double, rounded to 6 places, `:f` one
rounded to 3, `:i` a long, `:t` a timestamp and `:D` a date as text; without a mark it stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Engines round halves differently: this moves them off the half, away from 0.
OFF_TIES = 1.000000000001


def _columns(spec: str) -> list[tuple[str, str]]:
    return [(c.partition(":")[0], c.partition(":")[2]) for c in spec.split()]


def shown(df: DataFrame, spec: str) -> DataFrame:
    made = {
        "": lambda c: c,
        "d": lambda c: F.round(c.cast("double") * OFF_TIES, 6) + 0.0,
        "f": lambda c: F.round(c.cast("double") * OFF_TIES, 3) + 0.0,
        "i": lambda c: c.cast("long"),
        "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
        "D": lambda c: F.date_format(c, "yyyy-MM-dd"),
    }
    return df.select(*(made[k](F.col(n)).alias(n) for n, k in _columns(spec)))


def shown_sql(body: str, spec: str, cte: str = "") -> str:
    """body is a SELECT; cte goes before it."""
    made = {
        "": "{0}",
        "d": "round(CAST({0} AS DOUBLE) * {off}, 6) + 0.0 AS {0}",
        "f": "round(CAST({0} AS DOUBLE) * {off}, 3) + 0.0 AS {0}",
        "i": "CAST({0} AS BIGINT) AS {0}",
        "t": "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}",
        "D": "strftime({0}, '%Y-%m-%d') AS {0}",
    }
    return f"{cte} SELECT {', '.join(made[k].format(n, off=repr(OFF_TIES)) for n, k in _columns(spec))} FROM ({body}) shown"
