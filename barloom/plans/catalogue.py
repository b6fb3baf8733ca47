"""All registered queries of the market operators, with the SQL each is compared to."""

from __future__ import annotations

from barloom.plans import aggregates, evaluation, indicators, incremental, joining, research, states, tables, wide, windowed  # noqa: F401
from barloom.plans.registry import QUERIES, SQL  # noqa: F401
