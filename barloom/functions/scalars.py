"""Scalar functions of the market domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Futures month letters, January to December.
MONTHS = "FGHJKMNQUVXZ"
#: What a bar may be used for.
FLAGS = {"PRICE_RISK": 1, "ENTRY_ALLOWED": 2, "EXIT_ALLOWED": 4, "RANGE_UPDATE": 8, "VOLUME_UPDATE": 16, "SESSION_UPDATE": 32, "OI_UPDATE": 64, "BOUNDARY_BAR": 128, "SHORTENED_BAR": 256}
PROFILES = {"regular_trading": 127, "risk_only": 5, "incomplete": 5, "boundary_risk": 133, "shortened_risk": 261}


def safe_divide(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def clip01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def has_flags(flags: Column, required: int) -> Column:
    return flags.bitwiseAND(required) == required


def maturity_rank(code: Column) -> Column:
    """year * 12 + month of a contract code: a month letter and a year of one or two digits at its end, or `-M.YY`."""
    letter = F.regexp_extract(code, f"([{MONTHS}])([0-9]{{1,2}})$", 1)
    digits = F.regexp_extract(code, f"([{MONTHS}])([0-9]{{1,2}})$", 2)
    plain_month, plain_year = F.regexp_extract(code, r"-([0-9]{1,2})\.([0-9]{2})$", 1), F.regexp_extract(code, r"-([0-9]{1,2})\.([0-9]{2})$", 2)
    month = F.when(letter != "", F.position(letter, F.lit(MONTHS))).when(plain_month != "", plain_month.cast("int"))
    two = F.when(digits != "", digits).when(plain_year != "", plain_year)
    n = two.cast("int")
    year = F.when(F.length(two) == 1, 2020 + n).when(n < 70, 2000 + n).otherwise(1900 + n)
    return year * 12 + month


def local_minutes(ts: Column, zone: str) -> Column:
    """Minutes since midnight in a zone, of a UTC timestamp."""
    local = F.from_utc_timestamp(ts, zone)
    return F.hour(local) * 60 + F.minute(local)


def lag_class(seconds: Column, low: int = 60, high: int = 600) -> Column:
    return F.when(seconds <= low, "low").when(seconds <= high, "medium").otherwise("high")
