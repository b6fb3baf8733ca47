"""Contracts of tables: types by word, casts, and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampType

TYPES = {
    "string": StringType(), "json": StringType(), "timestamp": TimestampType(), "date": DateType(), "bool": BooleanType(), "boolean": BooleanType(),
    "double": DoubleType(), "float": DoubleType(), "int": IntegerType(), "integer": IntegerType(), "bigint": LongType(), "long": LongType(),
    "array<int>": ArrayType(IntegerType()), "array<bigint>": ArrayType(LongType()), "array<double>": ArrayType(DoubleType()), "array<string>": ArrayType(StringType()),
}


def schema(contract: dict[str, str]) -> StructType:
    """Unknown words are strings."""
    return StructType([StructField(k, TYPES.get(v, StringType())) for k, v in contract.items()])


def cast_to_contract(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Exactly the contract's columns: missing ones null, structs, maps and arrays in json columns written as JSON."""
    out = []
    for name, word in contract.items():
        kind = TYPES.get(word, StringType())
        if name not in df.columns:
            out.append(F.lit(None).cast(kind).alias(name))
        elif word == "json" and isinstance(df.schema[name].dataType, StructType | MapType | ArrayType):
            out.append(F.to_json(name).alias(name))
        else:
            out.append(F.col(name).cast(kind).alias(name))
    return df.select(*out)


def drift(df: DataFrame, contract: dict[str, str]) -> tuple[list[str], list[str]]:
    """Missing and extra columns."""
    return sorted(set(contract) - set(df.columns)), sorted(set(df.columns) - set(contract))


def assert_contract(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    missing, extra = drift(df, contract)
    if missing or extra:
        raise ValueError(f"missing {missing}, extra {extra}")
    return df


def first_of(df: DataFrame, names: list[str], kind: str = "string") -> Column:
    """The first of the names that df has, else a typed null."""
    return next((F.col(n) for n in names if n in df.columns), F.lit(None).cast(kind))


def column_or_json(df: DataFrame, name: str, json_col: str, paths: list[str]) -> Column:
    """The column if df has it, else (or where it is null) the first JSON path with a value."""
    own = [F.col(name).cast("string")] if name in df.columns else []
    return F.coalesce(*own, *(F.get_json_object(json_col, p) for p in paths))
