"""Reading loan tapes and lookup maps; schema-level column operations."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snake_case(name: str) -> str:
    """``'FICO Score'`` -> ``fico_score``; ``ListingCategory..numeric.`` -> ``listing_category_numeric``."""
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"[^0-9A-Za-z]+", "_", s)
    return s.strip("_").lower()


def read_tape(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
              fmt: str = "parquet", options: Mapping[str, str] | None = None,
              normalise_names: bool = False) -> DataFrame:
    """Load a loan tape.

    CSV needs a declared schema, as inferring one reads everything a second
    time; ``options={'inferSchema': 'true'}`` asks for it all the same.  Blank
    strings in CSV are not nulls in Spark by default; pair with
    ``blank_to_null`` when the source writes missing values as ''.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv" and (options or {}).get("inferSchema") != "true":
        raise ValueError("a CSV tape needs a schema")
    df = reader.load(path)
    if normalise_names:
        df = df.toDF(*[snake_case(c) for c in df.columns])
    return df


def read_mapping(spark: SparkSession, path: str, names: Sequence[str] | None = None,
                 fmt: str = "csv", schema: T.StructType | str | None = None) -> DataFrame:
    """Load a lookup table (for example state -> region) and optionally rename it positionally."""
    df = read_tape(spark, path, schema=schema, fmt=fmt)
    return rename_all(df, names) if names else df


def inline_mapping(spark: SparkSession, mapping: Mapping, key_col: str = "key",
                   value_col: str = "value", key_type: str | None = None,
                   value_type: str | None = None) -> DataFrame:
    """Literal code -> name table built from a Python dict (size known on the driver)."""
    kt = key_type or _infer_type(mapping.keys())
    vt = value_type or _infer_type(mapping.values())
    schema = f"`{key_col}` {kt}, `{value_col}` {vt}"
    return spark.createDataFrame([(k, v) for k, v in mapping.items()], schema=schema)


def _infer_type(values: Iterable) -> str:
    vals = [v for v in values if v is not None]
    if vals and all(isinstance(v, bool) for v in vals):
        return "boolean"
    if vals and all(isinstance(v, int) and not isinstance(v, bool) for v in vals):
        return "bigint"
    if vals and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in vals):
        return "double"
    return "string"


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename of every column."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename selected columns."""
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*list(cols))


def blank_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """'' -> NULL on string columns (CSV sources write missing values as blanks)."""
    str_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = [c for c in (cols or str_cols) if c in str_cols]
    return df.withColumns({c: F.when(F.col(c) == "", F.lit(None)).otherwise(F.col(c)) for c in targets})


def inspect_schema(df: DataFrame) -> DataFrame:
    """Column names, Spark types and nullability as a small DataFrame (schema metadata only)."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
