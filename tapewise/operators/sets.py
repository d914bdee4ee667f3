"""Size-checked value sets: a chosen set of values as a filter, without an exchange of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Chosen values sent along with the tasks; beyond that they are joined, the table salted against hot values.
MOST_VALUES = 10_000
SALTS = 64


def bounded_rows(chosen: DataFrame, most: int = MOST_VALUES) -> list | None:
    """The rows, or None if there are more than ``most``."""
    rows = chosen.limit(most + 1).collect()
    return None if len(rows) > most else rows


def among(col: Column, values: Sequence) -> Column:
    """Whether ``col`` is one of ``values`` (false for NULL)."""
    known = [v for v in values if v is not None]
    return F.coalesce(col.isin(known), F.lit(False)) if known else F.lit(False)


def salted_flag(df: DataFrame, col: str, chosen: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``, whether ``col`` is in the one-column table ``chosen`` of any size; a hot value is dealt to SALTS tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    right = chosen.select(F.col(chosen.columns[0]).alias("__v")).filter("__v is not null").distinct().select("__v", salts, F.lit(True).alias(out))
    left = df.withColumn("__salt", F.floor(F.rand(1) * SALTS).cast("int")).withColumn("__own", F.col(col).cast(chosen.schema[0].dataType))
    joined = left.join(right.withColumnRenamed("__salt", "__side"), (F.col("__own") == F.col("__v")) & (F.col("__salt") == F.col("__side")), "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(False))).drop("__v", "__side", "__salt", "__own")
