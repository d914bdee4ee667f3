"""Tape cleaning: labels, missing values, flags, transforms, bins, recodes.

Each function returns a new DataFrame and adds at most one narrow
projection, except where a statistic of the whole column is needed
(``fill_mean``, ``drop_sparse_columns``, ``equal_width_bins``,
``lump_rare``, ``label_encode``).  Those compute the statistic as a one-row
(or one-row-per-category) aggregate and join it back, so the plan stays one
lazy DataFrame.  Only per-column metadata reaches the driver: the
missing-value report of ``drop_sparse_columns`` (one row per column) and
the level list of ``label_encode``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewise.functions.exprs import (
    as_column,
    cut_expr,
    default_label_expr,
    flag_expr,
    floor_zero_expr,
    format_percent_expr,
    safe_log_expr,
)
from tapewise.operators.sets import among, bounded_rows, salted_flag
from tapewise.session import stored


def default_label(df: DataFrame, status: str = "status", good: Iterable[str] = ("Current", "Matured"),
                  out: str = "default_flag") -> DataFrame:
    """0 if the status is in ``good`` else 1 (NULL status -> 1)."""
    return df.withColumn(out, default_label_expr(status, good))


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def filter_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Inclusive range mask; Catalyst pushes it into the Parquet scan when the column maps to a source column."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(col) <= F.lit(hi))
    return df.filter(cond)


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def filter_not_blank(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose value is ''; NULL rows are kept (``which`` ignores NA)."""
    c = F.col(col)
    return df.filter(c.isNull() | (c != F.lit("")))


def isin_filter(df: DataFrame, col: str, values) -> DataFrame:
    """Set membership: a literal list, or a DataFrame of few values, becomes ``IN``; a larger one a salted join."""
    if isinstance(values, DataFrame):
        other = values.select(values.columns[0]).distinct()
        rows = bounded_rows(other)
        if rows is None:
            return salted_flag(df, col, other, "__in").filter("__in").drop("__in")
        return df.filter(among(F.col(col), [r[0] for r in rows]))
    return df.filter(F.col(col).isin(list(values)))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Listwise deletion."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """NULL -> constant.  A string constant on a numeric column casts it to string first ('999' style)."""
    out = df
    for c, v in values.items():
        dtype = df.schema[c].dataType
        col = F.col(c)
        if isinstance(v, str) and not isinstance(dtype, T.StringType):
            col = col.cast("string")
        out = out.withColumn(c, F.coalesce(col, F.lit(v)))
    return out


def fill_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> column mean (one aggregate row cross-joined back; the row is one record by construction)."""
    means = df.agg(*[F.avg(c).alias(f"__mean_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(means))
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"__mean_{c}")) for c in cols})
    return out.drop(*[f"__mean_{c}" for c in cols])


def one_hot_flags(df: DataFrame, spec: Mapping[str, tuple[str, object]]) -> DataFrame:
    """``{'male_fl': ('sex', 1), ...}`` -> int 0/1 columns; NULL -> 0."""
    return df.withColumns({name: flag_expr(col, val) for name, (col, val) in spec.items()})


def floor_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values <= 0 become 0."""
    return df.withColumns({c: floor_zero_expr(c) for c in cols})


def log_append(df: DataFrame, cols: Sequence[str], prefix: str = "log_") -> DataFrame:
    """Append ``log_<col>``: ln for positives, 0 for zero, NULL for negatives."""
    return df.withColumns({f"{prefix}{c}": safe_log_expr(c) for c in cols})


def as_number(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """String/factor -> number; '' and unparsable text -> NULL."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {to})") for c in cols})


def as_string(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def dense_rank(levels: DataFrame, col: str, out: str) -> DataFrame:
    """Distinct non-NULL values of any ordered type, numbered from 0 in ascending order.

    Values are range-partitioned and sorted once, written, and numbered by their place in the partition plus the sizes
    of the partitions before it; one row per partition goes through the running sum.
    """
    n = int(levels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()  # partition number above 33 bits of place
    ranked = stored(levels.repartitionByRange(n, col).sortWithinPartitions(col).withColumn("__place", place), "levels")
    part = F.shiftright("__place", 33)
    counts = ranked.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before, total = [], 0
    for r in counts.orderBy("__part").collect():  # one row per shuffle partition
        before.append((r["__part"], total))
        total += r["__n"]
    offsets = levels.sparkSession.createDataFrame(before, "__part long, __off long")
    joined = ranked.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return joined.withColumn(out, F.col("__off") + F.col("__place").bitwiseAND((1 << 33) - 1)).drop("__part", "__place", "__off")


def label_encode(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Categorical -> integer code in ascending value order (LabelEncoder semantics).

    Values are ordered in their own type, so numbers rank as numbers.  The
    codes are ranks over the distinct values (one row per level), joined back;
    no level list goes through the driver or one task.  NULL keeps a NULL code.
    """
    out = df
    for c in cols:
        levels = df.select(F.col(c).alias("__level")).filter(F.col("__level").isNotNull()).distinct()
        codes = dense_rank(levels, "__level", "__code").withColumn("__code", F.col("__code").cast("int"))
        out = out.join(codes, out[c] == codes["__level"], "left").drop("__level")
        out = out.withColumn(f"{c}{suffix}", F.col("__code")).drop("__code")
    return out


def cut_bins(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence | None = None,
             out: str | None = None, value_out: str | None = None) -> DataFrame:
    """Right-closed ``(a, b]`` bins; outside -> NULL.  ``value_out`` adds the upper edge as a number."""
    out = out or f"{col}_bucket"
    res = df.withColumn(out, cut_expr(col, edges, labels))
    if value_out:
        res = res.withColumn(value_out, cut_expr(col, edges, [float(b) for b in edges[1:]]))
    return res


def equal_width_bins(df: DataFrame, col: str, n: int, label: str = "default_flag") -> DataFrame:
    """Equal-width bins with a rounded step, then mean label per bin.

    step = round-half-even((max - min) / n); edges min, min+step, ... up to max,
    with max appended when the sequence stops short of it; intervals are
    right-closed, so the minimum itself falls in no bin (as ``cut`` does).
    A constant column has no bins.
    Returns ``bin, bin_lower, bin_upper, mean_default, n``; empty bins are absent
    (as ``aggregate`` omits them).
    """
    x = F.col(col).cast("double")
    stats = df.agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    stats = stats.withColumn("__raw", (F.col("__hi") - F.col("__lo")) / F.lit(float(n)))
    stats = stats.withColumn("__step", F.when(F.bround(F.col("__raw"), 0) > 0, F.bround(F.col("__raw"), 0))
                             .otherwise(F.col("__raw")))
    # number of sequence points, then bins (an extra bin when max is not on the grid)
    stats = stats.withColumn("__m", F.floor(F.try_divide(F.col("__hi") - F.col("__lo"), F.col("__step"))) + 1)
    stats = stats.withColumn(
        "__bins",
        F.when(F.col("__lo") + (F.col("__m") - 1) * F.col("__step") < F.col("__hi"), F.col("__m"))
        .otherwise(F.col("__m") - 1))
    j = df.select(x.alias("__x"), F.col(label).alias("__y")).crossJoin(F.broadcast(stats))
    k = F.least(F.ceil(F.try_divide(F.col("__x") - F.col("__lo"), F.col("__step"))), F.col("__bins"))
    j = j.filter(F.col("__x") > F.col("__lo")).withColumn("bin", k.cast("int"))
    agg = j.groupBy("bin", "__lo", "__hi", "__step", "__bins").agg(
        F.avg("__y").alias("mean_default"), F.count(F.lit(1)).alias("n"))
    lower = F.col("__lo") + (F.col("bin") - 1) * F.col("__step")
    upper = F.when(F.col("bin") == F.col("__bins"), F.col("__hi")).otherwise(F.col("__lo") + F.col("bin") * F.col("__step"))
    return agg.select("bin", lower.alias("bin_lower"), upper.alias("bin_upper"), "mean_default", "n")


def map_values(df: DataFrame, col: str, mapping, out: str | None = None) -> DataFrame:
    """Recode values.  A dict becomes a literal ``map`` lookup (no join); a
    DataFrame ``(key, value)`` is left-joined, broadcast when the planner's
    size estimate allows it; a key listed more than once gets its least value."""
    out = out or f"{col}_code"
    if isinstance(mapping, DataFrame):
        k, v = mapping.columns[:2]
        # one value per key, so the recode never multiplies rows: the least one
        m = mapping.groupBy(F.col(k).alias("__mk")).agg(F.min(F.col(v)).alias(out))
        return df.join(m, F.col(col) == F.col("__mk"), "left").drop("__mk")
    pairs = []
    for key, val in mapping.items():
        pairs.extend([F.lit(key), F.lit(val)])
    lookup = F.create_map(*pairs)
    return df.withColumn(out, F.element_at(lookup, F.col(col)) if pairs else F.lit(None))


def left_lookup_join(df: DataFrame, mapping: DataFrame, left_key: str, right_key: str | None = None,
                     broadcast: bool | str = "auto") -> DataFrame:
    """Left equi-join onto a lookup map.

    ``broadcast=True`` is for maps whose size the caller has bounded (inline
    dicts, fixed dimensions).  ``'auto'`` leaves the choice to the planner's
    size estimate and AQE's runtime statistics.
    """
    right_key = right_key or left_key
    m = F.broadcast(mapping) if broadcast is True else mapping
    if left_key == right_key:
        return df.join(m, left_key, "left")
    return df.join(m, F.col(left_key) == m[right_key], "left").drop(m[right_key])


def lump_rare(df: DataFrame, col: str, min_frac: float = 0.01, other: str = "Other",
              out: str | None = None) -> DataFrame:
    """Keep a category when its count exceeds ``min_frac`` of all rows, else ``other``.

    Counts are a partial aggregate per category (skew-safe); the total is a
    one-row aggregate over those counts.  NULL stays NULL.
    """
    out = out or col
    counts = df.groupBy(F.col(col).alias("__cat")).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("__total"))
    keep = (counts.crossJoin(F.broadcast(total))
            .select("__cat", (F.col("__n") > F.lit(min_frac) * F.col("__total")).alias("__keep"))
            .filter(F.col("__cat").isNotNull()))
    res = df.join(keep, F.col(col) == F.col("__cat"), "left")
    res = res.withColumn(out, F.when(F.col(col).isNull(), F.lit(None))
                         .when(F.col("__keep"), F.col(col).cast("string"))
                         .otherwise(F.lit(other)))
    return res.drop("__cat", "__keep")


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One pass: per column the count of NULL (or '' for strings) and its share of rows."""
    cols = list(cols or df.columns)
    str_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}

    def missing(c: str) -> Column:
        cond = F.col(c).isNull()
        if c in str_cols:
            cond = cond | (F.col(c) == F.lit(""))
        return F.count_if(cond)

    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[missing(c).alias(f"m{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("__rows", f"stack({len(cols)}, {stack}) AS (column_name, n_missing)")
    return long.select("column_name", "n_missing", "__rows")


def sparse_column_report(df: DataFrame, max_missing: float = 0.70) -> DataFrame:
    """``column_name, n_missing, missing_frac, kept``: kept when missing < max_missing x rows."""
    rep = missing_report(df)
    return rep.select(
        "column_name", "n_missing",
        F.try_divide(F.col("n_missing").cast("double"), F.col("__rows").cast("double")).alias("missing_frac"),
        (F.col("n_missing") < F.lit(max_missing) * F.col("__rows")).alias("kept"))


def drop_sparse_columns(df: DataFrame, max_missing: float = 0.70) -> DataFrame:
    """Drop columns whose missing count reaches ``max_missing`` of the rows.

    The decision needs the counts before the projection can be planned, so
    one aggregate job runs here (its result is one row per column).
    """
    rep = sparse_column_report(df, max_missing).filter(~F.col("kept")).select("column_name").collect()
    return df.drop(*[r[0] for r in rep])


def threshold_predict(df: DataFrame, prob: str | Column, t: float = 0.5, out: str = "prediction") -> DataFrame:
    """prob >= t -> 1 else 0 (NULL stays NULL).  Accepts a probability vector column (index 1)."""
    p = as_column(prob)
    if isinstance(prob, str) and df.schema[prob].dataType.typeName() == "vector":
        from pyspark.ml.functions import vector_to_array
        p = vector_to_array(F.col(prob))[1]
    return df.withColumn(out, (p >= F.lit(t)).cast("int"))


def format_percent(df: DataFrame, col: str, out: str | None = None, digits: int = 2) -> DataFrame:
    return df.withColumn(out or f"{col}_pct", format_percent_expr(col, digits))


def round_to(df: DataFrame, cols: Sequence[str], digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})
