"""Projection, profiling and cleansing operators."""
from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.stats import predict_label


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def select_head(df: DataFrame, columns: list[str], order_by: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows of a column subset.  Spark tables have no row order, so an order key is required."""
    return df.select(*columns).orderBy(*order_by).limit(n)


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, has-null flag, plus the table's row and column counts.

    One aggregation pass computes the row count and every column's null count together.
    """
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.sum(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)).alias(f"__null_{i}") for i, c in enumerate(cols)]
    stats = df.agg(*aggs)
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    rows = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                              F.lit(types[c]).alias("data_type"),
                              (F.col(f"__null_{i}") > 0).alias("has_null")) for i, c in enumerate(cols)])
    return (stats.select(F.col("__n").alias("n_rows"), F.inline(rows))
            .select("ordinal", "column_name", "data_type", "has_null", "n_rows",
                    F.lit(len(cols)).cast("long").alias("n_cols")))


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Remove all whitespace from column names."""
    return df.toDF(*[re.sub(r"\s+", "", c) for c in df.columns])


def duration_seconds(text) -> Column:
    """``'<m> min… <s> sec…'`` → seconds; a missing part counts 0, hours are not recognised, null → 0."""
    t = F.coalesce(_c(text), F.lit(""))
    mins = F.nullif(F.regexp_extract(t, r"(\d+)\smin", 1), F.lit("")).try_cast("long")
    secs = F.nullif(F.regexp_extract(t, r"(\d+)\ssec", 1), F.lit("")).try_cast("long")
    return F.coalesce(mins, F.lit(0)) * 60 + F.coalesce(secs, F.lit(0))


def parse_duration_seconds(df: DataFrame, column: str, out: str = "time", drop: bool = True) -> DataFrame:
    df = df.withColumn(out, duration_seconds(F.col(f"`{column}`")).cast("long"))
    return df.drop(column) if drop else df


def fill_missing_const(df: DataFrame, columns: list[str], value=0) -> DataFrame:
    return df.fillna(value, subset=columns)


def coerce_numeric(df: DataFrame, columns: Iterable[str], missing_marker: str = "-") -> DataFrame:
    """Marker → null, then text → double (unparseable text → null, never an error)."""
    exprs = {c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit(missing_marker)).try_cast("double") for c in columns}
    return df.withColumns(exprs)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def impute_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null → the column's mean over non-null values.  The means are one row, so the cross join is 1×N."""
    means = df.agg(*[F.avg(F.col(f"`{c}`")).alias(f"__mean_{i}") for i, c in enumerate(columns)])
    out = df.crossJoin(F.broadcast(means))
    out = out.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.col(f"__mean_{i}")) for i, c in enumerate(columns)})
    return out.drop(*[f"__mean_{i}" for i in range(len(columns))])


def append_mean_row(df: DataFrame, id_col: str, mean_cols: list[str], int_cols: Iterable[str] = ()) -> DataFrame:
    """Append a row of column means with ``id = max(id) + 1``; ``int_cols`` are truncated to bigint."""
    int_cols = set(int_cols)
    agg = df.agg((F.max(id_col) + 1).alias(id_col), *[F.avg(F.col(f"`{c}`")).alias(c) for c in mean_cols])
    agg = agg.withColumns({c: F.col(f"`{c}`").cast("long").cast(df.schema[c].dataType) for c in mean_cols
                           if c in int_cols})
    return df.select(id_col, *mean_cols).unionByName(agg.select(id_col, *mean_cols))


def recode_categories(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Many-to-one recode through a small mapping table (broadcast); unlisted values stay unchanged."""
    spark = df.sparkSession
    m = spark.createDataFrame(list(mapping.items()), "__from string, __to string")
    return (df.join(F.broadcast(m), F.col(column) == F.col("__from"), "left")
            .withColumn(column, F.coalesce(F.col("__to"), F.col(column))).drop("__from", "__to"))


def dummy_encode(df: DataFrame, column: str, levels: list[str] | None = None, keep: bool = False) -> DataFrame:
    """One 0/1 integer column per level, named ``<col>_<level>``.  Levels default to the data's own
    (a small distinct list); pass the training levels when encoding test rows."""
    if levels is None:
        levels = sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)
    out = df.withColumns({f"{column}_{lv}": F.when(F.col(column) == lv, 1).otherwise(0) for lv in levels})
    return out if keep else out.drop(column)


def min_max_scale(train: DataFrame, apply_to: DataFrame, columns: list[str]) -> DataFrame:
    """Scale with the *training* min and max; a constant column divides by zero → null."""
    stats = train.agg(*[F.min(c).alias(f"__min_{i}") for i, c in enumerate(columns)],
                      *[F.max(c).alias(f"__max_{i}") for i, c in enumerate(columns)])
    out = apply_to.crossJoin(F.broadcast(stats))
    out = out.withColumns({c: F.try_divide(F.col(c) - F.col(f"__min_{i}"), F.col(f"__max_{i}") - F.col(f"__min_{i}"))
                           for i, c in enumerate(columns)})
    return out.drop(*[f"__min_{i}" for i in range(len(columns))], *[f"__max_{i}" for i in range(len(columns))])


def predict_threshold(df: DataFrame, score: str, out: str = "predicted", threshold: float = 0.5) -> DataFrame:
    """``sigmoid(score) >= threshold`` → 1 else 0."""
    return df.withColumn(out, predict_label(F.col(score), threshold))


def _bin_stats(df: DataFrame, value_col: str) -> DataFrame:
    return df.agg(F.min(value_col).alias("__lo"), F.max(value_col).alias("__hi"))


def bin_membership(df: DataFrame, id_col: str, value_col: str, bins: int = 5, exclude=None) -> DataFrame:
    """Long table ``(id, bin)`` of equal-width right-closed bins over [min, max].  The min/max row is a
    one-row aggregate, so the cross join is with a single broadcast row."""
    stats = _bin_stats(df, value_col)
    rows = df if exclude is None else df.filter(~exclude)
    width = (F.col("__hi") - F.col("__lo")) / bins
    return (rows.crossJoin(F.broadcast(stats))
            .select(id_col, F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil(
                F.try_divide(F.col(value_col) - F.col("__lo"), width)).cast("int"))).alias("bin")))


def equal_width_bins(df: DataFrame, id_col: str, value_col: str, bins: int = 5, exclude=None) -> DataFrame:
    """Per bin: edges, number of ids and the sum of ids (the membership itself is ``bin_membership``;
    a bin can hold a large share of all rows, so ids are never gathered into one list).  The lowest edge
    is extended down by 0.1 % of the range; empty bins are kept.  Rows matching ``exclude`` take part
    in min/max but not in the groups."""
    stats = _bin_stats(df, value_col)
    spark = df.sparkSession
    width = (F.col("__hi") - F.col("__lo")) / bins
    grid = (spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin")).crossJoin(stats)
            .select("bin",
                    F.when(F.col("bin") == 1, F.col("__lo") - (F.col("__hi") - F.col("__lo")) * 0.001)
                    .otherwise(F.col("__lo") + (F.col("bin") - 1) * width).alias("lower"),
                    (F.col("__lo") + F.col("bin") * width).alias("upper")))
    per_bin = (bin_membership(df, id_col, value_col, bins, exclude).groupBy("bin")
               .agg(F.count(id_col).alias("n_ids"), F.sum(id_col).alias("id_sum")))
    return (F.broadcast(grid).join(per_bin, "bin", "left")
            .select("bin", "lower", "upper", F.coalesce("n_ids", F.lit(0)).alias("n_ids"),
                    F.coalesce("id_sum", F.lit(0)).cast("long").alias("id_sum")))
