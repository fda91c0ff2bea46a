"""Profiles of sources and tests on columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_double
from ..operators import sketches
from ..operators.ordered import running_counts, value_counts

OUTLIER_QUANTILE = 0.99


def _metrics(df: DataFrame, columns: dict[str, str], metric: str, source: str) -> DataFrame:
    """Turn one row of numbers into report rows; ``columns`` maps a column to its report name."""
    entries = [
        F.struct(F.lit(name).alias("colonne"), F.col(c).cast("bigint").alias("valeur"))
        for c, name in columns.items()
    ]
    return df.select(F.explode(F.array(*entries)).alias("_e")).select(
        F.lit(source).alias("source"),
        F.lit(metric).alias("mesure"),
        F.col("_e.colonne").alias("colonne"),
        F.col("_e.valeur").alias("valeur"),
    )


def row_and_null_counts(df: DataFrame, source: str) -> DataFrame:
    """Rows, columns and the nulls of each column that has any, in a single pass."""
    aliases = {f"_c{i}": name for i, name in enumerate(df.columns)}
    one_row = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(f"`{name}`").isNull()).alias(a) for a, name in aliases.items()],
    ).withColumn("_columns", F.lit(len(df.columns)))
    entries = [
        F.struct(F.lit("lignes").alias("mesure"), F.lit("").alias("colonne"), F.col("_rows").alias("valeur")),
        F.struct(
            F.lit("colonnes").alias("mesure"),
            F.lit("").alias("colonne"),
            F.col("_columns").cast("bigint").alias("valeur"),
        ),
    ] + [
        F.struct(F.lit("nuls").alias("mesure"), F.lit(name).alias("colonne"), F.col(a).alias("valeur"))
        for a, name in aliases.items()
    ]
    return (
        one_row.select(F.inline(F.array(*entries)))
        .filter((F.col("mesure") != "nuls") | (F.col("valeur") > 0))
        .select(F.lit(source).alias("source"), "mesure", "colonne", "valeur")
    )


def duplicate_count(df: DataFrame, source: str) -> DataFrame:
    """Rows beyond the first of each group of equal rows; NULLs are equal here."""
    extra = (
        df.groupBy(_fingerprint(df).alias("_f"))
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_extra"))
    )
    return _metrics(extra, {"_extra": ""}, "doublons", source)


def outlier_count(
    df: DataFrame, column: str, source: str, q: float = OUTLIER_QUANTILE, accuracy: int | None = None
) -> DataFrame:
    """Values above the ``q`` quantile: exact by default, out of one sketch of size ``accuracy`` when that is given.

    The exact form counts equal values first and needs no threshold row: a value lies above the quantile
    when the rank of the quantile is below the rank of its first occurrence. The other form reads the
    column once; ``sketches.rank_error`` says by which share of the rows the count may be off.
    """
    values = df.select(safe_double(F.col(f"`{column}`").cast("string")).alias("_v")).filter(
        F.col("_v").isNotNull()
    )
    if accuracy is None:
        ranked = running_counts(value_counts(values, [], "_v"), [], "_v")
        above = ranked.agg(
            F.coalesce(
                F.sum(F.when(F.col("before") > F.lit(float(q)) * (F.col("total") - 1), F.col("n"))), F.lit(0)
            ).alias("_out")
        )
    else:
        whole = values.agg(sketches.sketch("_v", accuracy).alias("_sketch"))
        above = whole.select(sketches.above("_sketch", q).alias("_out"))
    return _metrics(above, {"_out": column}, "aberrants_p99", source)


def _fingerprint(df: DataFrame) -> Column:
    """Equal for equal rows, NULLs included; 64 characters travel instead of the row."""
    whole = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    options = {"timestampFormat": whole, "timestampNTZFormat": whole, "ignoreNullFields": "false"}
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options), 256)


def row_profile(df: DataFrame, source: str) -> DataFrame:
    """Rows, columns, nulls per column and duplicates in one pass over the source.

    Equal rows share their nulls, so counting per distinct row serves all of these numbers.
    """
    flags = F.array(*[F.col(f"`{c}`").isNull() for c in df.columns])
    distinct = df.groupBy(_fingerprint(df).alias("_f"), flags.alias("_nulls")).agg(F.count("*").alias("_n"))
    null_sums = [
        F.sum(F.when(F.get("_nulls", F.lit(i)), F.col("_n")).otherwise(0)) for i in range(len(df.columns))
    ]
    rows, kinds = F.coalesce(F.sum("_n"), F.lit(0)), F.count("*")

    def entry(measure: str, column: str, value: Column) -> Column:
        return F.struct(F.lit(measure).alias("mesure"), F.lit(column).alias("colonne"), value.alias("valeur"))

    entries = F.array(
        entry("lignes", "", rows),
        entry("colonnes", "", F.lit(len(df.columns)).cast("bigint")),
        entry("doublons", "", rows - kinds),
        *[entry("nuls", name, total) for name, total in zip(df.columns, null_sums)],
    )
    return (
        distinct.agg(entries.alias("_entries"))
        .select(F.inline("_entries"))
        .filter((F.col("mesure") != "nuls") | (F.col("valeur") > 0))
        .select(F.lit(source).alias("source"), "mesure", "colonne", "valeur")
    )


def profile(
    df: DataFrame, source: str, outlier_column: str | None = None, accuracy: int | None = None
) -> DataFrame:
    """Report rows ``source, mesure, colonne, valeur``; no outlier row without the column."""
    report = row_profile(df, source)
    if outlier_column and outlier_column in df.columns:
        report = report.unionByName(outlier_count(df, outlier_column, source, accuracy=accuracy))
    return report


def profile_sources(
    sources: Iterable[tuple[str, DataFrame, str | None]], accuracy: int | None = None
) -> DataFrame:
    """One report over several sources, each given as name, rows and outlier column."""
    return reduce(
        DataFrame.unionByName, (profile(df, name, column, accuracy) for name, df, column in sources)
    )


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, and how often."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
    )


def accepted_values_violations(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the accepted set, and how often; NULL is not a violation here."""
    return (
        df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))
    )


def not_null_counts(df: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """``test, violations`` of the not-null tests of one table, in one pass."""
    columns = list(columns)
    entries = [
        F.struct(F.lit(f"not_null_{table}_{c}").alias("test"), F.col(f"_{c}").alias("violations")) for c in columns
    ]
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in columns]).select(
        F.inline(F.array(*entries))
    )


def column_tests(
    stations: DataFrame,
    stop_map: DataFrame,
    shapes: DataFrame,
    fact: DataFrame,
    countries: Iterable[str],
    line_types: Iterable[str],
) -> DataFrame:
    """Number of violations of every declared column test."""

    def rows(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("test"), "violations")

    checks = [
        not_null_counts(stations, "dim_stations", ["id_gare", "station_id", "pays"]),
        not_null_counts(stop_map, "dim_stop_uic", ["stop_id"]),
        not_null_counts(shapes, "dim_shapes", ["shape_id"]),
        not_null_counts(fact, "fact", ["mois", "type_ligne"]),
        rows("unique_dim_stations_id_gare", unique_violations(stations, "id_gare")),
        rows("accepted_dim_stations_pays", accepted_values_violations(stations, "pays", countries)),
        rows("accepted_fact_type_ligne", accepted_values_violations(fact, "type_ligne", line_types)),
    ]
    return reduce(DataFrame.unionByName, checks)
