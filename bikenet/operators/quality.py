"""Validation of raw trip tables in one aggregation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikenet import schema as S
from bikenet.operators.cleaning import detect_schema
from bikenet.sources.files import FILE_COLUMN
from bikenet.sources.trips import PLACED, header_catalogue, placed_rows

_ALL_COORDINATES = (*S.COORDINATE_COLUMNS["current"], *S.COORDINATE_COLUMNS["legacy"])


@dataclass
class ValidationReport:
    """Driver-side form of one report row."""

    schema_version: str = "unknown"
    row_count: int = 0
    missing_required_columns: list[str] = field(default_factory=list)
    null_rate: dict[str, float] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)

    @property
    def is_valid(self) -> bool:
        return not self.errors

    @classmethod
    def from_row(cls, row) -> ValidationReport:
        return cls(**{name: row[name] for name in cls.__dataclass_fields__})


class InvalidTripData(RuntimeError):
    """Raised when a batch is stopped by an invalid report."""


def validate_dataframe(df: DataFrame, rsd: float | None = None) -> DataFrame:
    """One report row: version, counts, null rates, warnings, errors, verdict.

    Counting duplicates exactly shuffles the distinct ride ids. With ``rsd``, a relative standard
    deviation, they are estimated from a sketch instead and nothing but sketches is shuffled.
    """
    version = F.lit(detect_schema(df.columns))
    return _report(df.agg(*_measures(df, rsd)), version, F.array(*(F.lit(c.lower()) for c in df.columns)).cast("array<string>"))


def null_rates(df: DataFrame) -> DataFrame:
    """One row with the share of missing values per coordinate column, four digits."""
    present = _coordinates(df)
    return df.agg(*(
        F.bround(F.avg(_missing(df, actual).cast("int")), 4).alias(name)
        for name, actual in present.items()
    ))


def duplicate_count(df: DataFrame, key: str = "ride_id") -> DataFrame:
    """One row: rows beyond the first of each id, NULL counted as one id."""
    return df.agg(_duplicates(F.col(key)).alias("duplicate_count"))


#: Reports that the error of :func:`require_valid` shows; it counts all.
SHOWN = 20


def validate_csv(
    spark: SparkSession, path: str, na_tokens: tuple[str, ...] = S.NA_TOKENS,
) -> DataFrame:
    """One report per CSV file below ``path``, with ``source_file``.

    All files are measured in one grouped aggregation, whatever their headers. A file of which only the
    header line exists still gets its report, and so does one of zero bytes.
    """
    catalogue = header_catalogue(spark, path)
    if catalogue.isEmpty():
        raise ValueError(f"no files below {path}")
    measures: list[Column] = [F.count("*").alias("row_count")]
    if not catalogue.where(F.size("header") > 0).isEmpty():
        rows = placed_rows(spark, path, catalogue)
        given = {c: F.when(~F.col(f"`{c}`").isin(*na_tokens), F.col(f"`{c}`")) for c in PLACED}
        rows = rows.select(FILE_COLUMN, *(c.alias(n) for n, c in given.items()))
        measures += [F.avg(_missing(rows, name).cast("int")).alias(f"_null {name}") for name in _ALL_COORDINATES]
        measured = rows.groupBy(FILE_COLUMN).agg(*measures, _duplicates(F.col("ride_id")).alias("_duplicates"))
        stats = catalogue.join(measured, FILE_COLUMN, "left").fillna(0, ["row_count"])
    else:
        stats = catalogue.withColumn("row_count", F.lit(0).cast("bigint"))
    return _report(stats, F.col("schema_version"), F.col("columns"), FILE_COLUMN)


def require_valid(reports: DataFrame) -> DataFrame:
    """Pass reports through, or raise when any of them has errors.

    The error tells how many there are and shows the first :data:`SHOWN`.
    """
    bad = reports.where(~F.col("is_valid"))
    shown = bad.limit(SHOWN).collect()
    if shown:
        rows = "; ".join(str(row.asDict()) for row in shown)
        raise InvalidTripData(f"{bad.count()} invalid files, among them: {rows}")
    return reports


def _coordinates(df: DataFrame) -> dict[str, str]:
    actual = {c.lower(): c for c in df.columns}
    wanted = S.COORDINATE_COLUMNS[detect_schema(df.columns)]
    return {name: actual[name] for name in wanted if name in actual}


def _missing(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    if df.schema[name].dataType.simpleString() in ("double", "float"):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _duplicates(key: Column, rsd: float | None = None) -> Column:
    null_id = F.coalesce(F.max(key.isNull().cast("long")), F.lit(0))
    if rsd is None:
        return F.count("*") - F.count_distinct(key) - null_id
    return F.greatest(F.count("*") - F.approx_count_distinct(key, rsd) - null_id, F.lit(0))


def _measures(df: DataFrame, rsd: float | None = None) -> list[Column]:
    measures = [F.count("*").alias("row_count")]
    for name, actual in _coordinates(df).items():
        measures.append(F.avg(_missing(df, actual).cast("int")).alias(f"_null {name}"))
    if detect_schema(df.columns) == "current":
        key = next(c for c in df.columns if c.lower() == "ride_id")
        measures.append(_duplicates(F.col(f"`{key}`"), rsd).alias("_duplicates"))
    return measures


def _report(stats: DataFrame, version: Column, columns: Column, *keep: str) -> DataFrame:
    """Turn measured counts and rates into report rows, each by its own version and columns."""
    def by_version(values: dict[str, tuple[str, ...]]) -> Column:
        lists = {v: F.array(*map(F.lit, names)).cast("array<string>") for v, names in values.items()}
        return F.when(version == "current", lists["current"]).when(version == "legacy", lists["legacy"]).otherwise(lists["unknown"])

    stats = stats.withColumns({
        "_version": version, "_absent": F.sort_array(F.array_except(by_version(S.REQUIRED_COLUMNS), columns)),
        "_watched": F.array_intersect(by_version(S.COORDINATE_COLUMNS), columns), "_named": F.size(columns) > 0,
    })
    rows, absent, known = F.col("row_count"), F.col("_absent"), F.col("_version") != "unknown"
    rates = {
        name: F.when(F.array_contains("_watched", name), F.col(f"`_null {name}`"))
        for name in _ALL_COORDINATES if f"_null {name}" in stats.columns
    }
    warnings = [
        F.when(rate > S.MAX_NULL_RATE, F.format_string(S.NULLS_MESSAGE, F.lit(name), rate * 100))
        for name, rate in rates.items()
    ]
    warnings.append(F.when(known & rows.between(1, S.LOW_ROW_COUNT - 1), F.format_string(
        S.FEW_ROWS_MESSAGE, rows,
    )))
    copies = F.lit(0).cast("long")
    if "_duplicates" in stats.columns:
        copies = F.when(F.col("_version") == "current", F.coalesce("_duplicates", F.lit(0))).otherwise(0)
        warnings.append(F.when(copies > 0, F.format_string(S.DUPLICATES_MESSAGE, copies)))
    errors = [
        F.when(~known & F.col("_named"), F.lit(S.UNKNOWN_MESSAGE)),
        F.when(~F.col("_named"), F.lit(S.ZERO_BYTES_MESSAGE)),
        F.when(F.size(absent) > 0, F.format_string(S.MISSING_MESSAGE, F.array_join(absent, ", "))),
        F.when(known & (rows == 0), F.lit(S.EMPTY_MESSAGE)),
    ]
    pairs = [F.struct(F.lit(name).alias("key"), F.bround(rate, 4).alias("value")) for name, rate in rates.items()]
    measured = F.filter(F.array(*pairs), lambda p: F.array_contains("_watched", p["key"])) if pairs else None
    return stats.select(
        *keep,
        F.col("_version").alias("schema_version"),
        rows.alias("row_count"),
        absent.alias("missing_required_columns"),
        (F.map_from_entries(measured) if pairs else F.create_map().cast("map<string,double>")).alias("null_rate"),
        copies.cast("long").alias("duplicate_count"),
        F.array_compact(F.array(*warnings)).alias("warnings"),
        F.array_compact(F.array(*errors)).alias("errors"),
    ).withColumn("is_valid", F.size("errors") == 0)
