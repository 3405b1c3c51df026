"""Landing files: delimited trips, zone lookups, tolerant loads and line checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.schemas import TRIP_SCHEMA, ZONE_SCHEMA

LINE = "_line"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# formats a tolerant load tries in turn, after the plain cast
TIME_FORMATS = ("MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy", "yyyyMMdd", "yyyyMMdd HHmmss")
QUOTED = '"([^"]|"")*"'


class TooManyBadRows(Exception):
    """More rejected rows than a load may have."""


def trips_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = TRIP_SCHEMA,
    glob: str = "*.csv*",
    exclude: str | None = None,
) -> DataFrame:
    """Headered CSV files in a directory tree.

    With a declared schema nothing is read twice, and a file whose header names other columns, or in another
    order, fails the read instead of filling the wrong columns. ``schema=None`` infers it at the cost of
    an extra pass. ``glob`` selects by file name and ``exclude`` (a pattern on the whole
    path) skips other files kept in the same tree, before they are opened.
    """
    reader = (
        spark.read.option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("timestampNTZFormat", TIME_FORMAT)
    )
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema).option("enforceSchema", False)
    df = reader.csv(path)
    if exclude is not None:
        df = df.filter(~F.col("_metadata.file_path").rlike(exclude))
    return df


def by_header(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV whose columns are found by name, letter case aside, in any order; a declared column that the files lack is NULL, others are
    left out. A value that does not fit its type is NULL. All files of a path have one header."""
    raw = spark.read.option("header", True).csv(path)
    have = {c.strip().lower(): c for c in raw.columns}
    columns = []
    for f in schema.fields:
        found = have.get(f.name.lower())
        text = F.lit(None).cast("string") if found is None else F.nullif(F.trim(F.col(f"`{found}`")), F.lit(""))
        columns.append(text.try_cast(f.dataType).alias(f.name))
    return raw.select(*columns)


def zones_csv(spark: SparkSession, path: str) -> DataFrame:
    return by_header(spark, path, ZONE_SCHEMA)


def _fitted(text: Column, kind: T.DataType, formats: tuple[str, ...]) -> Column:
    """A text as a type, NULL if it does not fit; times in any of the formats."""
    value = text.try_cast(kind)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        value = F.coalesce(value, *[F.try_to_timestamp(text, F.lit(f)).cast(kind) for f in formats])
    return value


REPLACED = "\ufffd"


def _parsed(spark: SparkSession, path: str, schema: T.StructType, formats: tuple[str, ...], replacement: str) -> tuple[DataFrame, dict[str, Column], Column]:
    """The fields as texts, their typed values, and whether a row is bad. Bytes that are no UTF-8 become ``replacement``."""
    names = [f.name for f in schema.fields]
    texts = T.StructType([T.StructField(n, T.StringType()) for n in [*names, LINE]])
    reader = spark.read.schema(texts).option("header", True).option("columnNameOfCorruptRecord", LINE)
    raw = reader.option("enforceSchema", True).csv(path)
    read = {n: F.replace(F.trim(n), F.lit(REPLACED), F.lit(replacement)) for n in names}
    filled = raw.select(*[F.nullif(value, F.lit("")).alias(n) for n, value in read.items()], LINE)
    typed = {f.name: _fitted(F.col(f.name), f.dataType, formats) for f in schema.fields}
    fields = F.size(F.split(F.regexp_replace(LINE, QUOTED, ""), ",", -1))
    bad = F.coalesce(fields > len(names), F.lit(False))
    for name, value in typed.items():
        bad = bad | (F.col(name).isNotNull() & value.isNull())
    return filled, typed, bad


def bulk_load(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    most: int | None = None,
    formats: tuple[str, ...] = TIME_FORMATS,
    replacement: str = "?",
) -> tuple[DataFrame, DataFrame]:
    """A tolerant load: blanks and empty fields become NULL, and rows with a field that does
    not fit its type or with too many fields are set aside as text. Missing trailing fields
    are NULL. Returns (rows, rejected), which read the files once each; with ``most``, more rejected rows than that end the load.
    :func:`staged_load` reads them once for both.

    Fields are read as text and cast here, so whether a row is rejected does not depend on
    the columns a later query happens to read. Lines of another width than the schema's come with their
    text, and the fields of that are counted.
    """
    filled, typed, bad = _parsed(spark, path, schema, formats, replacement)
    rows = filled.filter(~bad).select(*[value.alias(name) for name, value in typed.items()])
    rejected = filled.filter(bad)
    if most is not None:
        within_budget(rejected, most)
    return rows, rejected


def staged_load(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target: str,
    most: int = 1000,
    share: float = 0.0,
    formats: tuple[str, ...] = TIME_FORMATS,
    replacement: str = "?",
) -> dict:
    """A tolerant load into the table at ``target`` that reads the files once.

    One job parses, writes rows and rejects side by side under the load's own folder, and counts both as they pass. The load is published by
    one record in the table's list of loads, and only if no more rows were rejected than ``most`` or ``share`` of all, whichever is
    more. Until then, and for ever if it fails, :func:`loaded` does not see it; a repeated load gets a folder of its own. Returns its record.
    """
    filled, typed, bad = _parsed(spark, path, schema, formats, replacement)
    text = F.struct(*[f.name for f in schema.fields], LINE)
    parsed = filled.select(bad.alias("rejected"), *[value.alias(name) for name, value in typed.items()], F.when(bad, text).alias(LINE))
    counts = Observation("load")
    watched = parsed.observe(counts, F.count(F.lit(1)).alias("n_rows"), F.count_if("rejected").alias("n_rejected"))
    load = uuid.uuid4().hex
    watched.write.partitionBy("rejected").parquet(f"{target}/data/load={load}")
    n_rows, n_rejected = counts.get["n_rows"], counts.get["n_rejected"]
    allowed = max(most, int(share * n_rows))
    if n_rejected > allowed:
        raise TooManyBadRows(f"{n_rejected} rows were rejected, {allowed} are allowed; load {load} is not published")
    record = {"load": load, "n_rows": n_rows, "n_rejected": n_rejected}
    spark.createDataFrame([record], "load string, n_rows bigint, n_rejected bigint").write.mode("append").parquet(f"{target}/loads")
    return record


def loaded(spark: SparkSession, target: str, schema: T.StructType, rejected: bool = False) -> DataFrame:
    """The rows of all published loads, or with ``rejected`` the texts that were set aside."""
    listed = [r["load"] for r in spark.read.parquet(f"{target}/loads").select("load").distinct().collect()]
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*(f.name for f in schema.fields), LINE]])
    kinds = T.StructType([*schema.fields, T.StructField(LINE, text), T.StructField("load", T.StringType()), T.StructField("rejected", T.BooleanType())])
    reader = spark.read.schema(kinds).option("basePath", f"{target}/data")
    rows = reader.parquet(*[f"{target}/data/load={load}" for load in listed]).filter(F.col("rejected") == rejected)
    return rows.select(f"{LINE}.*") if rejected else rows.select(*[f.name for f in schema.fields])


def within_budget(rejected: DataFrame, most: int = 1000) -> int:
    """The number of rejected rows; an error beyond the budget. Counted by one aggregate, so no rows move."""
    n = rejected.count()
    if n > most:
        raise TooManyBadRows(f"{n} rows were rejected, {most} are allowed")
    return n


def lines_of_arity(lines: DataFrame, fields: int, column: str = "value") -> DataFrame:
    """Text lines that are not blank and have the right number of comma-separated fields."""
    text = F.col(column)
    return lines.filter((F.trim(text) != "") & (F.size(F.split(text, ",", -1)) == fields))
