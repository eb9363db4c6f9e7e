"""Typed file readers. Nothing is inferred and a malformed row fails the load."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import LOADED_AT, TABLES

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "dateFormat": "yyyy-MM-dd",
}


def stamp_load(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Add the load time, one value for the whole batch."""
    return df.withColumn(LOADED_AT, F.localtimestamp() if loaded_at is None else loaded_at)


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV with a header line and optionally quoted fields; columns go by position."""
    return stamp_load(spark.read.schema(TABLES[table]).options(**CSV_OPTIONS).csv(path))


def split_by_form(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The JSON files under ``path`` that hold one array each, and those with lines.

    Records are objects, so a file holds an array when one of its lines begins with a
    bracket. Tasks look at the files, compressed ones too, and send a word for each file;
    files without anything in them are in neither list.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    opens = F.ltrim(F.regexp_replace("value", "[\ufeff\t]", " ")).startswith("[")
    forms = lines.filter(F.trim("value") != "").groupBy(
        F.col("_metadata.file_path").alias("file")).agg(F.max(opens).alias("array")).collect()
    return tuple([unquote(r.file) for r in forms if r.array == array] for array in (True, False))


def read_json(spark: SparkSession, path: str, table: str,
              array_file: bool | None = None) -> DataFrame:
    """JSON records with typed fields, from arrays or with one record per line.

    ``array_file`` tells which of the two all files are; otherwise each file is looked
    at, which reads them once more, and a folder may hold both. A file with an array cannot
    be split, so deliver large loads as many files or as lines.
    """
    def read(paths: str | list[str], array: bool) -> DataFrame:
        reader = spark.read.schema(TABLES[table]).option("mode", "FAILFAST")
        return reader.option("multiLine", array).option("dateFormat", "yyyy-MM-dd").json(paths)

    if array_file is not None:
        return stamp_load(read(path, array_file))
    arrays, lines = split_by_form(spark, path)
    if not arrays:
        return stamp_load(read(lines or path, False))
    rows = read(arrays, True)
    return stamp_load(rows.unionByName(read(lines, False)) if lines else rows)


def read_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Parquet in the table's column layout, without the load time."""
    return stamp_load(spark.read.schema(TABLES[table]).parquet(path))


READERS = {"csv": read_csv, "json": read_json, "parquet": read_parquet}


def extract_json(df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]],
                 strict: bool = True) -> DataFrame:
    """Add typed fields of a JSON text column: ``{name: (path, type)}``.

    The text is parsed once into a VARIANT. ``strict`` fails on a value that does
    not fit its type; otherwise it becomes NULL.
    """
    get = F.variant_get if strict else F.try_variant_get
    parse = F.parse_json if strict else F.try_parse_json
    parsed = df.withColumn("_json", parse(F.col(column)))
    values = {name: get("_json", path, dtype) for name, (path, dtype) in fields.items()}
    return parsed.withColumns(values).drop("_json")
