"""Readers: explicit schemas for text formats, nested JSON flattening, fallback, presence."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lodestrata.operators.extremes import has_at_least


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """CSV with a declared schema; no inference pass over the data."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with inferred types, for small files of unknown layout."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet with its own schema; ``merge_schema`` unites files of evolving layouts."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multi_line: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def _leaves(schema: StructType, parents: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found = []
    for field in schema.fields:
        here = (*parents, field.name)
        found += _leaves(field.dataType, here) if isinstance(field.dataType, StructType) else [here]
    return found


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs as top-level columns named by their joined path."""
    columns: list[Column] = [
        F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path)) for path in _leaves(df.schema)]
    return df.select(*columns)


def parse_and_flatten(df: DataFrame, column: str, schema: StructType | str) -> DataFrame:
    """Parse a JSON text column by schema and spread it into ``column_field`` columns."""
    parsed = df.withColumn(column, F.from_json(column, schema))
    return flatten(parsed)


def _is_object(column: str) -> Column:
    return F.schema_of_variant(F.try_parse_json(column)).startswith("OBJECT<")


def variant_schema(df: DataFrame, column: str) -> str | None:
    """Schema of all JSON objects of a column together, found in one aggregate; nothing if there is none with a field."""
    found = df.where(_is_object(column)).agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return None
    return re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", found))


def _spread(schema: StructType, base: Column, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], Column]]:
    found = []
    for field in schema.fields:
        here, value = (*prefix, field.name), base.getField(field.name)
        found += _spread(field.dataType, value, here) if isinstance(field.dataType, StructType) else [(here, value)]
    return found


def flatten_json(df: DataFrame, column: str, explode: str | None = None, separator: str = "_") -> DataFrame:
    """JSON texts of unknown layout as a table: the other columns, then one per path, objects of any depth spread.

    ``explode`` names the path of one array (joined by ``separator``); it becomes rows, an element's fields columns below
    the path, its place ``<path>_at``, and a text with an empty or no array keeps one row. Other arrays stay arrays. A field
    that has several types in the texts takes the type that holds them all, in the end a variant. Texts that are no JSON
    objects, and missing fields, give nulls. Where two paths join to one name, whatever the case, later ones in the order
    of the schema get ``_2``, ``_3`` and so on; columns beside ``column`` come first and keep their names.
    """
    rest, layout = [c for c in df.columns if c != column], variant_schema(df, column)
    if layout is None:
        return df.select(*rest)
    rows = df.select(*rest, F.when(_is_object(column), F.try_variant_get(F.try_parse_json(column), "$", layout)).alias("_json"))
    leaves = _spread(rows.schema["_json"].dataType, F.col("_json"))
    if explode is not None:
        path, array = next((p, c) for p, c in leaves if separator.join(p) == explode)
        rows = rows.select("*", F.posexplode_outer(array).alias("_at", "_element"))
        kind = rows.schema["_element"].dataType
        inner = _spread(kind, F.col("_element"), path) if isinstance(kind, StructType) else [(path, F.col("_element"))]
        place = leaves.index(next(x for x in leaves if x[0] == path))
        leaves[place:place + 1] = [((*path, "at"), F.col("_at")), *inner]
    taken, columns = {c.lower() for c in rest}, [F.col(c) for c in rest]
    for path, value in leaves:
        name = plain = separator.join(path)
        number = 1
        while name.lower() in taken:
            number += 1
            name = f"{plain}_{number}"
        taken.add(name.lower())
        columns.append(value.alias(name))
    return rows.select(*columns)


@dataclass(frozen=True)
class Source:
    """One place a dataset can be read from."""

    name: str
    format: str
    path: str
    schema: str | None = None

    def load(self, spark: SparkSession) -> DataFrame:
        if self.format == "csv":
            return read_csv(spark, self.path, self.schema) if self.schema else read_inferred_csv(spark, self.path)
        if self.format == "json":
            return flatten(read_json(spark, self.path, self.schema, multi_line=True))
        return read_parquet(spark, self.path)


def read_first_available(spark: SparkSession, candidates: Sequence[Source], min_rows: int,
                         on_fallback=None) -> tuple[DataFrame, Source]:
    """First candidate that can be read and holds at least ``min_rows`` rows.

    The last one is taken as it is.  ``on_fallback(source, reason)`` is told about
    each candidate passed over.
    """
    for source in candidates[:-1]:
        try:
            df = source.load(spark)
            if df.columns == ["_corrupt_record"]:
                reason = "no readable record"
            elif has_at_least(df, min_rows):
                return df, source
            else:
                reason = f"fewer than {min_rows} rows"
        except (PySparkException, Py4JJavaError) as error:
            reason = (error.getCondition() if isinstance(error, PySparkException) else None) or "unreadable"
        if on_fallback:
            on_fallback(source, reason)
    return candidates[-1].load(spark), candidates[-1]


def present_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Non-empty files below a folder with their sizes; content is never read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True).load(folder).select("path", "length"))


def missing_entries(expected: DataFrame, files: DataFrame, pattern: str, name: str = "name") -> DataFrame:
    """Expected names that no present file carries; ``pattern`` extracts the name from a path."""
    found = files.select(F.regexp_extract("path", pattern, 1).alias(name)).distinct()
    return expected.join(found, name, "left_anti")


def require_present(missing: DataFrame, name: str = "name") -> None:
    """Stop when anything is missing, naming every missing file (a list of expected files fits the driver)."""
    names = [r[0] for r in missing.orderBy(name).collect()]
    if names:
        raise FileNotFoundError("missing source files: " + ", ".join(names))
