"""File sources: pinned schemas, incremental discovery, rescued fields, evolving columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


RESCUED = "_rescued_data"


def sample_schema(spark: SparkSession, path: str, fmt: str, hints: str | None = None, **options) -> T.StructType:
    """Infer a schema from all files present; `hints` is DDL that overrides or adds columns.

    Pass the result to `read` or `stream`, so that inference runs once.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("inferSchema", True)
    inferred = reader.load(path).schema
    if hints is None:
        return inferred
    fixed = {f.name: f for f in T.StructType.fromDDL(hints)}
    fields = [fixed.pop(f.name, f) for f in inferred]
    return T.StructType(fields + list(fixed.values()))


def read(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None, rescued: bool = False,
         **options) -> DataFrame:
    """Batch scan; a parquet schema may be left out, since its files carry one.

    With `rescued`, JSON and CSV rows have a last column ``_rescued_data`` with what does not fit the schema (see `_rescuing`).
    """
    if rescued:
        return _rescuing(spark.read, path, fmt, schema, options)
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def stream(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str, rescued: bool = False, **options) -> DataFrame:
    """New files of a folder, each exactly once under the query's checkpoint; `rescued` as in `read`."""
    if rescued:
        return _rescuing(spark.readStream, path, fmt, schema, options)
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def _rescuing(reader, path: str, fmt: str, schema: T.StructType | str | None, options: dict) -> DataFrame:
    """JSON lines through `rescue`; CSV rows with a value that does not convert, or too few or many values, keep their whole line.

    CSV columns go by position, so a file with other names in its header but as many columns is not noticed.
    """
    if fmt not in ("json", "csv") or schema is None or str(options.get("multiLine", False)).lower() == "true":
        raise ValueError("rescued needs JSON or CSV with one record a line, and a schema")
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if fmt == "json":
        lines = reader.format("text").options(**options).load(path).select("value").where(F.col("value").rlike(r"\S"))
        return rescue(lines, schema, options=options)
    whole = T.StructType([*schema, T.StructField(RESCUED, T.StringType())])
    # Without pruning, as values of columns that a query leaves out are not parsed and so never found wrong.
    return reader.format("csv").schema(whole).options(**options, columnNameOfCorruptRecord=RESCUED, columnPruning=False).load(path)


def with_file_name(df: DataFrame, name: str = "source_file_name") -> DataFrame:
    """The base name of the file each row came from."""
    return df.select("*", F.col("_metadata.file_name").alias(name))


def rescue(lines: DataFrame, schema: T.StructType, line: str = "value", options: dict | None = None) -> DataFrame:
    """Parse JSON lines into `schema`; whatever does not fit goes to ``_rescued_data`` as JSON.

    Rescued are fields outside the schema and fields whose value does not convert to the declared type, at any depth: of a
    struct the fields concerned, of an array or map that holds one, all of it. A line that is not one JSON object is kept whole.
    Works on batch and streaming text.
    """
    typed = lines.withColumn("_typed", F.from_json(line, schema, options or {}))
    # As the only element of an array, so that text after the object is noticed.
    objects = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<map<string,string>>")
    parsed = F.when(F.size(objects) == 1, F.get(objects, F.lit(0)))
    rest = F.when(parsed.isNull() & F.col(line).rlike(r"\S"), F.col(line)).otherwise(_rest_of_struct(parsed, F.col("_typed"), schema))
    others = [c for c in lines.columns if c != line]
    return typed.select(*others, "_typed.*", rest.alias(RESCUED))


def _rest_of_struct(parsed: Column, typed: Column, kind: T.StructType) -> Column:
    """The entries of `parsed` (name to JSON text) that `typed` lacks, as JSON; null if there are none."""

    def rest(name, raw):
        lost = raw
        for f in kind:
            lost = F.when(name == f.name, _rest(raw, typed.getField(f.name), f.dataType)).otherwise(lost)
        return lost

    left_over = F.map_filter(F.transform_values(parsed, rest), lambda _, v: v.isNotNull())
    return F.when(F.size(left_over) > 0, F.to_json(left_over))


def _rest(raw: Column, typed: Column, kind: T.DataType) -> Column:
    """What of the JSON text `raw` is missing in `typed`; null if nothing is."""
    if isinstance(kind, T.StructType):
        inner = _rest_of_struct(F.from_json(raw, "map<string,string>"), typed, kind)
    elif isinstance(kind, T.ArrayType):
        each = F.transform(F.from_json(raw, "array<string>"), lambda v, i: _rest(v, F.get(typed, i), kind.elementType))
        inner = F.when(F.exists(each, lambda v: v.isNotNull()), raw)
    elif isinstance(kind, T.MapType):
        each = F.transform_values(F.from_json(raw, "map<string,string>"), lambda k, v: _rest(v, F.try_element_at(typed, k), kind.valueType))
        inner = F.when(F.exists(F.map_values(each), lambda v: v.isNotNull()), raw)
    else:
        inner = F.lit(None).cast("string")
    return F.when(typed.isNull(), raw).otherwise(inner)


def from_generations(df: DataFrame, columns: list[str], rescued_paths: list[str]) -> Column:
    """One value out of several schema generations: declared columns first, then rescued JSON paths."""
    return F.coalesce(*[F.col(c) for c in columns],
                      *[F.get_json_object(RESCUED, p) for p in rescued_paths])


def ensure_columns(df: DataFrame, columns: str) -> DataFrame:
    """Add the columns of a DDL list that `df` lacks, as typed nulls."""
    missing = [f for f in T.StructType.fromDDL(columns) if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def union_evolved(parts: list[DataFrame]) -> DataFrame:
    """Union by name; rows from before a column existed carry null in it."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def append_flow(sources: dict[str, DataFrame], tag: str = "_flow") -> DataFrame:
    """Several sources into one target, each row tagged with the name of its flow."""
    return union_evolved([df.withColumn(tag, F.lit(name)) for name, df in sources.items()])
