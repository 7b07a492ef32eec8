"""File streams whose files gain columns while they run, and rescue of what fits no column, as structure.

`rescue` parses JSON records into a schema and keeps the rest in ``_rescued_data``, a VARIANT: nested rest keeps its shape,
so ``variant_get(_rescued_data, '$.a.b[0]', 'string')`` reaches it.

`Ingest` appends a folder of JSON or CSV files to a table. The schema lives in a log of its own beside the checkpoint. A batch
with fields outside the schema widens it, fails before it is committed and runs again under the wider schema; rows from before
read as null in the new columns. The shape of what does not fit comes with the write of the batch, as an observed aggregate, so a batch
without new fields is read once.
"""

from __future__ import annotations

import csv
import json
import re
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import workspace
from strata.sources.files import RESCUED
from strata.streaming.runner import _trigger

BATCH = "_batch"
#: Files of a CSV batch at most; their header lines are broadcast.
CSV_FILES = 1000


def record_of(line: str) -> Column:
    """The one JSON object of a line as VARIANT; null if the line is anything else, or repeats a key."""
    # As the only element of an array, so that text after the object is noticed.
    whole = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    first = F.try_variant_get(whole, "$[0]", "variant")
    alone = F.try_variant_get(whole, "$[1]", "variant").isNull()
    return F.when(alone & F.schema_of_variant(first).startswith("OBJECT<"), first)


def documents(reader, path: str, **options) -> DataFrame:
    """VARIANT column `record` of JSON documents over many lines, batch or streaming; an array is one record for each element."""
    whole = reader.format("json").options(**options, multiLine=True, singleVariantColumn="document").load(path)
    elements = F.coalesce(F.try_variant_get("document", "$", "array<variant>"), F.array("document"))
    return whole.select(F.explode(elements).alias("record"))


def rescue(rows: DataFrame, schema: T.StructType, line: str | None = "value", record: str | None = None) -> DataFrame:
    """Parse JSON into `schema`; ``_rescued_data`` holds as VARIANT what does not fit, null if all fits.

    The input is a text column `line`, one object each, or a VARIANT column `record`. Rescued are fields outside the schema and
    values that do not convert, at any depth and in their place; of an array or map that holds one, all of it. A line that
    is not one object, or repeats a key, is kept whole, as a string. JSON nulls are not kept. Other columns stay.
    """
    if record is None:
        parsed, text, source = record_of(line), F.col(line), line
        whole = F.when(text.rlike(r"\S"), text.cast("variant"))
    else:
        is_object = F.schema_of_variant(record).startswith("OBJECT<")
        parsed, text, source = F.when(is_object, F.col(record)), F.to_json(record), record
        whole = F.when(~F.is_variant_null(record), F.col(record))
    typed = rows.withColumns({"_typed": F.from_json(text, schema), "_record": parsed})
    rest = F.when(F.col("_record").isNull(), whole).otherwise(_rest_of_struct(F.col("_record"), F.col("_typed"), schema))
    return typed.select(*[c for c in rows.columns if c != source], "_typed.*", rest.alias(RESCUED))


def _entries(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _rest_of_struct(value: Column, typed: Column, kind: T.StructType) -> Column:
    """The entries of an object that `typed` lacks, as an object; null if there are none."""

    def rest(name, raw):
        lost = raw
        for f in kind:
            lost = F.when(name == f.name, _rest(raw, typed.getField(f.name), f.dataType)).otherwise(lost)
        return F.when(~F.is_variant_null(raw), lost)

    left = F.map_filter(F.transform_values(_entries(value), rest), lambda _, v: v.isNotNull())
    return F.when(F.size(left) > 0, F.to_variant_object(left))


def _rest(raw: Column, typed: Column, kind: T.DataType) -> Column:
    """What of the VARIANT `raw` is missing in `typed`; null if nothing is."""
    if isinstance(kind, T.StructType):
        inner = _rest_of_struct(raw, typed, kind)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)):
        each = F.transform(F.try_variant_get(raw, "$", "array<variant>"), lambda v, i: _rest(v, F.get(typed, i), kind.elementType))
        inner = F.when(F.exists(each, lambda v: v.isNotNull()), raw)
    elif isinstance(kind, T.ArrayType):
        lost = F.transform(F.try_variant_get(raw, "$", "array<variant>"), lambda v, i: ~F.is_variant_null(v) & F.get(typed, i).isNull())
        inner = F.when(F.exists(lost, lambda v: v), raw)
    elif isinstance(kind, T.MapType):
        each = F.transform_values(_entries(raw), lambda k, v: _rest(v, F.try_element_at(typed, k), kind.valueType))
        inner = F.when(F.exists(F.map_values(each), lambda v: v.isNotNull()), raw)
    else:
        inner = F.lit(None).cast("variant")
    return F.when(typed.isNull() & ~F.is_variant_null(raw), raw).otherwise(inner)


def shape(column: str = RESCUED) -> Column:
    """Aggregate: the shape of all objects in a VARIANT column, as text; null without any."""
    found = F.schema_of_variant_agg(F.when(F.schema_of_variant(column).startswith("OBJECT<"), F.col(column)))
    return F.nullif(found, F.lit("VOID"))


def columns_of(found: str | None) -> T.StructType:
    """Columns for a shape: whole numbers that outgrow BIGINT become decimals, mixed types stay VARIANT.

    Values that are always null, and objects without fields, have no column.
    """
    if not found or not found.startswith("OBJECT<"):
        return T.StructType()
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    return _plain(T.DataType.fromDDL(ddl)) or T.StructType()


def _plain(kind: T.DataType) -> T.DataType | None:
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, plain) for f in kind if (plain := _plain(f.dataType)) is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        element = _plain(kind.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.DecimalType(38, 0)
    return None if isinstance(kind, T.NullType) else kind


def widen(known: T.DataType, found: T.DataType) -> T.DataType:
    """`known` with the fields that only `found` has, at any depth; the type of a known value never changes."""
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        other = {f.name: f.dataType for f in found}
        old = [T.StructField(f.name, widen(f.dataType, other[f.name]) if f.name in other else f.dataType) for f in known]
        names = {f.name.lower() for f in known}
        new = {f.name.lower(): f for f in reversed(list(found)) if f.name.lower() not in names}
        return T.StructType(old + list(reversed(new.values())))
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(widen(known.elementType, found.elementType))
    return known


def header_lines(lines: DataFrame) -> DataFrame:
    """_file, _header (its first line) and _first (that line's number in `lines`) of each file; lines have value, _file and _start."""
    numbered = lines.withColumn("_row", F.monotonically_increasing_id()).where("_start = 0")
    return numbered.groupBy("_file").agg(F.min_by("value", "_row").alias("_header"), F.min("_row").alias("_first"))


def layouts_of(headers: DataFrame) -> list[str]:
    """The different header lines, in order; there are at most as many as files in a batch."""
    return sorted(r["_header"] for r in headers.select("_header").distinct().collect())


def names_of(header: str, options: dict) -> list[str]:
    """The column names of a header line."""
    return next(csv.reader([header], delimiter=options.get("sep", ","), quotechar=options.get("quote", '"')))


def by_header(lines: DataFrame, headers: DataFrame, schema: T.StructType, options: dict) -> DataFrame:
    """CSV lines under the header of their own file, by name; columns a file lacks are null.

    A line with a value that does not convert, or with too few or many values, is kept whole in ``_rescued_data``, as a string.
    """
    kinds = {f.name.lower(): f for f in schema}
    layouts = layouts_of(headers)

    def parse(header: str) -> Column:
        names = names_of(header, options)
        own = T.StructType([T.StructField(n, kinds[n.lower()].dataType) for n in names] + [T.StructField(RESCUED, T.StringType())])
        parsed = F.from_csv("value", own.toDDL(), {**options, "columnNameOfCorruptRecord": RESCUED})
        have = {n.lower(): n for n in names}

        def place(row: Column) -> Column:
            columns = [(row.getField(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema]
            return F.struct(*columns, row.getField(RESCUED).cast("variant").alias(RESCUED))

        # An array of one, so that the line is parsed once for all its columns.
        return F.get(F.transform(F.array(parsed), place), F.lit(0))

    numbered = lines.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(headers), "_file")
    data = numbered.where((F.col("_row") != F.col("_first")) & F.col("value").rlike(r"\S"))
    return data.select(F.coalesce(*[F.when(F.col("_header") == h, parse(h)) for h in layouts]).alias("row")).select("row.*")


@dataclass(frozen=True)
class SchemaLog:
    """Numbered versions of a schema in a folder; a version is written once and never changed."""

    spark: SparkSession
    path: str

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in workspace.child_files(self.spark, self.path)]

    def current(self) -> T.StructType:
        """The newest version that was written to its end; no columns before the first."""
        for version in sorted(self.versions(), reverse=True):
            try:
                return T.StructType.fromJson(json.loads(workspace.read_text(self.spark, f"{self.path}/{version:08d}.json")))
            except ValueError:
                continue
        return T.StructType()

    def add(self, schema: T.StructType) -> None:
        version = max(self.versions(), default=-1) + 1
        workspace.write_text(self.spark, f"{self.path}/{version:08d}.json", json.dumps(schema.jsonValue()))


@dataclass
class Ingest:
    """A folder of files appended to the table folder `target`, whose columns follow the files.

    `fmt` is ``json`` (lines, or whole documents with ``multiLine``) or ``csv`` (a header in each file, columns by name, one
    record a line). `hints` is DDL of columns whose type is fixed. Every batch is one partition of the table, replaced as a whole when it
    runs again.
    """

    spark: SparkSession
    path: str
    fmt: str
    target: str
    checkpoint: str
    hints: str = ""
    options: dict = field(default_factory=dict)

    @property
    def log(self) -> SchemaLog:
        return SchemaLog(self.spark, f"{self.checkpoint}-schemas")

    @property
    def schema(self) -> T.StructType:
        return widen(T.StructType.fromDDL(self.hints) if self.hints else T.StructType(), self.log.current())

    def _source(self) -> DataFrame:
        reader = self.spark.readStream.options(**self.options)
        if self.fmt == "csv":
            files = {"maxFilesPerTrigger": CSV_FILES, **self.options}
            return self.spark.readStream.options(**files).format("text").load(self.path).select(
                "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
        if str(self.options.get("multiLine", False)).lower() == "true":
            return documents(reader, self.path)
        return reader.format("text").load(self.path).select("value").where(F.col("value").rlike(r"\S"))

    def _step(self, batch: DataFrame, number: int, schema: T.StructType) -> None:
        """Store one batch under `schema`, or widen the log and fail."""
        if self.fmt == "csv":
            headers = header_lines(batch)
            layouts = [names_of(h, self.options) for h in layouts_of(headers)]
            wider = widen(schema, T.StructType([T.StructField(n, T.StringType()) for names in layouts for n in names]))
            if wider == schema:
                self._store(by_header(batch, headers, schema, self.options), number)
        else:
            seen = Observation(f"batch {number}")
            rows = rescue(batch, schema, record="record") if "record" in batch.columns else rescue(batch, schema)
            self._store(rows.observe(seen, shape().alias("shape")), number)
            wider = widen(schema, columns_of(seen.get["shape"]))
        if wider != schema:
            self.log.add(wider)
            raise RuntimeError(f"batch {number} has new columns: {wider.simpleString()}")

    def _store(self, rows: DataFrame, number: int) -> None:
        (rows.withColumn(BATCH, F.lit(number).cast("bigint")).write.mode("overwrite").partitionBy(BATCH)
         .option("partitionOverwriteMode", "dynamic").parquet(self.target))

    def run(self, every: str | None = None) -> None:
        """Process what is there, or continuously with `every`; restarts under the wider schema whenever it was widened."""
        while True:
            before, schema = self.log.versions(), self.schema
            query = (self._source().writeStream.option("checkpointLocation", self.checkpoint)
                     .foreachBatch(lambda batch, number: self._step(batch, number, schema)).trigger(**_trigger(every)).start())
            try:
                query.awaitTermination()
                return
            except StreamingQueryException:
                if self.log.versions() == before:
                    raise

    def read(self) -> DataFrame:
        """All rows under the newest schema, with ``_rescued_data``."""
        stored = T.StructType([*self.schema, T.StructField(RESCUED, T.VariantType())])
        if not workspace.exists(self.spark, self.target):
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(self.target).select(*[F.col(f"`{c}`") for c in stored.names])
