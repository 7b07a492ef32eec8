"""Sources and sinks: written in one form, read back through the library."""

from __future__ import annotations

import hashlib
import io
import itertools
import tarfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import workspace
from strata.functions import clean
from strata.operators import quality
from strata.plans.registry import query
from strata.sources import archives, evolving, files, messages, onboarding, sinks
from strata.sources.storage import store_of
from strata.streaming import runner
from strata.tables import SCHEMAS, table, table_stream

K = "CAST(get_json_object(props, '$.k') AS INT)"
SQL_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _land(df: DataFrame, label: str, fmt: str, **options) -> str:
    """Write `df` as raw files under the shared workspace."""
    return sinks.write(df, workspace.new_dir(df.sparkSession, label), fmt=fmt, **options)


@query("SELECT * FROM customer")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer")


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _land(table(spark, sf_dir, "customer"), "json", "json")
    return files.read(spark, path, "json", files.sample_schema(spark, path, "json"))


@query("SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _land(table(spark, sf_dir, "customer"), "csv", "csv", header=True)
    schema = files.sample_schema(spark, path, "csv", hints="c_custkey INT, c_nationkey INT, c_acctbal DOUBLE", header=True)
    return files.read(spark, path, "csv", schema, header=True)


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_multiline_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    pretty = table(spark, sf_dir, "customer").select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
    path = _land(pretty.mapInPandas(_documents, "value STRING"), "documents", "text", maxRecordsPerFile=1)
    schema = files.sample_schema(spark, path, "json", multiLine=True)
    return files.read(spark, path, "json", schema, multiLine=True)


def _documents(batches):
    """One JSON document, an array over many lines, per batch of records."""
    import pandas as pd

    for batch in batches:
        yield pd.DataFrame({"value": ["[" + ",\n".join(batch["value"]) + "]"]})


@query("SELECT event_id, 'events.parquet' AS source_file_name FROM events")
def file_metadata_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.with_file_name(table(spark, sf_dir, "events").select("event_id", "_metadata")).drop("_metadata")


@query(f"""SELECT event_id, event_type AS action_name, '{{"k":' || {SQL_K} || '}}' AS request_params FROM events""")
def schema_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type AS action_name", f"named_struct('k', {K}) AS request_params")
    path = _land(raw, "audit", "json")
    schema = files.sample_schema(spark, path, "json", hints="request_params STRING")
    return files.read(spark, path, "json", schema)


@query("SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS op, CAST(NULL AS INTEGER) AS loyalty_segment FROM customer")
def ensure_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return files.ensure_columns(rows, "c_name STRING, op STRING, loyalty_segment INT")


@query("""SELECT o_orderkey, o_totalprice,
                 CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority
          FROM orders""")
def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, cut = table(spark, sf_dir, "orders"), F.lit("1998-01-01").cast("timestamp")
    before = orders.where(F.col("o_orderdate") < cut).select("o_orderkey", "o_totalprice")
    after = orders.where(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderpriority", "o_totalprice")
    return files.union_evolved([before, after])


@query("""SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, 'customers' AS flow FROM customer
          UNION ALL SELECT s_name, s_nationkey, s_acctbal, 'suppliers' FROM supplier""")
def append_flow_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def parties(name: str, prefix: str) -> DataFrame:
        return table(spark, sf_dir, name).selectExpr(
            *[f"{prefix}_{c} AS {c}" for c in ("name", "nationkey", "acctbal")])

    return files.append_flow({"customers": parties("customer", "c"), "suppliers": parties("supplier", "s")}, "flow")


@query("SELECT event_id, user_id, value, event_type FROM events WHERE event_type = 'purchase'")
def partitioned_write_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    path = sinks.write(events, workspace.new_dir(spark, "by-type"), partition_by=["event_type"])
    return sinks.branch(spark, path, "event_type", "purchase", events.schema)


@query("""SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
          FROM events GROUP BY event_type""")
def fanout_by_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    path = sinks.fan_out(events.select("event_id", "value", "event_type"),
                         workspace.new_dir(spark, "fan-out"), "event_type")
    return (spark.read.schema("event_id BIGINT, value DOUBLE, event_type STRING").parquet(path)
            .groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")))


@query("""SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
                 CASE WHEN event_type = 'error' THEN '{"value":"n/a","status":"error"}' END AS _rescued_data
          FROM events""")
def rescued_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.to_json(F.struct("event_id", F.lit("n/a").alias("value"), F.col("event_type").alias("status")))
    good = F.to_json(F.struct("event_id", "value"))
    lines = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", bad).otherwise(good).alias("value"))
    return files.rescue(lines, T.StructType.fromDDL("event_id BIGINT, value DOUBLE"))


_TYPE_LENGTH = "CAST(length(event_type) AS BIGINT)"


@query(f"""SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS amount,
                  CASE WHEN event_type = 'error' THEN 'n/a' END AS lost_amount, {_TYPE_LENGTH} AS note_length,
                  event_type AS first_tag, CAST(user_id AS VARCHAR) AS second_tag
           FROM events""")
def rescued_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents over many lines; what their schema does not know is read by path from the nested rest."""
    amount = F.when(F.col("event_type") == "error", F.lit('"n/a"')).otherwise(F.col("value").cast("string"))
    rest = F.to_json(F.struct(F.length("event_type").alias("length"), F.array("event_type", F.col("user_id").cast("string")).alias("tags")))
    pretty = table(spark, sf_dir, "events").select(F.concat(
        F.lit('{"event_id":\n'), "event_id", F.lit(',\n"detail": {"amount":'), amount, F.lit(',\n"note":'), rest, F.lit("}}")).alias("value"))
    path = _land(pretty.mapInPandas(_documents, "value STRING"), "nested", "text", maxRecordsPerFile=1)
    schema = T.StructType.fromDDL("event_id BIGINT, detail STRUCT<amount: DOUBLE>")
    rows = evolving.rescue(evolving.documents(spark.read, path), schema, record="record")

    def rescued(at: str, kind: str):
        return F.try_variant_get(files.RESCUED, f"$.detail.{at}", kind)

    return rows.select("event_id", "detail.amount", rescued("amount", "string").alias("lost_amount"),
                       rescued("note.length", "bigint").alias("note_length"), rescued("note.tags[0]", "string").alias("first_tag"),
                       rescued("note.tags[1]", "string").alias("second_tag"))


_SECOND, _THIRD = "2024-01-10", "2024-01-20"


@query(f"""SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
                  CASE WHEN ts >= TIMESTAMP '{_SECOND}' THEN user_id END AS user_id,
                  CASE WHEN ts >= TIMESTAMP '{_SECOND}' THEN {SQL_K} END AS k,
                  CASE WHEN ts >= TIMESTAMP '{_THIRD}' THEN event_type END AS label,
                  CASE WHEN event_type = 'error' THEN 'n/a' END AS lost_value
           FROM events""")
def stream_late_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON stream over files of three generations: each adds columns, the last one inside a struct, while the stream runs."""
    events = table(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "error", F.lit("n/a").cast("variant")).otherwise(F.col("value").cast("variant"))
    first = [F.col("event_id"), value.alias("value")]
    second = [*first, F.col("user_id"), F.struct(F.expr(K).alias("k")).alias("props")]
    third = [*first, F.col("user_id"), F.struct(F.expr(K).alias("k"), F.col("event_type").alias("label")).alias("props")]
    base = workspace.new_dir(spark, "generations")
    ingest = evolving.Ingest(spark, f"{base}/landing/*", "json", f"{base}/bronze", f"{base}/checkpoint", hints="event_id BIGINT, value DOUBLE")
    cuts = [("0001-01-01", _SECOND, first), (_SECOND, _THIRD, second), (_THIRD, "9999-01-01", third)]
    for i, (since, until, columns) in enumerate(cuts):
        some = events.where((F.col("ts") >= F.lit(since).cast("timestamp")) & (F.col("ts") < F.lit(until).cast("timestamp")))
        sinks.write(some.select(*columns), f"{base}/landing/{i}", fmt="json")
        ingest.run()
    rows = files.ensure_columns(ingest.read(), "user_id BIGINT, props STRUCT<k: BIGINT, label: STRING>")
    return rows.select("event_id", "value", "user_id", F.col("props.k").cast("int").alias("k"), "props.label",
                       F.try_variant_get(files.RESCUED, "$.value", "string").alias("lost_value"))


@query("""SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal,
                 CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment, FALSE AS rescued FROM customer""")
def stream_late_csv_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV stream over files whose headers have other columns in another order."""
    customers = table(spark, sf_dir, "customer")
    base = workspace.new_dir(spark, "headers")
    ingest = evolving.Ingest(spark, f"{base}/landing/*", "csv", f"{base}/bronze", f"{base}/checkpoint",
                             hints="c_custkey BIGINT, c_acctbal DOUBLE")
    for i, columns in enumerate((["c_custkey", "c_name", "c_acctbal"], ["c_mktsegment", "c_name", "c_custkey"])):
        sinks.write(customers.where(F.col("c_custkey") % 2 == i).select(*columns), f"{base}/landing/{i}", fmt="csv", header=True)
    ingest.run()
    return ingest.read().select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", F.col(files.RESCUED).isNotNull().alias("rescued"))


def _generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case reports in two column generations, resolved through the rescue column."""
    events = table(spark, sf_dir, "events")
    first = F.to_json(F.struct("event_id", F.col("event_type").alias("Country/Region"), F.col("user_id").alias("confirmed"),
                               F.col("user_id").alias("Latitude")))
    second = F.to_json(F.struct("event_id", F.col("event_type").alias("Country_Region"), F.col("user_id").alias("confirmed"),
                                F.col("user_id").alias("Lat")))
    cut = F.lit("2024-01-15").cast("timestamp")
    lines = events.select(F.when(F.col("ts") < cut, first).otherwise(second).alias("value"),
                          F.concat(F.date_format("ts", "MM-dd-yyyy"), F.lit(".json")).alias("source_file_name"))
    rows = files.rescue(lines, T.StructType.fromDDL("event_id BIGINT, `Country/Region` STRING, confirmed BIGINT"))
    cleansed = rows.select(
        "event_id", files.from_generations(rows, ["`Country/Region`"], ["$.Country_Region"]).alias("country_region"),
        files.from_generations(rows, [], ["$.Latitude", "$.Lat"]).alias("lat"), "confirmed",
        clean.date_in_file_name("source_file_name", r"(\d{2}-\d{2}-\d{4})", "MM-dd-yyyy").alias("curr_date"))
    return quality.expect(cleansed, [quality.Rule("valid_confirmed", "confirmed IS NOT NULL", "drop")])


_GENERATIONS_SQL = """SELECT event_id, event_type AS country_region, CAST(user_id AS VARCHAR) AS lat,
                             user_id AS confirmed, strftime(ts, '%Y-%m-%d') AS curr_date FROM events"""


@query(_GENERATIONS_SQL)
def coalesce_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generations(spark, sf_dir).withColumn("curr_date", F.col("curr_date").cast("string"))


@query(_GENERATIONS_SQL + " WHERE event_type = 'signup'")
def filter_covid_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coalesce_generations(spark, sf_dir).where("country_region = 'signup'")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


_MESSAGE = "event_id BIGINT, event_type STRING, value DOUBLE"
_MESSAGE_SQL = """SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(ts) AS broker_us, event_id, event_type, value
                  FROM events"""


def _decoded(events: DataFrame) -> DataFrame:
    sent = messages.encode(events, "user_id", ["event_id", "event_type", "value"], "ts")
    return (messages.decode(sent, _MESSAGE, keep=["key", "timestamp"])
            .withColumn("broker_us", F.unix_micros("timestamp")).drop("timestamp"))


@query(_MESSAGE_SQL)
def kafka_encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(table(spark, sf_dir, "events"))


@query(_MESSAGE_SQL)
def message_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner.appended(_decoded(table_stream(spark, sf_dir, "events")), "decoded")


@query("SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_us, strftime(ts, '%Y-%m-%d') AS date FROM events")
def stream_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value",
                                                F.unix_micros("ts").alias("ts_us"))
    path = _land(raw, "landing", "json")
    schema = files.sample_schema(spark, path, "json")
    dated = files.stream(spark, path, "json", schema).withColumn("date", F.to_date(F.timestamp_micros("ts_us")))
    bronze = runner.appended(dated, "bronze", partition_by=["date"])
    return bronze.withColumn("date", F.col("date").cast("string"))


@query("""SELECT c_name AS name, c_nationkey AS nationkey, 'customers' AS flow FROM customer
          UNION ALL SELECT s_name, s_nationkey, 'suppliers' FROM supplier""")
def stream_append_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams into one bronze table, each with its own checkpoint."""
    flows = {label: table_stream(spark, sf_dir, name).selectExpr(f"{prefix}_name AS name", f"{prefix}_nationkey AS nationkey")
             for label, name, prefix in (("customers", "customer", "c"), ("suppliers", "supplier", "s"))}
    base = workspace.new_dir(spark, "append-flow")
    for started in runner.append_flows(flows, f"{base}/table", f"{base}/checkpoints"):
        runner.finish(started)
    return runner.read_flows(spark, f"{base}/table", flows["customers"].schema, list(flows), "flow")


@query("""SELECT user_id, CAST(floor(value) AS INTEGER) AS bpm, event_type AS model FROM events
          WHERE floor(value) > 0 AND event_type <> 'error'""")
def tracker_cleansed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded tracker messages under several drop rules; errors play the undefined model."""
    events = table(spark, sf_dir, "events").selectExpr(
        "user_id", "CAST(floor(value) AS INT) AS heart_bpm", "CASE WHEN event_type = 'error' THEN 'undef' ELSE event_type END AS model",
        "CAST(ts AS STRING) AS time", "ts")
    sent = messages.encode(events, "user_id", ["user_id", "heart_bpm", "model", "time"], "ts")
    decoded = messages.decode(sent, "user_id BIGINT, heart_bpm INT, model STRING, time TIMESTAMP")
    rules = [quality.Rule("heart rate is set", "bpm IS NOT NULL", "drop"), quality.Rule("event time is set", "time IS NOT NULL", "drop"),
             quality.Rule("human has pulse >0", "bpm > 0", "drop"), quality.Rule("tracker is valid", "model <> 'undef'", "drop")]
    return quality.expect(decoded.withColumnRenamed("heart_bpm", "bpm"), rules).select("user_id", "bpm", "model")


@query("""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS Op,
                 TRUE AS has_file_name FROM customer""")
def stream_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _land(table(spark, sf_dir, "customer"), "full-load", "csv", header=True)
    feed = files.with_file_name(files.stream(spark, path, "csv", SCHEMAS["customer"], header=True), "_file")
    rows = runner.appended(files.ensure_columns(feed, "Op STRING"), "csv-bronze")
    return rows.withColumn("has_file_name", F.col("_file").endswith(".csv")).drop("_file")


@query("""SELECT user_id, event_type, value, ts_us FROM
            (SELECT user_id, event_type, value, epoch_us(ts) AS ts_us,
                    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r
             FROM events WHERE value >= 5.0 AND event_type IS NOT NULL)
          WHERE r = 1 AND event_type <> 'error'""")
def metadata_driven_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [
        onboarding.Spec("bronze", "events", ["user_id", "event_type", "value", "ts"]),
        onboarding.Spec("silver", "bronze", rules=[quality.Rule("enough", "value >= 5.0", "drop"),
                                                   quality.Rule("typed", "event_type IS NOT NULL", "drop")],
                        keys=["user_id"], sequence_by="ts", deletes="event_type = 'error'"),
        onboarding.Spec("gold", "silver", ["user_id", "event_type", "value", "unix_micros(ts) AS ts_us"]),
    ]
    return onboarding.build(specs, lambda name: table(spark, sf_dir, name))["gold"].data


@query("""SELECT page_id, split_part(url, '/', 3) AS bucket_name,
                 substr(url, length(split_part(url, '/', 1)) + length(split_part(url, '/', 3)) + 4) AS source_key
          FROM pages""")
def path_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.split_path(table(spark, sf_dir, "pages").select("page_id", "url"), "url").drop("url")


@query("""SELECT event_id, CAST(user_id AS VARCHAR) AS station_id, strftime(ts, '%Y-%m-%d') AS file_date FROM events""")
def filename_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("weather_info_"), F.date_format("ts", "yyyyMMdd"), F.lit("_station_"), "user_id", F.lit(".json"))
    return (table(spark, sf_dir, "events").select("event_id", name.alias("name"))
            .select("event_id", clean.key_in_file_name("name").alias("station_id"),
                    clean.date_in_file_name("name", r"_(\d{8})_", "yyyyMMdd").cast("string").alias("file_date")))


_ITEMS = """SELECT conv_id, turn, CAST(i AS BIGINT) AS row_id,
                   CASE i WHEN 0 THEN '{"name":"role","text":"' || role || '"}'
                          ELSE '{"name":"size","text":"' || length(text) || '"}' END AS item
            FROM conversations, (VALUES (0), (1)) AS v(i)"""


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    def entry(name: str, text) -> F.Column:
        return F.struct(F.lit(name).alias("name"), text.cast("string").alias("text"))

    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat_ws(":", "conv_id", "turn").alias("id"),
        F.array(entry("role", F.col("role")), entry("size", F.length("text"))).alias("items"))


def _split_id(rows: DataFrame) -> DataFrame:
    part = F.split("id", ":")
    return rows.select(part[0].cast("bigint").alias("conv_id"), part[1].cast("bigint").alias("turn"), "row_id", "item")


@query(_ITEMS)
def unpack_posexplode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_id(archives.unpack_list(_listed(spark, sf_dir), "id", "items"))


@query(_ITEMS)
def unpack_map_in_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_id(archives.unpack_list_in_pandas(_listed(spark, sf_dir), "id", "items"))


@query("""SELECT doc_id, md5(rtrim(text, E' \\t\\n\\r\\x0b\\x0c')) AS body_md5, CAST(NULL AS VARCHAR) AS error
          FROM documents""")
def untar_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), "text").mapInPandas(
        _pack, "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    return archives.unpack_archives(packed).select(*_mail_columns(), "error")


def _mail_columns() -> list[F.Column]:
    """Document id and digest of the text of a member that `_pack` made."""
    lines = F.split("body", "\n", 2)
    head = F.split(F.get(lines, F.lit(0)), ",")
    # Unpacking strips the end of a member, so a blank text has no second line.
    text = F.when(F.size(head) == 1, F.coalesce(F.get(lines, F.lit(1)), F.lit("")))
    return [F.nullif(F.get(head, F.lit(0)), F.lit("")).cast("bigint").alias("doc_id"), F.md5(text).alias("body_md5")]


def _add(archive: tarfile.TarFile, doc_id: str | None, text: str | None) -> None:
    """A mail-like member: the document id on the first line, with a comma if there is no text."""
    head = doc_id if isinstance(doc_id, str) else ""
    data = (f"{head}\n{text}" if isinstance(text, str) else f"{head},").encode()
    member = tarfile.TarInfo(f"{head}.eml")
    member.size = len(data)
    archive.addfile(member, io.BytesIO(data))


def _pack(batches):
    """Archives of a hundred members, ids as text: input for unpacking."""
    import pandas as pd

    for batch in batches:
        for start in range(0, len(batch), 100):
            part, buffer = batch.iloc[start:start + 100], io.BytesIO()
            with tarfile.open(fileobj=buffer, mode="w:gz", compresslevel=1) as archive:
                for doc_id, text in zip(part["doc_id"], part["text"]):
                    _add(archive, doc_id, text)
            content = buffer.getvalue()
            yield pd.DataFrame({"path": [f"mail/{part['doc_id'].iloc[0]}.tar.gz"],
                                "modificationTime": [pd.Timestamp("2024-01-01")],
                                "length": [len(content)], "content": [content]})


#: Stands for the lot in the name of the archive of documents without id.
_NO_LOT = "none"


def _lot_name(path: str) -> F.Column:
    """Name of an archive that `_mail` made, with nine characters of the lot; null for documents without id."""
    stem = F.regexp_extract(path, r"([^/]*)\.tar\.gz$", 1)
    return F.when(stem != _NO_LOT, F.concat(F.lpad(stem, 9, "0"), F.lit(".tar.gz")))


def _mail(spark: SparkSession, sf_dir: str) -> str:
    """A folder of archives of the documents of a hundred ids each, packed once for each table and shared folder."""
    path = f"{workspace.root(spark)}/strata/mail-{hashlib.md5(sf_dir.encode()).hexdigest()}"
    if not workspace.committed(spark, path):
        def pack(batches):
            # The rows of a lot follow each other and are written as they come, however many share an id or have none.
            rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
            for lot, group in itertools.groupby(rows, lambda row: row[0]):
                name = f"{path}/{_NO_LOT if lot is None else lot.rjust(9, '0')}.tar.gz"
                store, target = store_of(name)
                with store.open_output_stream(target, compression=None) as out, tarfile.open(fileobj=out, mode="w|gz", compresslevel=1) as archive:
                    for _, doc_id, text in group:
                        _add(archive, doc_id, text)
                yield pa.RecordBatch.from_pydict({"name": [name]})

        workspace.write_text(spark, f"{path}/_READ_ME", "archives of documents", replace=True)
        docs = table(spark, sf_dir, "documents").select(F.expr("doc_id DIV 100").cast("string").alias("lot"), "doc_id", "text")
        lots = docs.repartition("lot").sortWithinPartitions("lot", "doc_id").select("lot", F.col("doc_id").cast("string"), "text")
        lots.mapInArrow(pack, "name STRING").collect()
        workspace.write_text(spark, f"{path}/_SUCCESS", "")
    return path


@query("""SELECT lpad(CAST(doc_id // 100 AS VARCHAR), 9, '0') || '.tar.gz' AS name, TRUE AS has_length, 3 AS n_columns
          FROM documents GROUP BY ALL""")
def archive_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of stored archives that are listed, not opened."""
    listed = archives.archive_files(spark, _mail(spark, sf_dir), streaming=True, with_content=False)
    rows = runner.appended(listed, "listing")
    return rows.select(_lot_name("path").alias("name"), (F.col("length") > 100).alias("has_length"),
                       F.lit(len(rows.columns)).alias("n_columns"))


@query("""SELECT doc_id, md5(rtrim(text, E' \\t\\n\\r\\x0b\\x0c')) AS body_md5, CAST(NULL AS VARCHAR) AS error,
                 lpad(CAST(doc_id // 100 AS VARCHAR), 9, '0') || '.tar.gz' AS name FROM documents""")
def untar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of stored archives, which the tasks read as streams."""
    members = archives.unpack_stored(archives.archive_files(spark, _mail(spark, sf_dir), with_content=False))
    return members.select(*_mail_columns(), "error", _lot_name("path").alias("name"))
