import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import session, workspace
from strata.functions import text
from strata.operators import aggregates, quality
from strata.sources import archives, catalog, files, messages, onboarding, sinks


def test_rescue_collects_unknown_and_mistyped_fields(spark, rows):
    lines = spark.createDataFrame([('{"id": 1, "n": 2.5, "tags": ["a"]}',), ('{"id": "x", "n": null, "more": {"z": 1}}',),
                                   ('{"id": 3, "n": "oops", "tags": "text"}',)], "value STRING")
    schema = T.StructType.fromDDL("id INT, n DOUBLE, tags ARRAY<STRING>")
    assert rows(files.rescue(lines, schema)) == sorted([
        (1, 2.5, ["a"], None), (None, None, None, '{"id":"x","more":"{\\"z\\":1}"}'),
        (3, None, None, '{"n":"oops","tags":"text"}')], key=str)


def test_rescue_keeps_corrupt_lines_and_nested_fields(spark, rows):
    schema = T.StructType.fromDDL("id INT, s STRUCT<a: INT, t: STRUCT<b: INT>>, l ARRAY<STRUCT<a: INT>>, m MAP<STRING, INT>")
    text = lambda **fields: json.dumps(fields, separators=(",", ":"))
    cases = [('{"id": 1, "s": {"a": 1, "t": {"b": 2}}, "l": [{"a": 1}], "m": {"k": 1}}', None), ("no json", "no json"), ("", None),
             ('{"id": 2, "s"', '{"id": 2, "s"'), ('[{"id": 3}]', '[{"id": 3}]'),
             ('{"id": 3} rest', '{"id": 3} rest'), ('{"id": 3}, {"id": 4}', '{"id": 3}, {"id": 4}'),
             ('{"id": 4, "s": {"a": "x", "t": {"b": 2}}}', text(s=text(a="x"))),
             ('{"id": 5, "s": {"a": 1, "t": {"b": 2, "c": 3}}}', text(s=text(t=text(c="3")))),
             ('{"id": 6, "l": [{"a": 1}, {"z": 2}]}', text(l='[{"a":1},{"z":2}]')), ('{"id": 7, "m": {"k": "x", "o": 1}}', text(m='{"k":"x","o":1}'))]
    lines = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i INT, value STRING")
    assert rows(files.rescue(lines, schema).select("i", "_rescued_data")) == sorted(((i, x) for i, (_, x) in enumerate(cases)), key=str)


def test_reads_and_streams_rescue(spark, rows, tmp_path):
    (tmp_path / "json").mkdir()
    (tmp_path / "csv").mkdir()
    (tmp_path / "json" / "a.json").write_text('{"id": 1}\n\n')
    (tmp_path / "json" / "b.json").write_text('{"id": 2, "late": "x"}\nbroken\n')
    (tmp_path / "csv" / "a.csv").write_text("id,n\n1,2\n")
    (tmp_path / "csv" / "b.csv").write_text("id,n,late\n2,3,x\n4,oops,y\n")
    expected = {"json": [(1, None), (2, '{"late":"x"}'), (None, "broken")],
                "csv": [(1, None), (2, "2,3,x"), (4, "4,oops,y")]}
    for fmt, schema in (("json", "id INT"), ("csv", "id INT, n INT")):
        options = {"header": True} if fmt == "csv" else {}
        path = str(tmp_path / fmt)
        assert rows(files.read(spark, path, fmt, schema, rescued=True, **options).select("id", "_rescued_data")) == sorted(expected[fmt], key=str)
        feed = files.stream(spark, path, fmt, schema, rescued=True, **options)
        feed.writeStream.format("memory").queryName(f"rescued_{fmt}").trigger(availableNow=True).option(
            "checkpointLocation", str(tmp_path / f"at-{fmt}")).start().awaitTermination()
        assert rows(spark.table(f"rescued_{fmt}").select("id", "_rescued_data")) == sorted(expected[fmt], key=str)


def test_hints_override_and_add_columns(spark):
    path = workspace.new_dir(spark, "hints")
    spark.createDataFrame([(1, "2")], "a INT, b STRING").write.json(path)
    schema = files.sample_schema(spark, path, "json", hints="a STRING, c DATE")
    assert schema.simpleString() == "struct<a:string,b:string,c:date>"


def test_schema_comes_from_all_files(spark):
    path = workspace.new_dir(spark, "many")
    spark.range(4).repartition(4).selectExpr("id", "1 AS n").write.json(path)
    spark.sql("SELECT 9 AS id, 12.5 AS n, 'late' AS extra").write.mode("append").json(path)
    schema = files.sample_schema(spark, path, "json")
    assert {f.name: f.dataType.simpleString() for f in schema} == {"id": "bigint", "n": "double", "extra": "string"}


def test_file_metadata_without_contents(spark):
    path = workspace.new_dir(spark, "binary")
    spark.range(10).coalesce(1).write.parquet(path)
    listed = archives.archive_files(spark, path, with_content=False)
    assert listed.columns == ["path", "modificationTime", "length"]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def tarball(members):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as archive:
        for name, body in members:
            entry = tarfile.TarInfo(name)
            entry.size = len(body)
            archive.addfile(entry, io.BytesIO(body))
    return buffer.getvalue()


@pytest.mark.parametrize("portion", [1, 1 << 20])
def test_unpack_archives(spark, monkeypatch, portion):
    monkeypatch.setattr(archives, "PORTION_BYTES", portion)
    good = tarball([("a.eml", b"first \n"), ("b.eml", b"second"), ("c.eml", "été".encode())])
    data = spark.createDataFrame([("s/x.tar.gz", good), ("s/bad.tar.gz", good[:40]), ("s/none.tar.gz", b"not an archive")],
                                 "path STRING, content BINARY")
    found = archives.unpack_archives(data.withColumn("modificationTime", F.current_timestamp())
                                     .withColumn("length", F.length("content").cast("bigint"))).collect()
    members = sorted((r.member_id, r.body) for r in found if r.error is None)
    assert members == [("s_x_tar_gz0", "first"), ("s_x_tar_gz1", "second"), ("s_x_tar_gz2", "été")]
    assert {r.path for r in found if r.error} == {"s/bad.tar.gz", "s/none.tar.gz"}


def test_stored_archives_are_read_by_the_tasks(spark, tmp_path):
    """Names that URIs escape, damaged files, an empty one; the listing itself opens nothing."""
    from strata.streaming import runner

    good = tarball([("a", b"one"), ("b", b"\xff"), ("c", b"two\n")])
    for name, content in (("x y%.tar.gz", good), ("cut.tar.gz", good[:40]), ("none.tar.gz", b"not an archive"), ("flip.tar.gz", good[:30] + b"\0" + good[31:]),
                          ("empty.tar.gz", b"")):
        (tmp_path / name).write_bytes(content)
    listed = archives.archive_files(spark, str(tmp_path), with_content=False)
    assert listed.columns == ["path", "modificationTime", "length"] and listed.count() == 4  # Spark lists no empty files
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    got = archives.unpack_stored(listed).collect()
    assert sorted((r.body, r.error is None) for r in got if "x y%" in r.path and r.body) == [("one", True), ("two", True)]
    assert {r.path.rsplit("/", 1)[1][:4] for r in got if r.error} >= {"x y%", "cut.", "none"} and {r.length for r in got if r.body == "one"} == {len(good)}
    base = str(tmp_path / "out")
    runner.finish(runner.append(archives.unpack_stored(archives.archive_files(spark, str(tmp_path / "*.gz"), streaming=True, with_content=False)),
                                base, f"{base}-check"))
    assert spark.read.parquet(base).count() == len(got)


def test_unpack_archives_as_a_stream_of_files(spark, tmp_path):
    from strata.streaming import runner

    for i in range(2):
        (tmp_path / f"{i}.tar.gz").write_bytes(tarball([(f"{n}.eml", f"mail {i} {n}".encode()) for n in range(3)]))
    members = archives.unpack_archives(archives.archive_files(spark, str(tmp_path), streaming=True))
    bodies = [r.body for r in runner.appended(members, "mail").collect()]
    assert sorted(bodies) == sorted(f"mail {i} {n}" for i in range(2) for n in range(3))


def test_split_path(spark, rows):
    data = spark.createDataFrame([("s3://bucket/a/b/c.tar.gz",)], "path STRING")
    assert rows(archives.split_path(data)) == [("s3://bucket/a/b/c.tar.gz", "bucket", "a/b/c.tar.gz")]


def test_lists_unpack_to_one_row_per_item(spark, rows):
    data = spark.createDataFrame([(i, [("apples", "1"), ("oranges", str(i))]) for i in range(3)],
                                 "id BIGINT, json_data ARRAY<STRUCT<fruit: STRING, qty: STRING>>")
    native = archives.unpack_list(data, "id", "json_data")
    assert native.count() == 6
    assert rows(native) == rows(archives.unpack_list_in_pandas(data, "id", "json_data"))


def test_envelopes(spark, rows):
    image = "STRUCT<id: INT, v: STRING>"
    schema = f"payload STRUCT<before: {image}, after: {image}, op: STRING>"
    sent = spark.createDataFrame([('{"payload":{"before":null,"after":{"id":1,"v":"a"},"op":"c"}}',),
                                  ('{"payload":{"before":{"id":1,"v":"a"},"after":null,"op":"d"}}',)], "value STRING")
    decoded = messages.decode(sent.withColumn("value", F.col("value").cast("binary")), schema, keep=[])
    assert rows(messages.unwrap_envelope(decoded)) == [(1, "a", "c"), (1, "a", "d")]


def test_partitions_are_pruned(spark):
    path = sinks.write(spark.range(100).withColumn("p", F.col("id") % 4), workspace.new_dir(spark, "parts"), partition_by=["p"])
    plan = spark.read.parquet(path).where("p = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    assert sinks.branch(spark, path, "p", "3").count() == 25


def test_filters_reach_the_scan(spark, sf_dir):
    from strata.tables import table

    df = quality.expect(table(spark, sf_dir, "events"), [quality.Rule("recent", "ts >= TIMESTAMP '2024-01-20'", "drop")])
    plan = df.select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp>" in plan


def test_specs_build_on_each_other(spark, rows):
    source = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 3, "c"), (2, 1, "D")], "id INT, seq INT, v STRING")
    built = onboarding.build([
        onboarding.Spec("clean", "raw", rules=[quality.Rule("id", "id IS NOT NULL", "drop")]),
        onboarding.Spec("target", "clean", keys=["id"], sequence_by="seq", deletes="v = 'D'", except_columns=["seq"]),
    ], {"raw": source}.__getitem__)
    assert rows(built["target"].data) == [(1, "b")]
    assert rows(built["clean"].quarantine) == [(None, 3, "c", ["id"])]


def test_catalog(spark):
    spark.range(1).createOrReplaceTempView("a_view_to_find")
    assert "default" in catalog.databases(spark, "def")
    assert "a_view_to_find" in catalog.tables(spark, "default")


def test_without_a_checkpoint_folder_the_warehouse_is_used():
    class Conf:
        def get(self, key, default=None):
            return "shared/warehouse/" if key == "spark.sql.warehouse.dir" else default

    class Session:
        conf = Conf()

    assert workspace.root(Session()).startswith("shared/warehouse/")


def test_recommended_settings(spark):
    for key, value in session.RECOMMENDED.items():
        assert spark.conf.get(key) == value


def test_incremental_statistics_equal_a_full_pass(spark, rows):
    data = spark.range(200).select((F.col("id") % 7).alias("k"), (F.col("id") * 13 % 101).cast("decimal(18,2)").alias("v"))
    parts = [data.where(F.col("v") % 3 == i) for i in range(3)]
    merged = aggregates.partial_stats(parts[0], ["k"], "v")
    for part in parts[1:]:
        merged = aggregates.merge_stats(merged, aggregates.partial_stats(part, ["k"], "v"), ["k"])
    assert rows(merged) == rows(aggregates.partial_stats(data, ["k"], "v"))
    assert merged.dtypes == aggregates.partial_stats(data, ["k"], "v").dtypes


def test_polarity(spark, rows):
    data = spark.createDataFrame([("Great, GREAT win! bad",), ("awful",), ("nothing",)], "t STRING")
    assert rows(data.select(text.polarity("t").alias("s")).select("s.*")) == sorted(
        [("POS", 0.75), ("NEG", 1.0), ("NEU", 0.0)], key=str)
