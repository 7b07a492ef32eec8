"""Rescue as structure, and streams whose files gain columns while they run."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import evolving
from strata.sources.files import RESCUED

SCHEMA = "id BIGINT, s STRUCT<a: BIGINT, t: STRUCT<b: STRING>>, l ARRAY<BIGINT>, ls ARRAY<STRUCT<x: INT>>, m MAP<STRING, INT>"


def _rescued(spark, *lines):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n INT, value STRING")
    out = evolving.rescue(rows, T.StructType.fromDDL(SCHEMA)).withColumn("j", F.to_json(RESCUED)).orderBy("n").collect()
    return [(r["id"], None if r["j"] is None else json.loads(r["j"])) for r in out]


def test_rest_keeps_its_shape(spark):
    assert _rescued(
        spark, '{"id":1,"s":{"a":2,"t":{"b":"x"}},"l":[1,2],"ls":[{"x":1}],"m":{"k":1}}', '{"id":2,"z":{"y":[1,{"w":null}]},"s":{"a":1,"u":[true]}}',
        '{"id":"x","s":{"a":"q","t":{"b":"x","c":{"d":1.5}}}}', '{"id":3,"l":[1,"two"],"ls":[{"x":1},{"x":2,"e":5}],"m":{"k":"v"}}',
        '{"id":4,"new":null,"s":null,"l":[null,1]}', '{"id":5,"s":7}') == [
        (1, None), (2, {"z": {"y": [1, {"w": None}]}, "s": {"u": [True]}}), (None, {"id": "x", "s": {"a": "q", "t": {"c": {"d": 1.5}}}}),
        (3, {"l": [1, "two"], "ls": [{"x": 1}, {"x": 2, "e": 5}], "m": {"k": "v"}}), (4, None), (5, {"s": 7})]


def test_lines_that_are_not_one_object_are_kept_whole(spark):
    odd = ["nonsense", '{"id":1} trailing', '{"id":1},{"id":2}', "[1]", '{"id":1,"id":2}', '"text"', "{"]
    assert [r for _, r in _rescued(spark, *odd)] == odd
    assert _rescued(spark, "", "  ", None) == [(None, None)] * 3


def test_paths_into_the_rest_and_clashing_columns(spark):
    rows = spark.createDataFrame([('{"id":1,"deep":{"a b":[{"q":"found"}]}}', 9)], "value STRING, extra INT")
    got = evolving.rescue(rows, T.StructType.fromDDL("id BIGINT")).select("extra", F.variant_get(RESCUED, '$.deep["a b"][0].q', "string")).first()
    assert tuple(got) == (9, "found")


def test_documents_over_many_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1,\n "s": {"a": 2,\n "more": 3}},\n {"id": 2}]')
    (tmp_path / "b.json").write_text('{"id": 3,\n "s": {"a": "x"}}')
    out = evolving.rescue(evolving.documents(spark.read, str(tmp_path)), T.StructType.fromDDL(SCHEMA), record="record").orderBy("id")
    assert [(r[0], r[1]) for r in out.select("id", F.to_json(RESCUED)).collect()] == [(1, '{"s":{"more":3}}'), (2, None), (3, '{"s":{"a":"x"}}')]


def test_shapes_become_columns(spark):
    lines = ['{"a":1,"n":null,"o":{},"mix":1,"l":[{"q":1}],"big":123456789012345678901234567890,"OBJECT<":{"x y":true}}', '{"a":2.5,"mix":{"z":1}}', '[1]']
    found = spark.createDataFrame([(x,) for x in lines], "v STRING").select(F.try_parse_json("v").alias("v")).agg(evolving.shape("v")).first()[0]
    got = {f.name: f.dataType.simpleString() for f in evolving.columns_of(found)}
    assert got == {"a": "double", "mix": "variant", "l": "array<struct<q:bigint>>", "big": "decimal(38,0)", "OBJECT<": "struct<x y:boolean>"}
    assert evolving.columns_of(None) == evolving.columns_of("VOID") == T.StructType()


def test_known_types_never_change(spark):
    known = T.StructType.fromDDL("a INT, s STRUCT<x: INT>, l ARRAY<STRUCT<p: INT>>")
    found = T.StructType.fromDDL("A STRING, a STRING, s STRUCT<x: STRING, y: STRING>, l ARRAY<STRUCT<q: INT>>, b INT, B STRING")
    assert evolving.widen(known, found) == T.StructType.fromDDL("a INT, s STRUCT<x: INT, y: STRING>, l ARRAY<STRUCT<p: INT, q: INT>>, b INT")


@pytest.fixture
def landing(spark, tmp_path):
    """(write, ingest): files in the order in which they arrive, one batch each."""
    (tmp_path / "in").mkdir()

    def ingest(fmt, **options):
        return evolving.Ingest(spark, str(tmp_path / "in"), fmt, str(tmp_path / "out"), str(tmp_path / "check"), **options)

    return lambda name, text: (tmp_path / "in" / name).write_text(text), ingest


def test_columns_that_arrive_late(landing, spark):
    write, ingest = landing
    feed = ingest("json", hints="id BIGINT", options={"maxFilesPerTrigger": 1})
    assert feed.read().collect() == [] and feed.read().columns == ["id", RESCUED]
    write("1.json", '{"id":1}\n{"id":"bad","x":1}\n')
    feed.run()
    write("2.json", '{"id":2,"x":"not a number","s":{"a":1}}\nbroken\n')
    write("3.json", '{"id":3,"s":{"a":2,"b":[{"c":1}]}}\n')
    feed.run()
    write("4.json", '{"id":4,"s":{"b":[{"c":2,"d":"late"}]}}\n')
    feed.run()
    again = ingest("json", hints="id BIGINT")  # another process finds the same schema
    assert again.schema == T.StructType.fromDDL("id BIGINT, x BIGINT, s STRUCT<a: BIGINT, b: ARRAY<STRUCT<c: BIGINT, d: STRING>>>")
    rows = again.read().withColumn(RESCUED, F.to_json(RESCUED)).select(F.to_json(F.struct("*"))).collect()
    assert sorted(r[0] for r in rows) == sorted([
        '{"id":1}', '{"x":1,"_rescued_data":"{\\"id\\":\\"bad\\"}"}', '{"id":2,"s":{"a":1},"_rescued_data":"{\\"x\\":\\"not a number\\"}"}',
        '{"_rescued_data":"\\"broken\\""}', '{"id":3,"s":{"a":2,"b":[{"c":1}]}}', '{"id":4,"s":{"b":[{"c":2,"d":"late"}]}}'])


def test_a_version_that_was_not_finished_is_passed_over(landing, tmp_path):
    write, ingest = landing
    feed = ingest("json")
    write("1.json", '{"id":1}\n')
    feed.run()
    (tmp_path / "check-schemas" / "00000001.json").write_text('{"type":"struct","fie')
    assert feed.schema == T.StructType.fromDDL("id BIGINT")
    write("2.json", '{"id":2,"b":true}\n')
    feed.run()
    assert sorted((r.id, r.b) for r in feed.read().collect()) == [(1, None), (2, True)]


def test_other_errors_are_raised(landing, spark):
    write, ingest = landing
    write("1.json", '{"id":1}\n')
    feed = ingest("json", hints="id BIGINT")
    feed._store = lambda rows, number: 1 / 0
    with pytest.raises(Exception, match="division by zero"):
        feed.run()


def test_csv_columns_go_by_name(landing):
    write, ingest = landing
    feed = ingest("csv", hints="id BIGINT, amount DOUBLE", options={"escape": '"'})
    write("1.csv", 'id,name,amount\n1,"a,b",1.5\n2,c,bad\n3,too few\n4,d,4.5,too many\n\n')
    write("2.csv", "amount,id\n7.5,7\n")
    feed.run()
    write("3.csv", 'name,"new one",ID\nx,"y ""z""",8\n')
    write("4.csv", "id,name,amount\n")
    feed.run()
    rows = feed.read().withColumn(RESCUED, F.variant_get(RESCUED, "$", "string")).collect()
    got = {r.id if r[RESCUED] is None else r[RESCUED]: (r.amount, r.name, r["new one"]) for r in rows}
    assert {k: got[k] for k in (1, 7, 8)} == {1: (1.5, "a,b", None), 7: (7.5, None, None), 8: (None, "x", 'y "z"')}
    assert set(got) == {1, 7, 8, "2,c,bad", "3,too few", "4,d,4.5,too many"} and len(rows) == 6
