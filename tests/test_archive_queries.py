"""Queries over archives on documents that are blank, missing, without id or many to an id, against their SQL."""

import duckdb
import oracle
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry

ROWS = [(1, "a\nb  "), (2, ""), (205, " \t\n"), (3, None), (None, "no id"), (None, None), (None, ""), (-250, "x,y"), (-251, ",\n"),
        (1234567890123456, "far"), (1234567890199999, "farther"), *[(7, f"text {i}") for i in range(250)]]


@pytest.mark.parametrize("name", ["untar_members", "untar_files"])
def test_odd_documents(spark, tmp_path, name):
    ids, texts = zip(*ROWS)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts), "lang": ["en"] * len(ROWS), "source": ["s"] * len(ROWS),
                             "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}), f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    assert oracle.compare(entry.queries()[name](spark, str(tmp_path)), con, entry.oracle_sql()[name]) is None
