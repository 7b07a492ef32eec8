import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import cdc

SCHEMA = "id INT, seq INT, op STRING, name STRING, meta STRING"
FEED = [(1, 1, "APPEND", "a", "m1"), (1, 5, "UPDATE", "b", "m2"), (1, 3, "UPDATE", "x", "m3"), (2, 2, "APPEND", "c", "m4"),
        (2, 4, "DELETE", "c", "m5"), (2, 3, "UPDATE", "late", "m6"), (3, 1, None, "full", "m7"), (4, 1, "DELETE", "z", "m8"),
        (5, 1, "APPEND", "s", "m9"), (5, 2, "UPDATE", "s", "n1"), (5, 3, "DELETE", "s", "n2"), (5, 4, "APPEND", "s", "n3")]
DELETES, EXCEPT = "op = 'DELETE'", ["op", "meta"]


def apply(spark, feed, scd_type, **options):
    return cdc.apply_changes(spark.createDataFrame(feed, SCHEMA), ["id"], "seq", DELETES, EXCEPT, scd_type, **options)


def reference_history(feed):
    """Row-by-row replay of a feed."""
    found, open_version = [], {}
    for id_, seq, op, name, _ in sorted(feed, key=lambda r: (r[0], r[1], r[2] == "DELETE", r[3])):
        old = open_version.get(id_)
        if op == "DELETE":
            if old:
                found.append((id_, old[0], old[1], seq))
                del open_version[id_]
        elif old is None or old[0] != name:
            if old:
                found.append((id_, old[0], old[1], seq))
            open_version[id_] = (name, seq)
    found += [(k, v[0], v[1], None) for k, v in open_version.items()]
    return sorted((r for r in found if r[2] != r[3]), key=str)


def test_type_1(spark, rows):
    got = apply(spark, FEED, 1)
    assert got.columns == ["id", "seq", "name"]
    assert rows(got) == [(1, 5, "b"), (3, 1, "full"), (5, 4, "s")]


@pytest.mark.parametrize("heavy_rows", [10**6, 1])
def test_type_2(spark, rows, heavy_rows):
    assert rows(apply(spark, FEED, 2, heavy_rows=heavy_rows)) == reference_history(FEED)


def test_order_and_repetition_of_the_feed_do_not_matter(spark, rows):
    for seed in range(3):
        shuffled = FEED * 2
        random.Random(seed).shuffle(shuffled)
        assert rows(apply(spark, shuffled, 1)) == rows(apply(spark, FEED, 1))
        assert rows(apply(spark, shuffled, 2)) == rows(apply(spark, FEED, 2))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 12), st.sampled_from(["UPDATE", "DELETE", None]),
                          st.sampled_from("ab"), st.just("m")), min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1])))
def test_history_replays_any_feed(spark, rows, feed):
    history = apply(spark, feed, 2, heavy_rows=4)
    assert rows(history) == reference_history(feed)
    assert rows(cdc.current(history).select("id", "name")) == rows(apply(spark, feed, 1).select("id", "name"))


def test_a_delete_wins_over_an_update_of_the_same_sequence(spark, rows):
    feed = [(1, 1, "APPEND", "a", "m"), (1, 2, "DELETE", "a", "m"), (1, 2, "UPDATE", "b", "m")]
    assert rows(apply(spark, feed, 1)) == []


def test_other_scd_types_are_refused(spark):
    with pytest.raises(ValueError):
        apply(spark, FEED, 3)


@pytest.mark.parametrize("heavy_rows", [10**6, 2])
def test_as_of_join(spark, rows, heavy_rows):
    history = spark.createDataFrame([(1, "a", 10, 20), (1, "b", 30, None), (2, "c", 5, None)],
                                    f"id INT, name STRING, {cdc.START} INT, {cdc.END} INT")
    facts = spark.createDataFrame([(n, k, t) for n, (k, t) in enumerate(
        [(1, 9), (1, 10), (1, 19), (1, 20), (1, 29), (1, 30), (1, 99), (2, 5), (3, 7)])], "n INT, k INT, at INT")
    got = cdc.as_of_join(facts, history, "k", "id", "at", ["name"], heavy_rows)
    assert [r[3] for r in rows(got)] == [None, "a", "a", None, None, "b", "b", "c", None]


def test_change_feed_with_a_text_sequence_is_parsed_first(spark, rows):
    feed = spark.createDataFrame([(1, "12-31-2023 10:00:00", "old"), (1, "01-01-2024 10:00:00", "new")], "id INT, d STRING, v STRING")
    parsed = feed.withColumn("d", F.to_timestamp("d", "MM-dd-yyyy HH:mm:ss"))
    assert rows(cdc.apply_changes(parsed, ["id"], "d").select("v")) == [("new",)]
    assert rows(cdc.apply_changes(feed, ["id"], "d").select("v")) == [("old",)]
