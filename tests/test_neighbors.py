import random

import pytest
from pyspark.sql import functions as F

from strata.operators import neighbors


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{rng.randrange(20)}", rng.randrange(500), i,
             rng.choice([None, "a", "b", "c"])) for i in range(900)]
    rows += [(None, i, 10_000 + i, "n") for i in range(60)]
    return spark.createDataFrame(rows, "k STRING, at BIGINT, id BIGINT, v STRING").cache()


def brute(df, pick):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.k, []).append(r)
    found = {}
    for group in groups.values():
        group.sort(key=lambda r: (r["at"], r.id))
        for i, r in enumerate(group):
            found[r.id] = pick(group, i)
    return found


@pytest.mark.parametrize("threshold", [10**9, 40, 5])
def test_next_previous_and_carry(skewed, threshold):
    slices = neighbors.plan_slices(skewed, ["k"], "at", threshold)
    assert (slices.heavy is None) == (threshold == 10**9)
    order = ["at", "id"]
    df = neighbors.next_values(skewed, slices, order, {"nxt": "id", "nxt_v": "v"})
    df = neighbors.previous_values(df, slices, order, {"prv": "v"})
    df = neighbors.carry_forward(df, slices, order, F.col("v"), "seen")
    got = {r.id: r for r in df.collect()}
    nxt = brute(skewed, lambda g, i: g[i + 1].id if i + 1 < len(g) else None)
    nxt_v = brute(skewed, lambda g, i: g[i + 1].v if i + 1 < len(g) else None)
    prv = brute(skewed, lambda g, i: g[i - 1].v if i else None)
    seen = brute(skewed, lambda g, i: next((r.v for r in reversed(g[:i + 1]) if r.v is not None), None))
    assert len(got) == 960
    for id_, r in got.items():
        assert r.nxt == nxt[id_]
        assert r.nxt_v == nxt_v[id_]
        assert r.prv == prv[id_]
        assert r.seen == seen[id_]


def test_heavy_keys_are_cut_into_bounded_slices(skewed):
    marked = neighbors.plan_slices(skewed, ["k"], "at", 50).mark(skewed)
    sizes = marked.where("k = 'hot'").groupBy("_slice").count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < 60
    assert marked.where("k <> 'hot' AND _slice <> 0").count() == 0


@pytest.mark.parametrize("limit", ["LISTED_KEYS", "BROADCAST_EDGES"])
def test_beyond_the_limits_nothing_is_broadcast(skewed, monkeypatch, limit):
    monkeypatch.setattr(neighbors, limit, 1)
    slices = neighbors.plan_slices(skewed, ["k"], "at", 5)
    df = neighbors.next_values(skewed, slices, ["at", "id"], {"nxt": "id"})
    assert (slices.count is None) == (limit == "LISTED_KEYS")
    expected = brute(skewed, lambda g, i: g[i + 1].id if i + 1 < len(g) else None)
    assert {r.id: r.nxt for r in df.collect()} == expected


SEQUENCES = {
    "numbers": lambda i: F.when(i == 0, F.lit(1e300)).otherwise(i.cast("double")),
    "times": lambda i: F.timestamp_seconds(F.when(i == 0, F.lit(9e9)).otherwise(i)),
    "zone-less times": lambda i: F.timestamp_seconds(F.when(i == 0, F.lit(-9e9)).otherwise(i)).cast("timestamp_ntz"),
    "dates": lambda i: F.when(i == 0, F.lit("9999-01-01").cast("date")).otherwise(F.date_add(F.lit("2020-01-01").cast("date"), i.cast("int"))),
    "texts": lambda i: F.when(i == 0, F.lit("zzz")).otherwise(F.format_string("2024-01-01T%09d", i)),
    "bytes": lambda i: F.when(i == 0, F.lit("zzz")).otherwise(F.format_string("2024-01-01T%09d", i)).cast("binary"),
}


@pytest.mark.parametrize("kind", SEQUENCES)
def test_one_outlier_does_not_fill_a_slice(spark, kind):
    """20,000 rows of one key, all but one close together, besides ordinary keys."""
    rows = spark.range(20_001).select(F.lit("hot").alias("k"), SEQUENCES[kind](F.col("id")).alias("at"), "id")
    rows = rows.union(spark.range(50).select(F.lit("cold"), SEQUENCES[kind](F.col("id")), F.col("id") + 100_000))
    slices = neighbors.plan_slices(rows, ["k"], "at", 1000)
    sizes = [r["count"] for r in slices.mark(rows).where("k = 'hot'").groupBy("_slice").count().collect()]
    assert len(sizes) > 60 and sum(sizes) == 20_001 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    order = ["at", "id"]
    got = {r.id: (r.nxt, r.prv) for r in neighbors.previous_values(
        neighbors.next_values(rows, slices, order, {"nxt": "id"}), slices, order, {"prv": "id"}).where("k = 'hot'").collect()}
    line = [r.id for r in rows.where("k = 'hot'").orderBy(*order).collect()]
    assert got == {i: (line[n + 1] if n + 1 < len(line) else None, line[n - 1] if n else None) for n, i in enumerate(line)}


def test_nulls_and_ties_of_a_heavy_key_stay_in_order(spark):
    rows = spark.range(3000).selectExpr("'hot' AS k", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS at", "id")
    slices = neighbors.plan_slices(rows, ["k"], "at", 100)
    got = {r.id: r.nxt for r in neighbors.next_values(rows, slices, ["at", "id"], {"nxt": "id"}).collect()}
    line = [r.id for r in rows.orderBy("at", "id").collect()]
    assert got == dict(zip(line, [*line[1:], None]))
    nothing = rows.withColumn("at", F.lit(None).cast("bigint"))
    assert neighbors.plan_slices(nothing, ["k"], "at", 100).heavy is None


def test_the_sketch_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "MOST_CUTS", 3)
    rows = spark.range(50_000).selectExpr("'hot' AS k", "id AS at")
    sizes = neighbors.plan_slices(rows, ["k"], "at", 100).mark(rows).groupBy("_slice").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 25_000
