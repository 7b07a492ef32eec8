"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its distinct word n-grams. Equal sets become one node. Grams are ordered from rare to
common by counts over all documents; two sets of similarity t share at least m grams within their first
``n - ceil(t n) + m`` ones. m is chosen per document: where the counts of its prefix promise many candidates, the prefix is
lengthened and that many more shared grams are asked for; a pair needs the smaller m of its two documents.

Candidates must also pass exact bounds on size and on the symmetric difference, which the bits in which
two 512-bit parity sketches differ can only underestimate. What remains is verified on the texts. To avoid all pairs
within a group of near copies, every gram first compares its documents with one of them, its pivot; the second, complete,
pass then leaves out pairs that are already connected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import components
from strata.llm.tools import WORD, map_rows, slices
from strata.workspace import materialize

#: Buckets of the gram counts, and how many rows carry them.
BUCKETS, CHUNKS = 1 << 18, 64
WORDS_OF_BITS = 8
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BASE = np.uint64(0x9E3779B97F4A7C15)
#: More expected candidates than this lengthen a prefix by one gram, ten times as many by two, and so on.
COSTLY, MOST_SHARED = 200, 4


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, as far as they were needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
                self.up = np.cumprod(np.r_[np.uint64(1), np.full(size, BASE)])
                self.down = np.cumprod(np.r_[np.uint64(1), np.full(size, inverse)])
        return self.up, self.down


POWERS = Powers()


def gram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-grams of words; fewer words count as one gram, none give nothing."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace").translate(LOWER), np.uint8)
    edge = np.flatnonzero(np.diff(np.r_[True, SPACE[raw], True].view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = POWERS.to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    words = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    size = min(n, len(words))
    grams = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        grams = grams * BASE + words[k:len(words) - size + 1 + k]
    return np.unique(_mix(grams))


def least_shared(n, percent: int):
    """The smallest overlap with any set that a similar one of n grams can have."""
    return (percent * n + 99) // 100


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def gram_counts(documents: DataFrame, n: int) -> np.ndarray:
    """Occurrences of grams per hash bucket over all documents: a fixed 1 MB on the driver, summed in two steps."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                np.add.at(total, (gram_set(text, n) >> np.uint64(46)).astype(np.int64), 1)
        salt = TaskContext.get().partitionId() % 256
        yield pa.RecordBatch.from_pydict({"chunk": np.arange(CHUNKS), "salt": np.full(CHUNKS, salt),
                                          "counts": [c.tobytes() for c in total.reshape(CHUNKS, -1)]})

    def add(key, rows):
        total = sum(np.frombuffer(c, np.int64) for c in rows["counts"])
        return pd.DataFrame({"chunk": [key[0]], "counts": [total.tobytes()]})

    parts = documents.select("text").mapInArrow(count, "chunk BIGINT, salt BIGINT, counts BINARY")
    summed = parts.groupBy("chunk", "salt").applyInPandas(add, "chunk BIGINT, counts BINARY")
    out = np.zeros((CHUNKS, BUCKETS // CHUNKS), np.int64)
    for row in summed.groupBy("chunk").applyInPandas(add, "chunk BIGINT, counts BINARY").collect():
        out[row.chunk] = np.frombuffer(row.counts, np.int64)
    return out.reshape(-1)


def prefix_of(grams: np.ndarray, counts: np.ndarray, percent: int) -> tuple[int, np.ndarray]:
    """(m, prefix): how many shared grams are asked for, and the grams among which they are looked for."""
    n = len(grams)
    seen = counts[(grams >> np.uint64(46)).astype(np.int64)]
    order = np.argsort(seen, kind="stable")  # grams are sorted, so ties are in order of the hash
    length, excess = n - least_shared(n, percent) + 1, np.maximum(seen - 2 * counts.mean(), 0)
    shared = 1
    while shared < min(MOST_SHARED, least_shared(n, percent)) and excess[order[:length]].sum() > COSTLY * 10 ** (shared - 1):
        shared, length = shared + 1, length + 1
    return shared, grams[order[:length]]


def _bits(grams: np.ndarray) -> np.ndarray:
    """Parity sketch: bit i is the parity of the grams that hash to i."""
    odd = np.bincount((grams & np.uint64(64 * WORDS_OF_BITS - 1)).astype(np.int64), minlength=64 * WORDS_OF_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def describe(documents: DataFrame, n: int, percent: int, counts: np.ndarray) -> DataFrame:
    """doc_id, text_key, n_shingles, digest, shared, prefix and sketch of each document."""
    known = documents.sparkSession.sparkContext.broadcast(counts.astype(np.int64))

    def make():
        def work(rows):
            out = [rows["doc_id"], rows["text_key"], [], [], [], [], []]
            for text in rows["text"]:
                grams = gram_set(text, n)
                shared, prefix = prefix_of(grams, known.value, percent) if len(grams) else (0, grams)
                for column, value in zip(out[2:], (len(grams), xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None,
                                                   shared, prefix.view(np.int64), _bits(grams))):
                    column.append(value)
            return out

        return work

    keyed = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return map_rows(keyed, ["doc_id", "text_key", "text"], "doc_id BIGINT, text_key BIGINT, n_shingles BIGINT, digest BINARY, "
                    "shared INT, prefix ARRAY<BIGINT>, sketch ARRAY<BIGINT>", make)


def _verified(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar. Sizes and sketches are compared before texts are fetched."""
    meta = nodes.select("node", "n_shingles", "sketch")
    a = meta.select(*[F.col(c).alias(f"{c}_a") for c in meta.columns])
    b = meta.select(*[F.col(c).alias(f"{c}_b") for c in meta.columns])
    sized = pairs.join(a, F.col("a") == F.col("node_a")).join(b, F.col("b") == F.col("node_b"))
    close = materialize(sized.where(_may_be_similar(percent)).select("a", "b"), "pairs")
    wanted = close.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "doc_id", "text_key"), "node")
    texts = materialize(
        documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
        .join(wanted.withColumnRenamed("doc_id", "of"), "text_key")
        .where(F.col("doc_id").eqNullSafe(F.col("of"))).dropDuplicates(["node"]).select("node", "text"), "texts")
    both = (close.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))

    def make():
        def work(rows):
            keep = [i for i, (x, y) in enumerate(zip(rows["text_a"], rows["text_b"]))
                    if similar(gram_set(x, n), gram_set(y, n), percent)]
            return [[rows["a"][i] for i in keep], [rows["b"][i] for i in keep]]

        return work

    return map_rows(both, ["a", "b", "text_a", "text_b"], "a BIGINT, b BIGINT", make)


def _may_be_similar(percent: int):
    """Exact necessary conditions on n_shingles and sketch of both sides (suffixes _a and _b)."""
    a, b = F.col("n_shingles_a"), F.col("n_shingles_b")
    differ = sum((F.bit_count(F.get("sketch_a", F.lit(i)).bitwiseXOR(F.get("sketch_b", F.lit(i)))) for i in range(WORDS_OF_BITS)), F.lit(0))
    return ((100 * a >= percent * b) & (100 * b >= percent * a)
            & ((100 + percent) * differ <= (100 - percent) * (a + b)))


def cluster(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id linked directly or through others) of each document.

    Words are runs without ASCII white space, A-Z lower-cased. A document without words is linked with
    nothing and is its own component. Equal texts, repeated rows and null ids are handled through their sets:
    component_id is the smallest non-null doc_id among all documents of linked sets. Other columns are ignored; an empty
    table gives no rows. Intermediate tables go to the shared folder.
    """
    return _labelled(documents, n, percent).select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _labelled(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, text_key, n_shingles, component and component_id (both null without words) of each row."""
    described = materialize(describe(documents, n, percent, gram_counts(documents, n)), "grams")
    filled = described.where("n_shingles > 0")
    nodes = materialize(
        filled.groupBy("digest").agg(
            F.min(F.struct("doc_id", "text_key")).alias("of"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"),
            F.first("shared").alias("shared"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "least", "of.doc_id", "of.text_key", "n_shingles", "shared",
                "prefix", "sketch"), "nodes")
    postings = nodes.select("node", F.posexplode("prefix").alias("pos", "gram"))
    repeated = postings.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    live = materialize(postings.join(repeated, "gram"), "postings")

    # First pass: every gram's documents against its pivot, the one with the fewest rarer grams before it.
    pivots = live.groupBy("gram").agg(F.min(F.struct("pos", "node")).alias("pivot")).select("gram", F.col("pivot.node").alias("pivot"))
    first = (live.join(pivots, "gram").where("node <> pivot")
             .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())
    stars = materialize(_verified(first, nodes, documents, n, percent), "stars")

    # Second pass: all other pairs that share enough grams, unless they are connected already.
    known = components.label(stars, rounds=3)
    side = (live.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
            .join(nodes.select("node", "n_shingles", "shared", "sketch"), "node"))
    side = materialize(side.select("gram", "node", "component", "n_shingles", "shared", "sketch"), "sides")
    mixed = side.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("gram")
    side = side.join(mixed, "gram")
    a = side.select("gram", *[F.col(c).alias(f"{c}_a") for c in side.columns if c != "gram"])
    b = side.select("gram", *[F.col(c).alias(f"{c}_b") for c in side.columns if c != "gram"])
    met = a.join(b, (a["gram"] == b["gram"]) & (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
                 & _may_be_similar(percent))
    second = (met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
              .agg(F.count("*").alias("n"), F.min(F.least("shared_a", "shared_b")).alias("asked"))
              .where("n >= asked").select("a", "b"))
    others = materialize(_verified(second.join(first, ["a", "b"], "left_anti"), nodes, documents, n, percent), "links")
    links = stars.union(others).distinct()
    labels = components.label(links)
    placed = nodes.join(labels, "node", "left").select(
        "digest", "least", F.coalesce("component", "node").alias("component"))
    of = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = placed.join(of, "component").select("digest", "component", "component_id")
    return (described.select("doc_id", "text_key", "n_shingles", "digest").join(classes, "digest", "left")
            .select("doc_id", "text_key", "n_shingles", "component", "component_id"))


def keep_first(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of similar documents: the one with the smallest doc_id, null last, then text; all columns stay.

    Rows are judged by their own text, so rows that share an id or have none are kept or dropped one by one.
    Rows without words all stay but for repeats of doc_id and text.
    """
    columns = [F.col(f"`{c}`") for c in documents.columns]
    has_word = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    labels = materialize(_labelled(documents, n, percent).where("n_shingles > 0").select("doc_id", "text_key", "component").distinct(),
                         "classes")
    # Joined by id as well, so that a large group does not meet in one task.
    least = labels.groupBy("component").agg(F.min("doc_id").alias("least")).withColumnRenamed("component", "of")
    first = (labels.join(least, (F.col("component") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("least")))
             .select("least", "text_key", "component"))
    rows = documents.where(has_word).select(F.struct(*columns).alias("row"), F.xxhash64("text").alias("key"))
    rows = rows.join(first, (F.col("key") == F.col("text_key")) & F.col("row.doc_id").eqNullSafe(F.col("least")))
    place = F.row_number().over(Window.partitionBy("component").orderBy("row.text"))
    named = rows.select("row", place.alias("place")).where("place = 1").select("row.*")
    return named.unionByName(documents.where(~has_word).dropDuplicates(["doc_id", "text"])).select(*columns)
