"""Near-duplicate groups by one-permutation MinHash with optimal densification and star-shaped candidate edges.

A document is the set of its distinct word n-grams; equal sets become one node. The 64-bit gram hashes are one random
permutation: the top bits of a hash name its bin, and a bin's smallest hash is its minimum. An empty bin borrows the
minimum of the first filled bin in an order drawn for it, so each bin agrees between two sets as often as a MinHash does.
Bands of bins are the buckets; two sets of Jaccard similarity s share none of 32 buckets of four bins with a probability of
(1 - s^4)^32: 5e-8 at 0.8, 2e-4 at 0.7.

Within a bucket, edges form stars: every member is compared with a hub only. A member that is connected with all others
of its bucket needs no further comparison, so a group of near copies costs one edge a member. Members that are not yet
connected meet in further rounds with more and more hubs, each of which leaves the bucket once it has met the others, until no
bucket holds two groups: no pair of a bucket is lost, none within a connected group is made. Large buckets of nodes that are not
connected, such as different documents around one passage, are first replaced by buckets of their rarest grams, exactly as
many as similar sets need to share one, where the gram's place in a set bounds the size of its partner. Edges are links only after their full sets were compared; size and a parity sketch, which
can only underestimate the difference, rule out most others before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import components
from strata.llm.jaccard_join import gram_set, similar
from strata.llm.tools import map_rows, slices
from strata.workspace import materialize

#: Bins (a power of two) and bins of a band.
BINS, BAND = 128, 4
#: Longs of the parity sketch.
SKETCH = 16
#: How many times as many hubs a bucket has in each round; one in the first.
HUBS = 64
#: Members from which a bucket that its hub did not connect is replaced by finer ones.
CROWD = 16
#: Members that meet their hub in one group of the comparison.
TOGETHER = 256
ODD = np.uint64(0x9E3779B97F4A7C15)
SHIFT = np.uint64(65 - BINS.bit_length())
#: For each bin, the order in which it looks for a filled one; the same on every machine.
LOOK = np.argsort(np.random.RandomState(20170401).random_sample((BINS, BINS)), axis=1)


def signature(grams: np.ndarray) -> np.ndarray:
    """The densified minimum of each bin of a non-empty sorted set of hashes."""
    first = np.searchsorted(grams, np.arange(BINS, dtype=np.uint64) << SHIFT)
    filled = np.diff(np.r_[first, len(grams)]) > 0
    least = grams[np.minimum(first, len(grams) - 1)]
    source = LOOK[np.arange(BINS), filled[LOOK].argmax(axis=1)]
    return least[np.where(filled, np.arange(BINS), source)]


def buckets_of(grams: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band, different for different bands."""
    key = np.arange(BINS // BAND, dtype=np.uint64) + np.uint64(1)
    for column in signature(grams).reshape(-1, BAND).T:
        key = (key ^ column) * ODD
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def parity(grams: np.ndarray) -> np.ndarray:
    """Bit i is the parity of the number of hashes that fall to i."""
    odd = np.bincount((grams & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def describe(documents: DataFrame, n: int) -> DataFrame:
    """doc_id, text_key, n_shingles, digest, buckets and sketch of each document."""

    def make():
        def work(rows):
            sets = [gram_set(text, n) for text in rows["text"]]
            return [rows["doc_id"], rows["text_key"], [len(s) for s in sets],
                    [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    [buckets_of(s) if len(s) else None for s in sets], [parity(s) if len(s) else None for s in sets]]

        return work

    keyed = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return map_rows(keyed, ["doc_id", "text_key", "text"], "doc_id BIGINT, text_key BIGINT, n_shingles BIGINT, "
                    "digest BINARY, buckets ARRAY<BIGINT>, sketch ARRAY<BIGINT>", make)


def _possible(percent: int):
    """Necessary for similarity, from the sizes and sketches of both sides."""
    a, b = F.col("hub_size"), F.col("size")
    differ = sum((F.bit_count(F.get("hub_sketch", F.lit(i)).bitwiseXOR(F.get("sketch", F.lit(i)))) for i in range(SKETCH)), F.lit(0))
    return (100 * a >= percent * b) & (100 * b >= percent * a) & ((100 + percent) * differ <= (100 - percent) * (a + b))


def _verify(edges: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The edges (hub, node) whose full sets are similar, as a and b.

    The members of a hub are dealt to groups of some `TOGETHER`; each group has the hub's text once, before theirs.
    """
    close = materialize(edges, "close")
    sizes = close.groupBy("hub").agg(F.ceil(F.count("*") / TOGETHER).alias("parts"))
    members = close.join(sizes, "hub").select("hub", "node", F.pmod(F.xxhash64("node"), "parts").alias("part"))
    with_hubs = members.union(members.select("hub", F.col("hub").alias("node"), "part").distinct())
    both = with_hubs.join(texts, "node").select("hub", "part", (F.col("hub") != F.col("node")).alias("member"), "node", "text")
    both = both.repartition("hub", "part").sortWithinPartitions("hub", "part", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, grams = None, None
        for part in slices(batches):
            found_a, found_b = [], []
            for hub, member, node, text in zip(*(part.column(c).to_pylist() for c in ("hub", "member", "node", "text"))):
                if not member:
                    of, grams = hub, gram_set(text, n)
                elif hub == of and similar(grams, gram_set(text, n), percent):
                    found_a.append(hub)
                    found_b.append(node)
            yield pa.RecordBatch.from_pydict({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return both.select("hub", "member", "node", "text").mapInArrow(run, "a BIGINT, b BIGINT")


def _texts(documents: DataFrame, nodes: DataFrame, live: DataFrame) -> DataFrame:
    """node, n_shingles and text of the nodes that share a bucket with another one."""
    wanted = nodes.join(live.select("node").distinct(), "node", "left_semi").select(
        "node", "n_shingles", F.col("doc_id").alias("of"), "text_key")
    return (documents.select("doc_id", "text", F.xxhash64("text").alias("text_key")).join(wanted, "text_key")
            .where(F.col("doc_id").eqNullSafe(F.col("of"))).dropDuplicates(["node"]).select("node", "n_shingles", "text"))


def _finer(crowded: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """bucket, node, size and most: buckets of single grams instead of those of `crowded`, for the same pairs.

    With grams in order of the number of crowded nodes that have them, two sets of n and m grams that are similar share one among
    their first n - ceil(t n) + 1 and m - ceil(t m) + 1. Grams of one node only come first and are shared by nobody.
    """

    def make():
        def work(rows):
            return [rows["node"], rows["n_shingles"], [gram_set(text, n).view(np.int64) for text in rows["text"]]]

        return work

    members = texts.join(crowded.select("node").distinct(), "node", "left_semi")
    listed = map_rows(members, ["node", "n_shingles", "text"], "node BIGINT, size BIGINT, grams ARRAY<BIGINT>", make)
    grams = materialize(listed.select("node", "size", F.explode("grams").alias("gram")), "grams")
    common = grams.groupBy("gram").agg(F.count("*").alias("seen")).where("seen > 1")
    place = F.row_number().over(Window.partitionBy("node").orderBy("seen", "gram"))
    alone = F.col("size") - F.count("*").over(Window.partitionBy("node"))
    placed = grams.join(common, "gram").select("node", "size", "gram", (alone + place).alias("place"))
    return (placed.where(F.col("place") <= F.col("size") - F.floor((percent * F.col("size") + 99) / 100) + 1)
            .select(F.col("gram").alias("bucket"), "node", "size", _most(percent, "place").alias("most")))


def _most(percent: int, place: str | None = None):
    """The size of the largest similar set whose first gram in common is at `place` (the first if None) in the order of grams.

    The overlap is that gram and what follows it, at most. Of two similar sets the smaller one's `most` is its own size or more.
    """
    follows = F.col("size") - (F.lit(1) if place is None else F.col(place)) + 1
    return F.floor((100 + percent) * follows / percent).cast("bigint") - F.col("size")


def _linked(documents: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """node and component of the nodes that similar sets of a common bucket connect."""
    spark = documents.sparkSession
    postings = nodes.select("node", F.col("n_shingles").alias("size"), F.explode("buckets").alias("bucket"))
    shared = postings.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("bucket")
    sketches, columns = nodes.select("node", "sketch"), ["bucket", "node", "size", "most"]
    live = materialize(postings.withColumn("most", _most(percent)).join(shared, "bucket").select(*columns), "buckets")
    texts = materialize(_texts(documents, nodes, live), "texts")
    links, labels = spark.createDataFrame([], "a BIGINT, b BIGINT"), spark.createDataFrame([], "node BIGINT, component BIGINT")
    hubs_each, refined = 1, False
    may_be_hub = F.col("most") >= F.col("size")
    while True:
        placed = live.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        split = (placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members"),
                                              F.max(may_be_hub).alias("open"))
                 .where("lo < hi AND open").select("bucket", "members"))
        placed = materialize(placed.join(split, "bucket").join(sketches, "node").select(*columns, "component", "members", "sketch"), "placed")
        if placed.isEmpty():
            return labels
        if hubs_each > 1 and not refined:
            # Large buckets that their hub did not connect.
            refined, crowded = True, placed.where(F.col("members") > CROWD)
            if not crowded.isEmpty():
                hubs_each = 1
                small = placed.where(F.col("members") <= CROWD).select(*columns)
                live = materialize(small.union(_finer(crowded, texts, n, percent).select(*columns)), "finer")
                continue
        # First hubs of different components, which leave large ones behind at once; then ever more of all nodes.
        slot = F.pmod(F.xxhash64("component" if hubs_each <= HUBS else "node"), F.lit(hubs_each))
        hubs = placed.where(may_be_hub).groupBy("bucket", slot.alias("slot")).agg(F.min(F.struct("node", "component", "size", "most", "sketch")).alias("of"))
        hubs = materialize(hubs.select("bucket", F.col("of.node").alias("hub"),
                                       *[F.col(f"of.{c}").alias(f"hub_{c}") for c in ("component", "size", "most", "sketch")]), "hubs")
        is_hub = hubs.select("bucket", F.col("hub").alias("node"), F.lit(True).alias("is_hub"))
        marked = placed.join(is_hub, ["bucket", "node"], "left")
        # A pair meets once: of two hubs of one bucket, the smaller is the hub of the other. Only pairs that may be similar leave the join.
        meet = ((F.col("component") != F.col("hub_component")) & (F.col("is_hub").isNull() | (F.col("hub") < F.col("node")))
                & (F.col("size") <= F.col("hub_most")) & (F.col("hub_size") <= F.col("most")) & _possible(percent))
        edges = marked.join(hubs, "bucket").where(meet).select("hub", "node").distinct()
        found = materialize(_verify(edges, texts.select("node", "text"), n, percent), "links")
        live = materialize(marked.where("is_hub IS NULL").select(*columns), "live")
        if not found.isEmpty():
            links = links.union(found)
            labels = components.label(links)
        hubs_each *= HUBS


def cluster(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id linked directly or through others) and kept of each document.

    Words are runs without ASCII white space, A-Z lower-cased; a text with fewer than n words is one gram. A document without
    words, or without text, is linked with nothing and is its own component. kept is true for the document whose doc_id
    is its component_id; repeated rows of that id are all kept. A null doc_id counts as no id: component_id is the smallest
    non-null one among all documents of linked sets, or null, and kept is then false. Long texts are read whole; other columns are
    ignored; an empty table gives no rows. Intermediate tables go to the shared folder.
    """
    described = materialize(describe(documents, n), "minhash")
    nodes = materialize(
        described.where("n_shingles > 0").groupBy("digest").agg(
            F.min(F.struct("doc_id", "text_key")).alias("of"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"),
            F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "least", "of.doc_id", "of.text_key", "n_shingles", "buckets",
                "sketch"), "nodes")
    labels = _linked(documents, nodes, n, percent)
    # Only sets that differ from a linked one have a label; all others are their own component.
    of = nodes.join(labels, "node").groupBy("component").agg(F.min("least").alias("linked"))
    linked = labels.join(of, "component").select("node", "linked")
    classes = nodes.join(linked, "node", "left").select("digest", F.coalesce("linked", "least").alias("component_id"))
    out = described.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
