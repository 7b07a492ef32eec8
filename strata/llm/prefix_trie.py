"""Prefix trie of conversations, its subtree totals computed by time-forward processing.

Every conversation is rebuilt and followed turn by turn; the first d turns name a node by the xor of d hashes of (turn, place), 128
bits long. Nodes come from one grouped aggregate with map-side sums. Nodes with many members, the heavy ones, form the top of the
trie; what hangs below them is cut into shards, each the subtree of a light node with a heavy parent. The weight a node needs
to be heavy grows with the input, so that there are `MOST_HEAVY` of them at most.

Within a shard nodes are sorted by Spark in reverse level order, deepest first. Each node takes the messages of
its children from a priority queue ordered like the nodes, adds its own part and sends the sum forward to its parent, so
that no node is ever looked up. The queue spills sorted runs beyond `QUEUE` messages. A node is given out when its parent is
reached, which alone knows parent_conv_id. What shard roots send is added up per heavy parent; then the heavy
nodes are processed the same way.
"""

from __future__ import annotations

import heapq
import itertools
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tools import slices
from strata.workspace import materialize

#: Members from which a node is heavy, and the most heavy nodes there can be.
HEAVY, MOST_HEAVY = 32, 50_000
#: Messages a queue holds in memory, and runs that it has on disk.
QUEUE, RUNS = 50_000, 64
#: Conversations whose heads are shared, and the modulus of their lengths.
GROUP, LENGTHS = 5, 9
#: Ids joined in one row before they are hashed.
IDS = 4096

NODE = ("depth BIGINT, k1 BIGINT, k2 BIGINT, p1 BIGINT, p2 BIGINT, n_convs BIGINT, conv_id BIGINT, n_bytes BIGINT, "
        "n_children BIGINT, n_leaves BIGINT, saved_tokens BIGINT")
DONE = f"{NODE}, parent_conv_id BIGINT, is_top BOOLEAN"
FIELDS = [f.split()[0] for f in NODE.split(", ")]


class SpillingQueue:
    """A priority queue of tuples; beyond `limit` in memory they move to a sorted run on disk, in Spark's own scratch folder."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.tie = limit, [], [], itertools.count()

    def push(self, key: tuple, value: tuple) -> None:
        heapq.heappush(self.heap, (key, next(self.tie), value))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        scratch = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=scratch if os.path.isdir(scratch) else None)  # has no name and ends with the task
        items = sorted(self.heap)
        for item in heapq.merge(items, self._stored()) if len(self.runs) >= RUNS else items:
            pickle.dump(item, file)
        file.seek(0)
        self.heap = []
        self._advance(file)

    def _stored(self) -> Iterator[tuple]:
        """All items of the runs, in order; the runs end with it."""
        while self.runs:
            item, _, file = heapq.heappop(self.runs)
            yield item
            self._advance(file)

    def _advance(self, file) -> None:
        """The next item of a run competes for the head of the queue."""
        try:
            heapq.heappush(self.runs, (pickle.load(file), id(file), file))
        except EOFError:
            file.close()

    def pop_all(self, key: tuple) -> list[tuple]:
        """The values of all messages of `key`, which no message may precede."""
        found = []
        while True:
            in_heap = bool(self.heap) and self.heap[0][0] == key
            if in_heap and not (self.runs and self.runs[0][0] < self.heap[0]):
                found.append(heapq.heappop(self.heap)[2])
            elif self.runs and self.runs[0][0][0] == key:
                item, _, file = heapq.heappop(self.runs)
                found.append(item[2])
                self._advance(file)
            else:
                return found


def forward(nodes: Iterator[tuple], limit: int = QUEUE) -> Iterator[tuple]:
    """Completed nodes of one shard, which come in reverse level order; a node whose parent is not among them comes last, marked.

    A node is (depth, k1, k2, p1, p2, n_convs, conv_id, n_bytes, n_children, n_leaves, saved_tokens), the last three with what
    came from elsewhere. Its place in time is (-depth, k1, k2).
    """
    queue = SpillingQueue(limit)
    for depth, k1, k2, p1, p2, n_convs, conv_id, n_bytes, children, leaves, saved in nodes:
        for child in queue.pop_all((-depth, k1, k2)):
            children, leaves, saved = children + 1, leaves + child[9], saved + child[10]
            yield (*child, conv_id, False)
        total = (depth, k1, k2, p1, p2, n_convs, conv_id, n_bytes, children, leaves or 1, saved + (n_convs - 1) * n_bytes)
        queue.push((1 - depth, p1, p2), total)
    # The top is the last node; only its own message is left.
    while queue.heap or queue.runs:
        head = min(([queue.heap[0][0]] if queue.heap else []) + ([queue.runs[0][0][0]] if queue.runs else []))
        for child in queue.pop_all(head):
            yield (*child, None, True)


def _time_forward(nodes: DataFrame, limit: int) -> DataFrame:
    """`forward` over each shard (s1, s2) of `nodes`, a stream of rows in constant memory."""
    columns = ["s1", "s2", *FIELDS]
    names = [f.split()[0] for f in DONE.split(", ")]
    kinds = [pa.bool_() if f.endswith("BOOLEAN") else pa.int64() for f in DONE.split(", ")]

    def run(batches):
        rows = (r for part in slices(batches, 1024) for r in zip(*(part.column(c).to_pylist() for c in range(len(columns)))))
        done = (r for _, shard in itertools.groupby(rows, key=lambda r: r[:2]) for r in forward((r[2:] for r in shard), limit))
        while block := list(itertools.islice(done, 1024)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*block), kinds)], names=names)

    ordered = nodes.select(*columns).sortWithinPartitions("s1", "s2", F.desc("depth"), "k1", "k2")
    return ordered.mapInArrow(run, DONE)


def _head_length(conv_id: Column) -> Column:
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(LENGTHS))


def rebuild(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, k (node), p (parent), n_bytes and is_end of each rebuilt turn, and of the root of each conversation (depth 0)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    placed = materialize(turns.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "digest", "n_bytes"), "turns")
    first_of_group = F.col("conv_id") - F.col("conv_id") % GROUP
    convs = placed.where("place = 0").select("conv_id", first_of_group.alias("head"), _head_length(F.col("conv_id")).alias("h"))
    shared = placed.where((first_of_group == F.col("conv_id")) & (F.col("place") < LENGTHS - 1)).withColumnRenamed("conv_id", "head")
    heads = shared.join(convs, "head").where("place < h").select("conv_id", F.lit(1).alias("part"), "place", "digest", "n_bytes")
    own = placed.where(F.col("place") >= _head_length(F.col("conv_id"))).select("conv_id", F.lit(2).alias("part"), "place", "digest", "n_bytes")
    root = convs.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("place"), F.lit(None).cast("string").alias("digest"),
                        F.lit(0).cast("bigint").alias("n_bytes"))
    path = Window.partitionBy("conv_id").orderBy("part", "place")
    to_here = path.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("bigint")
    steps = root.union(heads).union(own).select("*", (F.row_number().over(path) - 1).cast("bigint").alias("depth"),
                                                F.lead(F.lit(1)).over(path).isNull().alias("is_end"))
    step1 = F.when(F.col("depth") == 0, zero).otherwise(F.xxhash64("digest", "depth"))
    step2 = F.when(F.col("depth") == 0, zero).otherwise(F.xxhash64("depth", F.lit("second"), "digest"))
    hashed = steps.withColumns({"t1": step1, "t2": step2})
    hashed = hashed.withColumns({"k1": F.bit_xor("t1").over(to_here), "k2": F.bit_xor("t2").over(to_here)})
    return hashed.select("conv_id", "depth", "is_end", "n_bytes", "k1", "k2", F.col("k1").bitwiseXOR(F.col("t1")).alias("p1"),
                         F.col("k2").bitwiseXOR(F.col("t2")).alias("p2"))


def _ends(rows: DataFrame) -> DataFrame:
    """k1, k2 and ends_sha256 of the nodes at which conversations end.

    SHA-256 must see the ids of a node in order, so sorted ranges are joined to long texts first; the task of a node
    then streams a few of them.
    """

    def join(batches):
        ids = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in range(3))))
        for (k1, k2), group in itertools.groupby(ids, key=lambda r: r[:2]):
            while block := [r[2] for r in itertools.islice(group, IDS)]:
                yield pa.RecordBatch.from_pydict({"k1": [k1], "k2": [k2], "first": [block[0]], "ids": [",".join(map(str, block))]})

    def digest(batches):
        import hashlib

        texts = (r for part in slices(batches, 256) for r in zip(*(part.column(c).to_pylist() for c in range(3))))
        found = []
        for (k1, k2), group in itertools.groupby(texts, key=lambda r: r[:2]):
            sha = hashlib.sha256()
            for i, (_, _, ids) in enumerate(group):
                sha.update(("," * (i > 0) + ids).encode())
            found.append((k1, k2, sha.hexdigest()))
            if len(found) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["k1", "k2", "ends_sha256"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["k1", "k2", "ends_sha256"])

    ends = rows.where("is_end").select("k1", "k2", "conv_id").repartitionByRange("k1", "k2", "conv_id")
    joined = ends.sortWithinPartitions("k1", "k2", "conv_id").mapInArrow(join, "k1 BIGINT, k2 BIGINT, first BIGINT, ids STRING")
    ordered = joined.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").select("k1", "k2", "ids")
    return ordered.mapInArrow(digest, "k1 BIGINT, k2 BIGINT, ends_sha256 STRING")


def prefix_trie(conversations: DataFrame, queue: int = QUEUE) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of each node.

    Turns are ordered by turn, null first, equal ones by the MD5 of length and text of their role and their text; repeated rows are turns of
    their own. A null role or text is empty. Rows without conv_id belong to no conversation and are left out. Other columns are
    ignored; an empty table has no nodes, not even a root. The turns of one conversation are numbered and hashed in one task
    as a sorted stream, and a single long branch is one shard, also a stream: memory stays bounded, time does not shrink with
    more tasks.
    """
    spark = conversations.sparkSession
    rows = materialize(rebuild(conversations), "trie-rows")
    nodes = rows.groupBy("depth", "k1", "k2").agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.min("n_bytes").alias("n_bytes"))
    nodes = materialize(nodes, "trie-nodes")
    # Members add up to the number of rows, so fewer than rows / weight nodes can have more than that.
    weight = max(HEAVY, rows.count() // MOST_HEAVY)
    none = F.lit(0).cast("bigint")
    heavy = nodes.where(F.col("n_convs") > weight)
    keys = F.broadcast(heavy.select("depth", "k1", "k2"))
    parents = F.broadcast(heavy.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                                       F.col("conv_id").alias("parent"), F.lit(True).alias("below")))
    # A light turn below a heavy node starts a shard: there is one at most on the way of a conversation. The root starts it in small tables.
    light = rows.join(keys, ["depth", "k1", "k2"], "left_anti").join(parents, ["depth", "p1", "p2"], "left")
    shards = light.where("below OR depth = 0").select("conv_id", F.col("k1").alias("s1"), F.col("k2").alias("s2"))
    dealt = nodes.where(F.col("n_convs") <= weight).join(shards, "conv_id").select(
        "s1", "s2", *FIELDS[:8], *[none.alias(c) for c in FIELDS[8:]])
    done = materialize(_time_forward(dealt.repartition("s1", "s2"), queue), "trie-shards")
    sent = done.where("is_top AND depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    top = heavy.join(sent, ["depth", "k1", "k2"], "left").select(
        F.lit(0).alias("s1"), F.lit(0).alias("s2"), *FIELDS[:8], *[F.coalesce(c, none).alias(c) for c in FIELDS[8:]])
    upper = materialize(_time_forward(top.repartition(1), queue), "trie-top")
    # Roots of shards learn their parent from the heavy nodes.
    lower = done.join(parents, (done["p1"] == parents["p1"]) & (done["p2"] == parents["p2"]) & (done["depth"] == parents["depth"])
                      & done["is_top"], "left")
    lower = lower.select(done["depth"], "k1", "k2", done["conv_id"], F.coalesce("parent_conv_id", "parent").alias("parent_conv_id"), "n_convs",
                         "n_children", "n_leaves", "saved_tokens")
    every = lower.union(upper.select(*lower.columns)).join(_ends(rows), ["k1", "k2"], "left")
    nothing = F.sha2(F.lit(""), 256)
    return every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
