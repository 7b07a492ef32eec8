"""Exact removal of repeated byte strings with a sparse, range-partitioned suffix array.

Every string of `LENGTH` bytes has an anchor that depends on its bytes alone: the leftmost of its 64-byte grams with the
smallest hash. Equal strings have equal anchors, so only strings with the same anchor gram have to be compared, and
neighbouring strings that share an anchor travel together as one context. Grams that occur once, and contexts
that are the only one of their gram, are decided by counts alone, which combine on the map side.

The rest is sorted: Spark samples splitters and range-partitions the contexts by the bytes that follow their anchor (then those
before it), each bucket sorts the suffixes of its contexts by multikey quicksort - eight bytes at a time, refining only ranges
that still tie - and equal neighbours are repeats. A gram at the edge of a bucket may go on in the next one: the digests of its
suffixes are compared across buckets, dealt by digest, so that one common passage spreads over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.jaccard_join import BASE, POWERS, _mix
from strata.llm.tools import map_rows, slices
from strata.workspace import materialize

LENGTH, GRAM = 200, 64
WIDTH = LENGTH - GRAM + 1
#: Bytes of contexts that are sorted in one bucket, about.
BUCKET_BYTES = 16 << 20
#: Contexts that are cut from texts at a time.
CUT = 10_000
#: Suffixes of a bucket that are compared at a time, and bytes of contexts that are hashed at a time, about.
COMPARED, HASHED = 1 << 18, 1 << 20
#: String starts handled at a time, and the low bits of a sort key that hold a position.
SEGMENT, POSITION_BITS = 1 << 19, np.uint64(22)
RESULT = "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING"


def _window_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive keys, by running minima from both ends of blocks."""
    n = len(keys)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def _prefix_sums(raw: np.ndarray) -> np.ndarray:
    up, _ = POWERS.to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return sums


def _hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _mix((sums[end] - sums[start]) * POWERS.to(len(sums))[1][start])


def contexts_of(raw: bytes) -> tuple[np.ndarray, ...]:
    """(gram, context, first, back, span) per context: starts first..first+span share the anchor at first + back."""
    out = []
    for begin in range(0, len(raw) - LENGTH + 1, SEGMENT):
        part = np.frombuffer(raw, np.uint8)[begin:begin + SEGMENT + LENGTH - 1]
        sums = _prefix_sums(part)
        at = np.arange(len(part) - GRAM + 1)
        grams = _hash(sums, at, at + GRAM)
        keys = (grams >> POSITION_BITS << POSITION_BITS) | at.astype(np.uint64)
        anchor = (_window_minimum(keys, WIDTH) & np.uint64((1 << int(POSITION_BITS)) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:], len(anchor)] - 1
        a = anchor[first]
        back, span = a - first, last - first
        context = _mix(_hash(sums, first, last + LENGTH) + (back * 256 + span).astype(np.uint64) * BASE)
        out.append((grams[a].view(np.int64), context.view(np.int64), first + begin, back, span))
    return tuple(map(np.concatenate, zip(*out))) if out else (np.zeros(0, np.int64),) * 5


def _place(first, back, span, tag):
    """One long: first start, 16 bits more of the row's hash, anchor offset, number of further starts."""
    return first << 32 | tag << 16 | back << 8 | span


def _keyed(documents: DataFrame) -> DataFrame:
    """doc_id, raw and an 80-bit hash of both (id, tag), so that rows which share a doc_id or have none are told apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(F.col("doc_id"), F.xxhash64("doc_id", F.col("doc_id").isNull(), text).alias("id"),
                            F.xxhash64(F.lit("tag"), text, "doc_id").bitwiseAND(0xFFFF).alias("tag"), text.cast("binary").alias("raw"))


def _all_contexts(keyed: DataFrame) -> DataFrame:
    def run(batches):
        for part in slices(batches):
            found = [(i, t, contexts_of(r)) for i, t, r in zip(*(part.column(k).to_pylist() for k in range(3))) if len(r) >= LENGTH]
            if found:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([c[0] for _, _, c in found])), pa.array(np.concatenate([c[1] for _, _, c in found])),
                    pa.array(np.repeat(np.array([i for i, _, _ in found], np.int64), [len(c[0]) for _, _, c in found])),
                    pa.array(np.concatenate([_place(c[2], c[3], c[4], t) for _, t, c in found]))],
                    names=["gram", "context", "id", "place"])

    return keyed.select("id", "tag", "raw").mapInArrow(run, "gram BIGINT, context BIGINT, id BIGINT, place BIGINT")


def _first(place) -> Column:
    return F.shiftright(place, 32)


def _tag(place) -> Column:
    return F.shiftright(place, 16).bitwiseAND(0xFFFF)


def _span(place) -> Column:
    return F.col(place).bitwiseAND(0xFF)


def _cut(samples: DataFrame, keyed: DataFrame) -> DataFrame:
    """The bytes of one occurrence of each undecided context: gram, context, known, back, span, lead (from the anchor on), left."""
    wanted = samples.groupBy(F.col("at.id").alias("id"), _tag("at.place").alias("tag")).agg(
        F.collect_list(F.struct("gram", "context", "known", F.col("at.place").alias("place"))).alias("wanted"))

    kinds = {"gram": pa.int64(), "context": pa.int64(), "known": pa.bool_(), "back": pa.int64(), "span": pa.int64(), "lead": pa.binary(), "left": pa.binary()}

    def rows_of(part):
        for raw, wanted in zip(*map(iter, part.columns)):
            raw = raw.as_py()
            for w in wanted.as_py():
                first, back, span = w["place"] >> 32, w["place"] >> 8 & 0xFF, w["place"] & 0xFF
                anchor = first + back
                yield w["gram"], w["context"], w["known"], back, span, raw[anchor:first + span + LENGTH], raw[first:anchor]

    def run(batches):
        for part in slices(batches):
            rows = rows_of(part)
            while some := list(islice(rows, CUT)):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds.values())], names=list(kinds))

    # Documents with one id and text arrive more than once; their contexts are made distinct again below.
    return keyed.join(wanted, ["id", "tag"]).select("raw", "wanted").mapInArrow(
        run, "gram BIGINT, context BIGINT, known BOOLEAN, back BIGINT, span BIGINT, lead BINARY, left BINARY")


def equal_neighbours(group: np.ndarray, words: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Multikey quicksort of suffixes: whether each has an equal one. `group` holds integers that must tie first.

    `words` are the big-endian 8-byte words that begin at every byte, `start` the suffixes' first bytes. Ranges that
    still tie are sorted by their next word and split; a suffix alone in its range is settled.
    """
    order = np.argsort(group, kind="stable")
    label = np.cumsum(np.r_[True, group[order][1:] != group[order][:-1]])
    for step in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        if not len(order):
            break
        tied = np.bincount(label)[label] > 1
        order, label = order[tied], label[tied]
        word = words[start[order] + step].astype(np.uint64)
        turn = np.lexsort((word, label))
        order, label, word = order[turn], label[turn], word[turn]
        label = np.cumsum(np.r_[True, (label[1:] != label[:-1]) | (word[1:] != word[:-1])]) if len(order) else label
    found = np.zeros(len(group), bool)
    if len(order):
        found[order[np.bincount(label)[label] > 1]] = True
    return found


def _ranges(owner: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive offsets of an owner: owner, first, last. Input is in order."""
    fresh = np.r_[True, (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)]
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(owner)] - 1
    return owner[first], offset[first], offset[last]


EDGE = np.dtype([("digest", "<u8"), ("group", "<i8"), ("gram", "<i8"), ("context", "<i8"), ("offset", "<i8"), ("repeated", "<i8")])


class Bucket:
    """The contexts of one bucket. Beside their bytes it holds one flag per suffix; all else is made for some suffixes at a time."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        raw, columns, ends = bytearray(), [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            lead, left = batch.column("lead").to_pylist(), batch.column("left").to_pylist()
            raw += b"".join(chain.from_iterable(zip(left, lead)))
            columns.append([np.array(batch.column(k).to_numpy(zero_copy_only=False)) for k in ("gram", "context", "known", "back", "span")])
            first, last = (f(range(len(lead)), key=lead.__getitem__) for f in (min, max))
            ends += [(lead[first], columns[-1][0][first]), (lead[last], columns[-1][0][last])]
        self.empty = not columns
        if self.empty:
            return
        self.gram, self.context, known, self.back, self.span = map(np.concatenate, zip(*columns))
        self.mixed = _mix(self.gram.view(np.uint64))
        #: Grams that may go on in the bucket before and the one after.
        self.edge = [min(ends)[1], max(ends)[1]]
        raw += b"\0" * 8
        self.raw = np.frombuffer(raw, np.uint8)
        self.words = np.ndarray(len(self.raw) - 7, ">u8", self.raw, strides=(1,))
        sizes = self.span + LENGTH
        self.base = np.cumsum(sizes) - sizes
        self.place = np.cumsum(self.span + 1) - self.span - 1
        self.repeated = np.repeat(known.astype(bool), self.span + 1)

    def group(self, owner: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """One value per gram and distance to it; only suffixes that share it can be equal."""
        return (self.mixed[owner] * BASE + (self.back[owner] - offset).astype(np.uint64)).view(np.int64)

    def parts(self) -> Iterator[tuple[np.ndarray, int, int]]:
        """Contexts, and distances to their gram from..to, of about `COMPARED` suffixes: whole grams, or some distances of a large one."""
        order = np.argsort(self.gram, kind="stable")
        n = self.span[order] + 1
        begin = np.cumsum(n) - n
        fresh = np.flatnonzero(np.r_[True, self.gram[order][1:] != self.gram[order][:-1]])
        cuts = fresh[np.r_[True, np.diff(begin[fresh] // COMPARED) != 0]]
        for some in np.split(order, cuts[1:]):
            last = self.back[some]
            starts = np.cumsum(np.bincount(last - self.span[some], minlength=WIDTH + 1) - np.bincount(last + 1, minlength=WIDTH + 1))
            turn = (np.cumsum(starts) - 1).clip(0) // COMPARED
            edges = np.flatnonzero(np.r_[True, turn[1:] != turn[:-1], True])
            yield from ((some, x, y) for x, y in zip(edges[:-1], edges[1:]))

    def compare(self) -> None:
        """Flags the suffixes that have an equal one in the bucket."""
        for some, near, far in self.parts():
            low = np.maximum(self.back[some] - far + 1, 0)
            n = np.maximum(np.minimum(self.span[some], self.back[some] - near) - low + 1, 0)
            owner = np.repeat(some, n)
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n - low, n)
            found = equal_neighbours(self.group(owner, offset), self.words, self.base[owner] + offset)
            self.repeated[(self.place[owner] + offset)[found]] = True

    def suffixes(self, contexts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Contexts of about `HASHED` bytes in turn, and owner and offset of their suffixes."""
        sizes = self.span[contexts] + LENGTH
        for some in np.split(contexts, np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // HASHED)) + 1):
            n = self.span[some] + 1
            owner = np.repeat(some, n)
            yield some, owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)

    def edges(self, slots: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """Digests of the suffixes at the bucket's edges, one of equal ones that are known to be: slots and their `EDGE` rows."""
        for some, owner, offset in self.suffixes(np.flatnonzero(np.isin(self.gram, self.edge))):
            sizes = self.span[some] + LENGTH
            sums = _prefix_sums(np.concatenate([self.raw[x:x + n] for x, n in zip(self.base[some], sizes)]))
            start = np.repeat(np.cumsum(sizes) - sizes, self.span[some] + 1) + offset
            table = np.rec.fromarrays([_hash(sums, start, start + LENGTH), self.group(owner, offset), self.gram[owner], self.context[owner],
                                       offset, self.repeated[self.place[owner] + offset].astype(np.int64)], dtype=EDGE)
            table = table[np.lexsort((table["group"], table["digest"]))]
            again = (table["digest"][1:] == table["digest"][:-1]) & (table["group"][1:] == table["group"][:-1])
            table = table[np.r_[True, ~again]]
            slot = (table["digest"] % np.uint64(slots)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(slot[order]) != 0, True])
            yield slot[order[cuts[:-1]]], [table[order[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


def _sort_buckets(cut: DataFrame, buckets: int, slots: int) -> DataFrame:
    """Ranges (gram, context, lo, hi) of repeated starts, and blobs of digests (slot, blob) of the grams at bucket edges."""
    names = ["gram", "context", "lo", "hi", "slot", "blob"]

    def run(batches):
        bucket = Bucket(batches)
        if bucket.empty:
            return
        bucket.compare()
        for _, owner, offset in bucket.suffixes(np.arange(len(bucket.gram))):
            repeated = bucket.repeated[bucket.place[owner] + offset]
            if repeated.any():
                o, lo, hi = _ranges(owner[repeated], offset[repeated])
                yield pa.RecordBatch.from_arrays([pa.array(bucket.gram[o]), pa.array(bucket.context[o]), pa.array(lo), pa.array(hi),
                                                  pa.nulls(len(o), pa.int64()), pa.nulls(len(o), pa.binary())], names=names)
        # Suffixes of the grams at the bucket's edges: digests, dealt by digest.
        for slot, blobs in bucket.edges(slots):
            yield pa.RecordBatch.from_arrays([pa.nulls(len(blobs), pa.int64())] * 4 + [pa.array(slot), pa.array(blobs, pa.binary())], names=names)

    # A bucket's grams are in the order of their bytes, which is all that its edges need; only these bytes are sampled.
    return cut.repartitionByRange(buckets, F.substring("lead", 1, GRAM), F.xxhash64("lead", "left")).mapInArrow(
        run, "gram BIGINT, context BIGINT, lo BIGINT, hi BIGINT, slot BIGINT, blob BINARY")


def _across(edges: DataFrame) -> DataFrame:
    """Ranges of starts that are new repeats when suffixes of different buckets meet."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        t = np.concatenate([np.frombuffer(b, EDGE) for b in rows["blob"]])
        order = np.lexsort((t["group"], t["digest"]))
        t = t[order]
        same = (t["digest"][1:] == t["digest"][:-1]) & (t["group"][1:] == t["group"][:-1])
        hit = (np.r_[False, same] | np.r_[same, False]) & (t["repeated"] == 0)
        t = t[hit]
        return pd.DataFrame({"gram": t["gram"], "context": t["context"], "lo": t["offset"], "hi": t["offset"]})

    return edges.select("slot", "blob").groupBy("slot").applyInPandas(compare, "gram BIGINT, context BIGINT, lo BIGINT, hi BIGINT")


def remove_spans(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without `spans`, how many bytes went, and in how many maximal runs."""
    kept, at, runs, gone = [], 0, 0, 0
    end = -1
    for start, stop in sorted(spans):
        if start > end:
            kept.append(raw[max(end, 0):start])
            runs, gone, end = runs + 1, gone + stop - start, stop
        elif stop > end:
            gone, end = gone + stop - end, stop
    kept.append(raw[max(end, 0):])
    return b"".join(kept), gone, runs


def find_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, raw (the text's bytes) and spans (start, end; they may overlap) of each document; see `deduplicate`."""
    spark = documents.sparkSession
    keyed = _keyed(documents)
    contexts = _all_contexts(keyed)
    # Stored, so that both sides of the join are shuffled for it alone and a very common gram's rows can be split.
    repeated = materialize(contexts.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi"))
                .where("n > 1").select("gram", (F.col("lo") != F.col("hi")).alias("several")), "suffix-grams")
    hits = materialize(contexts.join(repeated, "gram"), "suffix-hits")
    open_hits = hits.where("several").drop("several")
    samples = open_hits.groupBy("gram", "context").agg((F.count("*") > 1).alias("known"), F.min(F.struct("id", "place")).alias("at"))
    cut = materialize(_cut(samples, keyed), "suffix-contexts")
    size = cut.agg(F.sum(F.length("lead") + F.length("left")).alias("bytes")).first()["bytes"] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    sorted_ = materialize(_sort_buckets(cut, buckets, 4 * buckets), "suffix-sorted")
    ranges = sorted_.where("slot IS NULL").select("gram", "context", "lo", "hi").union(_across(sorted_.where("slot IS NOT NULL")))
    settled = hits.where("NOT several").select("id", "place", _first("place").alias("start"),
                                               (_first("place") + _span("place") + LENGTH).alias("end"))
    compared = open_hits.join(ranges, ["gram", "context"]).select(
        "id", "place", (_first("place") + F.col("lo")).alias("start"), (_first("place") + F.col("hi") + LENGTH).alias("end"))
    spans = (settled.union(compared).groupBy("id", _tag("place").alias("tag"))
             .agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    return keyed.join(spans, ["id", "tag"], "left").select("doc_id", "raw", "spans")


def deduplicate(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document, without each byte that a `LENGTH`-byte
    string covers which also starts anywhere else, in the same document or another.

    A null text is empty; texts shorter than `LENGTH` lose nothing. Repeated rows are occurrences of their own, so both
    lose everything; other columns are ignored, an empty table gives no rows. Contexts of one gram are told apart by
    a 64-bit digest beside the gram's own.
    """

    def make():
        def work(rows):
            done = [remove_spans(r, [(s["start"], s["end"]) for s in spans or []]) for r, spans in zip(rows["raw"], rows["spans"])]
            return [rows["doc_id"], [len(r) for r in rows["raw"]], [g for _, g, _ in done], [n for _, _, n in done],
                    [hashlib.sha256(k).hexdigest() for k, _, _ in done]]

        return work

    return map_rows(find_repeats(documents), ["doc_id", "raw", "spans"], RESULT, make)
