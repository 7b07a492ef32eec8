"""Exact BM25 top-k search with block-max pruning over an inverted index in shards.

Every task turns its documents into shards: sorted term hashes, postings, term frequencies and lengths, stored in the
shared folder. Document frequencies, their number and mean length are summed over all shards, so scores do not depend
on the cut. Queries go to the shards in blocks of bounded size, and a shard searches some hundred at a time. Its documents
lie in blocks, like ones side by side. Rare terms give each document a sum; where that and a query's block maxima cannot
reach the query's bound, blocks are skipped, as in block-max WAND; elsewhere a matrix product adds the frequent terms. All
this is done in quanta rounded up, so it bounds the scores closely, and only the few documents whose bound reaches the k-th
score are summed up exactly. Shard results are merged by query. Term weights are rounded to integers (`SCALE` per unit),
so sums are exact in any order and ties are real: they go to the smaller doc_id.
"""

from __future__ import annotations

import io
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.jaccard_join import LOWER
from strata.llm.tools import map_rows, slices
from strata.workspace import materialize, new_dir

K1, B, SCALE = 1.2, 0.75, 100_000
#: Documents and words at most in a shard, documents in a block, queries and about how many of their terms sent at a time.
SHARD_DOCS, SHARD_WORDS, BLOCK, QUERIES, TERMS = 8192, 2_000_000, 64, 8192, 2_000_000
#: Terms in at least one in so many documents of a shard are held as full rows,
#: and that take so much memory at most. Bounds are summed up in so large parts of a weight.
DENSE, ROWS, ROW_BYTES, QUANTUM = 16, 4096, 64 << 20, 2048
#: Queries searched together, postings at most that are read to sum up documents.
TOGETHER, PORTION = 256, 1 << 18
#: Frequent terms by which documents of a shard are laid beside like ones, halvings at most; blocks whose rows lie together.
LIKE, HALVINGS, RUN = 256, 5, 8
NO_ID = -(1 << 63)
#: Lots among which shards are drawn by a hash, shards of the first round, and how many times as many each further round reaches.
LOTS, FIRST, MORE = 1 << 16, 4, 8


def words_of(text: str | None) -> Counter:
    """The words of a text (no ASCII white space, A-Z lower-cased) and how often each occurs."""
    return Counter((text or "").encode("utf-8", "replace").translate(LOWER).split())


def terms_of(words: Counter) -> np.ndarray:
    """64-bit hashes of distinct words."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


Bag = tuple[np.ndarray, np.ndarray]


def bag_of(text: str | None) -> Bag:
    """Term hashes and frequencies of a text, as arrays."""
    words = words_of(text)
    return terms_of(words), np.fromiter(words.values(), np.int32, len(words))


def build_shard(ids: list[int], bags: list[Bag]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Terms, document frequencies, document lengths and the packed postings of some documents, like ones beside each other."""
    term, tf = np.concatenate([t for t, _ in bags]), np.concatenate([n for _, n in bags])
    doc = np.repeat(np.arange(len(bags), dtype=np.int32), [len(t) for t, _ in bags])
    by_term = np.argsort(term)
    term = term[by_term]
    first = np.flatnonzero(np.r_[len(term) > 0, term[1:] != term[:-1]])
    terms, df = term[first], np.diff(np.r_[first, len(term)])
    lengths = np.fromiter((n.sum() for _, n in bags), np.int64, len(bags))
    doc = doc[by_term]
    order = _like_ones(doc, df, lengths)
    place = np.empty(len(bags), np.int32)
    place[order] = np.arange(len(bags))
    return terms, df, lengths[order], _pack(ids=np.array(ids, np.int64)[order], lengths=lengths[order], doc=place[doc], tf=tf[by_term])


def _like_ones(doc: np.ndarray, df: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """An order in which documents with the same frequent terms, and of like length, are neighbours, so that block maxima tell more.

    Documents are halved again and again where the vectors of their frequent terms differ most.
    """
    some = np.argsort(-df, kind="stable")[:LIKE]
    has, end = np.zeros((len(lengths), len(some)), np.float32), np.cumsum(df)
    for i, t in enumerate(some.tolist()):
        has[doc[end[t] - df[t]:end[t]], i] = 1
    has /= np.maximum(np.sqrt(has.sum(axis=1, keepdims=True)), 1)
    parts, start = [np.arange(len(lengths))], np.linspace(1, 2, len(some), dtype=np.float32)
    for _ in range(HALVINGS):
        halves = []
        for part in parts:
            if len(part) > 4 * BLOCK:
                own = has[part] - has[part].mean(axis=0)
                along = start
                for _ in range(8):
                    along = own.T @ (own @ along)
                    along /= max(float(np.sqrt(along @ along)), 1e-30)
                side = own @ along > 0
                halves += [part[~side], part[side]]
            else:
                halves.append(part)
        parts = halves
    return np.concatenate([part[np.argsort(lengths[part], kind="stable")] for part in parts])


def index(documents: DataFrame) -> DataFrame:
    """One row per shard: terms, df, n_docs, n_words, blob."""

    def run(batches):
        def row(ids, bags):
            terms, df, lengths, blob = build_shard(ids, bags)
            return pa.RecordBatch.from_arrays([
                pa.array([terms], pa.list_(pa.int64())), pa.array([df], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()),
                pa.array([int(lengths.sum())], pa.int64()), pa.array([blob], pa.binary())],
                names=["terms", "df", "n_docs", "n_words", "blob"])

        ids, bags, words = [], [], 0
        for part in slices(batches):
            for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids.append(NO_ID if i is None else i)
                bags.append(bag_of(text))
                words += len(bags[-1][0])
                if len(ids) >= SHARD_DOCS or words >= SHARD_WORDS:
                    yield row(ids, bags)
                    ids, bags, words = [], [], 0
        if ids:
            yield row(ids, bags)

    return documents.select("doc_id", "text").mapInArrow(
        run, "terms ARRAY<BIGINT>, df ARRAY<BIGINT>, n_docs BIGINT, n_words BIGINT, blob BINARY")


class Shard:
    """A shard ready to be searched with global statistics."""

    def __init__(self, terms: np.ndarray, df: np.ndarray, blob: bytes, mean_length: float):
        packed = np.load(io.BytesIO(blob))
        self.ids, self.terms, self.doc = packed["ids"], terms, packed["doc"]
        self.end = np.cumsum(df)
        self.start = self.end - df
        tf = packed["tf"].astype(np.float64)
        self.part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * packed["lengths"][self.doc] / mean_length))
        self.n = len(self.ids)
        self.blocks = -(-self.n // (BLOCK * RUN)) * RUN

    def prepare(self, terms: np.ndarray, df: np.ndarray, n: int) -> None:
        """Weigh the postings of all terms, ascending, that queries will ask for. df and n are global."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(len(self.terms) - 1, 0))
        hit = np.flatnonzero(self.terms[at] == terms) if len(self.terms) else np.zeros(0, np.int64)
        at, counts, self.terms, self.local = at[hit], self.end - self.start, terms, np.full(len(terms), -1, np.int32)
        idf, place = np.zeros(len(counts)), np.full(len(counts), -1, np.int32)
        idf[at], place[at] = np.log1p((n - df[hit] + 0.5) / (df[hit] + 0.5)), hit
        # Only postings of these terms stay.
        place = np.repeat(place, counts)
        keep = place >= 0
        weight = np.rint(self.part[keep] * np.repeat(idf, counts)[keep] * SCALE).astype(np.int32)
        doc, place, counts, self.part = self.doc[keep].astype(np.uint16), place[keep], counts[at], None
        ends = np.cumsum(counts)
        quanta = -(-weight // QUANTUM)
        # Terms of at least every DENSE-th document are rows of a matrix, with their block maxima beside them; the most frequent ones if they
        # are too many. Rows and rare postings have weights in quanta, rounded up, for bounds; sums of so few rows are exact in 32 bits.
        dense = np.flatnonzero(counts * DENSE >= self.n)
        dense = dense[np.argsort(-counts[dense], kind="stable")][:min(ROWS, ROW_BYTES // (4 * self.blocks * BLOCK))]
        self.row, self.rows = np.full(len(terms), -1, np.int32), np.zeros((self.blocks // RUN, len(dense), RUN * BLOCK), np.float32)
        self.row[hit[dense]] = np.arange(len(dense))
        at = _ranges((ends - counts)[dense], counts[dense])
        self.rows[doc[at] // (RUN * BLOCK), np.repeat(np.arange(len(dense)), counts[dense]), doc[at] % (RUN * BLOCK)] = quanta[at]
        tops = self.rows.reshape(self.blocks // RUN, len(dense), RUN, BLOCK).max(axis=3, initial=0)
        self.tops = tops.transpose(1, 0, 2).reshape(len(dense), self.blocks)
        self.rare, self.first, self.count = quanta.astype(np.uint32) << 16 | doc, np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        self.first[hit], self.count[hit], self.most = ends - counts, counts, int(quanta.max(initial=0))
        self.count[hit[dense]] = 0
        # The same postings by document, from which the few documents that bounds leave over are summed up exactly.
        order = np.argsort(doc, kind="stable")
        self.place, self.weight = place[order], weight[order]
        self.size = np.bincount(doc, minlength=self.n)
        self.begin = np.cumsum(self.size) - self.size

    def search(self, terms: list[int], k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(doc_id, score) of the k best documents with a score of `least` or more, best first."""
        at = np.flatnonzero(np.isin(self.terms, np.array(terms, np.int64)))
        return self.find(at, np.array([0, len(at)]), np.array([least]), k)[1:]

    def find(self, at: np.ndarray, cuts: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for several queries: query, doc_id and score. A query's terms are the places among those prepared from its cut to the next."""
        row, n = self.row[at], len(least)
        of = np.repeat(np.arange(n), np.diff(cuts))
        asked = np.zeros((n, self.rows.shape[1]), np.float32)
        asked[of[row >= 0], row[row >= 0]] = 1
        bound = np.zeros((n, self.blocks * BLOCK), np.float32 if np.diff(cuts).max(initial=0) * self.most < 1 << 24 else np.float64)
        for i, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            rare = self.rare[_ranges(self.first[at[x:y]], self.count[at[x:y]])]
            bound[i] = np.bincount(rare & 0xFFFF, rare >> 16, bound.shape[1])
        # Unless a block's best document and the block maxima reach the floor, the frequent terms do not matter to a run of blocks.
        floor = (-(-least // QUANTUM)).astype(bound.dtype)
        reach = bound.reshape(n, self.blocks, BLOCK).max(axis=2) + asked @ self.tops >= floor[:, None]
        reach = reach.reshape(n, -1, RUN).any(axis=2)
        for i in np.flatnonzero(reach.any(axis=0)).tolist():
            some = np.flatnonzero(reach[:, i])
            bound[some, i * RUN * BLOCK:(i + 1) * RUN * BLOCK] += asked[some] @ self.rows[i]
        # The k-th best of some documents is a bound for all: where many are left, those with the best chances are summed up first.
        many = np.flatnonzero((bound >= floor[:, None]).sum(axis=1) > 4 * k)
        if len(many):
            least, best = least.copy(), np.concatenate([np.argpartition(bound[i], bound.shape[1] - k)[-k:] for i in many.tolist()])
            least[many] = np.maximum(least[many], self._exact(at, of, n, np.repeat(many, k), best).reshape(-1, k).min(axis=1))
            floor = (-(-least // QUANTUM)).astype(bound.dtype)
        query, doc = np.nonzero(bound >= floor[:, None])
        score = self._exact(at, of, n, query, doc)
        good = score >= least[query]
        query, found, score = query[good], self.ids[doc[good]], score[good]
        best = np.lexsort((found, -score, query))
        query, found, score = query[best], found[best], score[best]
        best = np.arange(len(query)) - np.searchsorted(query, query) < k
        return query[best], found[best], score[best]

    def _exact(self, at: np.ndarray, of: np.ndarray, n: int, query: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Scores of some documents, each with a term of its query. Terms `at` belong to the queries `of`, of which there are n."""
        if not len(doc):
            return np.zeros(0, np.int64)
        terms, local = np.unique(at, return_inverse=True)
        self.local[terms] = np.arange(len(terms))
        has = np.zeros((n, len(terms) + 1), bool)
        has[of, local] = True
        out = []
        for some in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(np.cumsum(self.size[doc]) // PORTION)) + 1):
            size = self.size[doc[some]]
            there = _ranges(self.begin[doc[some]], size)
            weight = self.weight[there] * has[np.repeat(query[some], size), self.local[self.place[there]]]
            out.append(np.add.reduceat(weight, np.cumsum(size) - size, dtype=np.int64))
        self.local[terms] = -1
        return np.concatenate(out)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... count[0] numbers, then those of first[1] and so on."""
    end = np.cumsum(count)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(first - (end - count), count)


def _blocks(rows):
    """Lists of at most `QUERIES` rows, each ended by the row with which it has `TERMS` terms."""
    block, terms = [], 0
    for row in rows:
        block.append(row)
        terms += len(row["terms"]) // 8
        if len(block) == QUERIES or terms >= TERMS:
            yield block
            block, terms = [], 0
    if block:
        yield block


def _top(row) -> bytes:
    """The most frequent term of a query."""
    at = 8 * int(np.frombuffer(row["df"], np.int64).argmax())
    return bytes(row["terms"][at:at + 8])


class Block(NamedTuple):
    """Some queries: ids, the terms of all of them, ascending, and their global df; a query's terms are the places from its cut to the next."""

    ids: np.ndarray
    terms: np.ndarray
    df: np.ndarray
    places: np.ndarray
    cuts: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Block:
        # Queries with the same most frequent term ask for much the same postings, so they follow each other.
        rows = sorted(rows, key=_top)
        term, df = (np.frombuffer(b"".join(bytes(row[column]) for row in rows), np.int64) for column in ("terms", "df"))
        terms, first, places = np.unique(term, return_index=True, return_inverse=True)
        return cls(np.array([row["query_id"] for row in rows], np.int64), terms, df[first], places.astype(np.int32),
                   np.cumsum([0, *(len(row["terms"]) // 8 for row in rows)]))


def _packed(batches):
    """Query ids with their terms and df as bytes."""
    for batch in batches:
        ids, found = batch.columns
        cuts, pairs = found.offsets.to_numpy(), found.values
        columns = [pairs.field(i).to_numpy() for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([ids, *(pa.array([c[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary()) for c in columns)],
                                         names=["query_id", "terms", "df"])


def search(documents: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), doc_id and score of the k best documents for the distinct words of each query text.

    `queries` has doc_id and text. A query without id is left out, as its rows could not be told apart; one without words, or none of whose
    words occurs, has no rows. Documents without words are never found; a null doc_id can be found and sorts first among ties; repeated rows
    are documents of their own, repeated queries with one id are one query of all their words. Empty tables give no rows.

    Shards are searched in rounds, a few first and then `MORE` times as many each: what is found so far gives each query's k-th score
    as a bound, below which later shards return nothing. So a query has some k rows a round and not k a shard. The driver holds one block
    of `QUERIES` queries or some `TERMS` terms at a time.
    """
    spark = documents.sparkSession
    # Lots from 2^i to 2^(i + 1) are level i. Levels are folders, so a round opens only its own shards.
    stored, lot = new_dir(spark, "bm25-index"), F.pmod(F.xxhash64("blob"), F.lit(LOTS))
    parts = index(documents).withColumn("level", F.floor(F.log2(F.greatest(lot, F.lit(1)))).cast("int"))
    parts.write.partitionBy("level").parquet(stored)
    shards = spark.read.schema(parts.schema).parquet(stored)
    sizes = shards.groupBy("level").agg(F.sum("n_docs").alias("docs"), F.sum("n_words").alias("words"), F.count("*").alias("shards")).collect()
    n, words = (sum(row[column] for row in sizes) for column in ("docs", "words"))
    mean, rounds = words / max(n, 1) or 1.0, _levels({row.level: row.shards for row in sizes})

    def make():
        def work(rows):
            bags = [terms_of(words_of(t)) for t in rows["text"]]
            return [rows["doc_id"], bags]

        return work

    asked = map_rows(queries.where("doc_id IS NOT NULL"), ["doc_id", "text"], "query_id BIGINT, terms ARRAY<BIGINT>", make)
    asked = asked.select("query_id", F.explode("terms").alias("term")).distinct()
    df = (shards.select(F.explode(F.arrays_zip("terms", "df")).alias("t"))
          .groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.df").alias("df")))
    known = asked.join(df, "term").groupBy("query_id").agg(F.collect_list(F.struct("term", "df")).alias("terms"))
    known = materialize(known.mapInArrow(_packed, "query_id BIGINT, terms BINARY, df BINARY"), "bm25-queries")
    path = new_dir(spark, "bm25-found")
    schema = "query_id BIGINT, doc_id BIGINT, score BIGINT"
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    spark.createDataFrame([], schema).write.parquet(f"{path}/block=-1")
    for number, rows in enumerate(_blocks(known.toLocalIterator(prefetchPartitions=True))):
        block = Block.of(rows)
        least = np.ones(len(rows), np.int64)
        for start, until in rounds:
            sent = spark.sparkContext.broadcast((block, least))
            some = shards.where((F.col("level") >= start) & (F.col("level") < until)).select("terms", "df", "blob")
            some.mapInArrow(_searcher(sent, n, mean, k), schema).write.mode("append").parquet(f"{path}/block={number}")
            sent.unpersist()
            if (start, until) != rounds[-1]:
                so_far = spark.read.schema(schema).parquet(f"{path}/block={number}").withColumn("rank", F.row_number().over(best))
                bounds = dict(so_far.where(F.col("rank") == k).select("query_id", "score").collect())
                least = np.fromiter((bounds.get(q, 1) for q in block.ids.tolist()), np.int64, len(rows))
    found = spark.read.schema(schema).parquet(f"{path}/*").withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= k)
    return found.select("query_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), (F.col("score") / SCALE).alias("score"))


def _rounds(shards: int) -> list[int]:
    """Up to which of `LOTS` lots the shards are searched in each round: `FIRST` shards at most, then about `MORE` times as many. Powers of two."""
    ends, end = [], max(1, LOTS * FIRST // max(shards, 1))
    while end < LOTS:
        ends.append(1 << end.bit_length() - 1)
        end *= MORE
    return [*dict.fromkeys(ends), LOTS]


def _levels(shards: dict[int, int]) -> list[tuple[int, int]]:
    """From and up to which level each round goes, given the shards of each level. A round of fewer than `FIRST` shards goes on to further levels,
    as one that found little would leave the next without bounds."""
    out, start, last = [], 0, LOTS.bit_length() - 1
    for end in _rounds(sum(shards.values())):
        until = end.bit_length() - 1
        while until < last and sum(n for level, n in shards.items() if start <= level < until) < FIRST:
            until += 1
        if until > start:
            out.append((start, until))
            start = until
    return out


def _searcher(sent, n: int, mean: float, k: int):
    def run(batches):
        block, least = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                terms, df = (batch.column(c)[i].values.to_numpy() for c in (0, 1))
                shard = Shard(terms, df, batch.column(2)[i].as_py(), mean)
                shard.prepare(block.terms, block.df.astype(np.float64), n)
                for start in range(0, len(block.ids), TOGETHER):
                    cuts = block.cuts[start:start + TOGETHER + 1]
                    query, doc, score = shard.find(block.places[cuts[0]:cuts[-1]], cuts - cuts[0], least[start:start + TOGETHER], k)
                    yield pa.RecordBatch.from_arrays([pa.array(block.ids[start + query]), pa.array(doc), pa.array(score)],
                                                     names=["query_id", "doc_id", "score"])

    return run
