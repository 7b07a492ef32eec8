"""Sum-of-squares online packing of token sequences into fixed windows.

A document's ids are cut into full windows; the rest is an item. Items arrive online and go to the fill
level that minimises the sum over levels of the squared number of partially filled windows: the level array
holds that number per fill level, so one vector expression prices every choice. Packing runs per input partition, without a shuffle.
When `max_open` windows are open, and at the end of a partition, the open windows' pieces are laid end to
end and cut at window ends; the last rest of a partition is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import zlib
from collections import defaultdict

import numpy as np
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from strata.llm.tools import slices

SCHEMA = ("doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, "
          "sequence_id BIGINT, offset BIGINT")
#: Chunks and pieces remembered by a worker; the memory is emptied beyond it.
REMEMBERED = 1_500_000
#: Characters that are composed already, are no white space and have a lower case of their own. Added tokens need others.
LATIN = re.compile(r"[\x21-\x3b\x3d-\x7e\xa1-\u012f\u0131-\u024f]+").fullmatch


class Memory:
    """Numbers strings as they come, and holds their ids, one after the other."""

    def __init__(self):
        self.numbers: dict = defaultdict(itertools.count().__next__)
        self.flat, self.start, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, keys), np.int64, len(keys))

    def fresh(self) -> list:
        """Numbered strings without ids, in order."""
        return list(itertools.islice(reversed(self.numbers), len(self.numbers) - len(self.size)))[::-1]

    def add(self, row: np.ndarray, size: np.ndarray, order: np.ndarray | slice = slice(None)) -> None:
        """Ids of the strings without, in the order given: the i-th of `size` belongs to string `order[i]`."""
        start, sizes = np.empty_like(size), np.empty_like(size)
        start[order], sizes[order] = len(self.flat) + np.cumsum(size) - size, size
        self.start, self.size, self.flat = np.r_[self.start, start], np.r_[self.size, sizes], np.r_[self.flat, row]

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of strings `at` in a row, and how many each has."""
        size = self.size[at]
        ends = np.cumsum(size)
        step = np.arange(int(ends[-1]) if len(ends) else 0)
        return self.flat[step + np.repeat(self.start[at] - ends + size, size)], size


class Encoder:
    """Ids of texts. White space separates pre-tokens, so chunks between it are encoded once and remembered.

    A new chunk of Latin letters is lower-cased and cut by the tokenizer's own pattern first, where the tokenizer does so:
    its pieces are far fewer, and pass the rest of the tokenizer without the normalizer. Other chunks take all of it.
    """

    def __init__(self, file: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = sorted(i for i, t in self.tokenizer.get_added_tokens_decoder().items()
                       if not (t.normalized or t.single_word or t.lstrip or t.rstrip))
        self.mark_id = added[0] if added else None
        self.mark = self.tokenizer.id_to_token(added[0]) if added else None
        self.cut, self.rest = self._finer(json.loads(self.tokenizer.to_str()))
        self._forget()

    @staticmethod
    def _finer(spec: dict):
        """The pattern of the pre-tokens and a tokenizer for what it finds; None for tokenizers built otherwise."""
        normal = (spec["normalizer"] or {}).get("normalizers", [])
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        split = steps[0] if steps else {}
        if ([n["type"] for n in normal] != ["NFC", "Replace", "Lowercase"] or normal[1]["pattern"] != {"Regex": r"\s+"}
                or split.get("type") != "Split" or split["behavior"] != "Removed" or not split["invert"]
                or any("<" not in t["content"] for t in spec["added_tokens"])):
            return None, None
        rest = spec | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps[1:]}}
        return regex.compile(split["pattern"]["Regex"] + r"|\n").findall, Tokenizer.from_str(json.dumps(rest))

    def _forget(self, beyond: int = -1):
        if beyond < 0 or len(self.chunks.size) > beyond:
            self.chunks = Memory()
        if beyond < 0 or len(self.pieces.size) > beyond:
            self.pieces = Memory()
            self.pieces.of(["\n"])
            self.pieces.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _ids(self, tokenizer: Tokenizer, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each chunk has.

        An added token of the vocabulary splits a text before anything else happens to it, so chunks with it
        between them are encoded in one call as they would be one by one.
        """
        plain = self.mark is not None and not any(self.mark in c for c in chunks)
        texts = [self.mark.join(chunks)] if plain else chunks
        ids = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if not plain:
            return np.fromiter((i for x in ids for i in x), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))
        row = np.array(ids[0], np.uint32)
        marks = np.flatnonzero(row == self.mark_id)
        return np.delete(row, marks), np.diff(np.r_[-1, marks, len(row)]) - 1

    def _learn(self, fresh: list[str]) -> None:
        """Ids of new chunks: those of their pieces, or, for a chunk that is not cut, its own."""
        latin = [self.cut is not None and LATIN(c) is not None for c in fresh]
        found = self.cut("\n".join(itertools.compress(fresh, latin)).lower()) if any(latin) else []
        at = self.pieces.of(found)
        new = self.pieces.fresh()
        if new:
            self.pieces.add(*self._ids(self.rest, new))
        row, size = self.pieces.gather(at)
        # A line end between two chunks has no ids; sums up to each give the chunks' sizes.
        ends = np.flatnonzero(np.r_[at == self.pieces.numbers["\n"], True]) if any(latin) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[0, np.r_[0, np.cumsum(size)][ends]])
        whole = [c for c, cut in zip(fresh, latin) if not cut]
        order = np.argsort(~np.array(latin), kind="stable")
        if whole:
            more, lengths = self._ids(self.tokenizer, whole)
            row, sizes = np.r_[row, more], np.r_[sizes, lengths]
        self.chunks.add(row, sizes, order)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self._forget(self.remembered)
        groups = [t.encode().split() for t in texts]  # bytes are split at the six ASCII characters only
        at = self.chunks.of([c for group in groups for c in group])
        fresh = self.chunks.fresh()
        if fresh:
            self._learn([c.decode() for c in fresh])
        row, size = self.chunks.gather(at)
        ends = np.r_[0, np.cumsum(size)][np.cumsum([len(group) for group in groups])]
        return np.split(row, ends[:-1])


@functools.lru_cache(maxsize=1)
def encoder(file: str, remembered: int) -> Encoder:
    """One encoder per Python worker, so that tasks share what it remembers."""
    return Encoder(file, remembered)


class Packer:
    """Online packing of one stream of documents; `emit` collects output rows."""

    def __init__(self, window: int, max_open: int, base: int):
        self.window, self.max_open, self.next = window, max_open, base
        self.levels = np.zeros(window, np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0
        self.rows: list[tuple] = []

    def _write(self, pieces: list[tuple]) -> None:
        """One finished window: pieces of (doc, start, ids, doc_tokens) from offset 0 on."""
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def choose(self, size: int) -> int:
        """The fill level to put an item on; 0 opens a window. Ties go to the fullest level."""
        window, n = self.window, self.levels
        to = np.zeros(window - size + 1, np.int64)
        to[:window - size] = 2 * n[size:] + 1
        cost = to - 2 * n[:window - size + 1] + 1
        cost[1:][n[1:window - size + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = to[0]
        return len(cost) - 1 - int(np.argmin(cost[::-1]))

    def add(self, doc, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.window:
            self._write([(doc, start, ids[start:start + self.window], total)])
            start += self.window
        size = total - start
        if not size:
            return
        level = self.choose(size)
        pieces = self.open[level].pop() if level else []
        if level:
            self.levels[level] -= 1
        else:
            self.n_open += 1
        pieces.append((doc, start, ids[start:].copy(), total))
        if level + size == self.window:
            self._write(pieces)
            self.n_open -= 1
        else:
            self.open.setdefault(level + size, []).append(pieces)
            self.levels[level + size] += 1
        if self.n_open > self.max_open:
            self._cut_open()

    def _cut_open(self, last: bool = False) -> None:
        """Lay the open windows' pieces end to end and cut at window ends; what is left stays open, or is cut to powers of two."""
        pieces = [p for level in sorted(self.open, reverse=True) for group in self.open[level] for p in group]
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        left, size, room, current = sum(len(p[2]) for p in pieces), 0, 0, []
        for doc, start, ids, total in pieces:
            while len(ids):
                if not current:
                    room = self.window if left >= self.window or not last else 1 << (left.bit_length() - 1)
                    size = 0
                take = min(room - size, len(ids))
                current.append((doc, start, ids[:take], total))
                ids, start, size, left = ids[take:], start + take, size + take, left - take
                if size == room:
                    self._write(current)
                    current = []
        if current:
            self.open, self.n_open = {size: [current]}, 1
            self.levels[size] = 1

    def close(self) -> None:
        self._cut_open(last=True)


def pack(documents: DataFrame, tokenizer_file: str, window: int = 2048, end_id: int = 1, max_open: int = 4096,
         remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its whole text and `end_id`; a null or empty text is `end_id` alone. Repeated
    rows and equal ids are packed one by one, other columns are ignored, an empty table gives no rows. At most
    `max_open` windows are held per task. A worker keeps the ids of up to `remembered` chunks between its tasks;
    with fewer it needs less memory and encodes some chunks again.
    """
    import pyarrow as pa

    types = [pa.int64()] * 7
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches):
        encode = encoder(tokenizer_file, remembered).encode
        packer = Packer(window, max_open, TaskContext.get().partitionId() << 40)

        def rows():
            out, packer.rows = packer.rows, []
            columns = zip(*out) if out else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for part in slices(batches, 256):
            columns = part.to_pydict()
            for doc, ids in zip(columns["doc_id"], encode([t or "" for t in columns["text"]])):
                packer.add(doc, np.append(ids, np.uint32(end_id)))
            yield rows()
        packer.close()
        yield rows()

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
