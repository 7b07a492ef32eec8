"""Byte-level BPE encoding and decoding with recursive queries in an embedded DuckDB, one per Python worker.

A text is cut into words by the tokenizer's pattern. The distinct new words of a slice become token-position
rows; a recursive query joins neighbouring rows to the merge table and contracts each word's leftmost pair of
minimum rank until no pair of any word merges. Words that are tokens themselves are ready at once.
Words of more than `LONG` bytes contract in one step every pair that is the lowest as far as a token can reach, which gives the
same tokens. The recursion keeps the rows of all its steps, so words come in runs and long words go some steps at a time:
a query holds some `ROWS` rows. Ordered aggregation over the positions gives a word's ids and, joined to the vocabulary, its
bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import tempfile
from collections.abc import Callable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strata.llm.tools import map_rows

SCHEMA = "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
LONG = 128
#: Rows that a recursive query holds, about; a word of more bytes goes one step at a time.
ROWS = 1_000_000
#: Characters whose words are encoded together.
CHARACTERS = 4_000_000
#: Distinct words remembered by a worker; the memory is emptied beyond it.
REMEMBERED = 1_200_000

# A row's `key` orders its pair with the next row (`npos`, `ntok`) by rank, then position; the word's lowest key is
# contracted: that row takes the merged token and the place after its pair, the pair's second row goes.
SHORT_SQL = """
WITH RECURSIVE step(w, pos, tok, npos, ntok, key, it) AS (
  SELECT l.w, l.pos, l.tok, l.npos, l.ntok, m.rank * 65536 + l.pos, 0
  FROM (SELECT *, lead(pos) OVER word AS npos, lead(tok) OVER word AS ntok
        FROM letters WINDOW word AS (PARTITION BY w ORDER BY pos)) l
  LEFT JOIN merges m ON m.pair = l.tok::BIGINT * 65536 + l.ntok
  UNION ALL
  SELECT s.w, s.pos, s.tok, s.npos, s.ntok, m.rank * 65536 + s.pos, s.it
  FROM (SELECT r.w, r.pos, r.it + 1 AS it,
               CASE WHEN r.key = b.best THEN b.best // 65536 ELSE r.tok END AS tok,
               CASE WHEN r.key = b.best THEN b.npos ELSE r.npos END AS npos,
               CASE WHEN r.key = b.best THEN b.ntok WHEN r.npos = b.best % 65536 THEN b.best // 65536 ELSE r.ntok END AS ntok
        FROM step r
        JOIN (SELECT l.w, l.best, l.gone, g.npos, g.ntok
              FROM (SELECT w, min(key) AS best, arg_min(npos, key) AS gone FROM step WHERE key IS NOT NULL GROUP BY w) l
              JOIN step g ON g.w = l.w AND g.pos = l.gone) b ON b.w = r.w
        WHERE r.pos <> b.gone) s
  LEFT JOIN merges m ON m.pair = s.tok::BIGINT * 65536 + s.ntok
)
SELECT s.w, s.pos, s.tok FROM step s JOIN (SELECT w, max(it) AS it FROM step GROUP BY w) l ON s.w = l.w AND s.it = l.it"""

# A pair whose key is the lowest as far as a token can reach ({reach} bytes before its place and twice that behind it) is
# contracted, so a step takes one pair of each neighbourhood instead of one of the word. Whatever could take one of its two tokens away
# would be a token that holds a pair with a lower key, which would have to lie that close. Stops after {steps} steps.
LONG_SQL = """
WITH RECURSIVE step(w, pos, tok, it, active) AS (
  SELECT w, pos, tok, 0, true FROM letters
  UNION ALL
  SELECT w, pos, CASE WHEN take THEN key // 4294967296 ELSE tok END, it + 1, active
  FROM (SELECT *, lag(take) OVER (PARTITION BY w ORDER BY pos) AS gone, bool_or(take) OVER (PARTITION BY w) AS active
        FROM (SELECT w, pos, tok, it, key, coalesce(key = min(key) OVER (
                       PARTITION BY w ORDER BY pos RANGE BETWEEN {reach} PRECEDING AND 2 * {reach} FOLLOWING), false) AS take
              FROM (SELECT s.w, s.pos, s.tok, s.it, m.rank * 4294967296 + s.pos AS key
                    FROM (SELECT w, pos, tok, it, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM step
                          WHERE active AND it < {steps}) s
                    LEFT JOIN merges m ON m.pair = s.tok::BIGINT * 65536 + s.nxt)))
  WHERE NOT coalesce(gone, false)
)
SELECT w, pos, tok, active FROM step
QUALIFY it = max(it) OVER (PARTITION BY w)"""

# A word's ids and the bytes they stand for, in order: id:bytes id:bytes ...
GATHER = """
SELECT t.w, string_agg(t.tok::VARCHAR || ':' || v.hex, ' ' ORDER BY t.pos) AS tokens
FROM merged t JOIN vocabulary v ON v.id = t.tok
GROUP BY t.w"""


def _runs(words: list[int], rows: Callable[[int], int]) -> Iterator[list[int]]:
    """`words` in runs of at most `ROWS` rows, or of one word."""
    run, held = [], 0
    for w in words:
        if run and held + rows(w) > ROWS:
            yield run
            run, held = [], 0
        run.append(w)
        held += rows(w)
    if run:
        yield run


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    """`texts` in blocks of at most `CHARACTERS`, or of one text."""
    block, held = [], 0
    for text in texts:
        if block and held + len(text) > CHARACTERS:
            yield block
            block, held = [], 0
        block.append(text)
        held += len(text)
    if block:
        yield block


class Codec:
    """Vocabulary and merge table in DuckDB, and the words encoded so far."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        if max(self.ranks.values()) >= 65536:
            raise ValueError("pairs are keyed in 16 bits per token")
        pairs, ranks = [], []
        for piece, rank in self.ranks.items():
            for cut in range(1, len(piece)):
                left, right = self.ranks.get(piece[:cut]), self.ranks.get(piece[cut:])
                if left is not None and right is not None:
                    pairs.append(left * 65536 + right)
                    ranks.append(rank)
        # A query that needs more memory for a huge word goes to Spark's own scratch folder.
        scratch = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        scratch = f"{scratch if os.path.isdir(scratch) else tempfile.gettempdir()}/duckdb-{os.getpid()}"
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "preserve_insertion_order": False,
                                         "temp_directory": scratch})
        # The bytes of each piece as bits of a number, with its length, longest first.
        self.made_of = sorted(((len(piece), sum(1 << b for b in set(piece))) for piece in self.ranks), reverse=True)
        merges = pa.table({"pair": pa.array(pairs, pa.int64()), "rank": pa.array(ranks, pa.int64())})
        vocabulary = pa.table({"id": pa.array(list(self.ranks.values()), pa.int64()),
                               "hex": [piece.hex() for piece in self.ranks]})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def _table(self, name: str, w: np.ndarray, pos: np.ndarray, tok: np.ndarray) -> None:
        self.db.register("given", pa.table({"w": w.astype(np.int32), "pos": pos.astype(np.int32), "tok": tok.astype(np.int32)}))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _letters(self, at: list[int], raws: list[bytes]) -> None:
        """One row per byte of the words `at`, in the table letters."""
        chosen = [raws[w] for w in at]
        size = np.fromiter(map(len, chosen), np.int64, len(at))
        ends = np.cumsum(size)
        self._table("letters", np.repeat(np.array(at), size), np.arange(int(ends[-1])) - np.repeat(ends - size, size),
                    self.byte[np.frombuffer(b"".join(chosen), np.uint8)])

    def learn(self, words: list[str]) -> None:
        """Encode distinct words."""
        raws = [word.encode("utf-8", "replace") for word in words]
        rest = [w for w, raw in enumerate(raws) if raw not in self.ranks]
        for at in _runs([w for w, raw in enumerate(raws) if raw in self.ranks], lambda w: 8):
            self._table("merged", np.array(at), np.zeros(len(at)), np.array([self.ranks[raws[w]] for w in at]))
            self._remember(words)
        # A short word has a row less in each step; all words of a run end with their last step.
        for at in _runs([w for w in rest if len(raws[w]) <= LONG], lambda w: len(raws[w]) ** 2 // 2):
            self._letters(at, raws)
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE merged AS {SHORT_SQL}")
            self._remember(words)
        for at in _runs([w for w in rest if len(raws[w]) > LONG], lambda w: len(raws[w])):
            self._letters(at, raws)
            self._contract_long(b"".join(raws[w] for w in at))
            self._remember(words)

    def _remember(self, words: list[str]) -> None:
        """Take the words in merged over into `known`."""
        done = self.db.execute(GATHER).fetchnumpy()
        for w, tokens in zip(done["w"].tolist(), done["tokens"].tolist()):
            parts = tokens.replace(":", " ").split(" ")
            self.known[words[w]] = len(parts) // 2, " ".join(parts[::2]), bytes.fromhex("".join(parts[1::2]))

    def _contract_long(self, letters: bytes) -> None:
        """Contract the words in letters to the end, into merged, as many steps at a time as `ROWS` allows."""
        # No token reaches further than the longest piece that is made of the words' own bytes.
        others = ~sum(1 << b for b in set(letters))
        reach = next(size for size, made_of in self.made_of if not made_of & others)
        self.db.execute("CREATE OR REPLACE TEMP TABLE merged (w INTEGER, pos INTEGER, tok INTEGER)")
        while rows := self.db.execute("SELECT count(*) FROM letters").fetchone()[0]:
            sql = LONG_SQL.format(reach=reach, steps=max(1, ROWS // rows))
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE contracted AS {sql}")
            self.db.execute("INSERT INTO merged SELECT w, pos, tok FROM contracted WHERE NOT active")
            self.db.execute("CREATE OR REPLACE TEMP TABLE letters AS SELECT w, pos, tok FROM contracted WHERE active")

    def encode(self, texts: list[str]) -> list[tuple[int, str, bytes]]:
        """Per text, the number of tokens, its ids joined by spaces, and the decoded bytes."""
        words = [self.split(t) for t in texts]
        distinct = set().union(*words)
        fresh = distinct.difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
            fresh = distinct
        if fresh:
            self.learn(list(fresh))
        out = []
        for group in words:
            counts, ids, raws = zip(*map(self.known.__getitem__, group)) if group else ((), (), ())
            out.append((sum(counts), " ".join(ids), b"".join(raws)))
        return out


@functools.lru_cache(maxsize=1)
def codec(rank_file: str, pattern: str) -> Codec:
    """One codec per Python worker, so that tasks share the words it knows."""
    return Codec(rank_file, pattern)


def encode_decode(documents: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each whole text.

    A null or empty text has no tokens; its digests are those of nothing. Repeated rows are encoded one by one,
    other columns are ignored, an empty table gives no rows.
    """

    def make():
        encode = codec(rank_file, pattern).encode

        def work(rows):
            done = [d for block in _blocks([t or "" for t in rows["text"]]) for d in encode(block)]
            return [rows["doc_id"], [n for n, _, _ in done], [hashlib.sha256(ids.encode()).hexdigest() for _, ids, _ in done],
                    [hashlib.sha256(raw).hexdigest() for _, _, raw in done]]

        return work

    return map_rows(documents, ["doc_id", "text"], SCHEMA, make, rows=1024)
