"""Token counts of a BPE sentence-piece model by rank-synchronous merging of ragged arrays.

A text becomes pre-tokens that no piece of the vocabulary crosses. The distinct pre-tokens of a slice
are held as one ragged symbol array; each round finds the lowest-ranked adjacent pair of every sequence
with one segmented minimum and merges all its occurrences at once. Where such a merge would create a pair of a
still lower rank, which the sequential rule would have to take first, only the leftmost occurrence is merged
in that round. What survives is counted; a character outside the vocabulary counts its UTF-8 bytes.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from strata.llm.tools import map_rows

SCHEMA = "doc_id BIGINT, n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN"
SPACE = "▁"
PRE_TOKEN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NONE = np.int64(1 << 40)
#: Distinct pre-tokens remembered by a worker; the memory is emptied beyond it.
REMEMBERED = 400_000


class Merges:
    """Symbols, their cost in tokens, and the ranked pairs of a model."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        normal = [i for i in range(model.get_piece_size())
                  if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        pieces = [model.id_to_piece(i) for i in sorted(normal, key=lambda i: (-model.get_score(i), i))]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("a piece crosses pre-tokens; this model needs another split")
        chars = sorted({c for p in pieces for c in p} - set(pieces))
        self.symbol = {s: i for i, s in enumerate(pieces + chars)}
        self.size = len(self.symbol)
        self.cost = np.array([1] * len(pieces) + [len(c.encode()) for c in chars], np.int64)
        keys, ranks = [], []
        for rank, piece in enumerate(pieces):
            for cut in range(1, len(piece)):
                left, right = self.symbol.get(piece[:cut]), self.symbol.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    ranks.append(rank)  # the merged symbol has its rank as its number
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.ranks = np.array(keys, np.int64)[order], np.array(ranks, np.int64)[order]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the pair does not merge; negative symbols merge with nothing."""
        wanted = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each (non-empty) pre-token."""
        get = self.symbol.get
        # An unknown character is -(its number of bytes).
        flat = np.fromiter((get(c) if c in self.symbol else -len(c.encode("utf-8", "replace"))
                            for w in words for c in w), np.int64)
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        total = np.zeros(len(words), np.int64)

        def finish(sym, own):
            np.add.at(total, own, np.where(sym < 0, -sym, self.cost[np.maximum(sym, 0)]))

        pair = self._pairs(flat, owner)
        while len(flat):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(flat)])
            lowest = np.repeat(np.minimum.reduceat(pair, starts), sizes)
            done = lowest == NONE
            if done.any():
                finish(flat[done], owner[done])
                flat, owner, pair, lowest = flat[~done], owner[~done], pair[~done], lowest[~done]
                if not len(flat):
                    break
            at = np.flatnonzero(pair == lowest)
            # In a run of adjacent occurrences every second one is free.
            new_run = np.r_[True, at[1:] != at[:-1] + 1]
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            at = self._allowed(flat, owner, pair, at)
            flat[at] = pair[at]
            keep = np.ones(len(flat), bool)
            keep[at + 1] = False
            # Only the pairs beside a merge change.
            stale = np.zeros(len(flat), bool)
            stale[at] = True
            stale[np.maximum(at - 1, 0)] = True
            stale[np.maximum(at - 2, 0)] = True
            flat, owner, pair, stale = flat[keep], owner[keep], pair[keep], stale[keep]
            self._refresh(flat, owner, pair, np.flatnonzero(stale))
        return total

    def _pairs(self, flat, owner):
        pair = np.full(len(flat), NONE)
        self._refresh(flat, owner, pair, np.arange(len(flat)))
        return pair

    def _refresh(self, flat, owner, pair, at):
        after = np.minimum(at + 1, len(flat) - 1)
        inside = (at + 1 < len(flat)) & (owner[after] == owner[at])
        pair[at] = np.where(inside, self.rank(flat[at], np.where(inside, flat[after], -1)), NONE)

    def _allowed(self, flat, owner, pair, at):
        """The occurrences to merge now: all of a sequence, or its first where a lower pair would appear."""
        made, n = pair[at], len(flat)
        chained = np.r_[False, at[1:] == at[:-1] + 2]
        before, after = np.maximum(at - 1, 0), np.minimum(at + 2, n - 1)
        has_before = (at > 0) & (owner[before] == owner[at])
        has_after = (at + 2 < n) & (owner[after] == owner[at])
        left = np.where(chained, np.r_[0, made[:-1]], flat[before])
        lower = np.where(has_before | chained, self.rank(left, made), NONE) < made
        lower |= np.where(has_after, self.rank(made, flat[after]), NONE) < made
        if not lower.any():
            return at
        own = owner[at]
        first = np.r_[True, own[1:] != own[:-1]]
        return at[first | ~np.isin(own, own[lower])]


@functools.lru_cache(maxsize=1)
def remembered(model_file: str) -> tuple[Merges, dict[str, int]]:
    """The merges and the counts of known pre-tokens, shared by the tasks of a Python worker."""
    return Merges(model_file), {}


def count_tokens(documents: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each whole text.

    A null or empty text has no bytes and no tokens. Repeated rows are counted one by one, other columns
    are ignored, an empty table gives no rows. Begin and end tokens are never added.
    """

    def make():
        merges, known = remembered(model_file)

        def work(rows):
            texts = [t or "" for t in rows["text"]]
            words = [PRE_TOKEN.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
            fresh = list({w for group in words for w in group if w not in known})
            if fresh:
                if len(known) + len(fresh) > REMEMBERED:
                    known.clear()
                    fresh = list({w for group in words for w in group})
                known.update(zip(fresh, merges.count(fresh).tolist()))
            counts = [sum(map(known.__getitem__, group)) for group in words]
            return [rows["doc_id"], [len(t.encode("utf-8", "replace")) for t in texts], counts, [n > limit for n in counts]]

        return work

    return map_rows(documents, ["doc_id", "text"], SCHEMA, make)
