"""Quality rules whose cutoffs carry a guarantee on falsely rejected documents.

Each rule is a statistic of a text and a fixed grid of cutoffs, from lenient to strict. On the labelled
holdout, every stratum walks down each grid and keeps a cutoff while the exact binomial (Clopper-Pearson) test
shows that its false rejection rate is below `alpha / rules` at level `delta / (strata * rules)`. Testing in a
fixed order needs no further correction within a grid, and Bonferroni covers rules and strata: with
probability 1 - delta, no stratum loses more than a share alpha of its good documents. Among the certified
cutoffs the one that rejects most bad documents, less `price` times the good ones, is used; a rule that
separates nothing is left off. A stratum with too few labels to certify anything rejects by the base rules alone.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tools import WORD, map_rows
from strata.workspace import materialize

WORDS = re.compile(WORD)
SYMBOLS = "#*$%&|<>"
SPAN = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_echo", "n_marks")


class Rule(NamedTuple):
    """Reject when `number / per` is above the cutoff (below it when `low`); the grid runs from lenient to strict."""

    name: str
    number: str
    per: str
    grid: tuple[float, ...]
    low: bool = False


def _grid(start: float, stop: float, steps: int = 24) -> tuple[float, ...]:
    return tuple(round(start + (stop - start) * i / steps, 6) for i in range(steps + 1))


RULES = (
    Rule("long_words", "word_chars", "n_words", _grid(30, 6)),
    Rule("short_words", "word_chars", "n_words", _grid(1, 4), low=True),
    Rule("symbols", "n_symbols", "n_words", _grid(1, 0.04)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", _grid(0.98, 0.02)),
    Rule("repeated_words", "n_repeat_words", "n_words", _grid(0.3, 0.02)),
    Rule("upper_case", "n_upper", "n_words", _grid(0.98, 0.02)),
    Rule("echoed_words", "n_echo", "n_words", _grid(0.98, 0.02)),
    Rule("exclamations", "n_marks", "n_words", _grid(0.98, 0.02)),
)


def _ids(keys: np.ndarray) -> tuple[np.ndarray, int]:
    unique, ids = np.unique(keys, return_inverse=True)
    return ids.astype(np.int64), len(unique)


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words inside 8-word windows that occur at two or more places. Windows are named exactly, by doubling their length."""
    level, width = ids, 1
    while width < SPAN:
        if len(level) <= width:
            return 0
        level, found = _ids(level[:-width] * kinds + level[width:])
        if found == len(level):
            return 0
        kinds, width = found, 2 * width
    twice = np.bincount(level)[level] > 1
    cover = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + SPAN, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of COUNTS; a null text is empty."""
    text = text or ""
    words = WORDS.findall(text)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(ids, max(1, len(number))), len(lines), sum(map(str.isupper, words)),
            int((ids[1:] == ids[:-1]).sum()), text.count("!"))


def features(documents: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the counts of each document."""
    def make():
        def work(rows):
            counts = zip(*map(measure, rows["text"])) if rows["text"] else [[]] * len(COUNTS)
            return [rows["doc_id"], rows[stratum], *counts]

        return work

    schema = f"doc_id BIGINT, stratum STRING, {', '.join(f'{c} BIGINT' for c in COUNTS)}"
    return map_rows(documents, list(dict.fromkeys(["doc_id", "text", stratum])), schema, make)


def _value(rule: Rule) -> Column:
    per = F.greatest(F.col(rule.per), F.lit(1))
    return F.col(rule.number) / per


def _beyond(rule: Rule, cutoff) -> Column:
    return _value(rule) < cutoff if rule.low else _value(rule) > cutoff


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of Binomial(n, p): the exact p-value of "the rate is p or more" after k rejections."""
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
           for i in range(k + 1)]
    top = max(log)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in log))


def certified(falsely: list[int], good: int, share: float, level: float) -> int:
    """How many cutoffs, from the lenient end on, are shown to reject less than `share` of the good documents."""
    passed = 0
    for k in falsely:
        if k >= share * good or binomial_tail(k, good, share) > level:
            break
        passed += 1
    return passed


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05,
            price: float = 4.0) -> dict[str, dict[str, float]]:
    """The cutoff per stratum and rule. Documents failing the base rules take no part: they go in any case.

    The driver receives one count per stratum, rule, grid step and label, and only of strata with enough
    good labels to certify a cutoff; there are at most (labelled rows / that number) of those.
    A document labelled twice counts once, as bad if any label says so. A null stratum or label is left out.
    """
    level_of = lambda strata: delta / (strata * len(RULES))
    share = alpha / len(RULES)
    least = math.ceil(math.log(level_of(1)) / math.log1p(-share))
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    held = measured.where(~base_failed() & F.col("stratum").isNotNull()).join(marks, "doc_id")
    steps = [F.struct(F.lit(r.name).alias("rule"),
                      sum((_beyond(r, c).cast("int") for c in r.grid), F.lit(0)).alias("step")) for r in RULES]
    counted = (held.select("stratum", (F.col("good") > 0).alias("good"), F.explode(F.array(*steps)).alias("s"))
               .groupBy("stratum", "good", "s.rule", "s.step").agg(F.count("*").alias("n")))
    sized = (held.where("good > 0").groupBy("stratum").agg(F.count("*").alias("n_good"))
             .where(F.col("n_good") >= least))
    found = counted.join(sized, "stratum").collect()
    good_of = {r.stratum: r.n_good for r in found}
    tally: dict = defaultdict(int)
    for r in found:
        tally[r.stratum, r.rule, r.good, r.step] += r.n
    chosen: dict[str, dict[str, float]] = {}
    for stratum, good in good_of.items():
        for rule in RULES:
            # A document beyond a cutoff is beyond all stricter ones, so cutoff i rejects those beyond len - i or more.
            lost = {kind: [sum(tally[stratum, rule.name, kind, s] for s in range(len(rule.grid) - i, len(rule.grid) + 1))
                           for i in range(len(rule.grid))] for kind in (True, False)}
            passed = certified(lost[True], good, share, level_of(len(good_of)))
            worth = [lost[False][i] - price * lost[True][i] for i in range(passed)]
            if worth and max(worth) > 0:
                chosen.setdefault(stratum, {})[rule.name] = rule.grid[worth.index(max(worth))]
    return chosen


def judge(measured: DataFrame, chosen: dict[str, dict[str, float]]) -> DataFrame:
    """`measured` with base_failed, the name of the first violated rule, and kept."""
    failed = F.lit(None).cast("string")
    for rule in reversed(RULES):
        limits = {s: c[rule.name] for s, c in chosen.items() if rule.name in c}
        if limits:
            limit = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])[F.col("stratum")]
            failed = F.when(_beyond(rule, limit), rule.name).otherwise(failed)
    return (measured.withColumn("base_failed", base_failed()).withColumn("failed_rule", failed)
            .withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull()))


def filter_documents(documents: DataFrame, labels: DataFrame, stratum: str = "lang", **limits) -> DataFrame:
    """One judged row per document: doc_id, counts, base_failed, failed_rule, kept.

    A null text has no words and fails; repeated rows are judged one by one; empty tables give no rows, or no
    cutoffs. The measured counts are stored in the shared folder, as they are used twice.
    """
    measured = materialize(features(documents, stratum), "quality-features")
    return judge(measured, cutoffs(measured, labels, **limits))


def keep_documents(documents: DataFrame, labels: DataFrame, stratum: str = "lang", **limits) -> DataFrame:
    """The rows of `documents` that are kept, with all their columns.

    Cutoffs come from all rows; each row is then judged in its place, so that no join by id is needed and null or
    repeated ids do no harm.
    """
    chosen = cutoffs(materialize(features(documents, stratum), "quality-features"), labels, **limits)

    @F.pandas_udf(", ".join(f"{c} BIGINT" for c in COUNTS))
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=COUNTS)

    row = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                           F.col(f"`{stratum}`").alias("stratum"), measured("text").alias("m"))
    judged = judge(row.select("row", "stratum", "m.*"), chosen)
    return judged.where("kept").select("row.*")
