"""Word-level text expressions, evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Common English words left out of word counts.
STOP_WORDS = """
a about above after again against all also am an and any are as at be because been before being below
between both but by can cannot could did do does doing down during each else ever few for from further get
had has have having he hence her here hers herself him himself his how however http https i if in into is it
its itself just k like me more most my myself no nor not of off on once only or other otherwise ought our ours
ourselves out over own r rt same shall she should since so some such than that the their theirs them
themselves then there therefore these they this those through to too under until up very was we were what
when where which while who whom why with would www you your yours yourself yourselves com
""".split()

# A small polarity lexicon.
POSITIVE = ["good", "great", "love", "happy", "best", "nice", "excellent", "awesome", "thanks", "win"]
NEGATIVE = ["bad", "hate", "worst", "broken", "sad", "error", "awful", "poor", "fail", "angry"]


def words(column: str) -> Column:
    """Lower-case runs of letters."""
    return F.filter(F.split(F.lower(F.col(column)), r"[^\p{L}]+"), lambda w: w != "")


def polarity(column: str, positive: list[str] = POSITIVE, negative: list[str] = NEGATIVE) -> Column:
    """Struct of label (POS, NEG, NEU) and score: the share of polar words that agree with the label."""
    counts = F.transform(F.array(words(column)), lambda w: F.struct(
        F.size(F.filter(w, lambda x: x.isin(positive))).alias("p"),
        F.size(F.filter(w, lambda x: x.isin(negative))).alias("n")))[0]

    def verdict(c: Column) -> Column:
        p, n = c["p"], c["n"]
        label = F.when(p > n, "POS").when(n > p, "NEG").otherwise("NEU")
        share = F.when(p + n == 0, F.lit(0.0)).otherwise(F.greatest(p, n) / (p + n))
        return F.struct(label.alias("label"), share.alias("score"))

    return F.transform(F.array(counts), verdict)[0]


def batch_scorer(load: Callable[[], Callable[[list[str]], list[dict]]]):
    """A UDF around any text classifier that maps texts to ``{"label", "score"}`` records.

    `load` runs once per task, so a heavy model is not rebuilt for every batch.
    """

    @F.pandas_udf("label STRING, score DOUBLE")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classify = load()
        for texts in batches:
            yield pd.DataFrame(classify(texts.tolist()), columns=["label", "score"])

    return score
