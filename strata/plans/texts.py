"""Text pipeline: language filter, sentiment, top texts and word counts over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import text
from strata.operators import aggregates, quality
from strata.plans.registry import query
from strata.tables import table

# The texts are invented, so everyday particles stand in for polar words.
POSITIVE, NEGATIVE = ["is", "was", "for"], ["by", "on", "at"]
_WORDS_SQL = r"string_split_regex(lower(text), '[^\pL]+')"


def _listed(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


_SCORED_SQL = rf"""scored AS (SELECT doc_id, CASE WHEN p > n THEN 'POS' WHEN n > p THEN 'NEG' ELSE 'NEU' END AS label,
    CASE WHEN p + n = 0 THEN 0.0::DOUBLE ELSE greatest(p, n)::DOUBLE / (p + n) END AS score FROM
   (SELECT doc_id, len(list_filter(w, lambda x: x IN ({_listed(POSITIVE)}))) AS p,
           len(list_filter(w, lambda x: x IN ({_listed(NEGATIVE)}))) AS n
    FROM (SELECT doc_id, {_WORDS_SQL} AS w FROM documents WHERE lang = 'en')))"""


def english(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [quality.Rule("valid_language", "lang = 'en'", "drop"), quality.Rule("valid_id", "doc_id IS NOT NULL", "drop")]
    return quality.expect(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), rules)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (english(spark, sf_dir).select("doc_id", text.polarity("text", POSITIVE, NEGATIVE).alias("s"))
            .select("doc_id", "s.label", "s.score"))


@query(f"WITH {_SCORED_SQL} SELECT * FROM scored")
def sentiment_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir)


@query(f"WITH {_SCORED_SQL} SELECT * FROM scored")
def sentiment_batch_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same verdicts from a classifier that runs in Python on batches of texts."""
    score = text.batch_scorer(lambda: _particles)
    return english(spark, sf_dir).select("doc_id", score("text").alias("s")).select("doc_id", "s.label", "s.score")


def _particles(texts: list[str]) -> list[dict]:
    import regex

    verdicts = []
    for words in (regex.split(r"[^\p{L}]+", t.lower()) for t in texts):
        p, n = (sum(words.count(w) for w in polar) for polar in (POSITIVE, NEGATIVE))
        label = "POS" if p > n else "NEG" if n > p else "NEU"
        verdicts.append({"label": label, "score": max(p, n) / (p + n) if p + n else 0.0})
    return verdicts


@query(f"WITH {_SCORED_SQL} SELECT * FROM scored WHERE label = 'POS' ORDER BY score DESC, doc_id LIMIT 15")
def top_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).where("label = 'POS'").orderBy(F.desc("score"), "doc_id").limit(15)


@query(f"""WITH {_SCORED_SQL} SELECT label, COUNT(*) AS n, COUNT(*) / SUM(COUNT(*)) OVER () AS share FROM scored GROUP BY label""")
def sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.shares(scored(spark, sf_dir), "label")


@query(rf"""SELECT word, COUNT(*) AS n FROM (SELECT unnest({_WORDS_SQL}) AS word FROM documents WHERE lang = 'en')
            WHERE word <> '' AND word NOT IN ({_listed(text.STOP_WORDS)}) GROUP BY word ORDER BY n DESC, word LIMIT 50""")
def word_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words counted per task first; stop words are removed before anything is shuffled."""
    return (english(spark, sf_dir).select(F.explode(text.words("text")).alias("word"))
            .where(~F.col("word").isin(text.STOP_WORDS))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(50))


@query("SELECT doc_id, substr(text, 1, 100) AS preview, right(CAST(doc_id AS VARCHAR), 3) AS short_id FROM documents")
def text_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A display column; the stored text stays whole."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.substring("text", 1, 100).alias("preview"),
        F.right(F.col("doc_id").cast("string"), F.lit(3)).alias("short_id"))
