"""Secret scan: fixed patterns, and a battery of randomness tests under false-discovery control.

Fixed patterns give the base spans. Beside them, every run of 20 or more key characters that mixes letters
and digits and touches no base span is a candidate. Its encoding (hex, base32, base64) is inferred from its characters, and
under the hypothesis "drawn uniformly from that alphabet" three tests give a p-value each: chi-squared
uniformity over alphabet cells, the number of runs above and below the alphabet's middle, and the lag-1 serial
correlation. Fisher's method combines them. Random keys have uniform p-values; text, paths and names pile up
near zero. So in each length class the level at the top of the p-values tells how many keys there are anywhere on the
scale, and what exceeds it is text. The smallest cutoff whose estimated share of text is
at most `q` is used; short strings, whose tests have little power, thereby need larger p-values. A string counts once
however often it occurs, as the p-values of copies are no tests of their own; the cutoff then holds for every occurrence.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tools import map_rows
from strata.workspace import materialize

# The base patterns, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Steps of the p-value scale, and the upper part of it that is taken as free of text.
BINS, CLEAN = 64, 32
#: Shortest lengths of the length classes.
LENGTHS = (20, 24, 32, 48, 64, 128)

ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Letters that make up most of European text; a random key has them no more often than others.
COMMON = set("etaoinshrdlu")


def infer_encoding(run: str) -> tuple[str, str]:
    """The smallest alphabet that holds the run, and the run in that alphabet's letters."""
    body = run.rstrip("=")
    if re.fullmatch(r"[0-9a-fA-F]+", body) and (body == body.lower() or body == body.upper()):
        return "hex", body.lower()
    if re.fullmatch(r"[A-Z2-7]+", body):
        return "base32", body
    return "base64", body.replace("-", "+").replace("_", "/").replace("=", "/")


def _cell(char: str) -> int:
    return 0 if char.isdigit() else 1 if char in "+/" else 2 + 2 * char.islower() + (char.lower() in COMMON)


def _upper_chi2(x: float, df: int) -> float:
    """P(chi-squared > x), by the Wilson-Hilferty cube root."""
    if df <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def randomness(run: str) -> float:
    """Combined p-value of "uniform over the inferred alphabet"."""
    encoding, body = infer_encoding(run)
    alphabet = ALPHABETS[encoding]
    n = len(body)
    if n < 8:
        return 0.0
    code = np.fromiter((alphabet.index(c) for c in body), np.int64, n)
    cell_of = np.arange(len(alphabet)) if n >= 5 * len(alphabet) else np.unique([_cell(c) for c in alphabet], return_inverse=True)[1]
    cells = int(cell_of.max()) + 1
    expected = np.bincount(cell_of, minlength=cells) * n / len(alphabet)
    seen = np.bincount(cell_of[code], minlength=cells)
    uniform = _upper_chi2(float(((seen - expected) ** 2 / expected).sum()), cells - 1)
    high = code >= len(alphabet) / 2
    ones = int(high.sum())
    runs_p = 0.0
    if 0 < ones < n:
        mean = 2 * ones * (n - ones) / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        runs_p = _two_sided((1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    centred = code - code.mean()
    power = float((centred ** 2).sum())
    serial = _two_sided((float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    # Fisher: -2 sum(log p) is chi-squared with 6 degrees of freedom, whose tail has a closed form.
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, runs_p, serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order; positions are code points."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, p-value bin) of runs that no base span touches."""
    out = []
    for m in RUN.finditer(text):
        run = m.group().strip("=/-_+")
        start = m.start() + m.group().find(run) if run else m.start()
        end = start + len(run)
        if len(run) < LENGTHS[0] or not any(map(str.isdigit, run)) or not any(map(str.isalpha, run)):
            continue
        if any(s < end and start < e for s, _, e in base):
            continue
        size = sum(len(run) >= n for n in LENGTHS) - 1
        out.append((start, end, size, min(BINS - 1, int(randomness(run) * BINS))))
    return out


def run_key(run: str) -> int:
    """64 bits, signed, by which copies of a run are known."""
    return int.from_bytes(xxhash.xxh3_64_digest(run), signed=True)


def distinct_counts(runs: DataFrame) -> dict[tuple[int, int], int]:
    """Distinct strings per length class and p-value bin, from one row (size, bin, key) or more for each of them."""
    tally = runs.select("size", "bin", "key").distinct().groupBy("size", "bin").agg(F.count("*").alias("n"))
    return {(r["size"], r["bin"]): r["n"] for r in tally.collect()}


def join_spans(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def cutoffs(counts: dict[tuple[int, int], int], q: float = 0.1) -> dict[int, int]:
    """The first accepted p-value bin per length class, from counts of distinct strings per (class, bin)."""
    chosen = {}
    for size in range(len(LENGTHS)):
        n = [counts.get((size, b), 0) for b in range(BINS)]
        level = sum(n[BINS - CLEAN:]) / CLEAN
        for cut in range(BINS - CLEAN + 1):
            total = sum(n[cut:])
            text = max(0.0, sum(n[cut:BINS - CLEAN]) - level * (BINS - CLEAN - cut))
            if total and text <= q * total:
                chosen[size] = cut
                break
    return chosen


def scan(documents: DataFrame, q: float = 0.1) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (text) and found (start, end per span) of each document.

    A null or empty text has no spans. Repeated rows are scanned one by one, other columns are ignored, an
    empty table gives no rows. Found spans and candidates are stored in the shared folder; the driver
    receives at most one count per length class and p-value bin.
    """

    def make():
        def work(rows):
            texts = [t or "" for t in rows["text"]]
            base = [base_spans(t) for t in texts]
            n = lambda kind: [sum(k == kind for _, k, _ in spans) for spans in base]
            return [rows["doc_id"], n(0), n(1), n(2),
                    [hashlib.sha256(join_spans(s).encode()).hexdigest() for s in base],
                    [[dict(start=s, kind=k, end=e) for s, k, e in spans] for spans in base],
                    [[dict(start=s, end=e, size=z, bin=b, key=run_key(t[s:e])) for s, e, z, b in candidates(t, spans)]
                     for t, spans in zip(texts, base)]]

        return work

    schema = ("doc_id BIGINT, n_assign BIGINT, n_access BIGINT, n_hex BIGINT, base_sha256 STRING, "
              "base ARRAY<STRUCT<start: BIGINT, kind: INT, end: BIGINT>>, "
              "runs ARRAY<STRUCT<start: BIGINT, end: BIGINT, size: INT, bin: INT, key: BIGINT>>")
    scanned = materialize(map_rows(documents, ["doc_id", "text"], schema, make), "secret-spans")
    cuts = cutoffs(distinct_counts(scanned.where(F.size("runs") > 0).select(F.inline("runs"))), q)
    cut = F.array(*[F.lit(cuts.get(i, BINS)) for i in range(len(LENGTHS))])
    added = F.transform(F.filter("runs", lambda r: r["bin"] >= F.get(cut, r["size"])),
                        lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))
    found = F.array_sort(F.concat("base", added))
    names = F.array(*map(F.lit, KINDS))
    text = F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"), found.alias("found"))


def redact(documents: DataFrame, mark: str = "[secret]", q: float = 0.1) -> DataFrame:
    """The rows of `documents`, with every found span of `text` replaced by `mark` and n_chars brought up to date.

    The cutoffs come from a scan of all rows; each row is then rewritten in its place, so no join is needed
    and repeated or null ids do no harm. Overlapping spans become one mark. Null texts stay null.
    """
    cuts = cutoffs(distinct_counts(map_rows(documents, ["text"], "size INT, bin INT, key BIGINT", _distinct_runs)), q)

    @F.pandas_udf("string")
    def rewritten(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _mask(t, cuts, mark), na_action="ignore")

    out = documents.withColumn("text", rewritten("text"))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out


def _distinct_runs():
    def work(rows):
        seen = {(size, p, run_key(text[start:end])) for text in rows["text"] if text
                for start, end, size, p in candidates(text, base_spans(text))}
        return list(zip(*seen)) or [[], [], []]

    return work


def _mask(text: str, cuts: dict[int, int], mark: str) -> str:
    base = base_spans(text)
    spans = sorted([(s, e) for s, _, e in base]
                   + [(s, e) for s, e, z, b in candidates(text, base) if b >= cuts.get(z, BINS)])
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]
