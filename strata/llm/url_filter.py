"""URL filter: rules in a sorted array of 64-bit digests, probed by binary search.

The rules become two files: records sorted by the xxhash of ``host + path``, and the strings
themselves. Executors fetch the files once, memory-map them, look up all candidate strings of a
batch of urls with one vectorised binary search, and compare the stored string on every hit, so that
two strings with one digest are told apart. Beyond `max_index_bytes` the index is not shipped:
the candidates are joined to the rules instead, with the same result.

A rule fits a url when the url's host is the rule's host or a subdomain of it and the url's path starts
with the rule's path. The longest fitting rule (``host + path``) decides; without one the verdict is `default`.
"""

from __future__ import annotations

import io
import uuid
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tools import map_rows
from strata.workspace import new_dir

ENTRY = np.dtype([("key", "<u8"), ("start", "<u8"), ("length", "<u4"), ("allow", "u1")])
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SCHEMA = "page_id BIGINT, host STRING, path STRING, rule STRING, verdict STRING"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path; both empty without ``://``."""
    start = -1 if url is None else url.find("://")
    if start < 0:
        return "", ""
    rest = url[start + 3:]
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    slash = rest.find("/", 0, end)
    host_end = end if slash < 0 else slash
    return rest[:host_end].translate(LOWER), rest[host_end:end]


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """Every ``host + path`` a fitting rule could have, longest first."""
    if not host:
        return []
    hosts, at = [host], host.find(".")
    while at >= 0:
        hosts.append(host[at + 1:])
        at = host.find(".", at + 1)
    found = {h + path[:n] for h in hosts for n in lengths if n <= len(path)}
    return sorted(found, key=lambda s: (-len(s), s))


def build(rules: list[Rule]) -> tuple[bytes, bytes, list[int]]:
    """The sorted records, the strings they point to, and the path lengths in use. A later rule replaces an equal one."""
    unique = {(r.host.translate(LOWER) + r.path): (r, len(r.path)) for r in rules}
    strings, entries = io.BytesIO(), np.zeros(len(unique), ENTRY)
    for i, (text, (rule, _)) in enumerate(unique.items()):
        raw = text.encode()
        entries[i] = (xxhash.xxh64_intdigest(raw), strings.tell(), len(raw), rule.verdict == "allow")
        strings.write(raw)
    return np.sort(entries, order="key").tobytes(), strings.getvalue(), sorted({n for _, n in unique.values()})


class Index:
    """Memory-mapped sorted digests."""

    def __init__(self, entries: np.ndarray, strings: np.ndarray):
        self.entries, self.strings = entries, strings
        self.keys = entries["key"]

    def probe(self, texts: list[str]) -> list[bool | None]:
        """For each text, whether its rule allows; None without a rule."""
        if not len(self.keys) or not texts:
            return [None] * len(texts)
        raw = [t.encode() for t in texts]
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, raw), np.uint64, len(raw))
        at = np.searchsorted(self.keys, wanted)
        out: list[bool | None] = [None] * len(raw)
        hit = self.keys[np.minimum(at, len(self.keys) - 1)] == wanted
        for i in np.flatnonzero(hit):
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == wanted[i]:
                entry = self.entries[j]
                start, n = int(entry["start"]), int(entry["length"])
                if bytes(self.strings[start:start + n]) == raw[i]:
                    out[i] = bool(entry["allow"])
                    break
                j += 1
        return out


def _store(spark, data: bytes, name: str) -> str:
    """Put a driver-side file where every executor can fetch it; returns its name there."""
    folder = new_dir(spark, "url-index")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", max_index_bytes: int = 256 << 20) -> DataFrame:
    """page_id, host, path, rule and verdict for each row of `pages` (page_id, url).

    A null url, or one without ``://``, has an empty host and path and gets the default. Repeated rows
    are judged one by one; other columns are ignored; no rules or no pages are fine.
    """
    spark = pages.sparkSession
    entries, strings, lengths = build(rules)
    if len(entries) + len(strings) > max_index_bytes:
        return _judge_by_join(pages, rules, lengths, default)
    tag = uuid.uuid4().hex
    files = [_store(spark, data or b"\0", f"{kind}-{tag}") for kind, data in (("entries", entries), ("strings", strings))]
    empty = not entries

    def make():
        mapped = [np.memmap(SparkFiles.get(f), dtype, "r") for f, dtype in zip(files, ("u1" if empty else ENTRY, "u1"))]
        index = Index(np.zeros(0, ENTRY) if empty else mapped[0], mapped[1])

        def work(rows):
            parts = [split_url(u) for u in rows["url"]]
            tries = [candidates(h, p, lengths) for h, p in parts]
            verdicts = iter(index.probe([t for group in tries for t in group]))
            best = [next(((t, v) for t, v in [(t, next(verdicts)) for t in group] if v is not None), (None, None))
                    for group in tries]
            return [rows["page_id"], [h for h, _ in parts], [p for _, p in parts], [t for t, _ in best],
                    [default if v is None else "allow" if v else "block" for _, v in best]]

        return work

    return map_rows(pages, ["page_id", "url"], SCHEMA, make)


def _judge_by_join(pages: DataFrame, rules: list[Rule], lengths: list[int], default: str) -> DataFrame:
    spark = pages.sparkSession
    known = spark.createDataFrame(list({r.host.translate(LOWER) + r.path: r.verdict for r in rules}.items()),
                                  "rule STRING, verdict STRING")

    def make():
        def work(rows):
            parts = [split_url(u) for u in rows["url"]]
            return [rows["page_id"], [h for h, _ in parts], [p for _, p in parts],
                    [candidates(h, p, lengths) for h, p in parts]]

        return work

    parsed = map_rows(pages, ["page_id", "url"], "page_id BIGINT, host STRING, path STRING, tries ARRAY<STRING>", make)
    # One row per distinct list of candidates, so that repeated hosts and rows do not repeat the lookup.
    tries = parsed.select("tries").distinct()
    best = (tries.select("tries", F.explode("tries").alias("rule")).join(known, "rule")
            .groupBy("tries").agg(F.max_by(F.struct("rule", "verdict"), F.length("rule")).alias("best")))
    return parsed.join(best, "tries", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
