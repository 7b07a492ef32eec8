"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

A rolling hash over the hashes of three consecutive lines decides where a chunk ends, so boundaries move
with the text and not with its position: an inserted line changes the chunks around it, not those after it.
Chunks of two or more lines with content that occur more than once anywhere are compared byte by byte - they
are grouped by hash and text - and all but the first occurrence (lowest doc_id, then position) are removed.

`remove_repeats` follows the published SQL, which has no shortest chunk. `drop_repeats`, the pipeline's stage, lets a
boundary count only once the chunk has two lines with content, and marks one place in two: fewer repeats are lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines in the rolling window, and the leading hex digits of its hash that end a chunk: one place in four.
WINDOW, MARKS = 2, ("0", "4", "8", "c")
#: The same for `drop_repeats`, one place in two, and the lines with content that a chunk has before it can end.
DENSE_MARKS, LEAST = ("0", "2", "4", "6", "8", "a", "c", "e"), 2


def _with(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` and one more column, computed once per row: as a generator's output it is not repeated inside later lambdas."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _chunked(documents: DataFrame, marks: tuple[str, ...], least: int) -> DataFrame:
    """`documents` as one struct `row` each, with `key` and `parts`: the text's chunks as arrays of lines.

    A mark ends a chunk that has `least` or more lines with content.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(text)).alias("key"), text.alias("whole"))
    rows = _with(rows, "lines", F.split("whole", "\n", -1))
    rows = _with(rows, "hashes", F.transform("lines", F.md5))

    def marked(i):
        """Whether the window that ends before the line has the mark."""
        window = [F.when(i > back, F.get("hashes", i - 1 - back)).otherwise("") for back in range(WINDOW - 1, -1, -1)]
        return F.substring(F.md5(F.concat(*window)), 1, 1).isin(*marks)

    def step(state, line):
        """Lines with content since the last start, and the starts, after the line."""
        starts = line["marked"] & (state["filled"] >= least)
        return F.struct((F.when(starts, 0).otherwise(state["filled"]) + line["filled"]).alias("filled"),
                        F.when(starts, F.array_append(state["starts"], line["at"])).otherwise(state["starts"]).alias("starts"))

    if least:
        rows = _with(rows, "places", F.transform("lines", lambda x, i: F.struct(
            i.alias("at"), marked(i).alias("marked"), _has_word(x).cast("int").alias("filled"))))
        none = F.struct(F.lit(0).alias("filled"), F.array(F.lit(0)).cast("array<int>").alias("starts"))
        rows = _with(rows, "starts", F.aggregate("places", none, step, lambda state: state["starts"]))
    else:
        rows = _with(rows, "starts", F.filter(F.transform("lines", lambda _, i: F.when((i == 0) | marked(i), i)), F.isnotnull))
    parts = F.transform("starts", lambda at, k: F.slice("lines", at + 1, F.coalesce(F.get("starts", k + 1), F.size("lines")) - at))
    return _with(rows.select("row", "key", "lines", "starts"), "parts", parts).select("row", "key", "parts")


def remove_repeats(documents: DataFrame, marks: tuple[str, ...] = MARKS, least: int = 0) -> DataFrame:
    """`row` (the row of `documents`), text (what is left), n_lines and n_removed (lines) of each document.

    Rows with equal doc_id and text are one document and are treated alike; a null doc_id sorts last. A
    null text is the empty text, one line without content. Chunks of which fewer than two lines hold a word are never
    removed. An empty table gives no rows; other columns stay inside `row`, whatever their names. `marks` are the
    leading hex digits that end a chunk once `least` of its lines hold a word.

    Grouping by digest and text combines on the map side, so a chunk that a third of all documents share arrives as
    one row per task. A digest that ever stood for two texts is left alone. Digests are joined back without texts.
    """
    parts = _chunked(documents, marks, least)
    chunks = (parts.select("row.doc_id", "key", F.posexplode("parts").alias("chunk", "part"))
              .where(F.size(F.filter("part", _has_word)) > 1)
              .select("doc_id", "key", "chunk", F.array_join("part", "\n").alias("lines"))
              .withColumn("digest", F.sha2("lines", 256)))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "chunk")
    texts = chunks.groupBy("digest", "lines").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    repeated = (texts.groupBy("digest").agg(F.sum("n").alias("n"), F.count("*").alias("texts"), F.min("first").alias("first"))
                .where("n > 1 AND texts = 1").select("digest", "first"))
    later = chunks.drop("lines").join(repeated, "digest").where((F.col("key") != F.col("first.key"))
                                                                | (F.col("chunk") != F.col("first.chunk")))
    removed = later.groupBy("key").agg(F.collect_set("chunk").alias("removed"))
    marked = parts.join(removed, "key", "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    kept = F.flatten(F.filter("parts", lambda _, i: ~F.array_contains("removed", i)))
    return (_with(marked, "kept", kept)
            .select("row", F.array_join("kept", "\n").alias("text"), F.size(F.flatten("parts")).cast("bigint").alias("n_lines"),
                    (F.size(F.flatten("parts")) - F.size("kept")).cast("bigint").alias("n_removed")))


def drop_repeats(documents: DataFrame) -> DataFrame:
    """The rows of `documents` without repeated chunks, n_chars brought up to date; untouched rows stay as they are.

    A document of which no word is left goes. Chunks have two lines with a word or more, but for a document's last.
    """
    done = remove_repeats(documents, DENSE_MARKS, LEAST).where((F.col("n_removed") == 0) | _has_word(F.col("text")))
    touched = F.col("n_removed") > 0
    new = {"text": F.when(touched, F.col("text")).otherwise(F.col("row.text"))}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        new["n_chars"] = F.when(touched, F.length("text").cast(kind)).otherwise(F.col("row.n_chars"))
    return done.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in documents.columns])
