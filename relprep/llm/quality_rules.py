"""Quality rules with cross-document line frequency (operator 8), DataFrame functions only.

Rules on one text: words, their code points, symbols, repeated lines, and
words inside three-word windows that the text holds twice or more.  A text
fails with fewer than 50 words, or with over half its words in repeated
windows.

The method: lines are normalised (lower case, white space runs to one space,
trimmed) and hashed, and the distinct documents of a host that hold a line are
counted.  A line in more than ``max_docs`` documents of its host is removed
from all of them but its carrier, the first (smallest doc_id) that passes the
rules on one text; if none does, from all.  A document is depleted, and not
kept, when less than ``min_share`` of its words is left.  ``strip_common``
gives the kept documents without the removed lines, ``keep_good`` as they are.

Scale: the row-local measures and line hashes are computed once and written
as a narrow table.  Counting shuffles (host, line, document) first and (host,
line) counts after it, both pre-aggregated, so a host or a line with a third
of all rows is no single task's work; the join back is one that Spark can
split where a line is hot.

Defined results: a null or wordless text has zero measures and fails; a null
host is a host of its own; rows equal in doc_id and text are one document
and share its verdict; no rows give no rows; other columns are ignored by
``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relprep.llm.common import matching, unused, words, written

SYMBOLS = "[#*$%&|<>]"


def _clean(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[ \t\x0B\f\r]+", " ")


def _normal(line: Column) -> Column:
    return F.trim(_clean(line))


def measure(docs: DataFrame, window: int = 3) -> DataFrame:
    """(doc_id, text_hash, host, measures, lines) for every row; ``lines`` holds (hash, words) of each line with a word.

    Window hashes chain three 64-bit word hashes; two windows of one text
    collide with a chance near n^2 / 2^65.
    """
    empty = F.array().cast("array<bigint>")
    step = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("source").alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    step = step.withColumn("w", words(F.col("text"))).withColumn("n_words", F.size("w").cast("long"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("n_words") - window)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get("w", (i + k).cast("int")) for k in range(window)]))
    step = step.withColumn("h", F.when(F.col("n_words") >= window, hashes).otherwise(empty))
    step = step.withColumn("repeats", F.size(F.array_distinct("h")) < F.size("h"))
    # Positions of windows found twice or more: equal hashes are neighbours once sorted.
    placed = F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("s", F.when(F.col("repeats"), placed))
    twice = F.filter("s", lambda x, i: (x["h"] == F.get("s", i - 1)["h"]) | (x["h"] == F.get("s", i + 1)["h"]))
    step = step.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("at", lambda p, i: F.least(F.lit(window), F.coalesce(F.get("at", i + 1) - p, F.lit(window)))), F.lit(0).cast("long"), lambda a, x: a + x
    )
    line = F.filter(F.transform(F.split(_clean(F.col("text")), "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    raw = F.filter(F.split("text", "\n", -1), lambda x: F.trim(x, F.lit(" \t\x0b\x0c\r")) != "")
    step = step.withColumn("raw", raw)
    return step.select(
        "doc_id", "text_hash", "host", "n_words",
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("repeats"), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.transform(line, lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).alias("words"))).alias("lines"),
    )


def judge(docs: DataFrame, max_docs: int = 20, min_share: float = 0.3, min_words: int = 50, max_repeat: float = 0.5) -> DataFrame:
    """A verdict for every row: the measures, ``base_failed``, ``n_removed_words`` and ``kept``."""
    own, removed = _counted(docs, max_docs, min_words, max_repeat)
    lost = removed.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("host").alias("_of")).agg(F.sum("words").alias("n_removed_words"))
    return _verdicts(own, lost, min_share)


def _counted(docs: DataFrame, max_docs: int, min_words: int, max_repeat: float) -> tuple[DataFrame, DataFrame]:
    """The measures with ``base_failed``; the lines that go: (host, line, doc_id, text_hash, words)."""
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    own = written(measure(docs).withColumn("base_failed", failed), "quality")
    lines = own.dropDuplicates(["doc_id", "text_hash", "host"]).select("host", "doc_id", "text_hash", "base_failed", F.explode("lines").alias("x"))
    held = lines.groupBy("host", "x.line", "doc_id", "text_hash", "base_failed").agg(F.sum("x.words").alias("words"))
    doc = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")
    carrier = F.min(F.when(~F.col("base_failed"), doc)).alias("carrier")
    common = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"), carrier).where(F.col("n") > max_docs)
    common = written(common.select(F.col("host").alias("_host"), F.col("line").alias("_line"), "carrier"), "common-lines")
    hit = held.join(common, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
    return own, hit.where(~doc.eqNullSafe(F.col("carrier"))).select("host", "line", "doc_id", "text_hash", "words")


def _verdicts(own: DataFrame, lost: DataFrame, min_share: float) -> DataFrame:
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("text_hash").eqNullSafe(F.col("_hash")) & F.col("host").eqNullSafe(F.col("_of"))
    left = F.col("n_words") - F.col("n_removed_words")
    return (
        own.drop("lines").join(lost, same, "left").drop("_id", "_hash", "_of")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
        .withColumn("kept", ~F.col("base_failed") & (left >= min_share * F.col("n_words")))
    )


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, unchanged."""
    return matching(docs, judge(docs, **limits).where("kept"), "left_semi", host="source")


def strip_common(docs: DataFrame, max_docs: int = 20, min_share: float = 0.3, min_words: int = 50, max_repeat: float = 0.5) -> DataFrame:
    """The rows that ``judge`` keeps, their texts without the lines that it removes."""
    own, removed = _counted(docs, max_docs, min_words, max_repeat)
    gone = removed.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("host").alias("_of")).agg(
        F.sum("words").alias("n_removed_words"), F.collect_list("line").alias("gone")
    )
    gone = written(gone, "removed-lines")
    kept = matching(docs, _verdicts(own, gone.drop("gone"), min_share).where("kept"), "left_semi", host="source")
    doc, text_hash, host, lines, norm = unused(docs.columns, "doc", "hash", "of", "gone", "norm")
    gone = gone.select(F.col("_id").alias(doc), F.col("_hash").alias(text_hash), F.col("_of").alias(host), F.col("gone").alias(lines))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & F.xxhash64("text").eqNullSafe(F.col(text_hash)) & F.col("source").eqNullSafe(F.col(host))
    met = kept.join(gone, same, "left")
    left = F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains(F.col(lines), F.xxhash64(_normal(x))))
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return met.withColumn("text", text).select(*docs.columns)
