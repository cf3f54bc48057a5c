"""Token counts of whole documents by overlap resynchronisation (operator 11).

Ids are those of the ``tokenizers`` library without added special tokens;
special strings inside a text are read as the library does by default; no
truncation or padding.  Texts of up to ``whole`` characters are encoded as
they are, a few at a time.

Huge texts are cut into chunks that each reach ``overlap`` characters into
the next one.  The chunks are dealt out over all tasks and encoded with
offsets.  At a seam both encodings cover the same characters; they are spliced
at the first position that is *proven stable* and that ends a token in both:

* a character that is not white space, followed by white space, or a letter
  followed by a digit or a mark.  The pre-tokenizer's pattern has no token
  across such a place and never looks back, so every scan that comes by
  starts anew there;
* no special string lies across it.

A document's count is the sum of its chunks' counts less, at each seam, the
left chunk's tokens after the splice and the right chunk's before it.  Where
an overlap holds no such position (one long run of letters), it is widened
over the whole next chunk, and further while the seam behind that fails too:
these chunks are encoded again as one, up to the next seam that aligned.

Scale: one text is held by the task that cuts it (it is one row of the
input); all else is dealt out by (text, chunk).  The huge texts are written
once to the shared folder.

Defined results: a null text is empty, zero bytes and zero tokens; one row
comes back for every row, also for equal or null doc_ids; columns other than
``doc_id`` and ``text`` are dropped, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relprep.llm.common import partitions, written
from relprep.llm.tokenizing import groups

#: Letters, and the marks and digits that may follow them at a stable place (fixed values):
#: characters whose class is the same in every version of Unicode.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſΑ-ΡΣ-Ωα-ωА-яぁ-ゔァ-ヺ一-龥가-힣"
_OTHERS = "!-@\\[-`{-~、。！，？"
_STABLE = re.compile(f"(?<=[^\\s᠎])(?=[ \\t\\n\\r])|(?<=[{_LETTERS}])(?=[{_OTHERS}])")
#: Stable places kept at each end of a chunk; the first common one is taken.
_KEPT = 32

_LIBRARIES: dict[str, tuple] = {}


def _library(path: str):
    """(tokenizer, its special strings), one for each Python worker and file."""
    if path not in _LIBRARIES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        lib = Tokenizer.from_file(path)
        lib.no_truncation()
        lib.no_padding()
        _LIBRARIES[path] = lib, [t.content for t in lib.get_added_tokens_decoder().values()]
    return _LIBRARIES[path]


def _count_whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, _ = _library(path)
        for batch in batches:
            texts, n = batch.column("text").to_pylist(), np.zeros(batch.num_rows, dtype=np.int64)
            for i, j in groups(texts, 1_000_000):
                n[i:j] = [len(e) for e in lib.encode_batch_fast(texts[i:j], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    return run


def _cut(chunk: int, overlap: int):
    """Each text as its chunks, or as the stretches of chunks in ``first``..``last``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["uid", "text", "first", "last"]).to_pylist():
                text, size = row["text"], len(row["text"])
                n = -(-size // chunk)
                spans = zip(row["first"], row["last"]) if row["first"] is not None else ((k, k) for k in range(n))
                for k, m in spans:
                    stop = min(size, (m + 1) * chunk + overlap)
                    yield pa.RecordBatch.from_pydict(
                        {"uid": [row["uid"]], "k": [k], "m": [m], "ends": [stop == size], "text": [text[k * chunk : stop]]},
                        schema=pa.schema([("uid", pa.int64()), ("k", pa.int64()), ("m", pa.int64()), ("ends", pa.bool_()), ("text", pa.string())]),
                    )

    return run


def stable_places(text: str, special: list[str], ends: bool, begins: bool) -> np.ndarray:
    """Where every scan of a text that holds ``text`` starts a token anew.

    Near an end of ``text`` that is not the whole text's, a special string
    could reach over the border unseen; such places are left out.
    """
    at = np.array([m.start() for m in _STABLE.finditer(text)], dtype=np.int64)
    reach = max(map(len, special), default=0)
    at = at[(at >= (0 if begins else reach)) & (at <= (len(text) if ends else len(text) - reach))]
    for s in special:
        for m in re.finditer(re.escape(s), text):
            at = at[(at <= m.start()) | (at >= m.end())]
    return at


def _measure(path: str, chunk: int):
    """Each chunk's token count, and the stable token ends of its two overlaps."""
    lists = pa.list_(pa.int64())
    schema = pa.schema([("uid", pa.int64()), ("k", pa.int64()), ("m", pa.int64()), ("total", pa.int64()), ("head_at", lists), ("head_n", lists), ("tail_at", lists), ("tail_n", lists)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, special = _library(path)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            for row in batch.to_pylist():
                offsets = np.array(lib.encode(row["text"], add_special_tokens=False).offsets, dtype=np.int64).reshape(-1, 2)
                stop = np.maximum.accumulate(offsets[:, 1])
                at = stable_places(row["text"], special, row["ends"], row["k"] == 0)
                before = np.searchsorted(stop, at, side="right")
                inside = (before > 0) & (before < len(stop))
                at, before = at[inside], before[inside]
                fits = (stop[before - 1] == at) & (offsets[before, 0] >= at)
                at, before = at[fits], before[fits]
                tail = np.flatnonzero(at >= (row["m"] + 1 - row["k"]) * chunk)[:_KEPT]
                out["uid"].append(row["uid"])
                out["k"].append(row["k"])
                out["m"].append(row["m"])
                out["total"].append(len(stop))
                out["head_at"].append(at[:_KEPT] + row["k"] * chunk)
                out["head_n"].append(before[:_KEPT])
                out["tail_at"].append(at[tail] + row["k"] * chunk)
                out["tail_n"].append(len(stop) - before[tail])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def _spliced(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(uid, n_tokens) of the texts of ``huge`` (uid, text)."""
    n = partitions(huge.sparkSession)
    cut_schema = "uid long, k long, m long, ends boolean, text string"
    out_schema = "uid long, k long, m long, total long, head_at array<long>, head_n array<long>, tail_at array<long>, tail_n array<long>"

    def measured(rows: DataFrame) -> DataFrame:
        pieces = rows.mapInArrow(_cut(chunk, overlap), cut_schema)
        return pieces.repartition(n, "uid", "k").mapInArrow(_measure(path, chunk), out_schema)

    none = F.lit(None).cast("array<long>")
    first = written(measured(huge.select("uid", "text", none.alias("first"), none.alias("last"))), "chunks")

    left = first.select("uid", (F.col("k") + 1).alias("k"), "tail_at", "tail_n")
    seams = first.select("uid", "k", "total", "head_at", "head_n").join(left, ["uid", "k"], "left")
    at = F.array_min(F.array_intersect("tail_at", "head_at"))
    dropped = F.get("tail_n", (F.array_position("tail_at", F.col("at")) - 1).cast("int")) + F.get("head_n", (F.array_position("head_at", F.col("at")) - 1).cast("int"))
    seams = seams.withColumn("at", at).select("uid", "k", "total", dropped.alias("dropped"))

    # A chunk whose left seam aligned begins a stretch; one whose seam failed belongs to the one before.
    along = Window.partitionBy("uid").orderBy("k")
    stretch = F.sum(F.when(F.col("dropped").isNotNull() | (F.col("k") == 0), 1).otherwise(0)).over(along)
    stretches = seams.withColumn("stretch", stretch).groupBy("uid", "stretch").agg(
        F.min("k").alias("first"), F.max("k").alias("last"), F.sum("total").alias("total"), F.max("dropped").alias("dropped")
    )
    stretches = written(stretches, "stretches")
    single = stretches.where("first = last").select("uid", (F.col("total") - F.coalesce("dropped", F.lit(0))).alias("n"))
    # The one row of a stretch that has a seam before it is its first chunk's, so ``dropped`` is that seam's.
    failed = stretches.where("first < last")
    wanted = failed.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("s"))
    again = measured(huge.join(wanted, "uid").select("uid", "text", F.col("s.first").alias("first"), F.col("s.last").alias("last")))
    joined = failed.select("uid", F.col("first").alias("k"), "dropped").join(again, ["uid", "k"])
    joined = joined.select("uid", (F.col("total") - F.coalesce("dropped", F.lit(0))).alias("n"))
    return single.union(joined).groupBy("uid").agg(F.sum("n").alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, limit: int = 512, whole: int = 65_536, chunk: int = 32_768, overlap: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    if not 0 < overlap <= chunk:
        raise ValueError("an overlap is at most a chunk long")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    # No text has more characters than bytes, and few have to be counted.
    is_huge = (F.col("n_bytes") > whole) & (F.char_length("text") > whole)
    short = rows.where(~is_huge).mapInArrow(_count_whole(path), f"doc_id {kind}, n_bytes long, n_tokens long")
    huge = written(rows.where(is_huge).withColumn("uid", F.monotonically_increasing_id()), "huge-texts")
    counted = short
    if not huge.isEmpty():
        spliced = _spliced(huge.select("uid", "text"), path, chunk, overlap)
        counted = short.union(huge.select("doc_id", "n_bytes", "uid").join(spliced, "uid").select("doc_id", "n_bytes", "n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
