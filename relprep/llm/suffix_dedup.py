"""Removal of byte strings that repeat across documents (operator 10).

A byte goes if a ``WIDTH``-byte string that covers it also starts in a document
with a smaller doc_id.  Texts are UTF-8 bytes; strings are judged on the
input and never cross documents.

Method: a difference-cover suffix sort.  Suffixes matter up to WIDTH bytes, so
the recursion is two levels deep.  With the cover {1, 2} modulo 3:

1. sampled suffixes are sorted by triples of six-byte letters (18 bytes) and
   named by rank;
2. the names 0, 18 and 30 bytes on form triples of names (48 bytes), which are
   sorted and named again;
3. the remaining suffixes and the last bytes follow from one or two leading
   bytes and a name: any two residues share a shift onto sampled positions,
   so suffixes 0 and 1, 0 and 2, 1 and 2 (modulo 3) are merged in three sorts;
4. neighbours in sorted order whose WIDTH-byte prefixes are equal form a run,
   and a run's smallest doc_id is what each of its members is held against.

Distribution: equal strings have equal minimizers (the smallest of the 31 hashes
of their 20-byte substrings), so suffixes are dealt out by minimizer and
equal ones meet in one bucket.  Consecutive suffixes with one minimizer
travel together as one context of at most 80 bytes.  Before any text moves,
(minimizer, text, place) records are matched, and a suffix whose minimizer no
other text has is left out: no string of its own can be shared.  That removes
no case, and only contested text is sorted.

Skew: equal texts count once (the later ones are covered whole).  Equal
contexts are one row, with their smallest doc_id, before they are sorted, so a
passage in a third of all documents is one context.  Buckets hold about
``CONTEXTS`` contexts at any input size.

Disk: a table between two steps is removed as soon as the next one is written.

Defined results: a null text is empty; a null doc_id is larger than any other
and not larger than a null one; equal rows do not remove each other; texts
under WIDTH bytes stay; no rows give no rows; other columns are ignored.
Texts are told apart by 64-bit hashes together with their lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relprep.llm.common import Passing, partitions, written

WIDTH = 50
GRAM = 20
WINDOW = WIDTH - GRAM + 1
STRIDE = 81  # a context and padding, a multiple of 3
#: Contexts sorted at a time (about 5 KB of working memory each).
CONTEXTS = 10_000
#: Bytes whose records are dealt out at a time, and hashed at a time.
FLUSH = 4_000_000
BLOCK = 1_000_000
_LAST = (1 << 63) - 1


def _sliding(x: np.ndarray, n: int, low) -> np.ndarray:
    """``low`` (np.minimum or np.maximum) over each window of ``n`` values."""
    width = 1
    while 2 * width <= n:
        x = low(x[:-width], x[width:])
        width *= 2
    return low(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


def minimizers(data: np.ndarray) -> np.ndarray:
    """For each WIDTH-byte string of ``data`` (uint8), the smallest hash of its GRAM-byte substrings."""
    eight = np.lib.stride_tricks.as_strided(data[: len(data) - 7].view(np.uint8), shape=(len(data) - 7, 8), strides=(1, 1))
    words = np.ascontiguousarray(eight).view("<u8").ravel()
    n = len(data) - GRAM + 1
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= words[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h += words[12 : 12 + n] * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return _sliding(h, WINDOW, np.minimum)


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first, suffixes) of each run of strings in the texts that end at ``ends``."""
    if len(data) < WIDTH:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    n = len(data) - WIDTH + 1
    # A block at a time: the hashes of a very long text are never held together.
    low = np.concatenate([minimizers(data[a : a + BLOCK + WIDTH - 1]) for a in range(0, n, BLOCK)])
    inside = np.ones(n, dtype=bool)
    for end in ends[:-1].tolist():  # strings across the end of a text
        inside[max(0, end - WIDTH + 1) : end] = False
    change = np.ones(n, dtype=bool)
    change[1:] = (low[1:] != low[:-1]) | ~inside[:-1]
    first = np.flatnonzero(change & inside)
    stop = np.flatnonzero(np.append(change[1:] | ~inside[1:], True) & inside) + 1
    size = stop - first
    if len(size) and size.max() > WINDOW:  # a repeating text: cut long runs
        parts = -(-size // WINDOW)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, size = np.repeat(first, parts) + WINDOW * nth, np.minimum(WINDOW, np.repeat(size, parts) - WINDOW * nth)
    return low[first], first, size


def _records(buckets: int):
    """Rows (bucket, blob): planes of 6-byte minimizers, text numbers, places and lengths."""

    def deal(ids: list[int], texts: list[bytes]) -> pd.DataFrame:
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(sizes)
        value, first, size = runs(np.frombuffer(b"".join(texts), dtype=np.uint8), ends)
        text = np.searchsorted(ends, first, side="right")
        place = first - (ends - sizes)[text]
        bucket = (value % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        named, out = np.array(ids, dtype=np.int64), []
        for b in np.flatnonzero(np.diff(cut)).tolist():
            i = order[cut[b] : cut[b + 1]]
            own, at = np.unique(text[i], return_inverse=True)
            planes = [np.array([len(i), len(own)], dtype="<i8"), named[own], at.astype("<u4"), place[i].astype("<i8"), size[i].astype("u1"), (value[i] >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]]
            out.append((b, b"".join(p.tobytes() for p in planes)))
        return pd.DataFrame(out, columns=["bucket", "blob"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for d, t in zip(batch["tid"].tolist(), batch["data"].tolist()):
                ids.append(d)
                texts.append(t)
                held += len(t)
                if held >= FLUSH:
                    yield deal(ids, texts)
                    ids, texts, held = [], [], 0
        if texts:
            yield deal(ids, texts)

    return run


def _grouped(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[int, pd.DataFrame]]:
    """The rows of each value of ``key``, from batches sorted by it."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        while len(batch):
            same = batch[key].to_numpy() == batch[key].iloc[0]
            n = len(batch) if same.all() else int(np.argmin(same))
            if held and held[0][key].iloc[0] != batch[key].iloc[0]:
                yield held[0][key].iloc[0], pd.concat(held, ignore_index=True)
                held = []
            held.append(batch.iloc[:n])
            batch = batch.iloc[n:]
    if held:
        yield held[0][key].iloc[0], pd.concat(held, ignore_index=True)


def _contested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(tid, value, place, size) of the records whose minimizer two texts have."""
    for _, rows in _grouped(batches, "bucket"):
        parts: list[list[np.ndarray]] = [[], [], [], []]
        for blob in rows["blob"]:
            n, k = np.frombuffer(blob, "<i8", 2).tolist()
            at = 16
            named = np.frombuffer(blob, "<i8", k, at)
            text = np.frombuffer(blob, "<u4", n, at := at + 8 * k)
            parts[0].append(named[text])
            parts[2].append(np.frombuffer(blob, "<i8", n, at := at + 4 * n))
            parts[3].append(np.frombuffer(blob, "u1", n, at := at + 8 * n))
            wide = np.zeros((n, 8), dtype=np.uint8)
            wide[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, at + n).reshape(n, 6)
            parts[1].append(wide.view("<i8").ravel())
        tid, value, place, size = map(np.concatenate, parts)
        order = np.argsort(value, kind="stable")
        tid, value, place, size = tid[order], value[order], place[order], size[order]
        begin = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        more = np.minimum.reduceat(tid, begin) != np.maximum.reduceat(tid, begin)
        keep = np.repeat(more, np.diff(np.append(begin, len(value))))
        yield pd.DataFrame({"tid": tid[keep], "value": value[keep], "place": place[keep], "size": size[keep].astype("int32")})


def _cut_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        tid, first, value, place, size, context = [], [], [], [], [], []
        for t, f, data, at in zip(batch["tid"].tolist(), batch["first"].tolist(), batch["data"].tolist(), batch["at"].tolist()):
            for x in at:
                tid.append(t)
                first.append(f)
                value.append(x["value"])
                place.append(x["place"])
                size.append(x["size"])
                context.append(data[x["place"] : x["place"] + x["size"] + WIDTH - 1])
            if len(tid) >= 20_000:
                yield pd.DataFrame({"tid": tid, "first": first, "value": value, "place": place, "size": size, "context": context})
                tid, first, value, place, size, context = [], [], [], [], [], []
        yield pd.DataFrame({"tid": tid, "first": first, "value": value, "place": place, "size": size, "context": context})


def _names(*keys: np.ndarray) -> np.ndarray:
    """Ranks of sorted key triples, equal for equal triples."""
    bits = [int(k.max()).bit_length() if len(k) else 0 for k in keys]
    if sum(bits) <= 63:
        key = keys[0].astype(np.int64)
        for k, b in zip(keys[1:], bits[1:]):
            key = (key << b) | k.astype(np.int64)
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = key[1:] != key[:-1]
    else:
        order = np.lexsort(keys[::-1])
        new = np.zeros(max(0, len(order) - 1), dtype=bool)
        for k in keys:
            k = k[order]
            new |= k[1:] != k[:-1]
    out = np.zeros(len(order), dtype=np.int64)
    out[order] = np.append(0, np.cumsum(new)) if len(order) else 0
    return out


def run_minima(contexts: list[bytes], first: np.ndarray) -> list[np.ndarray]:
    """For each context, the smallest ``first`` over all contexts that hold each of its WIDTH-byte strings."""
    m = len(contexts)
    text = np.frombuffer(b"".join([c.ljust(STRIDE, b"\0") for c in contexts]), dtype=np.uint8).reshape(m, STRIDE)
    count = np.fromiter(map(len, contexts), dtype=np.int64, count=m) - WIDTH + 1  # suffixes of each
    # Sampled suffixes that the strings below start from, then their triples of letters.
    at = np.arange(WINDOW + 2)
    second = (at % 3 != 0)[None, :] & (at[None, :] < count[:, None] + 2)
    level1 = np.zeros((m, WINDOW + 2 + 30), dtype=bool)
    for shift in (0, 18, 30):
        level1[:, shift : shift + WINDOW + 2] |= second
    row, col = np.nonzero(level1)
    base = row * STRIDE + col
    flat = np.append(text.ravel(), np.zeros(8, dtype=np.uint8))
    letter = np.zeros(m * STRIDE, dtype=np.uint64)
    for k in range(6):
        letter = (letter << np.uint64(8)) | flat[k : k + m * STRIDE]
    name18 = np.zeros(level1.shape, dtype=np.int32)
    name18[row, col] = _names(letter[base], letter[base + 6], letter[base + 12])
    row, col = np.nonzero(second)
    name48 = np.zeros(second.shape, dtype=np.int64)
    name48[row, col] = _names(name18[row, col], name18[row, col + 18], name18[row, col + 30])
    # Merge residues pairwise; strings are told apart to their last byte.
    best = np.full((m, WINDOW), _LAST, dtype=np.int64)
    place = np.arange(WINDOW)
    valid = place[None, :] < count[:, None]
    for pair, lead, tail in (((0, 1), 1, 1), ((0, 2), 2, 0), ((1, 2), 0, 2)):
        row, col = np.nonzero(valid & np.isin(place % 3, pair)[None, :])
        if not len(row):  # contexts of one string each
            continue
        key = name48[row, col + lead] << 16
        for k in range(lead):
            key |= text[row, col + k].astype(np.int64) << (8 * k)
        for k in range(tail):
            key |= text[row, col + WIDTH - 1 - k].astype(np.int64) << (8 * (lead + k))
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        low = np.repeat(np.minimum.reduceat(first[row[order]], begin), np.diff(np.append(begin, len(key))))
        row, col = row[order], col[order]
        best[row, col] = np.minimum(best[row, col], low)
    return [b[:n] for b, n in zip(best, count.tolist())]


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(value, hash, minima) of the contexts of which some string starts in an earlier document."""
    for _, rows in _grouped(batches, "bucket"):
        low = run_minima(rows["context"].tolist(), rows["low"].to_numpy())
        high = rows["high"].tolist()
        hit = [k for k, x in enumerate(low) if x.min() < high[k]]
        yield pd.DataFrame({"value": rows["value"].iloc[hit], "hash": rows["hash"].iloc[hit], "minima": [low[k].tolist() for k in hit]})


def _ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(tid, first, start, stop): byte ranges that go, one or more for each context."""
    for batch in batches:
        tid, first, start, stop = [], [], [], []
        for t, f, at, minima in zip(batch["tid"].tolist(), batch["first"].tolist(), batch["place"].tolist(), batch["minima"].tolist()):
            gone = np.flatnonzero(np.asarray(minima) < f)
            if len(gone):
                cut = np.flatnonzero(np.diff(gone) > WIDTH)
                for a, b in zip(gone[np.append(0, cut + 1)].tolist(), gone[np.append(cut, len(gone) - 1)].tolist()):
                    tid.append(t)
                    first.append(f)
                    start.append(at + a)
                    stop.append(at + b + WIDTH)
        yield pd.DataFrame({"tid": tid, "first": first, "start": start, "stop": stop}).astype("int64")


def removals(docs: DataFrame) -> DataFrame:
    """(tid, first, ranges): sorted, disjoint byte ranges that go from the first document of each text."""
    spark = docs.sparkSession
    n, tables = partitions(spark), Passing(spark)
    own = docs.select("tid", "place_of", "data").where(F.octet_length("data") >= WIDTH)
    buckets = 3 * n
    found = own.select("tid", "data").mapInPandas(_records(buckets), "bucket int, blob binary")
    found = found.repartition(n, "bucket").sortWithinPartitions("bucket").mapInPandas(_contested, "tid long, value long, place long, size int")
    contested = tables.written(found, "contested")
    firsts = own.groupBy("tid").agg(F.min("place_of").alias("first"))
    at = contested.groupBy("tid").agg(F.collect_set(F.struct("value", "place", "size")).alias("at")).join(firsts, "tid")
    met = at.withColumnRenamed("tid", "_tid").join(own, (F.col("_tid") == F.col("tid")) & (F.col("first") == F.col("place_of")))
    contexts = met.select("tid", "first", "data", "at").mapInPandas(_cut_contexts, "tid long, first long, value long, place long, size int, context binary")
    contexts = tables.written(contexts.withColumn("hash", F.xxhash64("context")), "contexts")
    tables.remove("contested")
    alike = contexts.groupBy("value", "hash").agg(F.min("first").alias("low"), F.max("first").alias("high"), F.first("context").alias("context"))
    alike = tables.written(alike, "distinct-contexts")
    share = max(n, -(-alike.count() // CONTEXTS))
    sorted_in = alike.withColumn("bucket", F.pmod("value", F.lit(share))).repartition(n, "bucket").sortWithinPartitions("bucket")
    judged = tables.written(sorted_in.select("bucket", "value", "hash", "low", "high", "context").mapInPandas(_judge, "value long, hash long, minima array<bigint>"), "judged")
    tables.remove("distinct-contexts")
    gone = contexts.drop("context").join(judged, ["value", "hash"]).select("tid", "first", "place", "minima").mapInPandas(_ranges, "tid long, first long, start long, stop long")
    listed = gone.groupBy("tid", "first").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("r"))
    # Overlapping and touching ranges become one.
    grow = F.aggregate(
        "r",
        F.array().cast("array<struct<start:bigint,stop:bigint>>"),
        lambda a, x: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["stop"] >= x["start"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["stop"], x["stop"]).alias("stop")))),
        ).otherwise(F.concat(a, F.array(x))),
    )
    listed = written(listed.select("tid", "first", grow.alias("ranges")), "removals")
    tables.remove("contexts", "judged")
    return listed


def deduplicate(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row; ``kept`` holds the remaining bytes."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text, F.octet_length(text)).alias("tid"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("place_of"), text.cast("binary").alias("data"))
    gone = removals(rows)
    narrow = rows.where(F.octet_length("data") >= WIDTH).select("tid", "place_of").distinct()
    firsts = narrow.groupBy("tid").agg(F.min("place_of").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = narrow.join(firsts, "tid").where("place_of > first").select("tid", "place_of", F.lit(True).alias("copy"), F.lit(None).cast("array<struct<start:bigint,stop:bigint>>").alias("ranges"))
    say = written(copies.union(gone.select("tid", F.col("first").alias("place_of"), F.lit(False).alias("copy"), "ranges")), "verdicts")
    say = say.select(F.col("tid").alias("_tid"), F.col("place_of").alias("_place"), "copy", "ranges")
    met = rows.join(say, (F.col("tid") == F.col("_tid")) & (F.col("place_of") == F.col("_place")), "left")
    size = F.octet_length("data").cast("long")
    parts = F.transform("ranges", lambda x, i: F.struct((F.when(i == 0, F.lit(0)).otherwise(F.get("ranges", i - 1)["stop"])).alias("a"), x["start"].alias("b")))
    left = F.aggregate(
        F.concat(parts, F.array(F.struct(F.element_at("ranges", -1)["stop"].alias("a"), F.octet_length("data").cast("long").alias("b")))),
        F.lit(b"").cast("binary"),
        lambda a, x: F.concat(a, F.substring(F.col("data"), (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int"))),
    )
    removed = F.aggregate("ranges", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    copy = F.coalesce("copy", F.lit(False))
    return met.select(
        "doc_id",
        size.alias("n_bytes"),
        F.when(copy, size).when(F.col("ranges").isNotNull(), removed).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).when(F.col("ranges").isNotNull(), F.size("ranges")).otherwise(F.lit(0)).cast("long").alias("n_spans"),
        F.when(copy, F.lit(b"")).when(F.col("ranges").isNotNull(), left).otherwise(F.col("data")).alias("kept"),
    )
