"""SimHash near-duplicate documents (operator 1).

Fingerprint: lower-case A-Z, cut into words, hash the word shingles with
XXH64, and set each bit that is set in over half of the hashes.  Texts are
fingerprinted in Arrow batches with numpy.

Links: deletion-variant signatures.  64 bits are cut into so few segments
(two for up to three differing bits) that in one of them two linked
fingerprints differ by at most one bit.  Every segment is indexed once for
each of its bits with that bit left out, fingerprints that share a variant
meet by an equality join on it, and the whole distance is verified.

Skew: copies share one fingerprint, and only distinct fingerprints are
indexed.  A variant that may hold more than ``limit`` fingerprints (counted by
whole segments first) is cut again on its remaining bits by the same rule,
down to eight open bits, where a group holds at most 2,048 fingerprints by
construction.  A group yields one
link from each member to its local root, never all pairs.  Links become
components by distributed rounds.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle; equal doc_ids
keep one row each; a null doc_id never names a component unless all its
members are null; no rows give no rows; other columns are dropped by
``components`` and kept by ``deduplicate``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relprep.llm.common import connected_components, matching, partitions, unused, written

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Hashes counted at a time, so that a very long text needs bounded memory.
_CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    import xxhash

    found = _WORD.findall(text.encode("utf-8", "surrogatepass").lower())
    if not found:
        return 0
    line, n = b" ".join(found), max(1, len(found) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    begin = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    end = ends[-n:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, n, _CHUNK):
        hashes = np.array([digest(line[i:j], 42) for i, j in zip(begin[k : k + _CHUNK], end[k : k + _CHUNK])], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) for every row; ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in batch.pop("text").tolist()], dtype=np.uint64).view(np.int64)
            yield batch.assign(doc_id=batch["doc_id"].astype("Int64"), fp=fp)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, text_hash long, fp long")


def _cuts(open_bits: tuple[int, ...], segments: int) -> list[tuple[int, tuple[int, ...]]]:
    """(mask of a segment without one of its bits, the bits of the other segments)."""
    out = []
    for part in np.array_split(np.array(open_bits), segments):
        part = part.tolist()
        rest = tuple(b for b in open_bits if b not in set(part))
        out += [(sum(1 << b for b in part if b != gone), rest) for gone in part]
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _local_links(max_bits: int):
    """Links each fingerprint of a sorted group to the group's components' roots."""

    def roots(fp: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, live = [], [], np.arange(len(fp) - 1)
        for step in range(1, len(fp)):
            live = live[live + step < len(fp)]
            live = live[key[live] == key[live + step]]
            if not len(live):
                break
            near = live[np.bitwise_count(fp[live] ^ fp[live + step]) <= max_bits]
            a.append(near)
            b.append(near + step)
        if not a:
            return fp[:0], fp[:0]
        a, b = np.concatenate(a), np.concatenate(b)
        root = np.arange(len(fp))
        while True:  # smallest index by repeated minimum and jumping
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            low = low[low]
            if (low == root).all():
                break
            root = low
        own = np.flatnonzero(root != np.arange(len(fp)))
        return fp[own], fp[root[own]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fp, key = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            fp = np.concatenate([fp, batch["fp"].to_numpy().view(np.uint64)])
            key = np.concatenate([key, batch["key"].to_numpy()])
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last group may go on
            a, b = roots(fp[:last], key[:last])
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
            fp, key = fp[last:], key[last:]
        a, b = roots(fp, key)
        yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def _index(rows: DataFrame, opens: list[tuple[int, ...]], segments: int) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """(key, open, fp) for each one-wildcard variant of each segment of the open bits; what stays open."""
    table, later = [], []
    for i, bits in enumerate(opens):
        for c, (mask, rest) in enumerate(_cuts(bits, segments)):
            if rest not in later:
                later.append(rest)
            table.append((i, c, _signed(mask), later.index(rest)))
    cuts = F.broadcast(rows.sparkSession.createDataFrame(table, "open int, cut int, mask long, next int"))  # a constant of the method
    index = rows.join(cuts, "open")
    return index.select(F.xxhash64("key", "open", "cut", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), F.col("next").alias("open"), "fp"), later


def _crowded(rows: DataFrame, segments: int, limit: int) -> DataFrame:
    """The keys of the first index that may hold more than ``limit`` rows.

    A variant's group is what two segment values share that differ in the
    left-out bit, so it is small unless one of them has over half the limit.
    Counting segment values takes two rows a fingerprint, not one a variant.
    """
    bits = np.array_split(np.arange(64), segments)
    masks = F.array(*[F.lit(_signed(sum(1 << int(b) for b in part))) for part in bits])
    whole = rows.select(F.posexplode(masks).alias("segment", "whole"), "fp").select("segment", F.col("fp").bitwiseAND(F.col("whole")).alias("value"))
    many = whole.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * 2 > limit)
    first, cuts = [0, *np.cumsum([len(p) for p in bits]).tolist()], _cuts(tuple(range(64)), segments)
    table = rows.sparkSession.createDataFrame([(s, c, _signed(cuts[c][0])) for s in range(segments) for c in range(first[s], first[s + 1])], "segment int, cut int, mask long")
    keys = many.join(F.broadcast(table), "segment")
    return keys.select(F.xxhash64(F.lit(0).cast("long"), F.lit(0), "cut", F.col("value").bitwiseAND(F.col("mask"))).alias("key")).distinct()


def links(fps: DataFrame, max_bits: int = 3, limit: int = 512) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``fps.fp`` within ``max_bits``."""
    spark, segments = fps.sparkSession, max(2, max_bits // 2 + 1)
    near = _local_links(max_bits)

    def met(index: DataFrame) -> DataFrame:
        grouped = index.select("key", "fp").repartition("key").sortWithinPartitions("key")
        return grouped.mapInPandas(near, "a long, b long").distinct()

    rows = fps.select(F.lit(0).cast("long").alias("key"), F.lit(0).alias("open"), "fp").distinct().repartition(partitions(spark))
    index, opens = _index(rows, [tuple(range(64))], segments)
    crowded = written(_crowded(rows, segments, limit), "crowded")
    if crowded.isEmpty():
        return met(index)
    edges = met(index.join(crowded, "key", "left_anti"))
    rows = written(index.join(crowded, "key"), "crowded-rows")
    while True:  # the same cut of the bits that are still open
        index, opens = _index(rows, opens, segments)
        if max(map(len, opens)) <= 8:
            return edges.union(met(index))
        crowded = written(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit), "crowded")
        edges = edges.union(met(index.join(crowded, "key", "left_anti")))
        rows = written(index.join(crowded, "key").select("key", "open", "fp"), "crowded-rows")


def components(docs: DataFrame, shingle: int = 3, max_bits: int = 3, limit: int = 512) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, root) for every row.

    ``component_id`` is the smallest doc_id the row reaches, which may be null
    or shared where doc_ids are; ``root``, a fingerprint, tells components apart.
    """
    rows = written(fingerprints(docs, shingle), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    member = connected_components(links(fps, max_bits, limit), "simhash")
    rooted = fps.join(member, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id", "root")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def deduplicate(docs: DataFrame, shingle: int = 3, max_bits: int = 3, limit: int = 512) -> DataFrame:
    """The rows of ``docs`` with the smallest (doc_id, text hash) of each component, one of each."""
    found = components(docs, shingle, max_bits, limit)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("s")).select("s.doc_id", "s.text_hash")
    best = written(best, "kept")
    kept = matching(docs, best, "left_semi")
    repeated = found.groupBy("doc_id", "text_hash").count().where("count > 1")
    if not repeated.isEmpty():
        (text_hash,) = unused(docs.columns, "hash")
        kept = kept.withColumn(text_hash, F.xxhash64("text")).dropDuplicates(["doc_id", text_hash])
    return kept.select(*docs.columns)
