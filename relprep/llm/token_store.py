"""Token-ID files of patched frame-of-reference blocks (operator 5).

Documents are range-partitioned and sorted by ``doc_id``; each task encodes
its texts and cuts them into file images of about ``SEGMENT`` ids, each a row
of the written table (so Spark's commit protocol, not the task, decides
which attempt of a lost task counts, and any store Spark reaches will do).
Image ``k`` of shard ``s`` follows image ``k - 1``; shards follow in order.

File image, little endian:

    "PFR1", u32 block length B, u32 ids n, u32 documents d, u32 blocks b
    d x i64 doc_id, d x u8 (1: the doc_id is null), d x u32 ids of the document
    b x u32 start of each block, in bytes from the first
    blocks: u32 minimum, u8 width w, u16 exceptions e,
            B values less the minimum in w bits each, low bit first,
            e x u16 place, e x u32 value less the minimum

A block's width is the one that holds its ``percentile`` smallest value;
larger values are exceptions and their packed slot is zero.

Defined results: a null text is empty (only the end id); a null doc_id
comes first; equal doc_ids follow in order of their texts; no rows give no
images; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relprep.llm.common import written

BLOCK = 256
SEGMENT = 1 << 18
PERCENTILE = 0.9
IMAGES = "shard int, segment int, ids_before long, n_ids long, image binary"
_HEAD = struct.Struct("<4sIIII")


def encode_blocks(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """(start of each block, the blocks' bytes)."""
    n = -(-len(ids) // block)
    if not n:
        return np.zeros(0, dtype="<u4"), b""
    full = np.full(n * block, ids[-1], dtype=np.uint32)
    full[: len(ids)] = ids
    full = full.reshape(n, block)
    low = full.min(axis=1)
    rest = full - low[:, None]
    k = min(block - 1, max(0, int(np.ceil(percentile * block)) - 1))
    at = np.partition(rest, k, axis=1)[:, k].astype(np.uint64)
    width = np.ceil(np.log2(at + np.uint64(1))).astype(np.int64)
    over = rest > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1))[:, None]
    extra = over.sum(axis=1)
    packed = (block * width + 7) // 8
    sizes = 7 + packed + 6 * extra
    start = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(start[-1]), dtype=np.uint8)
    head = np.zeros((n, 7), dtype=np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    head[:, 4] = width
    head[:, 5:] = extra.astype("<u2").view(np.uint8).reshape(n, 2)
    out[start[:-1, None] + np.arange(7)] = head
    kept = np.where(over, 0, rest)
    for w in np.unique(width).tolist():
        if w:
            rows = np.flatnonzero(width == w)
            bits = np.unpackbits(kept[rows].astype("<u4").view(np.uint8).reshape(len(rows), block, 4), axis=2, count=w, bitorder="little")
            part = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
            out[start[rows, None] + 7 + np.arange(part.shape[1])] = part
    row, place = np.nonzero(over)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(extra) - extra, extra)
        tail = (start[:-1] + 7 + packed)[row]
        out[(tail + 2 * nth)[:, None] + np.arange(2)] = place.astype("<u2").view(np.uint8).reshape(-1, 2)
        out[(tail + 2 * extra[row] + 4 * nth)[:, None] + np.arange(4)] = rest[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return start[:-1].astype("<u4"), out.tobytes()


def decode_blocks(raw: np.ndarray, start: np.ndarray, n: int, block: int) -> np.ndarray:
    """The first ``n`` ids of blocks that begin at ``start`` in ``raw``."""
    if not len(start):
        return np.zeros(0, dtype="<u4")
    start = start.astype(np.int64)
    head = raw[start[:, None] + np.arange(7)]
    low = head[:, :4].copy().view("<u4").ravel()
    width, extra = head[:, 4].astype(np.int64), head[:, 5:].copy().view("<u2").ravel().astype(np.int64)
    packed = (block * width + 7) // 8
    out = np.zeros((len(start), block), dtype="<u4")
    for w in np.unique(width).tolist():
        if w:
            rows = np.flatnonzero(width == w)
            part = raw[start[rows, None] + 7 + np.arange((block * w + 7) // 8)]
            bits = np.unpackbits(part, axis=1, count=block * w, bitorder="little").reshape(len(rows), block, w)
            wide = np.packbits(bits, axis=2, bitorder="little")
            four = np.zeros((len(rows), block, 4), dtype=np.uint8)
            four[:, :, : wide.shape[2]] = wide
            out[rows] = four.view("<u4")[:, :, 0]
    row = np.repeat(np.arange(len(start)), extra)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(extra) - extra, extra)
        tail = (start + 7 + packed)[row]
        place = raw[(tail + 2 * nth)[:, None] + np.arange(2)].copy().view("<u2").ravel()
        out[row, place] = raw[(tail + 2 * extra[row] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").ravel()
    out += low[:, None]
    return out.ravel()[:n]


def image_of(doc_ids: list[int | None], raw: list[bytes], block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """One file image of whole documents (``raw``: each one's ids as bytes)."""
    ids = np.frombuffer(b"".join(raw), dtype="<u4")
    start, blocks = encode_blocks(ids, block, percentile)
    null = np.array([d is None for d in doc_ids], dtype=np.uint8)
    named = np.array([d or 0 for d in doc_ids], dtype="<i8")
    lengths = np.array([len(r) // 4 for r in raw], dtype="<u4")
    return b"".join([_HEAD.pack(b"PFR1", block, len(ids), len(doc_ids), len(start)), named.tobytes(), null.tobytes(), lengths.tobytes(), start.tobytes(), blocks])


def read_image(image: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, ids of each document, all ids)."""
    magic, block, n, d, b = _HEAD.unpack_from(image)
    if magic != b"PFR1":
        raise ValueError("not a token file")
    raw, at = np.frombuffer(image, dtype=np.uint8), _HEAD.size
    named = np.frombuffer(image, "<i8", d, at)
    null = raw[at + 8 * d : at + 9 * d]
    lengths = np.frombuffer(image, "<u4", d, at + 9 * d)
    start = np.frombuffer(image, "<u4", b, at + 13 * d)
    ids = decode_blocks(raw[at + 13 * d + 4 * b :], start, n, block)
    return [None if x else int(y) for x, y in zip(null, named)], lengths, ids


def read_range(image: bytes, first: int, last: int) -> np.ndarray:
    """Ids ``first`` to ``last`` (excluded) of an image, by its block index alone."""
    _, block, n, d, b = _HEAD.unpack_from(image)
    at = _HEAD.size + 13 * d
    start = np.frombuffer(image, "<u4", b, at)
    i, j, last = first // block, -(-min(last, n) // block), min(last, n)
    return decode_blocks(np.frombuffer(image, np.uint8)[at + 4 * b :], start[i:j], (j - i) * block, block)[first - i * block : last - i * block]


def write_tokens(docs: DataFrame, vocabulary: str, cut: str = "space", end_id: int = 0, segment: int = SEGMENT) -> DataFrame:
    """The written table of file images (IMAGES), in ascending order of doc_id by (shard, segment)."""
    end = int(end_id).to_bytes(4, "little")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from relprep.llm.tokenizing import encoder, groups

        enc, shard = encoder(vocabulary, cut), TaskContext.get().partitionId()
        k = before = held = 0
        ids: list[int | None] = []
        raw: list[bytes] = []

        def flush() -> pd.DataFrame:
            nonlocal k, before, held, ids, raw
            out = pd.DataFrame([(shard, k, before, held, image_of(ids, raw))], columns=["shard", "segment", "ids_before", "n_ids", "image"])
            k, before, held, ids, raw = k + 1, before + held, 0, [], []
            return out

        for batch in batches:
            texts, named = batch["text"].tolist(), [None if null else d for d, null in zip(batch["doc_id"].tolist(), batch["_null"].tolist())]
            for i, j in groups(texts, 4_000_000):
                for d, r in zip(named[i:j], enc.encode(texts[i:j])):
                    n = len(r) // 4 + 1
                    if held and held + n > segment:
                        yield flush()
                    ids.append(d)
                    raw.append(r + end)
                    held += n
        if held:
            yield flush()

    doc = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc, F.lit(0)).alias("doc_id"), doc.isNull().alias("_null"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("_null").desc(), F.col("doc_id").asc(), F.col("text").asc()]
    ranged = rows.repartitionByRange(F.col("_null").desc(), F.col("doc_id").asc(), F.substring("text", 1, 64).asc())
    return written(ranged.sortWithinPartitions(*order).mapInPandas(encode, IMAGES), "tokens")


def read_tokens(images: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document, read back from the images: doc_id, start, n_tokens, ids_crc32 (and ids, as bytes)."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for base, image in zip(batch["_base"].tolist(), batch["image"].tolist()):
                named, lengths, ids = read_image(image)
                raw, to = memoryview(ids.tobytes()), np.cumsum(lengths, dtype=np.int64)
                begin = to - lengths
                out = pd.DataFrame({"doc_id": pd.array(named, dtype="Int64"), "start": base + begin, "n_tokens": lengths.astype("int64"), "ids_crc32": [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(begin.tolist(), to.tolist())]})
                if with_ids:
                    out["ids"] = [bytes(raw[4 * i : 4 * j]) for i, j in zip(begin.tolist(), to.tolist())]
                yield out

    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    shards = images.groupBy("shard").agg(F.sum("n_ids").alias("_n")).select("shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shard"))
    at = images.join(F.broadcast(shards), "shard").select((F.col("_shard") + F.col("ids_before")).alias("_base"), "image")
    return at.mapInPandas(decode, schema)
