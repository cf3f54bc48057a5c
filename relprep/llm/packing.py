"""Best-fit packing of token pieces into fixed-length sequences (operator 4).

Method: exact-complement hashing.  The plan is made on the histogram of
piece lengths, never on pieces: at most ``capacity`` rows reach the driver
whatever the input's size.  For the longest available length, single, pair
and triple sums that exactly fill the gap are looked up and consumed as often
as the availability counts allow; what no combination fills is packed
best-fit.  Each step uses up at least one length, so the plan has a bounded
number of patterns, and each pattern covers any number of sequences.

Pieces get their place by rank: the n-th piece of a length takes the n-th
slot of that length.  Ranks are a running count inside each input task plus
the counts of earlier tasks, so a length that holds most rows is still
numbered by all tasks.

Defined results: a null text is empty (its piece is the end id alone); equal
rows are packed each on its own; no rows give no rows; other columns are
dropped by ``token_pieces`` and kept by ``pack``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from relprep.llm.common import unused, written

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(docs: DataFrame, vocabulary: str, cut: str = "word", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids): each text's ids and the end id, cut at ``capacity``.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    end, step = int(end_id).to_bytes(4, "little"), 4 * capacity

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from relprep.llm.tokenizing import encoder, groups

        enc = encoder(vocabulary, cut)
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].tolist()
            for i, j in groups(texts):
                rows = []
                for d, raw in zip(ids[i:j], enc.encode(texts[i:j])):
                    raw += end
                    for p, at in enumerate(range(0, len(raw), step)):
                        part = raw[at : at + step]
                        rows.append((d, p, at // 4, len(part) // 4, part))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(cut_up, PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths, times) that place ``counts[length]`` pieces of every length."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"piece length {length} is outside 1..{capacity}")
        have[length] = n
    out: list[tuple[list[int], int]] = []

    def take(lengths: list[int]) -> bool:
        need = {x: lengths.count(x) for x in lengths}
        times = min(int(have[x]) // k for x, k in need.items())
        if times < 1:
            return False
        for x, k in need.items():
            have[x] -= k * times
        out.append((lengths, times))
        return True

    def pair_for(total: int, used: list[int]) -> list[int] | None:
        """The available pair with sum ``total`` whose longer part is longest."""
        if total < 2:
            return None
        left = have[: total + 1].copy()
        for x in used:
            if x <= total:
                left[x] -= 1
        a = np.arange(total - 1, (total - 1) // 2, -1)
        fits = (left[a] > 0) & (left[total - a] > 0) & ((2 * a != total) | (left[a] > 1))
        hit = np.flatnonzero(fits)
        return [int(a[hit[0]]), total - int(a[hit[0]])] if len(hit) else None

    def exact(length: int) -> list[int] | None:
        gap = capacity - length
        if gap == 0 or (have[gap] > (gap == length)):
            return [length] + [gap] * bool(gap)
        if found := pair_for(gap, [length]):
            return [length, *found]
        for a in np.flatnonzero(have[: min(length, gap - 1)])[::-1].tolist():
            if a * 3 < gap:  # a is the longest of the three
                break
            if have[a] > (a == length) and (found := pair_for(gap - a, [length, a])) and found[0] <= a:
                return [length, a, *found]
        return None

    for length in range(capacity, 0, -1):  # each length, longest first, until none of it fits exactly
        while have[length] and (found := exact(length)) and take(found):
            pass
    while len(left := np.flatnonzero(have)):  # best fit for the rest
        rest, gap, lengths = have.copy(), capacity, []
        while len(fit := np.flatnonzero(rest[: gap + 1])):
            x = int(fit[-1])
            k = min(gap // x, int(rest[x]))
            lengths += [x] * k
            rest[x] -= k
            gap -= k * x
        take(lengths)
    return out


def slots(patterns: list[tuple[list[int], int]]) -> pd.DataFrame:
    """For each length, ranges of ranks: (length, rank, each, sequence, offset).

    Ranks from ``rank`` on go to sequences from ``sequence`` on, ``each`` of
    them to a sequence, the first at ``offset``.
    """
    rows, used, sequence = [], {}, 0
    for lengths, times in patterns:
        at = 0
        for x in sorted(set(lengths), reverse=True):
            k = lengths.count(x)
            rows.append((x, used.get(x, 0), k, sequence, at))
            used[x] = used.get(x, 0) + k * times
            at += k * x
        sequence += times
    return pd.DataFrame(rows, columns=["length", "rank", "each", "sequence", "offset"], dtype="int64")


def _numbered(pieces: DataFrame) -> DataFrame:
    """Adds the input task and the running number of each length in it."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            by = batch.groupby("length", sort=False)["length"]
            batch["_rank"] = by.cumcount() + batch["length"].map(seen).fillna(0).astype("int64")
            for x, n in by.size().items():
                seen[x] = seen.get(x, 0) + int(n)
            batch["_task"] = task
            yield batch

    schema = StructType([*pieces.schema.fields, StructField("_rank", LongType()), StructField("_task", IntegerType())])
    return pieces.mapInPandas(number, schema)


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (with a ``length`` of 1..capacity) and the ``sequence_id`` and ``offset`` of each.

    A sequence's pieces lie gapless from offset 0.  Columns named
    ``_rank`` and ``_task`` are replaced.
    """
    pieces = pieces.drop("_rank", "_task", "sequence_id", "offset")
    if any(isinstance(f.dataType, BinaryType) for f in pieces.schema.fields):
        pieces = pieces.withColumn("length", F.col("length").cast("long"))
    numbered = written(_numbered(pieces), "pieces")
    per_task = numbered.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {int(r[0]): int(r[1]) for r in per_task.groupBy("length").agg(F.sum("_n")).collect()}  # at most `capacity` rows
    table = slots(plan(histogram, capacity))
    key = (table["length"].to_numpy() << 44) + table["rank"].to_numpy()
    order = np.argsort(key, kind="stable")
    key, (each, sequence, offset) = key[order], (table[c].to_numpy()[order] for c in ("each", "sequence", "offset"))
    first = table["rank"].to_numpy()[order]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        i = np.searchsorted(key, (length.to_numpy() << 44) + rank.to_numpy(), side="right") - 1
        past = rank.to_numpy() - first[i]
        return pd.DataFrame({"sequence_id": sequence[i] + past // each[i], "offset": offset[i] + past % each[i] * length.to_numpy()})

    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    earlier, at = unused(numbered.columns, "_before", "_at")
    offsets = per_task.select("length", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(earlier))
    placed = numbered.join(offsets, ["length", "_task"]).withColumn(at, place("length", F.col("_rank") + F.col(earlier)))
    return placed.select(*[c for c in pieces.columns], f"{at}.sequence_id", f"{at}.offset")
