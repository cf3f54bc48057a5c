"""Benchmark decontamination by containment search (operator 9), DataFrame functions only.

Texts are lower-cased and cut into runs of letters and digits; shingles are
five such words (fewer words: all of them).  A test item is found in a
document when at least ``threshold`` of the item's distinct shingles occur
in it.

Candidates: size-partitioned MinHash.  A document with n distinct shingles
belongs to size class c, the least with 2**c > 8 n, and its sketch is a
one-permutation MinHash with 2**c bins: the smallest hash of each bin, where
the bin is the hash's top c bits.  Bins grow with the document, so a short
item's shingles are minima inside a long document as often as in a short one
(a sketch with a fixed number of bins would lose them).  An item is sketched
for every size class at once: in class c its shingle x is a bin's minimum
exactly if no smaller one of the item shares x's top c bits, which holds from
one class on; that class is stored beside x.  The lookup is an equality join
on the hash with ``class >= that class``.  A shared shingle is missed only when
another hash of the document falls below it in its bin (at most 1 in 8 for
one shingle, independent over shingles), so an item with m shared shingles
is missed with a chance below 8**-m; items are nearly always found by their
first few.

Short items: an item of at most ``FEW`` shingles is also looked up among all
shingles of a document, by equality of hashes; one of fewer than five words
(down to ``LEAST``) has one shingle, all its words, which is looked up among
the runs of as many words.  Items of still fewer words, which clean documents
hold by chance, are found only in texts that have no other words.

Verification: exact containment of shingle texts, on candidates alone.

Scale: documents are read once for the sketch, once for each length of short
items (none where there are no such items) and once for the candidates.  The
items' side is broadcast only if its texts and hashes have at most
``BROADCAST_BYTES``, measured first, and so are the candidates, which fetch
their documents' texts; beyond that the joins shuffle.  A passage
found in a third of all documents gives one pair for each, spread by document.

Defined results: null and wordless texts and items match nothing; equal items
and items of a null item_id match each on its own; rows equal in doc_id and text give one row an item; no rows
give no rows; other columns are ignored by ``leaks`` and kept by
``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relprep.llm.common import matching, written

SHINGLE = 5
#: Bins of a sketch for each shingle, as a power of two.
DENSITY_BITS = 3
#: The items' side is broadcast up to this size: the shingles' texts and 32 bytes for each.
BROADCAST_BYTES = 16 << 20
#: A candidate pair's share of the broadcast.
CANDIDATE_BYTES = 96
#: Items of at most so many shingles are looked up among all shingles of a document.
FEW = 4
#: Shorter items, in words, are found only in texts that hold nothing else.
LEAST = 3


def _words(text: Column) -> Column:
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " ", -1))


def _starts(words: str, size: int | Column) -> Column:
    return F.when(F.size(words) > 0, F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _hashes(words: str, size: int) -> Column:
    """Sorted distinct shingle hashes, non-negative."""
    one = lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(words, i + k) for k in range(size)]), 1)
    return F.sort_array(F.array_distinct(F.transform(_starts(words, size), one)))


def _shingles(words: str, size: int) -> Column:
    return F.array_distinct(F.transform(_starts(words, size), lambda i: F.array_join(F.slice(words, i + 1, size), " ")))


def _bits(x: Column) -> Column:
    """Bit length of a non-negative long, at least 1."""
    return F.length(F.bin(x))


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, class, hash): each document's sketch for its own size class."""
    step = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    step = step.withColumn("w", _words(F.col("text"))).withColumn("h", _hashes("w", size))
    step = step.withColumn("class", F.least(F.lit(62), _bits(F.size("h").cast("long")) + DENSITY_BITS))
    drop = F.lit(63) - F.col("class")
    low = F.filter("h", lambda x, i: (i == 0) | (F.call_function("shiftright", x, drop) != F.call_function("shiftright", F.get("h", i - 1), drop)))
    return step.select("doc_id", "text_hash", "class", F.explode(low).alias("hash"))


def item_sketch(items: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(item_id, hash, from_class): a row for each distinct shingle of an item."""
    step = items.withColumn("h", _hashes("w", size))
    first = F.transform("h", lambda x, i: F.struct(x.alias("hash"), F.when(i == 0, F.lit(0)).otherwise(F.lit(64) - _bits(x.bitwiseXOR(F.get("h", i - 1)))).alias("from_class")))
    return step.select("item_id", F.inline(first))


def _items(benchmark: DataFrame, size: int, least: int) -> DataFrame:
    """(item, item_id, w, size, shingles): ``item`` tells rows of equal or null item_id apart.

    An item of ``least`` to ``size`` - 1 words has one shingle of its own length.
    """
    rows = benchmark.select("item_id", _words(F.col("text")).alias("w")).where(F.size("w") > 0)
    own = F.when(F.size("w") < least, F.lit(size)).otherwise(F.least(F.lit(size), F.size("w")))
    rows = rows.withColumn("item", F.monotonically_increasing_id()).withColumn("size", own)
    return rows.select("item", "item_id", "w", "size", _shingles("w", size).alias("shingles"))


def _short(docs: DataFrame, items: DataFrame, small: bool) -> DataFrame:
    """(doc_id, text_hash, item) of the documents that share a shingle with an item of few.

    A sketch may miss these: each is looked up among all shingles of its length.
    """
    few = items.where((F.size("shingles") <= FEW) | (F.col("size") < SHINGLE))
    out = docs.sparkSession.createDataFrame([], "doc_id long, text_hash long, item long")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), _words(F.col("text")).alias("w"))
    for k in sorted(r.size for r in few.select("size").distinct().collect()):  # at most SHINGLE lengths
        side = few.where(F.col("size") == k).select("item", F.explode(_hashes("w", k)).alias("hash"))
        met = own.select("doc_id", "text_hash", F.explode(_hashes("w", k)).alias("hash")).join(F.broadcast(side) if small else side, "hash")
        out = out.union(met.select("doc_id", "text_hash", "item"))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, size: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """(doc_id, text_hash, item_id, n_item, n_shared) for every document that holds an item."""
    items = written(_items(benchmark, size, least), "items")
    volume = items.agg(F.sum(F.length(F.array_join("shingles", " ")) + F.size("shingles") * 32)).first()[0] or 0
    small = volume <= BROADCAST_BYTES
    sketch = item_sketch(items.select(F.col("item").alias("item_id"), "w"), size)
    met = sketches(docs, size).join(F.broadcast(sketch) if small else sketch, "hash").where(F.col("class") >= F.col("from_class"))
    pairs = met.select("doc_id", "text_hash", F.col("item_id").alias("item")).union(_short(docs, items, small))
    pairs = written(pairs.distinct(), "leak-candidates")

    lengths = items.select("item", "size")
    wanted = pairs.join(F.broadcast(lengths) if small else lengths, "item").groupBy("doc_id", "text_hash", "size").agg(F.collect_set("item").alias("found"))
    text = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    # The texts are not moved where the candidates are few: at most CANDIDATE_BYTES each, counted first.
    wanted = F.broadcast(wanted) if pairs.count() * CANDIDATE_BYTES <= BROADCAST_BYTES else wanted
    held = text.join(wanted, same).withColumn("w2", _words(F.col("text")))
    own = F.transform(_starts("w2", F.col("size")), lambda i: F.array_join(F.slice("w2", i + 1, F.col("size")), " "))
    held = held.withColumn("own", F.array_distinct(own)).select("doc_id", "text_hash", "own", F.explode("found").alias("item"))
    check = items.select("item", "item_id", "shingles")
    checked = held.join(F.broadcast(check) if small else check, "item")
    n, shared = F.size("shingles"), F.size(F.array_intersect("own", "shingles"))
    out = checked.select("doc_id", "text_hash", "item", "item_id", n.cast("long").alias("n_item"), shared.cast("long").alias("n_shared"))
    return out.where(F.col("n_shared") >= threshold * F.col("n_item")).distinct().drop("item")


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, size: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that hold no item of ``benchmark``, unchanged."""
    return matching(docs, leaks(docs, benchmark, threshold, size, least), "left_anti")
