"""Spelling variants of words by a frequency-vector trie (operator 13).

A word's letters fall into 32 groups (code point modulo 32: a letter, its
capital and a few accented ones).  The trie's levels are the groups, common
letters first; a word lies below the path of its counts of each group, so a
leaf holds words of the same letters.  Words that differ by one inserted,
deleted or replaced code point have counts that differ by a surplus of at
most one and a deficit of at most one.  The search takes a word down the trie
with that budget: at each level it goes on with its own count, or spends the
surplus on one more, or the deficit on one less, where such a child exists.
Words at the leaves are verified by the edit itself.

Each pair is found once: a surplus is spent before a deficit, so the search
goes from the word whose first differing count is the smaller one (words of
equal counts: the smaller word).

Scale: the first levels deal the trie out over the cluster.  A word is sent to
its own subtree, and, with the budget spent in these levels, to the few
others that it can reach (1 + t + t(t-1)/2 for t levels); tasks search their
subtrees, one in memory at a time, searched by words in blocks.  t is the
smallest number of levels whose largest subtree has at most ``limit`` words, and
at most a task's share of them.  A word has as many
near words as it has one-letter edits at most, so no group of pairs is hot.

Defined results: null texts have no words; a null doc_id counts as an empty
string where words are numbered; repeated rows count as often as they occur;
ties between forms go to the smaller word in code-point order; a word of any
length is compared whole; no words give no rows; columns other than
``doc_id`` and ``text`` are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relprep.llm.common import partitions, written

_GROUPS = 32
#: Levels of the trie: groups of the letters from the commonest on, then the groups of no plain letter.
_COMMON = [ord(c) % _GROUPS for c in "etaonisrhldcumfpgwybvkxjqz"]
LEVELS = np.array(_COMMON + [g for g in range(_GROUPS) if g not in _COMMON])
_LEVEL_OF = np.argsort(LEVELS)
#: A node with so few words is verified at once.
_LEAF = 8
#: Words searched for at a time, and pairs verified at a time.
_BLOCK, _PAIRS = 8_192, 200_000
#: Pairs at the fullest leaf that a block of words may reach at a time.
_FOUND = 4_000_000
#: Words up to this length are compared in padded rows.
_PAD = 40
#: Subtrees of so few words are not cut to be a task's share.
_SUBTREE = 2_000
#: Numbers of first levels that may deal the trie out.
_DEPTHS = (2, 3, 4, 5, 6, 8, 12, 16, 24, 32)
#: A path's key is the sum of its counts times these.
_FACTORS = np.random.default_rng(13).integers(1, 1 << 62, size=_GROUPS, dtype=np.int64) | 1


def document_words(docs: DataFrame, drop_every: int = 31, shortest: int = 7, least: int = 2) -> DataFrame:
    """(word, n): the words of all texts and how often they occur.

    A word is a maximal run of letters with A-Z lower-cased; a run whose
    number h, the CRC-32 of ``<doc_id>:<run>``, is a multiple of ``drop_every``
    loses its code point h % length.  Words of under ``shortest`` code
    points or ``least`` occurrences are left out.
    """
    capitals = "".join(map(chr, range(65, 91)))
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{shortest},}}"), F.lit(0))).alias("run"))
    runs = runs.withColumn("run", F.translate("run", capitals, capitals.lower()))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    runs = runs.withColumn("h", h).withColumn("at", (F.col("h") % F.char_length("run")).cast("int"))
    cut = F.concat(F.substring("run", F.lit(1), F.col("at")), F.substring("run", F.col("at") + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("run")).alias("word")).where(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all words in a row, each word's first place and the end, counts by level)."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    place = np.concatenate([[0], np.cumsum(size)])
    cell = np.repeat(np.arange(len(words)) * _GROUPS, size) + _LEVEL_OF[codes % _GROUPS]
    return codes, place, np.bincount(cell, minlength=len(words) * _GROUPS).reshape(-1, _GROUPS).astype(np.int32)


class Words:
    """Words with their counts by level and their padded code points."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        codes, place, self.counts = _letters(words)
        self.size = np.diff(place)
        self.padded = np.zeros((len(words), _PAD + 1), dtype=np.uint32)
        row, column = np.repeat(np.arange(len(words)), self.size), np.arange(len(codes)) - np.repeat(place[:-1], self.size)
        fits = column < _PAD
        self.padded[row[fits], column[fits]] = codes[fits]


def one_edit(a: str, b: str) -> bool:
    """Whether ``b``, as long as ``a`` or one longer, is one replaced or inserted code point away."""
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :])


class Trie:
    """The levels from ``top`` on over ``index``; all its words have equal counts above."""

    def __init__(self, index: Words, top: int):
        self.index, self.top = index, top
        self.order = np.lexsort(index.counts.T[::-1])
        counts = index.counts[self.order]
        self.base = int(counts.max(initial=0)) + 3
        self.keys, self.starts = [], []
        m = len(counts)
        new, node = np.zeros(m, dtype=bool), np.zeros(m, dtype=np.int64)
        new[:1] = True
        for g in range(top, _GROUPS):
            new[1:] |= counts[1:, g] != counts[:-1, g]
            first = np.flatnonzero(new)
            self.keys.append(node[first] * self.base + counts[first, g])
            self.starts.append(np.append(first, m))
            node = np.cumsum(new) - 1
            if len(first) == m:
                break
        #: Words below the fullest leaf.
        self.widest = max(_LEAF, int(np.diff(self.starts[-1]).max(initial=0)) if self.starts else m)

    def reached(self, counts: np.ndarray, spent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``counts``, index word) for every word at a leaf that the budget reaches.

        ``spent``: 0 nothing, 1 the surplus, 2 both.
        """
        q, node = np.arange(len(counts)), np.zeros(len(counts), dtype=np.int64)
        found_q, found_lo, found_n = [], [], []
        if len(self.order) <= _LEAF or not self.keys:
            found_q, found_lo, found_n = [q], [node], [np.full(len(q), len(self.order))]
            q = q[:0]
        for depth, (keys, starts) in enumerate(zip(self.keys, self.starts)):
            if not len(q):
                break
            own = np.minimum(counts[q, self.top + depth], self.base - 2)
            more, less = np.flatnonzero(spent == 0), np.flatnonzero((spent == 1) & (own > 0))
            count = np.concatenate([own, own[more] + 1, own[less] - 1])
            parent = np.concatenate([node, node[more], node[less]])
            q = np.concatenate([q, q[more], q[less]])
            spent = np.concatenate([spent, spent[more] + 1, spent[less] + 1])
            want = parent * self.base + count
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == want)
            q, node, spent = q[hit], at[hit], spent[hit]
            n = starts[node + 1] - starts[node]
            leaf = n <= _LEAF if depth + 1 < len(self.keys) else n > 0
            found_q.append(q[leaf])
            found_lo.append(starts[node[leaf]])
            found_n.append(n[leaf])
            q, node, spent = q[~leaf], node[~leaf], spent[~leaf]
        q, lo, n = np.concatenate(found_q), np.concatenate(found_lo), np.concatenate(found_n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(q, n), self.order[np.repeat(lo, n) + within]

    def near(self, asked: Words, spent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Verified pairs (word of ``asked``, word of the index), each once over the whole search."""
        block = max(1, min(_BLOCK, _FOUND // self.widest))  # words of very many anagrams are searched for in smaller blocks
        for i in range(0, len(spent), block):
            q, r = self.reached(asked.counts[i : i + block], spent[i : i + block])
            for j in range(0, len(q), _PAIRS):
                a, b = q[j : j + _PAIRS] + i, r[j : j + _PAIRS]
                change = self.index.counts[b] - asked.counts[a]
                up, down = np.maximum(change, 0), np.maximum(-change, 0)
                above = slice(0, self.top)
                fits = (up.sum(1) <= 1) & (down.sum(1) <= up.sum(1)) & (up[:, above].sum(1) == (spent[a] >= 1)) & (down[:, above].sum(1) == (spent[a] == 2))
                fits &= (down.sum(1) == 0) | (up.argmax(1) < down.argmax(1))
                a, b = a[fits], b[fits]
                ok = self._one_edit(asked, a, b)
                yield a[ok], b[ok]

    def _one_edit(self, asked: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = asked.padded[a], self.index.padded[b]
        differ = x != y
        first = differ.argmax(1)
        shifted = (x[:, :-1] != y[:, 1:]) & (np.arange(_PAD) >= first[:, None])
        same = asked.size[a] == self.index.size[b]
        ok = np.where(same, differ.sum(1) == 1, ~shifted.any(1))
        # Words of equal length and counts meet twice: the smaller one's search counts.
        least = np.take_along_axis(x, first[:, None], 1)[:, 0] < np.take_along_axis(y, first[:, None], 1)[:, 0]
        ok &= ~same | (asked.counts[a] != self.index.counts[b]).any(1) | least
        for k in np.flatnonzero(self.index.size[b] > _PAD):
            u, w = asked.words[a[k]], self.index.words[b[k]]
            ok[k] = one_edit(u, w) and (not same[k] or u < w or bool((asked.counts[a[k]] != self.index.counts[b[k]]).any()))
        return ok


def _send(top: int):
    """Each word to its own subtree (spent 0) and to those that it reaches by spending in the first levels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors = _FACTORS[:top]
        for batch in batches:
            counts = _letters(batch["word"].tolist())[2][:, :top].astype(np.int64)
            key = (counts * factors).sum(1)
            yield batch.assign(key=key, spent=0)
            for i in range(top):
                yield batch.assign(key=key + factors[i], spent=1)
                for j in range(i + 1, top):
                    has = counts[:, j] > 0
                    if has.any():
                        yield batch[has].assign(key=key[has] + factors[i] - factors[j], spent=2)

    return run


def _search(top: int):
    """Verified pairs of rows that come sorted by key, the index (spent 0) first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, trie = None, [], None

        def pairs(trie: Trie, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            asked = Words(rows["word"].tolist(), rows["n"].to_numpy())
            for a, b in trie.near(asked, rows["spent"].to_numpy()):
                if len(a):
                    yield pd.DataFrame({"u": [asked.words[k] for k in a.tolist()], "n_u": asked.n[a], "w": [trie.index.words[k] for k in b.tolist()], "n_w": trie.index.n[b]})

        def indexed() -> Trie:
            rows = pd.concat(held)
            return Trie(Words(rows["word"].tolist(), rows["n"].to_numpy()), top)

        for batch in batches:
            keys, spent = batch["key"].to_numpy(), batch["spent"].to_numpy()
            border = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | ((spent[1:] > 0) != (spent[:-1] > 0)), [True]]))
            for i, j in zip(border[:-1].tolist(), border[1:].tolist()):
                if keys[i] != key:
                    if held and trie is None:
                        yield from pairs(indexed(), pd.concat(held))
                    key, held, trie = keys[i], [], None
                if spent[i] == 0:
                    held.append(batch[i:j])
                elif held:
                    if trie is None:
                        trie = indexed()
                        yield from pairs(trie, pd.concat(held))
                    yield from pairs(trie, batch[i:j])
        if held and trie is None:
            yield from pairs(indexed(), pd.concat(held))

    return run


def _with_path(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The counts by level, as text, to size subtrees by."""
    for batch in batches:
        counts = np.minimum(_letters(batch["word"].tolist())[2], 0xFF) + 0x100  # one character a level
        yield batch.assign(path=["".join(map(chr, row)) for row in counts.tolist()])


def near_words(words: DataFrame, limit: int = 50_000) -> DataFrame:
    """Directed pairs (word, n, near, n_near) of the distinct words of ``words`` (word, n) one edit apart."""
    paths = words.mapInPandas(_with_path, "word string, n long, path string")
    share = -(-words.count() // partitions(words.sparkSession))
    limit, top = min(limit, max(_SUBTREE, share)), None
    for top in _DEPTHS:
        largest = paths.groupBy(F.substring("path", 1, top)).count().agg(F.max("count")).first()[0] or 0
        if largest <= limit:
            break
    sent = words.select("word", "n").mapInPandas(_send(top), "word string, n long, key long, spent int")
    found = sent.repartition("key").sortWithinPartitions("key", "spent").mapInPandas(_search(top), "u string, n_u long, w string, n_w long")
    both = F.explode(F.array(F.struct(F.col("u").alias("word"), F.col("n_u").alias("n"), F.col("w").alias("near"), F.col("n_w").alias("n_near")), F.struct(F.col("w").alias("word"), F.col("n_w").alias("n"), F.col("u").alias("near"), F.col("n_u").alias("n_near"))))
    return found.select(both.alias("p")).select("p.*")


def group_variants(words: DataFrame, ratio: int = 10, limit: int = 50_000) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of ``words`` (word, n).

    ``form`` is the near word of largest n if that is at least ``ratio`` times the
    word's own; ``root`` is the last word that forms lead to.  n grows by
    ``ratio`` along the way, so the doubling rounds below are few.
    """
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    near = near_words(words, limit).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_near")).alias("m"), "near")).alias("best"))
    out = words.join(near, "word", "left")
    formed = -F.col("best.m") >= ratio * F.col("n")
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.m")).alias("form_n"))
    out = written(out, "forms")
    roots, k = out.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:  # pointer doubling
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        k += 1
        step = written(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"roots-{k}")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
