"""Operators 11 to 13 against the library, brute force and awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from relprep.llm import conversation_trie, queries, token_counts, word_variants  # noqa: F401
from relprep.llm.registry import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


# ---- operator 11


def odd_texts():
    rng = random.Random(3)
    bits = ["the", "  ", " ", "\n", "\n\n", "<|endoftext|>", "<|endof", "text|>", "é", "日本語", "。", "᠎", "\x1c", "\x85", "\xa0", "'s", "'", "12", "a1", "!!", "z" * 40, "\U0001F600", "é"]
    texts = [None, "", "a b", "z" * 1500, " " * 3000, "x" * 500 + " " + "y" * 3000 + "." + "k " * 300, "<|endoftext|>" * 80 + "  " * 200]
    return texts + ["".join(rng.choice(bits) + rng.choice(["", "", " "]) for _ in range(rng.randint(1, 600))) for _ in range(80)]


@pytest.mark.parametrize("whole, chunk, overlap", [(300, 100, 30), (200, 64, 64), (100_000, 50_000, 10)])
def test_token_counts_are_the_librarys(spark, lib, whole, chunk, overlap):
    """Clashing names, null and repeated ids; chunks down to 64 characters, so that many seams fail."""
    rows = [(i // 2 if i % 7 else None, t, i, "x", 0) for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, uid int, n_tokens string, k int")
    got = collections.Counter(tuple(r) for r in token_counts.count_tokens(docs, PATH, 512, whole, chunk, overlap).collect())
    want = collections.Counter()
    for d, t, *_ in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want[d, len((t or "").encode()), n, n > 512] += 1
    assert got == want


def test_stable_places_leave_special_strings_whole():
    text = "abc <|endoftext|> def.x ghi"
    at = set(token_counts.stable_places(text, ["<|endoftext|>"], True, True).tolist())
    assert {3, 17, 21, 23} <= at and not at & set(range(5, 17))
    assert token_counts.stable_places(text, ["<|endoftext|>"], False, False).tolist() == []


def test_token_counts_query_and_empty_table(spark, smoke_dir, lib):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op11_token_counts"](spark, smoke_dir).collect()}
    for r in docs.collect():
        n = len(lib.encode(r.text or "", add_special_tokens=False).ids)
        assert got[r.doc_id] == (len((r.text or "").encode()), n, n > 512)
    assert token_counts.count_tokens(docs.limit(0), PATH).collect() == []


# ---- operator 12


def plain_trie(rows, every=100):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % every if c >= 0 else -(-c % every))
        rebuilt[c] = own.get(base, [])[:h] + v[h:]
    members = collections.defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
            leaves[k[:d]] += not kids[k]
    ends = {k: ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(k)) for k, m in members.items()}
    return sorted(
        ((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(ends[k].encode()).hexdigest()) for k, m in members.items()),
        key=str,
    )


TURNS = "conv_id long, turn long, role string, text string"


def odd_turns():
    rng = random.Random(5)
    rows = [(None, 1, "a", "b"), (None, None, None, None)]
    for c in [*range(40), *range(100, 160), 205, -3, -100, -250, *range(3000, 3030)]:
        rows += [(c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", "\U0001F600x", None])) for t in range(rng.randint(1, 7))]
    return rows + [(501, t, "u", str(t % 3)) for t in range(90)] + [(502, t, "u", str(t % 3)) for t in range(70)] + rows[5:9]


@pytest.mark.parametrize("long_from", [100_000, 4])
def test_trie_against_brute_force(spark, long_from):
    """Null and repeated turns, negative ids, absent bases, two long chains; blocks of four turns."""
    table = spark.createDataFrame([(*r, 0, 0) for r in odd_turns()], TURNS + ", a int, kids int")
    got = sorted((tuple(r) for r in conversation_trie.trie(table, long_from=long_from).collect()), key=str)
    assert got == plain_trie(odd_turns())


def test_trie_of_smoke_table_copies_and_no_rows(spark, smoke_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{smoke_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_conversation_trie"](spark, smoke_dir).collect()), key=str)
    assert got == plain_trie(rows)
    assert conversation_trie.trie(spark.createDataFrame([], TURNS)).collect() == []


def test_members_hash_over_many_blocks(spark):
    """3,000 conversations of one turn end at few nodes, over several blocks of ids."""
    rows = [(c, 0, "u", "hello") for c in range(-500, 2500)]
    got = sorted((tuple(r) for r in conversation_trie.trie(spark.createDataFrame(rows, TURNS)).collect()), key=str)
    assert got == plain_trie(rows)


def test_subtree_totals_of_random_trees(spark):
    rng = random.Random(8)
    up = {0: None} | {v: rng.choice([v - 1, v - 1, rng.randrange(v)]) for v in range(1, 120)}
    kids = collections.Counter(up.values())
    rows = [(v, -v, p, None if p is None else -p, kids[v], v * v) for v, p in up.items()]
    want = {v: v * v for v in up}
    for v in sorted(up, reverse=True):
        if up[v] is not None:
            want[up[v]] += want[v]
    tree = spark.createDataFrame(rows, "a long, b long, pa long, pb long, kids long, x long")
    assert {r.a: r.x for r in conversation_trie.subtree_totals(tree, ["x"]).collect()} == want


# ---- operator 13


def plain_words(rows):
    n = collections.Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= 7
    return {w: k for w, k in n.items() if k >= 2}


def plain_variants(n):
    holes, near = collections.defaultdict(set), collections.defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            if (x := w[:i] + w[i + 1 :]) in n:
                near[w].add(x)
                near[x].add(w)
    for g in holes.values():
        for w in g:
            near[w] |= g - {w}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root(w)) for w in n}


def held(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("limit", [50_000, 20, 3])
def test_variants_against_brute_force(spark, limit):
    """Letters that share groups, chains of forms, words of thousands of letters; tries dealt out at several depths."""
    rng = random.Random(2)
    words = {}
    for _ in range(40):
        base = "".join(rng.choice("abcáÁñz") for _ in range(rng.randint(7, 10)))
        words[base] = rng.choice([2, 30, 500])
        for _ in range(10):
            i, kind = rng.randrange(len(base)), rng.choice("dir")
            words[base[:i] + base[i + 1 :] if kind == "d" else base[:i] + rng.choice("abcdáÿ") + base[i + (kind == "r") :]] = rng.randint(2, 40)
    long = "q" * 60 + "abc" * 20
    words |= {long: 100, long + "x": 3, long[:30] + long[31:]: 2, long[:50] + "z" + long[51:]: 9, "a" * 4000: 2, "a" * 4001: 25, "abcdefgh": 2, "abcdefgi": 20, "abcdefgj": 20, "abcdefg": 200}
    table = spark.createDataFrame([(w, n, 0, "k") for w, n in words.items()], "word string, n long, spent int, key string")
    assert held(word_variants.group_variants(table, 10, limit)) == plain_variants(words)


def test_variants_of_anagrams_and_no_words(spark):
    rng = random.Random(4)
    words = {"".join(rng.sample("abcdefg", 7)): 2 for _ in range(300)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert held(word_variants.group_variants(table, limit=5)) == plain_variants(words)
    assert word_variants.group_variants(table.limit(0)).collect() == []


def test_document_words(spark):
    rows = [(1, "ABCDEFGHI abcdefghi ÀÉÎÕÜßñ ×÷×÷×÷× xx sevenlet " * 3), (None, "lonelyword lonelyword"), (2, None), (3, ""), (3, "abcdefghi" * 50), (3, "abcdefghi" * 50)]
    rows += [(i, "wonderful") for i in range(2000)]
    got = word_variants.document_words(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, run int"))
    want = plain_words(rows)
    assert {r.word: r.n for r in got.collect()} == want and len({w for w in want if len(w) == 8}) > 1


def test_variants_query(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    want = plain_variants(plain_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert held(QUERIES["op13_spelling_variants"](spark, smoke_dir)) == want


def test_one_edit():
    assert word_variants.one_edit("abc", "abd") and word_variants.one_edit("abc", "xabc") and word_variants.one_edit("abc", "abcx")
    assert not word_variants.one_edit("abc", "abc") and not word_variants.one_edit("abc", "acb") and not word_variants.one_edit("abc", "xyabc"[1:] + "z")
    assert np.array_equal(np.sort(word_variants.LEVELS), np.arange(32))
