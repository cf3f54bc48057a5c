"""Each corpus operator against a brute-force version, on the smoke tables and on awkward rows."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from relprep.llm import decontaminate, line_dedup, packing, pii_crf, quality_rules, queries, secret_forest, simhash_dedup, suffix_dedup, token_store, url_model
from relprep.llm.common import connected_components
from relprep.llm.registry import QUERIES
from relprep.llm.tokenizing import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _rank int, fp string"

AWKWARD = [
    (1, "one two three four five six seven eight nine ten " * 8, "en", "a", 1, 0, "x"),
    (2, "one two three four five six seven eight nine ten " * 8, "en", "a", 1, 0, "x"),
    (2, "one two three four five six seven eight nine ten " * 8, "en", "a", 1, 0, "x"),
    (3, None, None, None, None, None, None),
    (4, "", "en", "", 0, 1, ""),
    (None, "no id here, but quite some words to read and keep in mind", "en", "a", 5, 1, "y"),
    (None, None, None, None, None, None, None),
    (5, "a b", "en", "b", 3, 1, "z"),
    (6, "\n\n  \t \x0b\x0c\r\n", "en", "b", 3, 1, "z"),
    (7, "Ünïcödé    x \x1c y  z \U0001F600\U0001F600 <|endoftext|>.\n b c", "en", "b", 3, 1, "z"),
    (8, " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000)), "en", "b", 3, 1, "z"),
    (9, "z" * 400 + " tail", "en", "b", 3, 1, "z"),
    (10, "z" * 300 + " other", "en", "b", 3, 1, "z"),
]


@pytest.fixture(scope="module")
def docs(spark, smoke_dir):
    return spark.read.parquet(f"{smoke_dir}/documents.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


def rows_of(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


def closure(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


# ---- operator 1


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = WORD.findall(lower)
    s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_simhash_components(which, request):
    table = request.getfixturevalue(which)
    rows = rows_of(table)
    fps = [plain_fingerprint(t) for _, t in rows]
    root = closure(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for (d, _), f in zip(rows, fps):
        if d is not None:
            first[root[f]] = min(d, first.get(root[f], d))
    want = collections.Counter((d, f, first.get(root[f])) for (d, _), f in zip(rows, fps))
    got = simhash_dedup.components(table).collect()
    assert collections.Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want


def test_simhash_crowded_variants_lose_no_link(spark):
    """A dense cloud of fingerprints, cut again below a limit of four."""
    rng = np.random.default_rng(1)
    base = int(rng.integers(1 << 62))
    fps = {base ^ sum(1 << int(b) for b in rng.choice(64, size=int(rng.integers(0, 6)), replace=False)) for _ in range(150)}
    fps |= {int(x) for x in rng.integers(0, 1 << 63, size=40)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = closure(sorted(signed), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    found = {r.node: r.root for r in connected_components(simhash_dedup.links(table, 3, limit=4), "t").collect()}
    assert {f: found.get(f, f) for f in signed} == want


def test_simhash_deduplicate_keeps_one_of_each(awkward):
    kept = simhash_dedup.deduplicate(awkward)
    assert kept.columns == awkward.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert (False, 1) in got and (False, 2) not in got
    assert len(got) == len({c.component_id for c in simhash_dedup.components(awkward).collect()})


def test_simhash_deduplicate_tells_components_without_an_id_apart(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (7, text("c")), (7, text("d")), (8, text("d")), (None, text("d"))]
    got = simhash_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, text("a")), (0, text("b")), (7, text("c")), (7, text("d"))])


# ---- operator 2


def norm(line):
    return re.sub(r"[^\w]+|_+", " ", line.lower()).strip()


def lev(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def line_fp(text, features=None):
    w = text.split(" ")
    features = features or (w if len(w) <= line_dedup.LONG else [" ".join(w[i : i + 2]) for i in range(len(w))])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in features]
    return sum(1 << b for b in range(60) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_line_dedup(rows, max_bits):
    at = collections.defaultdict(list)
    for d, t in rows:
        for i, x in enumerate(t.split("\n")):
            if norm(x):
                at[norm(x)].append((d, i))
    fp = {x: line_fp(x) for x in at}

    def linked(a, b):
        most = max(len(a), len(b))
        return (fp[a] ^ fp[b]).bit_count() <= max_bits and min(len(a), len(b)) >= 0.8 * most and lev(a, b) <= int(0.2 * most + 1e-9)

    root, groups = closure(sorted(at), linked), collections.defaultdict(list)
    for x, places in at.items():
        groups[root[x]] += places
    gone = collections.defaultdict(set)
    for places in groups.values():
        for d, i in sorted(set(places))[1:]:
            gone[d].add(i)
    return gone


LINES = ["the quick brown fox jumps over the lazy dog near the old river bank today", "another line that stands alone", "Short.", "--", ""]


@pytest.mark.parametrize("limit,max_bits", [(256, 2), (3, 2), (3, 3)])
def test_line_dedup(spark, limit, max_bits):
    rng = np.random.default_rng(2)
    long = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"], n)) for n in (60, 60, 400)]
    rows = []
    for d in range(40):
        lines = []
        for x in long + LINES:
            if rng.random() < 0.6:
                w = x.split(" ")
                if len(w) > 20 and rng.random() < 0.7:
                    w[int(rng.integers(len(w)))] = f"new{int(rng.integers(30))}"
                lines.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
        rows.append((d, "\n".join(lines)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_line_dedup(rows, max_bits)
    got = {r.doc_id: set(r.removed) for r in line_dedup.decisions(table, max_bits=max_bits, limit=limit).collect()}
    assert got == {d: x for d, x in want.items() if x}
    assert sum(map(len, got.values())) > 60
    texts = {r.doc_id: r.text for r in line_dedup.deduplicate(table, max_bits=max_bits, limit=limit).collect()}
    for d, t in rows:
        assert texts[d] == "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want.get(d, ()))


def test_line_simhash_of_a_very_long_line(spark):
    words = [f"w{i % 7001}" for i in range(70_000)]
    got = line_dedup.line_table(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    pairs, want = [" ".join(words[i : i + 2]) for i in range(len(words))], 0
    for i in range(0, len(pairs), line_dedup.PART):
        want ^= line_fp("", pairs[i : i + line_dedup.PART])
    assert got.fp == want


@pytest.mark.parametrize("limit", [256, 1])
def test_line_dedup_links_near_copies_on_either_side_of_a_length(spark, limit):
    # A long vocabulary word by word, and one more frequent word at the end.
    words = [w for i in range(line_dedup.LONG // 2) for w in (f"w{i}", "the")]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "the"])), (3, " ".join([*words, "the", "the"])), (4, "alone")]
    got = {r.doc_id: r.removed for r in line_dedup.decisions(spark.createDataFrame(rows, "doc_id long, text string"), limit=limit).collect()}
    assert got == {2: [0], 3: [0]}


def test_line_simhash_adds_the_counts_of_parts(spark):
    n = 16_000
    words = [f"w{i % 7001}" for i in range(n + 1)]
    rows = [(k, " ".join(words[:k])) for k in (n, n + 1)]
    got = {r.doc_id: r.fp for r in line_dedup.line_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[n] ^ got[n + 1]).bit_count() <= 3


def test_line_dedup_awkward_rows(awkward):
    out = line_dedup.deduplicate(awkward)
    assert out.columns == [*awkward.columns, "_removed"]
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert (2, "") in got and (3, None) in got and (4, "") in got
    assert out.count() == awkward.count()
    assert line_dedup.deduplicate(awkward, keep_empty=False).count() == awkward.count() - 2


# ---- operators 4 and 5


@pytest.mark.parametrize("name,cut", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "space")])
def test_cached_ids_are_the_librarys(docs, name, cut):
    lib, own = Tokenizer.from_file(public_tokenizers.path(name)), Encoder(public_tokenizers.path(name), cut, cache_words=500)
    odd = [t or "" for _, t, *_ in AWKWARD] + ["a \nb", " lead", "trail ", "a  b", "\n\n", "x\n y", "it's we'll  ok", "　　a", "tab\t x", ".\x1c.", "A\x1dB c", "é ́x", "<|endoftext|>", "a<|endoftext|> b"]
    rng = np.random.default_rng(3)
    odd += ["".join(rng.choice(list(" \n\t \x1c.aéZ9's　"), 40)) for _ in range(300)]
    for texts in (odd, [r.text for r in docs.collect()]):
        want = [np.array(e.ids, dtype="<u4").tobytes() for e in lib.encode_batch(texts, add_special_tokens=False)]
        assert own.encode(texts) == want


@pytest.mark.parametrize("name,cut", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "space")])
def test_a_word_that_many_texts_hold_is_looked_up_once(name, cut):
    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    lib, own = Tokenizer.from_file(public_tokenizers.path(name)), Encoder(public_tokenizers.path(name), cut)
    own.new, own.old = Counted(), Counted()
    texts = [f"Some words, many times: some words. {'Some words and ' * 50}\nsome words" for _ in range(40)] + ["", " ", "\n", "a <|ENDOFTEXT|> b"]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want and own.encode([]) == []
    assert Counted.asked < 100


def test_contexts_sorted_at_a_time_need_little_memory():
    import tracemalloc

    from relprep.llm import suffix_dedup

    rng = np.random.default_rng(1)
    contexts = [rng.integers(97, 122, 80, dtype=np.uint8).tobytes() for _ in range(suffix_dedup.CONTEXTS)]
    tracemalloc.start()
    found = suffix_dedup.run_minima(contexts, np.arange(len(contexts)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((x == k).all() for k, x in enumerate(found)) and peak < 80_000_000


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_packing(which, request):
    table = request.getfixturevalue(which)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for d, t in rows_of(table):
        ids = np.array([*lib.encode(t, add_special_tokens=False).ids, 0], dtype="<u4")
        for p in range(0, len(ids), 2048):
            part = ids[p : p + 2048]
            want[d, p // 2048, p, len(part), zlib.crc32(part.tobytes())] += 1
    pieces = packing.token_pieces(table, public_tokenizers.path("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    out = packing.pack(pieces).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    by = collections.defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by) <= -(-sum(r.length for r in out) // 2048) * 1.05 + 2


def test_packing_plan_uses_exact_complements():
    counts = {1000: 6, 1048: 4, 500: 7, 300: 9, 248: 5, 2048: 2, 7: 30}
    patterns = packing.plan(counts, 2048)
    used = collections.Counter()
    for lengths, times in patterns:
        assert sum(lengths) <= 2048
        for x in lengths:
            used[x] += times
    assert used == counts
    assert ([1048, 1000], 4) in patterns
    assert sum(t for _, t in patterns) <= -(-sum(k * v for k, v in counts.items()) // 2048) + 1
    assert packing.plan({}, 2048) == []


def test_packing_plan_against_brute_force_triples():
    rng = np.random.default_rng(4)
    for _ in range(30):
        counts = {int(k): int(rng.integers(1, 4)) for k in rng.choice(np.arange(1, 25), 8, replace=False)}
        patterns = packing.plan(dict(counts), 24)
        used = collections.Counter()
        for lengths, times in patterns:
            assert sum(lengths) <= 24
            for x in lengths:
                used[x] += times
        assert used == counts


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_token_files(which, request):
    table = request.getfixturevalue(which)
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted(rows_of(table), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want, start = [], 0
    for d, t in rows:
        ids = np.array([*lib.encode(t, add_special_tokens=False).ids, 0], dtype="<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    images = token_store.write_tokens(table, public_tokenizers.path("byte_bpe_50k.json"), segment=5000)
    got = token_store.read_tokens(images, with_ids=True).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == want
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)


def test_token_blocks_round_trip():
    rng = np.random.default_rng(5)
    for n in (0, 1, 255, 256, 257, 5000):
        for high in (1, 2, 300, 50_257, 1 << 32):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype("<u4")
            ids[rng.random(n) < 0.05] = (1 << 32) - 1
            image = token_store.image_of([None, 7], [ids[: n // 3].tobytes(), ids[n // 3 :].tobytes()])
            named, lengths, back = token_store.read_image(image)
            assert named == [None, 7] and lengths.tolist() == [n // 3, n - n // 3] and (back == ids).all()
            a, b = n // 4, n // 2
            assert (token_store.read_range(image, a, b) == ids[a:b]).all()


# ---- operator 8


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_quality_rules(which, request):
    table, limit = request.getfixturevalue(which), 2
    data = table.select("doc_id", "text", "source").collect()
    clean = lambda x: re.sub(r"[ \t\x0b\f\r]+", " ", x.lower()).strip(" ")
    held, carriers = collections.defaultdict(set), collections.defaultdict(set)
    for d, t, s in data:
        w = WORD.findall(t or "")
        n = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        passes = len(w) >= 50 and 100 * len(covered) <= 50 * len(w)
        for x in (t or "").split("\n"):
            if clean(x):
                held[s, clean(x)].add((d is None, d or 0, t))
                if passes:
                    carriers[s, clean(x)].add((d is None, d or 0))
    want = collections.Counter()
    for d, t, s in data:
        raw, t = t, t or ""
        w = WORD.findall(t)
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        n = collections.Counter(windows)
        covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        lost = sum(len(clean(x).split(" ")) for x in t.split("\n") if clean(x) and len(held[s, clean(x)]) > limit and min(carriers[s, clean(x)], default=None) != (d is None, d or 0))
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        kept = not failed and len(w) - lost >= 0.3 * len(w)
        want[d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), lost, failed, kept] += 1
    got = quality_rules.judge(table, max_docs=limit)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept"]
    assert collections.Counter(map(tuple, got.select(*cols).collect())) == want
    kept = quality_rules.keep_good(table, max_docs=limit)
    assert kept.columns == table.columns and kept.count() == sum(v for k, v in want.items() if k[-1])


# ---- operator 9


def test_decontamination_finds_short_items_in_long_documents(spark):
    rng = np.random.default_rng(6)
    text = lambda n: " ".join(f"t{int(x)}" for x in rng.integers(0, 4000, n))
    items = [(i, text(12 + i)) for i in range(30)] + [(90, None), (91, "--"), (92, "tiny item")]
    rows = [(d, text(int(rng.integers(20, 20_000)))) for d in range(60)]
    for i in range(30):
        w = rows[i][1].split()
        at = int(rng.integers(len(w)))
        rows[i] = (i, " ".join(w[:at]) + ".\n" + items[i][1].upper() + "! " + " ".join(w[at:]))
    rows += [(200, None), (201, ""), (202, "Tiny, ITEM"), (202, "Tiny, ITEM")]
    sh = lambda t: {" ".join(w[i : i + 5]) for w in [re.sub(r"[^\w]+|_+", " ", (t or "").lower()).split()] if w for i in range(max(1, len(w) - 4))}
    want = {(d, i, len(sh(x)), len(sh(x) & sh(t))) for d, t in rows for i, x in items if sh(x) and len(sh(x) & sh(t)) >= 0.8 * len(sh(x))}
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(table, bench).select("doc_id", "item_id", "n_item", "n_shared").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) >= 31
    assert {r.doc_id for r in decontaminate.decontaminate(table, bench).collect()} == {d for d, _ in rows} - {w[0] for w in want}


def test_decontamination_recall_of_one_shingle_items(spark):
    rng = np.random.default_rng(7)
    rows = [(d, " ".join(f"t{int(x)}" for x in rng.integers(0, 10**6, 3000))) for d in range(200)]
    items = [(d, " ".join(t.split()[100:105])) for d, t in rows]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got.count() >= 0.9 * 200


# ---- operator 10


def plain_substring_dedup(rows):
    data = [(d, t.encode()) for d, t in rows]
    low = {}
    for d, b in data:
        if d is not None:
            for i in range(len(b) - 49):
                low[b[i : i + 50]] = min(d, low.get(b[i : i + 50], d))
    out = []
    for d, b in data:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - 49):
            x = low.get(b[i : i + 50])
            if x is not None and (d is None or x < d):
                gone[i : i + 50] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


def substring_dedup(table):
    got = suffix_dedup.deduplicate(table)
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got.collect())


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_suffix_dedup(which, request):
    table = request.getfixturevalue(which)
    want = plain_substring_dedup(rows_of(table))
    assert substring_dedup(table) == want and any(k[2] for k in want)


def test_runs_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(13)
    data = rng.integers(97, 100, 3000, dtype=np.uint8)
    data[500:900] = 97  # a repeating text
    ends = np.array([700, 1500, 3000])
    covered = lambda found: {(int(v), int(a) + k) for v, a, n in zip(*found) for k in range(int(n))}
    whole = covered(suffix_dedup.runs(data, ends))
    assert len(whole) == 3000 - 3 * 49
    for block in (1, 7, 64, 1000):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        assert covered(suffix_dedup.runs(data, ends)) == whole


def test_suffix_dedup_edges_of_matches(spark):
    rng = np.random.default_rng(8)
    letter = lambda n, k=3: "".join(rng.choice(list("abcdefghé")[:k], n))
    pool = [letter(n, 9) for n in (48, 49, 50, 51, 52, 80, 81, 200, 700)] + ["ab" * 60, "a" * 130, "é" * 40]
    rows = []
    for d in range(80):
        parts = []
        for _ in range(int(rng.integers(1, 6))):
            x = pool[int(rng.integers(len(pool)))]
            a, b = sorted(int(v) for v in rng.integers(0, len(x) + 1, 2)) if rng.random() < 0.5 else (0, len(x))
            parts += [letter(int(rng.integers(0, 30)), 9), x[a:b]]
        rows.append((int(rng.permutation(80)[0]) if d % 9 == 0 else d, "".join(parts)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert substring_dedup(table) == plain_substring_dedup(rows)


# ---- all


def test_empty_tables_and_queries(spark, tmp_path, awkward):
    empty = awkward.where("doc_id = -1")
    bench = spark.createDataFrame([], "item_id long, text string")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    assert simhash_dedup.components(empty).count() == 0 and simhash_dedup.deduplicate(empty).count() == 0
    assert line_dedup.deduplicate(empty).count() == 0
    assert packing.pack(packing.token_pieces(empty, vocabulary).drop("ids")).count() == 0
    assert token_store.read_tokens(token_store.write_tokens(empty, vocabulary)).count() == 0
    assert quality_rules.judge(empty).count() == 0
    assert decontaminate.leaks(empty, bench).count() == 0 and decontaminate.leaks(awkward, bench).count() == 0
    assert decontaminate.decontaminate(awkward, bench).count() == awkward.count()
    assert suffix_dedup.deduplicate(empty).count() == 0


def test_every_operator_has_a_query():
    assert queries and {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op")} == set(range(1, 11))


# ---- operator 3


def plain_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    order = ("email", "ip", "card", "phone")
    return sorted(out, key=lambda s: (s[1], order.index(s[0])))


def test_pii_base_spans_on_noise_and_documents(docs):
    rng = np.random.default_rng(9)
    texts = [r.text for r in docs.collect()]
    for alphabet in ("@.a-b1 ", "0123456789.", "0123456789 -", "+0123456789 ().-", "a@b.c1+é\n"):
        texts += ["".join(rng.choice(list(alphabet), int(rng.integers(0, 80)))) for _ in range(400)]
    texts += ["00000001.2.3.255 4111 1111 1111 1111 a.b@c.d.e@f.g +1 (017) 555-7713", "x@y", "@a.b", "a@b.c@d.e"]
    for t in texts:
        assert pii_crf.base_spans(t) == plain_base(t), t


def test_pii_model_on_held_out_windows():
    weights, hit, wrong, missed = pii_crf.default_weights(), 0, 0, 0
    for text, spans in pii_crf.generated(300, seed=77):
        got = set(pii_crf.decode(text, weights))
        hit, wrong, missed = hit + len(got & set(spans)), wrong + len(got - set(spans)), missed + len(set(spans) - got)
    assert hit / (hit + wrong) > 0.93 and hit / (hit + missed) > 0.93


def test_pii_decoding_is_the_best_segmentation():
    """Against every segmentation of short windows."""
    weights = pii_crf.default_weights()

    def every(ends, j):
        if j == 0:
            yield 0.0, "out", ()
            return
        for i, kind, names in [(j - 1, "out", []), *ends[j]]:
            own = sum(weights.get(n, 0.0) for n in names)
            for value, last, spans in every(ends, i):
                yield value + own + weights.get(f"{last}>{kind}", 0.0), kind, (*spans, (kind, i, j)) if kind != "out" else spans

    for text in ("ab 10.2.3.4 x", "tel 555-123-4567", "a@b.co, x"):
        cut, ends = pii_crf.segments(text)
        best = max(every(ends, len(cut) - 1))
        assert pii_crf.decode(text, weights) == [(k, cut[i], cut[j]) for k, i, j in best[2]]


def test_pii_query(spark, smoke_dir, docs):
    got = {r.doc_id: r for r in QUERIES["op3_pii_spans"](spark, smoke_dir).collect()}
    for r in docs.collect():
        base = plain_base(r.text or "")
        row, text = got[r.doc_id], ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(k == x for x, *_ in base) for k in ("email", "ip", "card", "phone"))
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(row.spans.split(","))


def test_pii_scan(spark, awkward):
    text = "Write to ann.lee@mail.example.com or call (555) 123-4567; host 10.0.0.7, é card 4111111111111111 4111111111111111."
    rows = [(1, text, "x"), (None, None, "x"), (2, "", None), (1, text, "x"), (3, "1" * 5000 + " " + "9 " * 3000, "x")]
    got = pii_crf.scan(spark.createDataFrame(rows, "doc_id long, text string, base string")).collect()
    assert len(got) == 5
    first = [r for r in got if r.doc_id == 1]
    assert len(first) == 2 and first[0] == first[1]
    assert [(s.kind, text[s.start : s.stop]) for s in first[0].base] == [("email", "ann.lee@mail.example.com"), ("ip", "10.0.0.7")]
    assert ("phone", "(555) 123-4567") in [(s.kind, text[s.start : s.stop]) for s in first[0].added]
    assert sum(s.kind == "card" for s in first[0].added) == 2
    assert pii_crf.scan(awkward).count() == awkward.count()


# ---- operator 6


def test_url_parts_and_rules(spark):
    cases = {
        "https://WWW.Example.com/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.example.com/en/9": ("a.example.com", "/en/9", "example.com/en/", "block"),
        "http://a.example.com/fr/9#t": ("a.example.com", "/fr/9", "com/", "allow"),
        "x://net/es/": ("net", "/es/", "net/es/", "block"),
        "x://b.net/fr/a/b": ("b.net", "/fr/a/b", "net/fr/", "block"),
        "x://b.net/en/a": ("b.net", "/en/a", None, None),
        "http://notcom": ("notcom", "", None, None),
        "http://a.com": ("a.com", "", None, None),
        "http://a.com?q=/": ("a.com", "", None, None),
        "http://É.com/": ("É.com", "/", "com/", "allow"),
        "no scheme": ("", "", None, None),
        "a://b://c.com/d": ("b:", "//c.com/d", None, None),
        "://": ("", "", None, None),
        None: ("", "", None, None),
    }
    rows = [(i, u, "junk") for i, u in enumerate(cases)]
    got = url_model.judge(spark.createDataFrame(rows, "page_id long, url string, verdict string")).collect()
    for r in got:
        host, path, rule, verdict = cases[r.url]
        assert (r.host, r.path, r.rule) == (host, path, rule), r
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert len(got) == len(rows)


def plain_gram_model(labelled, order):
    counts = collections.defaultdict(lambda: collections.defaultdict(int))
    for url, times in labelled:
        text = url_model.START * order + url
        for i in range(order, len(text)):
            for k in range(order + 1):
                counts[text[i - k : i]][text[i]] += times

    def p(context, char):
        low = p(context[1:], char) if context else 1 / url_model.ALPHABET
        seen = counts.get(context)
        return (seen.get(char, 0) + len(seen) * low) / (sum(seen.values()) + len(seen)) if seen else low

    return p


def test_url_scores_against_a_plain_model(spark):
    rng = np.random.default_rng(10)
    make = lambda x: x + "".join(rng.choice(list("abc/"), int(rng.integers(0, 12))))
    rows = [(make("http://good.com/"), int(rng.integers(1, 4)), True) for _ in range(40)] + [(make("http://bad.net/"), 1, False) for _ in range(30)]
    rows = list({r[0]: r for r in rows}.values())
    order = 3
    good = plain_gram_model([(u, n) for u, n, g in rows if g], order)
    bad = plain_gram_model([(u, n) for u, n, g in rows if not g], order)
    tried = [make("http://good.com/"), make("http://bad.org/"), "zzz", ""]
    want = {}
    for u in tried:
        text = url_model.START * order + u
        want[u] = sum(np.log(good(text[i - order : i], text[i])) - np.log(bad(text[i - order : i], text[i])) for i in range(order, len(text))) / max(1, len(u))
    model = url_model.train(spark.createDataFrame(rows, "url string, times long, good boolean"), order)
    got = {r.url: r.score for r in url_model.url_scores(spark.createDataFrame([(u,) for u in set(tried)], "url string"), model, order).collect()}
    assert got.keys() == want.keys() and all(abs(got[u] - want[u]) < 1e-9 for u in want)


def test_url_filter_on_held_out_kinds(spark):
    """URLs that no rule decides follow the kind of path they share with decided ones."""
    rows = []
    for i in range(300):
        rows.append((len(rows), f"http://s{i % 7}.com/news/{i}", None))
        rows.append((len(rows), f"http://s{i % 7}.example.com/en/casino-win/{i}", None))
    odd = [(10_000 + i, f"http://u{i}.org/{'en/casino-win' if i % 2 else 'news'}/{i}", None) for i in range(60)]
    got = {r.page_id: r.verdict for r in url_model.judge(spark.createDataFrame(rows + odd, "page_id long, url string, html string")).collect()}
    right = sum(got[p] == ("block" if "casino" in u else "allow") for p, u, _ in odd)
    assert right >= 55
    only = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://b.org/x"), (2, "http://b.org/x"), (None, None)], "page_id long, url string")
    assert sorted(r.verdict for r in url_model.judge(only).collect()) == ["allow"] * 4
    assert url_model.judge(only.where("page_id = 9")).count() == 0


# ---- operator 7


def test_secret_findings_and_places(spark):
    text = 'é api_key = "A9f8Q7z6X5c4V3b2N1m0" and /usr/local/share/dictionaries plus supercalifragilistic word'
    rows = [(1, text, "s"), (2, None, None), (3, "", "s"), (4, "short", "s"), (5, "x" * 100_000, "s")]
    got = secret_forest.findings(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = [(1, m.start(), m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9_+/\-]{16,}={0,2}", text)] + [(5, 0, 100_000, "x" * 100_000)]
    assert sorted((r.doc_id, r.start, r.stop, r.run) for r in got) == sorted(want)
    first = next(r for r in got if r.run.startswith("A9"))
    assert first.before.endswith('api_key = "') and first.after == '"'


def test_secret_forest_on_held_out_findings(spark):
    rng = np.random.default_rng(12)
    token = lambda n=40: "".join(rng.choice(list("0123456789abcdef"), n))
    word = lambda n: "".join(rng.choice(list("etaoinshr"), n))
    rows, hidden = [], {}
    for d in range(400):
        kind = d % 4
        prose = " ".join(word(int(k)) for k in rng.integers(3, 9, 12))
        if kind == 0:
            rows.append((d, f'{prose} token = "{token()}" {prose}', "a"))
        elif kind == 1:
            rows.append((d, f"{prose} {word(20)} {prose}", "a"))
        elif kind == 2:
            rows.append((d, f"{prose} /{word(6)}/{word(7)}/{word(9)} {prose}", "a"))
        elif d % 8 == 3:
            hidden[d] = token()  # an unassigned secret
            rows.append((d, f"{prose} see: `{hidden[d]}` {prose}", "a"))
        else:
            rows.append((d, prose, "a"))
    got = secret_forest.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = collections.defaultdict(set)
    for r in got:
        by[r.doc_id % 4].add(r.doc_id)
    assert len(by[0]) == 100 and len(by[1]) + len(by[2]) <= 10 and len(by[3]) >= 0.8 * len(hidden)
    assert secret_forest.scan(spark.createDataFrame(rows[:0], "doc_id long, text string, source string")).count() == 0


def test_secret_key_names_longer_than_a_run(spark):
    secret = "wJalrXUtnFEMI/K7MDENG+bPxRfiCY3Q9z"
    texts = [
        f"AWS_SECRET_ACCESS_KEY={secret}",
        f'AWS_SECRET_ACCESS_KEY="{secret}"',
        f'the_main_database_password = "{secret}"',
        f"some_service_account_token: {secret}",
        f"plain words and {secret}== then words",
    ]
    table = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {(r.doc_id, r.run): r for r in secret_forest.findings(table).collect()}
    names = [(0, "AWS_SECRET_ACCESS_KEY"), (1, "AWS_SECRET_ACCESS_KEY"), (2, "the_main_database_password"), (3, "some_service_account_token")]
    assert set(got) == {*names, *((i, secret) for i in range(4)), (4, secret + "==")}
    assert all(r.stop - r.start == len(r.run) and texts[r.doc_id][r.start : r.stop] == r.run for r in got.values())
    words = spark.createDataFrame([], "word string, n long")
    rows = secret_forest.featured(secret_forest.findings(table), words).withColumn("label", secret_forest.surroundings()).collect()
    assert {(r.doc_id, r.run): r.label for r in rows} == {k: float(k[0] < 4 and k[1] == secret) for k in got}
    found = secret_forest.scan(table.where("doc_id < 4").limit(1)).collect()
    assert [(r.doc_id, r.run) for r in found if r.run == secret]


def test_short_and_symbol_secrets_are_candidates(spark):
    cases = [
        ('é password = "hunter2Xy9kQ" end', "hunter2Xy9kQ"),
        ('pwd: "Tr0ub4dor&3-horse!x"', "Tr0ub4dor&3-horse!x"),
        ("passwd=p@ss.w0rd!, next", "p@ss.w0rd!"),
        ("{'api_key': 'a:b$c&d9'}", "a:b$c&d9"),
        ("auth token => q9!w8@e7#\nmore", "q9!w8@e7#"),
        ("cfg['password'] = `x7%kk(9)z`", "x7%kk(9)z"),
        ("password = short", None),
        ("my password has grown", None),
    ]
    table = spark.createDataFrame([(i, t, "s") for i, (t, _) in enumerate(cases)], "doc_id long, text string, source string")
    found = secret_forest.findings(table)
    want = [(i, t.index(x), t.index(x) + len(x), x) for i, (t, x) in enumerate(cases) if x]
    assert sorted((r.doc_id, r.start, r.stop, r.run) for r in found.collect()) == want
    rows = secret_forest.featured(found, spark.createDataFrame([], "word string, n long")).withColumn("label", secret_forest.surroundings())
    assert {r.label for r in rows.collect()} == {1.0}
    once = spark.createDataFrame([(1, 'token = "A9f8Q7z6X5c4V3b2N1m0"', "s")] * 2 + [(2, "token" * 20_000, "s"), (3, "password" + " " * 50_000, "s")], "doc_id long, text string, source string")
    assert sorted(r.doc_id for r in secret_forest.findings(once).collect()) == [1, 1, 2]


def test_secret_scan_awkward_rows(awkward):
    assert secret_forest.scan(awkward).columns == ["doc_id", "start", "stop", "run", "score"]
    texts = {r.doc_id: r.text for r in awkward.collect()}
    found = secret_forest.findings(awkward).collect()
    assert found and all(texts[r.doc_id][r.start : r.stop] == r.run for r in found)
    kept = [(r.doc_id, r.start, r.stop, r.run) for r in secret_forest.scan(awkward).collect()]
    assert set(kept) <= {(r.doc_id, r.start, r.stop, r.run) for r in found}
    assert not {d for d, *_ in kept} & {3, 4, 5, 6}
