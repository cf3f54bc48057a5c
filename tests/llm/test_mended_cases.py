"""Cases that once lost results: carriers that fail, short and unnamed items, columns with clashing names."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from relprep.llm import decontaminate, line_dedup, packing, pii_crf, quality_rules, simhash_dedup, suffix_dedup
from relprep.session import scratch_in

NAMES = ["_id", "_hash", "_th", "_of", "_lines", "_before", "_at", "_n", "hash", "doc", "own", "lines", "gone", "of", "norm", "text_hash", "node", "root", "fp", "host", "item", "kept", "HASH"]


def words(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


@pytest.fixture(scope="module")
def clashing(spark):
    same = words("a", 60) + "\n" + words("b", 60)
    rows = [(1, same, "s"), (2, same, "s"), (3, words("c", 70) + "\n" + words("d", 9), "s"), (None, None, None), (4, words("e", 80), "t")]
    names = NAMES[:-1]
    table = spark.createDataFrame([(*r, *[f"{r[0]}-{n}" for n in names]) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    return table


def same_columns(got, table):
    """Every caller's column came back with the row's own value."""
    for r in got.collect():
        assert all(r[n] == f"{r.doc_id}-{n}" for n in table.columns[3:])
    return sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect())


def test_clashing_columns_come_back_unchanged(spark, clashing):
    for n in NAMES[:-1]:  # each alone, and all of them together
        assert n in clashing.columns
    bench = spark.createDataFrame([(1, words("c", 30))], "item_id long, text string")
    kept = simhash_dedup.deduplicate(clashing)
    assert kept.columns == clashing.columns and [k for _, k in same_columns(kept, clashing)] == [1, 3, 4, 0]
    kept = line_dedup.deduplicate(clashing)
    assert kept.columns == [*clashing.columns, "_removed"] and len(same_columns(kept, clashing)) == 5
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns and same_columns(kept, clashing) == [(False, 1), (False, 2), (False, 3), (False, 4)]
    assert same_columns(quality_rules.strip_common(clashing, max_docs=1), clashing) == [(False, 1), (False, 3), (False, 4)]
    kept = decontaminate.decontaminate(clashing, bench)
    assert kept.columns == clashing.columns and same_columns(kept, clashing) == [(False, 1), (False, 2), (False, 4), (True, 0)]
    packed = packing.pack(clashing.select("doc_id", *clashing.columns[3:]).withColumn("length", F.lit(100).cast("long")), 2048)
    assert {r.sequence_id for r in packed.collect()} == {0} and sorted(r.offset for r in packed.collect()) == [0, 100, 200, 300, 400]


# ---- operator 8


def test_the_carrier_is_one_that_passes(spark):
    """31 carriers of a passage; the first holds it twice and fails, so the second carries it."""
    passage = "\n".join(words(f"p{k}x", 20) for k in range(3))
    rows = [(0, passage + "\n" + passage, "s")] + [(d, passage, "s") for d in range(1, 31)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.base_failed, r.n_removed_words, r.kept) for r in quality_rules.judge(table).collect()}
    assert got[0] == (True, 120, False) and got[1] == (False, 0, True)
    assert all(got[d] == (False, 60, False) for d in range(2, 31))
    assert [(r.doc_id, r.text) for r in quality_rules.keep_good(table).collect()] == [(1, passage)]


def test_without_a_passing_carrier_all_lose_the_line(spark):
    line = words("short", 30)
    table = spark.createDataFrame([(d, line, "s") for d in range(25)], "doc_id long, text string, source string")
    assert {(r.n_removed_words, r.kept) for r in quality_rules.judge(table).collect()} == {(30, False)}


def test_documents_with_own_text_keep_it_without_the_common_lines(spark):
    head = "All  Rights Reserved by the owners of this site"
    rows = [(d, f"{head}\n{words(f'd{d}x', 60)}\n  {head.lower()} ", "s") for d in range(30)] + [(99, head + "\n" + words("y", 60), "other")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in quality_rules.strip_common(table).collect()}
    assert got == {0: rows[0][1], 99: rows[-1][1]} | {d: words(f"d{d}x", 60) for d in range(1, 30)}


# ---- operator 9


def found(spark, docs, items, **kw):
    table = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, item int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in decontaminate.leaks(table, bench, **kw).collect())


def test_items_of_few_words_inside_longer_texts(spark):
    long = words("w", 3000)
    docs = [(d, f"{words(f'x{d}y', 500)} Four little Words, here {long}") for d in range(20)] + [(50, "four little words"), (51, "a yes b"), (52, "Yes!"), (53, None)]
    assert found(spark, docs, [(7, "four little words here")]) == [(d, 7, 1, 1) for d in range(20)]
    assert found(spark, docs, [(8, "little words here")]) == [(d, 8, 1, 1) for d in range(20)]
    assert found(spark, docs, [(9, "yes"), (10, "...")]) == [(52, 9, 1, 1)]


def test_items_of_one_to_four_shingles_are_never_missed(spark):
    docs = [(d, words(f"d{d}t", 1500)) for d in range(100)]
    items = [(d, " ".join(t.split()[700 : 705 + d % 4])) for d, t in docs]
    assert found(spark, docs, items) == [(d, d, 1 + d % 4, 1 + d % 4) for d in range(100)]


def test_items_without_a_name_and_equal_items(spark):
    docs = [(1, f"{words('a', 40)} {words('q', 15)}"), (2, words("r", 15))]
    bench = spark.createDataFrame([(None, words("q", 15)), (None, words("r", 15)), (5, words("r", 15)), (6, words("r", 15))], "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(map(str, decontaminate.leaks(table, bench).select("doc_id", "item_id", "n_item", "n_shared").collect()))
    assert got == sorted(f"Row(doc_id={d}, item_id={i}, n_item=11, n_shared=11)" for d, i in [(1, None), (2, None), (2, 5), (2, 6)])
    assert decontaminate.decontaminate(table, bench).collect() == []
    assert found(spark, docs, []) == []


def test_items_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    docs = [(d, words(f"d{d}t", 200)) for d in range(10)]
    items = [(d, " ".join(t.split()[50:80])) for d, t in docs[:5]] + [(77, "d7t9 d7t10 d7t11")]
    assert found(spark, docs, items) == [(d, d, 26, 26) for d in range(5)] + [(7, 77, 1, 1)]


# ---- operator 3


def test_windows_end_with_their_tokens():
    name, host = "anna" * 30, "mail" * 30
    text = f"please write to {name} at {host} dot org today, or {'q' * 300}@x then {'7' * 5}{'w' * 200} end"
    found = pii_crf.windows(text)
    assert found and all(a == 0 or text[a - 1].isspace() or text[a].isspace() for a, _ in found)
    assert all(b == len(text) or text[b].isspace() or text[b - 1].isspace() for _, b in found)
    at = text.index(name)
    assert any(a <= at and b >= text.index(" today") for a, b in found)
    many = "".join(f"a{i}" for i in range(60_000))  # one token of very many triggers
    assert pii_crf.windows(f"x {many} y")[-1][1] >= len(many)


def test_added_spans_start_with_their_words(spark):
    rows = [(k, f"you can write to {'anna' * k}.smith at example dot com about it") for k in range(1, 30)]
    for r in pii_crf.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        for s in r.added:
            assert rows[r.doc_id - 1][1][s.start - 1].isspace(), (r.doc_id, s)


def test_personal_data_of_no_rows(spark):
    assert pii_crf.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_suffix_dedup_leaves_no_tables_between_steps(spark, tmp_path):
    passage = " ".join(f"word{i}" for i in range(40))
    rows = [(d, f"text {d} begins, {passage}, and ends with {d * 7}") for d in range(6)]
    with scratch_in(str(tmp_path)):
        got = suffix_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_spans) for r in got) == [(d, int(d > 0)) for d in range(6)]
    assert {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()} == {"removals", "verdicts"}


def test_line_dedup_compares_what_lies_between_common_ends(spark):
    long = " ".join(f"wört{i}" for i in range(800))
    texts = [
        ("", "a"), ("same", "same"), ("aaaa", "aa"), ("abab", "ab"), ("𝒳y", "𝒳"), ("one two three", "one 2 three"), ("漢字 x 漢字", "漢字 漢字"),
        ("the cat sat on the mat", "the dog sat on a mat"), ("a b c d e", "a c d e"), (words("x", 30), words("y", 30)), (long, long.replace("wört700", "other")), (long, f"x {long} y"),
    ]
    pairs = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(len(texts))], "a long, b long")
    lines = spark.createDataFrame([(2 * k + j, t) for k, both in enumerate(texts) for j, t in enumerate(both)], "line long, norm string")
    both = spark.createDataFrame([(2 * k, x, y) for k, (x, y) in enumerate(texts)], "k long, x string, y string")
    found = both.select("k", "x", "y", line_dedup._middles(F.col("x"), F.col("y")).alias("m")).select("k", "m", F.levenshtein("x", "y").alias("whole"), F.levenshtein("m.a", "m.b").alias("middle"), F.greatest(F.length("x"), F.length("y")).alias("size")).collect()
    assert all(r.whole == r.middle for r in found)
    assert {r.k: tuple(r.m) for r in found}[20] == ("wört700"[::-1], "other"[::-1])
    for similarity in (0.5, 0.8):
        want = {r.k for r in found if r.whole <= int((1 - similarity) * r["size"] + 1e-9)}
        assert {r.a for r in line_dedup._verified(pairs, lines, similarity).collect()} == want


def test_line_dedup_does_not_compare_all_pairs_of_a_group(spark, monkeypatch):
    """Near copies are linked by about as many comparisons as there are lines, not by all their pairs."""
    base = words("w", 200).split(" ")
    rows = [(d, " ".join(base[:k] + [f"new{d}"] + base[k + 1 :])) for d, k in enumerate(range(0, 200, 4))] + [(90, words("x", 200))]
    tried, verified = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *more: tried.append(pairs.distinct().count()) or verified(pairs, *more))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    fps = {r.doc_id: r.fp for r in line_dedup.line_table(table).collect()}
    near = [(a, b) for a in fps for b in fps if a < b < 90 and (fps[a] ^ fps[b]).bit_count() <= 2]
    root = {d: d for d in fps}
    for _ in fps:
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    assert len(near) > 150
    got = {r.doc_id for r in line_dedup.decisions(table).collect()}
    assert got == {d for d in fps if root[d] != d}
    assert sum(tried) < len(near) / 2


@pytest.mark.parametrize("sizes", [range(1, 70), [92, 93, 94, 255, 256], [15_996, 15_997, 16_000, 16_001]])
def test_line_simhash_counts_groups_of_words(spark, sizes):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["the", "of", "añb", "漢字", "q7", "z"], n).tolist()) for n in sizes]
    rows = line_dedup.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {(r.doc_id, r.wide): r.fp for r in rows}
    for d, t in enumerate(texts):
        w = t.split(" ")
        both = [[" ".join(w[i : i + 2]) for i in range(len(w))], w] if len(w) > line_dedup.LONG else [w]
        for wide, features in enumerate(both):
            h = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in features], dtype="uint64")
            assert got[d, wide] == sum(1 << b for b in range(60) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h)), (len(w), wide)
    assert len(got) == sum(1 + (len(t.split(" ")) > line_dedup.LONG) for t in texts)


def test_line_dedup_tells_far_lines_without_their_frequent_letters(spark):
    rng = np.random.default_rng(6)
    vocabulary = ["the", "eat", "toe", "in", "krzm", "bglp", "漢字", "añb", "q7"]
    draw = lambda n, p: [vocabulary[i] for i in rng.choice(len(vocabulary), n, p=p)]
    texts = []
    for n in (3, 20, 60, 150):
        for p in (np.array([6, 5, 4, 5, 0.1, 0.1, 0.1, 0.1, 0.1]), np.ones(9)):
            a = draw(n, p / p.sum())
            texts += [(a, draw(n, p / p.sum())), (a, rng.permutation(a).tolist()), (a, [*draw(n // 8 + 1, p / p.sum()), *a]), (a, [x for x in a if rng.random() < 0.8])]
            texts += [(a, [x if rng.random() < q else vocabulary[rng.integers(9)] for x in a]) for q in (0.95, 0.8, 0.7, 0.6)]
    texts = [(" ".join(a), " ".join(b)) for a, b in texts]
    pairs = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(len(texts))], "a long, b long")
    lines = spark.createDataFrame([(2 * k + j, t) for k, both in enumerate(texts) for j, t in enumerate(both)], "line long, norm string")
    found = spark.createDataFrame([(2 * k, x, y) for k, (x, y) in enumerate(texts)], "k long, x string, y string").select("k", F.levenshtein("x", "y").alias("d"), F.greatest(F.length("x"), F.length("y")).alias("size")).collect()
    for similarity in (0.4, 0.6, 0.8):
        want = {r.k for r in found if r.d <= int((1 - similarity) * r["size"] + 1e-9)}
        assert 5 < len(want) < len(texts) - 5
        assert {r.a for r in line_dedup._verified(pairs, lines, similarity).collect()} == want
