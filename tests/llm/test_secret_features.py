"""The secret scan's places, features and forest against plain versions."""

import math
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from relprep.llm import secret_forest as S

DOCS = "doc_id long, text string, source string"


def test_places_of_very_many_runs_are_linear(spark):
    """40,000 runs in one text: every place is right, and in seconds."""
    runs = [f"tok{i:05d}abcdefgh{i % 7}" for i in range(40_000)]
    text = " ".join(runs)
    spark.createDataFrame([(0, "x", "s")], DOCS).count()
    t = time.time()
    got = S.findings(spark.createDataFrame([(1, text, "s")], DOCS)).select("start", "stop", "run").collect()
    assert time.time() - t < 30
    assert len(got) == 40_000 and all(text[r.start : r.stop] == r.run for r in got)
    ends = np.cumsum([len(r) + 1 for r in runs])
    assert sorted(r.stop for r in got) == (ends - 1).tolist()


def plain_features(run, before, after, source, words):
    n = len(run)
    share = lambda p: len(re.findall(p, run)) / n
    kind = lambda c: "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "."
    letters, low = set(), run.lower()
    for i in range(n):
        for k in range(4, 13):
            if low[i : i + k] in words and len(low[i : i + k]) == k:
                letters |= set(range(i, i + k))
    last = re.search(r"([a-z]+)[^a-z]*$", before.lower())
    return {
        "length": n, "digits": share("[0-9]"), "capitals": share("[A-Z]"), "vowels": share("[AEIOUaeiou]"), "symbols": share("[^A-Za-z0-9]"),
        "distinct": len(set(run)) / n, "changes": sum(kind(a) != kind(b) for a, b in zip(run, run[1:])) / n,
        "hexadecimal": bool(re.fullmatch("[0-9a-f]+|[0-9A-F]+", run)), "path": bool(re.search(r"^/|[A-Za-z0-9]/[A-Za-z0-9_-]+/", run)),
        "covered": len(letters) / n, "test_source": bool(re.search("(?i)test|example|sample|mock", source or "")),
        "key_before": bool(re.search(S.KEY + r"[A-Za-z0-9_]*[\"'\]]{0,2}\s*(=>|:=|=|:|is)?\s*[\"'`]?$", before)),
        "assigned": bool(re.search(r"(=>|=|:)\s*[\"'`]?$", before)), "quoted": bool(re.search(r"[\"'`]$", before)) and after in ('"', "'", "`"),
        "word_common": math.log1p(words.get(last.group(1), 0) if last else 0),
    }


def test_features_against_a_plain_version(spark):
    rows = [
        (1, 'the correcthorsebatterystaple and api_key = "A1b2C3d4E5f6G7h8" end', "src/test"),
        (2, "see /usr/share/dictionary/words.txt or deadbeefdeadbeef0123, deadbeefdeadbeef0123", "web"),
        (3, "password: hunter2Xy9kQ!", None),
        (4, "xxstaplexxbatteryzz12 horse horse", "example"),
        (5, None, None), (6, "", "s"),
    ]
    table = spark.createDataFrame([r for r in rows], DOCS)
    words = {"correct": 9, "horse": 5, "battery": 4, "staple": 3, "share": 7, "dictionary": 3, "words": 8, "tery": 3}
    found = S.findings(table)
    got = S.featured(found, spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    at = {(r.doc_id, r.start): r for r in found.collect()}
    assert len(got) == len(at) >= 6 and not {r.doc_id for r in got} & {5, 6}
    for r in got:
        f = at[r.doc_id, r.start]
        want = plain_features(r.run, f.before, f.after, f.source, words)
        assert {k: pytest.approx(float(v)) for k, v in want.items()} == {k: r[k] for k in S.FEATURES}, r.run
    whole = {r.run: r.covered for r in got}
    assert whole["correcthorsebatterystaple"] == 1.0


def corpus(seed, n):
    """Findings whose labels the neighbourhood does not tell: nothing is assigned, names and secrets stand in plain text."""
    rng = np.random.default_rng(seed)
    words = ["account", "builder", "context", "default", "element", "factory", "gateway", "handler", "service", "manager"]
    token = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 28))
    name = lambda: "".join(w.title() for w in rng.choice(words, int(rng.integers(3, 5))))
    rows, labels = [], []
    for d in range(n):
        text = " ".join(rng.choice(words, 5))
        for kind in rng.integers(0, 2, 2):
            run = token() if kind else name()
            labels.append((seed * 10_000 + d, len(text) + 1, len(text) + 1 + len(run), int(kind)))
            text += " " + run + " " + " ".join(rng.choice(words, 4))
        rows.append((seed * 10_000 + d, text, "web"))
    return rows, labels


def test_forest_learns_labels_that_the_rule_does_not_give(spark):
    """Precision and recall on held-out findings; the surroundings' rule would call all of them plain."""
    train, labels = corpus(1, 150)
    held, truth = corpus(2, 100)
    table = spark.createDataFrame(train + held, DOCS)
    labelled = spark.createDataFrame(labels, "doc_id long, start int, stop int, label int")
    got = {(r.doc_id, r.start, r.stop) for r in S.scan(table, labelled).collect() if r.doc_id >= 20_000}
    secret = {x[:3] for x in truth if x[3]}
    assert len(got & secret) / len(got) >= 0.95 and len(got & secret) / len(secret) >= 0.95


def test_labelled_features_of_other_texts(spark):
    train, labels = corpus(3, 100)
    held, truth = corpus(4, 40)
    table = spark.createDataFrame(train, DOCS)
    rows = S.featured(S.findings(table), S.dictionary(table)).join(spark.createDataFrame([(*x[:3], float(x[3])) for x in labels], "doc_id long, start int, stop int, label double"), ["doc_id", "start", "stop"])
    got = {(r.doc_id, r.start) for r in S.scan(spark.createDataFrame(held, DOCS), rows).collect()}
    secret = {x[:2] for x in truth if x[3]}
    assert len(got & secret) / max(1, len(got | secret)) >= 0.9
    with pytest.raises(ValueError):
        S.scan(table, rows.drop("run"))
    assert S.scan(table.where(F.lit(False)), rows).count() == 0
