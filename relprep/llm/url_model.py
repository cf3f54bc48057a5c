"""URL filter by the ratio of two character language models (operator 6).

Rules decide first: a rule is a host and a path start, it fits its host and all
subdomains, and the longest that fits wins.  For URLs that no rule fits, the
verdict is the method's: variable-order Markov models of the characters of
accepted and of rejected URLs (those that a rule allows or blocks), smoothed
by Witten-Bell interpolation over all shorter contexts down to a uniform
base; the mean log-likelihood difference per character is compared with a
threshold.  The threshold is calibrated on a fifth of the labelled URLs (by
hash), which the models then do not count: the one with the best balanced
accuracy, from a histogram of ``BINS`` scores.

Scale: everything is counted over all rows with pre-aggregated groupings, and
the models stay distributed tables that grow with the input; nothing of them
is broadcast or collected (the histogram has a fixed number of rows).  Equal
URLs are counted and scored once with their number.  Each distinct n-gram of
the URLs to judge is scored once, and its score joined back by a salted key,
as some n-grams (a scheme's letters) are in every URL.

Defined results: a null URL, or one without ``://``, has an empty host and
path, no rule and is scored by its text (null: as an empty text, which scores
the threshold's neutral 0); without accepted or without rejected URLs every
unruled URL is allowed; equal rows get equal verdicts; no rows give no rows;
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relprep.llm.common import written

#: (host, path, verdict), as the contract states them.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
ORDER = 5
ALPHABET = 1 << 16
BINS = 400
RANGE = 4.0
#: Occurrences of an n-gram that one salt takes.
SALT_ROWS = 20_000
START = "\x02"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    there = F.coalesce(at > 0, F.lit(False))
    return F.when(there, lower).otherwise(""), F.when(there, path).otherwise("")


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(the longest rule that fits, its verdict); null without one."""
    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in longest]
    pick = lambda values: F.coalesce(*[F.when(f, F.lit(v)) for f, v in zip(fits, values)])
    return pick([h + p for h, p, _ in longest]), pick([v for *_, v in longest])


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """A row for each character of each URL: the ``order`` characters before it and itself."""
    padded = F.concat(F.lit(START * order), F.coalesce("url", F.lit("")))
    at = F.when(F.length(F.coalesce("url", F.lit(""))) > 0, F.sequence(F.lit(1), F.length("url"))).otherwise(F.array().cast("array<int>"))
    step = urls.withColumn("_padded", padded).withColumn("_i", F.explode(at))
    return step.withColumn("gram", F.substr("_padded", F.col("_i"), F.lit(order + 1))).drop("_padded", "_i")


def train(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """(context, char, accepted, rejected): counts over ``labelled`` (url, times, good) for every context length."""
    full = _grams(labelled, order).groupBy("gram").agg(F.sum(F.when(F.col("good"), F.col("times")).otherwise(0)).alias("accepted"), F.sum(F.when(F.col("good"), 0).otherwise(F.col("times"))).alias("rejected"))
    each = full.select(F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k"), "gram", "accepted", "rejected")
    context = F.substr("gram", F.lit(order + 1) - F.col("k"), F.col("k"))
    return each.groupBy(context.alias("context"), F.substr("gram", F.lit(order + 1), F.lit(1)).alias("char")).agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


def gram_scores(grams: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, score): log-likelihood under the accepted less that under the rejected model."""
    kinds = ("accepted", "rejected")
    totals = model.groupBy("context").agg(*[f(F.col(k)).alias(f"{k}_{n}") for k in kinds for n, f in (("n", F.sum), ("types", lambda c: F.sum((c > 0).cast("long"))))])
    each = grams.select("gram", F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k"))
    each = each.select("gram", "k", F.substr("gram", F.lit(order + 1) - F.col("k"), F.col("k")).alias("context"), F.substr("gram", F.lit(order + 1), F.lit(1)).alias("char"))
    # Every gram has the empty context, whose totals are scalars; there it is dealt out by itself, which is no context's length.
    names = [f"{k}_{n}" for k in kinds for n in ("n", "types")]
    rest = totals.where("context <> ''").withColumnRenamed("context", "_context")
    key = F.when(F.col("k") == 0, F.col("gram")).otherwise(F.col("context"))
    met = each.join(model, ["context", "char"], "left").withColumn("_key", key).join(rest, F.col("_key") == F.col("_context"), "left")
    empty = totals.where("context = ''")
    met = met.select("gram", "k", *kinds, *[F.when(F.col("k") == 0, empty.select(c).scalar()).otherwise(F.col(c)).alias(c) for c in names])
    cells = F.sort_array(F.collect_list(F.struct("k", *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for k in kinds for c in (k, f"{k}_n", f"{k}_types")])))  # order + 1 of them

    def fold(kind: str) -> Column:
        return F.aggregate(
            "cells",
            F.lit(1.0 / ALPHABET),
            lambda p, c: F.when(c[f"{kind}_n"] > 0, (c[kind] + c[f"{kind}_types"] * p) / (c[f"{kind}_n"] + c[f"{kind}_types"])).otherwise(p),
        )

    return met.groupBy("gram").agg(cells.alias("cells")).select("gram", (F.log(fold("accepted")) - F.log(fold("rejected"))).alias("score"))


def url_scores(urls: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """(url, score) for distinct ``urls``: the mean of the scores of their characters, 0 for an empty one."""
    grams = _grams(urls.select("url"), order).groupBy("url", "gram").agg(F.count(F.lit(1)).alias("n"))
    grams = written(grams, "url-grams")
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("rows"))
    scored = gram_scores(often.select("gram"), model, order).join(often, "gram")
    salts = F.ceil(F.col("rows") / SALT_ROWS).cast("int")
    scored = scored.select("gram", "score", salts.alias("salts"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    scored = written(scored, "gram-scores")
    many = scored.where("salts > 1 AND salt = 0").select(F.col("gram").alias("_gram"), F.col("salts").alias("_salts"))
    salted = grams.join(many, F.col("gram") == F.col("_gram"), "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("url"), F.col("_salts")).cast("int"), F.lit(0)))
    summed = salted.join(scored.select("gram", "salt", "score"), ["gram", "salt"]).groupBy("url").agg((F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("score"))
    return urls.select("url").join(summed.withColumnRenamed("url", "_url"), F.col("url").eqNullSafe(F.col("_url")), "left").select("url", F.coalesce("score", F.lit(0.0)).alias("score"))


def calibrated(held_out: DataFrame) -> float:
    """The threshold with the best balanced accuracy on (score, good, times)."""
    cell = F.floor(F.greatest(F.lit(-RANGE), F.least(F.lit(RANGE), F.col("score"))) / (2 * RANGE) * BINS).cast("int")
    rows = held_out.groupBy(cell.alias("cell"), "good").agg(F.sum("times").alias("n")).collect()  # at most 2 * (BINS + 1)
    totals = {g: sum(r.n for r in rows if r.good is g) for g in (True, False)}
    if not all(totals.values()):
        return 0.0
    best, at = -1.0, 0.0
    for c in range(-BINS // 2, BINS // 2 + 1):
        right = sum(r.n for r in rows if r.good and r.cell >= c) / totals[True] + sum(r.n for r in rows if not r.good and r.cell < c) / totals[False]
        mark = c * 2 * RANGE / BINS
        if right > best + 1e-12 or (math.isclose(right, best) and abs(mark) < abs(at)):
            best, at = right, mark
    return at


def judge(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """(page_id, url, host, path, rule, score, verdict) for every row; ``score`` is null where a rule decides."""
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", verdict)
    urls = written(rows.groupBy("url").agg(F.first("ruled").alias("ruled"), F.count(F.lit(1)).alias("times")), "urls")
    labelled = urls.where("ruled IS NOT NULL").select("url", "times", (F.col("ruled") == "allow").alias("good"))
    fold = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    model = written(train(labelled.where(~fold), order), "url-model")
    both = model.agg(F.max("accepted"), F.max("rejected")).first()
    unruled = urls.where("ruled IS NULL").select("url")
    if not all(both):
        scores, threshold = unruled.select("url", F.lit(0.0).alias("score")), 0.0
    else:
        scores = written(url_scores(unruled.union(labelled.where(fold).select("url")), model, order), "url-scores")
        tried = labelled.where(fold).withColumnRenamed("url", "_url")
        threshold = calibrated(scores.join(tried, F.col("url") == F.col("_url")))
    out = rows.join(scores.withColumnRenamed("url", "_url"), F.col("url").eqNullSafe(F.col("_url")), "left")
    found = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return out.select("page_id", "url", "host", "path", "rule", F.when(F.col("ruled").isNull(), F.col("score")).alias("score"), F.coalesce("ruled", found).alias("verdict"))

