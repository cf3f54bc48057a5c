"""Secret scan with a random forest against false positives (operator 7), JVM functions only.

Findings are runs of at least 16 token characters, and values of at least 8
characters of any kind but white space that are assigned to a secret's name.  Features: the length;
shares of digits, capitals, vowels, symbols and distinct characters; changes
between character classes; whether the run is hexadecimal or looks like a
path; the share of it that words of the corpus cover, joined words
included; and the neighbourhood
(an assignment, a quote, a key word such as "token" before it, and how common
the word before it is).

Labels: ``labelled`` may bring the places of findings with a 0/1 ``label``; labelled
findings of other texts come with their features.  Without it they
are labelled by their surroundings: a finding that is assigned to a secret's
name and has digits, or that has an issuer's format, is a secret, another that
follows plain words with no assignment is not; the rest get no label.  As that uses the neighbourhood,
each training row is also given with its neighbourhood blanked, so the forest
has to judge by the run itself as well.  The fit takes at most
``MAX_TRAINING`` rows of each label, the first by a hash; that bound is the
classifier's alone.  Dictionary counts and the scan cover all rows.

Scale: a scan of the text for findings, one word count with map-side
aggregation, and joins of narrow rows.  Words are counted by occurrence, so
a hot word or source is summed before it moves.

Defined results: null and empty texts have no findings; equal rows (same
doc_id and text) are scanned each; a null source is plain; without labels of
both kinds the surroundings' rule decides alone; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relprep.llm.common import written

MIN_LENGTH = 16
MAX_TRAINING = 10_000
TREES, DEPTH, SEED = 20, 6, 7
#: A dictionary word occurs this often at least.
MIN_COUNT = 3
#: Letters of a dictionary word.
WORD_LETTERS = (4, 12)
#: Pieces of a text whose lengths are summed at a time.
CHUNK = 256
#: Characters of the neighbourhood before a finding.
NEAR = 80
_PIECES = NEAR // 8  # a finding has eight characters at least
_CLASS = "A-Za-z0-9_+/\\-"
#: A gap and the run after it; gaps and runs together give every run's place. The text's end
#: closes the last gap, else a search would start again at each of its characters.
#: An '=' that a value follows is an assignment, not a run's padding.
_RUN = f"(?<![{_CLASS}])[{_CLASS}]{{{MIN_LENGTH},}}+(?:={{1,2}}(?!=*[\"'`]?[{_CLASS}!@#$%^&*~]))?"
#: What secrets are assigned to (fixed values).
KEY = "(?i)(token|secret|password|passwd|pwd|api_?key|access_?key|private_?key|auth|credential)"
#: The shortest assigned value; a name's further characters and the space around the sign are bounded.
MIN_VALUE = 8
_SIGN = KEY + "[A-Za-z0-9_]{0,64}[\"'\\]]{0,2}\\s{0,16}(?:=>|:=|=|:|(?<=\\s)is\\s)\\s{0,16}"
#: A quoted value up to its quote, or one up to white space, without the punctuation that closes it.
_QUOTED = [f"(?<={q})[^{q}\\s]{{{MIN_VALUE},}}" for q in "\"'`"]
_PLAIN = f"(?<![\"'`])[^\\s\"'`]{{{MIN_VALUE},}}(?<![,;.)\\]}}>])"
_ASSIGNED = _SIGN + "[\"'`]?(?:" + "|".join([*[f"{v}(?={q})" for v, q in zip(_QUOTED, "\"'`")], _PLAIN]) + ")"
#: The same at the end of a piece, where the closing quote is cut off.
_LAST = _SIGN + "[\"'`]?(" + "|".join([*_QUOTED, _PLAIN]) + ")"
#: Formats that name their issuer (fixed values).
ISSUED = "^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_(live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})$"
NEIGHBOURS = ["key_before", "assigned", "quoted", "word_common"]
FEATURES = ["length", "digits", "capitals", "vowels", "symbols", "distinct", "changes", "hexadecimal", "path", "covered", "test_source", *NEIGHBOURS]


def _placed(rows: DataFrame, name: str, wanted: Column, found: str, tail: str, group: int) -> DataFrame:
    """``rows`` with the array ``name`` of (start, stop, run) that ``found`` matches in texts that are ``wanted``.

    ``tail`` cuts the run from a gap and its match.  Places are running sums of
    the pieces' lengths, taken in chunks and over the chunks' totals, so that a
    text of very many runs costs little more than its length.
    """
    pieces = F.regexp_extract_all("text", F.lit(f"(?s)(.*?)({found}|\\z)"), F.lit(0))
    each = F.transform(pieces, lambda x: F.struct(x.alias("piece"), F.regexp_extract(x, f"(?:{tail})\\z", group).alias("run")))
    rows = rows.withColumn("each", F.when(wanted & F.col("text").isNotNull(), each))
    starts = F.sequence(F.lit(0), F.floor((F.size("each") - 1) / CHUNK).cast("int"))
    summed = lambda lengths: F.aggregate(lengths, F.array().cast("array<int>"), lambda a, n: F.concat(a, F.array(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)) + n)))
    within = F.transform(starts, lambda c: summed(F.transform(F.slice("each", c * CHUNK + 1, CHUNK), lambda x: F.length(x["piece"]))))
    rows = rows.withColumn("within", F.when(F.size("each") > 0, within))
    rows = rows.withColumn("totals", summed(F.transform("within", lambda w: F.element_at(w, -1))))
    # Zipped, not looked up: the optimizer may put what a lambda names once in the lambda's place.
    offsets = F.slice(F.concat(F.array(F.lit(0)), F.col("totals")), F.lit(1), F.size("within"))
    stops = F.flatten(F.zip_with("within", offsets, lambda w, offset: F.transform(w, lambda n: n + offset)))
    rows = rows.withColumn("each", F.zip_with("each", stops, lambda x, stop: F.struct(x["piece"].alias("piece"), x["run"].alias("run"), stop.alias("stop"))))

    def finding(x: Column, i: Column) -> Column:
        # Each piece before holds a finding, so few of them hold the neighbourhood.
        near = [F.coalesce(F.right(F.get("each", i - k)["piece"], F.lit(NEAR)), F.lit("")) for k in range(_PIECES, 0, -1)]
        own = F.right(F.left(x["piece"], F.length(x["piece"]) - F.length(x["run"])), F.lit(NEAR))
        return F.struct(
            (x["stop"] - F.length(x["run"])).alias("start"), x["stop"].alias("stop"), x["run"].alias("run"),
            F.right(F.concat(*near, own), F.lit(NEAR)).alias("before"), F.coalesce(F.left(F.get("each", i + 1)["piece"], F.lit(1)), F.lit("")).alias("after"),
        )

    return rows.withColumn(name, F.filter(F.transform("each", finding), lambda x: x["run"] != "")).drop("each", "within", "totals")


def findings(docs: DataFrame) -> DataFrame:
    """(doc_id, source, start, stop, run, before, after): places in code points, stop excluded."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    rows = _placed(rows, "runs", F.col("text").rlike(f"[{_CLASS}]{{{MIN_LENGTH}}}"), _RUN, f"[{_CLASS}]{{{MIN_LENGTH},}}={{0,2}}", 0)
    rows = _placed(rows, "values", F.col("text").rlike(KEY), _ASSIGNED, _LAST, 2)
    # From the whole text: a long key name is a run itself, and the gap after it has lost the name.
    each = rows.select("row", "doc_id", "source", F.explode(F.array("runs", "values")).alias("found"))
    each = each.select("row", "doc_id", "source", F.inline("found"))
    return each.dropDuplicates(["row", "start", "stop"]).drop("row")


def dictionary(docs: DataFrame) -> DataFrame:
    """(word, n): lower-case words of 4 to 12 letters and how often all texts hold them, from MIN_COUNT on."""
    every = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+", -1)).alias("word"))
    return every.where(F.length("word").between(*WORD_LETTERS)).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def _share(run: Column, pattern: str) -> Column:
    return (F.length(run) - F.length(F.regexp_replace(run, pattern, ""))) / F.length(run)


def _covered(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, letters): how many of a run's letters lie in a word of the dictionary, wherever words begin and end in it."""
    lower, least, most = F.lower("run"), *WORD_LETTERS
    # Parts of letters only, as joined words have no border to cut them at.
    parts = runs.select("run", F.posexplode(F.split(lower, "(?<=[a-z])(?=[^a-z])|(?<=[^a-z])(?=[a-z])", -1)).alias("part", "letters"))
    parts = parts.where(F.col("letters").rlike(f"^[a-z]{{{least},}}$"))
    at = parts.select("run", "part", "letters", F.explode(F.sequence(F.lit(1), F.length("letters") - (least - 1))).alias("at"))
    cuts = at.select("run", "part", "at", F.explode(F.transform(F.sequence(F.lit(least), F.least(F.lit(most), F.length("letters") - F.col("at") + 1)), lambda k: F.substr("letters", "at", k))).alias("word"))
    hits = cuts.join(words.select("word"), "word")
    letters = hits.select("run", "part", F.explode(F.sequence("at", F.col("at") + F.length("word") - 1)).alias("letter")).distinct()
    return letters.groupBy("run").agg(F.count(F.lit(1)).alias("letters"))


def featured(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with FEATURES as doubles."""
    run, before = F.col("run"), F.col("before")
    own = found.select("doc_id", "source", "start", "stop", "run", "before", "after").withColumn("last_word", F.regexp_extract(F.lower(before), r"([a-z]+)[^a-z]*$", 1))
    covered = _covered(own.select("run").distinct(), words).select(F.col("run").alias("_run"), "letters")
    known = words.select(F.col("word").alias("_word"), "n")
    own = own.join(covered, F.col("run") == F.col("_run"), "left").join(known, F.col("last_word") == F.col("_word"), "left")
    changes = F.size(F.split(run, r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])", -1)) - 1
    values = {
        "length": F.length(run),
        "digits": _share(run, "[0-9]"),
        "capitals": _share(run, "[A-Z]"),
        "vowels": _share(run, "[AEIOUaeiou]"),
        "symbols": _share(run, "[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(run, ""))) / F.length(run),
        "changes": changes / F.length(run),
        "hexadecimal": run.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "path": run.rlike("^/|[A-Za-z0-9]/[A-Za-z0-9_-]+/"),
        "covered": F.coalesce(F.col("letters") / F.length(run), F.lit(0)),
        "test_source": F.coalesce(F.col("source").rlike("(?i)test|example|sample|mock"), F.lit(False)),
        "key_before": before.rlike(KEY + r"[A-Za-z0-9_]*[\"'\]]{0,2}\s*(=>|:=|=|:|is)?\s*[\"'`]?$"),
        "assigned": before.rlike(r"(=>|=|:)\s*[\"'`]?$"),
        "quoted": before.rlike(r"[\"'`]$") & F.col("after").isin('"', "'", "`"),
        "word_common": F.log1p(F.coalesce("n", F.lit(0))),
    }
    return own.select("doc_id", "start", "stop", "run", *[v.cast("double").alias(k) for k, v in values.items()])


def surroundings() -> Column:
    """1, 0 or null: what a finding's neighbourhood says."""
    secret = (F.col("key_before") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0) | F.col("run").rlike(ISSUED)
    plain = (F.col("key_before") == 0) & (F.col("assigned") == 0) & (F.col("quoted") == 0)
    return F.when(secret, 1.0).when(plain, 0.0)


def fit(rows: DataFrame, max_rows: int = MAX_TRAINING) -> PipelineModel | None:
    """A forest on at most ``max_rows`` of each label (and as many with a blanked neighbourhood); None without both."""
    pick = F.xxhash64("run", "doc_id", "start")
    some = [rows.where(F.col("label") == v).orderBy(pick, "doc_id", "start").limit(max_rows) for v in (0.0, 1.0)]
    train = written(some[0].union(some[1]).select("label", *FEATURES), "findings-labelled")
    if train.select("label").distinct().count() < 2:
        return None
    blank = train.select("label", *[F.lit(0.0).alias(f) if f in NEIGHBOURS else F.col(f) for f in FEATURES])
    both = VectorAssembler(inputCols=FEATURES, outputCol="features")
    ordered = train.union(blank).coalesce(1).sortWithinPartitions("label", *FEATURES)  # bounded; the same forest each time
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
    return PipelineModel([both, forest.fit(both.transform(ordered))])


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """(doc_id, start, stop, run, score) of the findings judged to be secrets.

    ``labelled``: (doc_id, start, stop, label) of findings in ``docs``, or rows
    with a label and all FEATURES of their own.
    """
    found = written(findings(docs), "found")  # read twice below, scanned once
    rows = written(featured(found, dictionary(docs)), "findings")
    if labelled is None:
        train = rows.withColumn("label", surroundings()).where("label IS NOT NULL")
    elif set(FEATURES) <= set(labelled.columns):
        train = labelled
        if not {"run", "doc_id", "start"} <= set(labelled.columns):
            raise ValueError("labelled rows with features need run, doc_id and start as well")
    else:
        train = rows.join(labelled.select("doc_id", "start", "stop", F.col("label").cast("double").alias("label")), ["doc_id", "start", "stop"])
    model = fit(train)
    if model is None:
        return rows.where(surroundings() == 1).select("doc_id", "start", "stop", "run", F.lit(1.0).alias("score"))
    scored = model.transform(rows).withColumn("score", F.round(F.get(vector_to_array("probability"), 1), 6))
    return scored.where(F.col("score") >= threshold).select("doc_id", "start", "stop", "run", "score")
