"""Batch tables and resumable flows: reruns, crashes, retried tasks, dense keys, clean-up."""

import os
import subprocess
import sys
import uuid

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from relprep.flows import Flow
from relprep.operators.keys import with_identity
from relprep.session import checkpoint_dir, scratch_path
from relprep.sources import batches, files
from relprep.sources.batches import BatchTable, Identity
from relprep.sources.sinks import materialize
from relprep.sources.tables import load

LAYOUT = "city_id long, city string, created string"


def table(spark, name="cities"):
    layout = spark.createDataFrame([], LAYOUT).schema
    return BatchTable(spark, scratch_path(spark, name), layout, {"created": "today"}, Identity("city_id", ("city",), 5, 5))


def cities(spark, names):
    return spark.createDataFrame([(n,) for n in names], "city string")


def rows(t):
    return sorted((tuple(r) for r in t.read().collect()), key=str if t.identity is None else None)


def test_identity_goes_on_and_a_rerun_appends_nothing(spark):
    t = table(spark)
    assert t.read().collect() == [] and t.next_value() == 5
    assert t.load(cities(spark, ["b", "a", "c"]), "first")
    assert not t.load(cities(spark, ["b", "a", "c"]), "first")
    assert t.load(cities(spark, ["e", "d", "d"]), "second") and t.load(cities(spark, []), "none")
    assert not t.load(cities(spark, ["z"]), "second")
    assert rows(t) == [(5, "a", "today"), (10, "b", "today"), (15, "c", "today"), (20, "d", "today"), (25, "d", "today"), (30, "e", "today")]
    assert t.next_value() == 35 and [c["rows"] for c in t.commits()] == [3, 3, 0]


def test_a_load_that_dies_before_its_commit_leaves_nothing(spark, monkeypatch):
    t = table(spark)
    t.load(cities(spark, ["a"]), "first")

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(batches.files, "put_record", die)
        with pytest.raises(RuntimeError):
            t.load(cities(spark, ["b", "c"]), "second")
    assert rows(t) == [(5, "a", "today")]
    assert t.load(cities(spark, ["b", "c"]), "second")
    assert rows(t) == [(5, "a", "today"), (10, "b", "today"), (15, "c", "today")]


def test_of_two_loaders_the_later_commit_fails(spark, monkeypatch):
    t = table(spark)
    before = t.commits()
    t.load(cities(spark, ["a"]), "first")
    with monkeypatch.context() as m:
        m.setattr(t, "commits", lambda: before)
        with pytest.raises(FileExistsError):
            t.load(cities(spark, ["b"]), "other")
    assert rows(t) == [(5, "a", "today")]


def test_retried_tasks_give_the_same_keys(spark):
    """The first attempt of every task fails; keys stay dense and in order over both loads."""

    def fail_once(batches):
        for b in batches:
            yield b
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("injected")

    t = table(spark)
    for k, batch in enumerate(("one", "two")):
        source = spark.range(k * 500, k * 500 + 500, numPartitions=4).select(F.format_string("%05d", "id").alias("city"))
        t.load(source.mapInPandas(fail_once, "city string"), batch)
    assert [(r.city_id, int(r.city)) for r in t.read().orderBy("city_id").collect()] == [(5 + 5 * i, i) for i in range(1000)]


def test_load_takes_named_columns_defaults_and_rejects_unknown_identity(spark):
    layout = spark.createDataFrame([], LAYOUT).schema
    t = BatchTable(spark, scratch_path(spark, "plain"), layout, {"created": "today"})
    t.load(spark.createDataFrame([("x", 7, None)], "city string, city_id int, created string"), "b")
    t.load(spark.createDataFrame([("y", "extra")], "city string, other string"), "c")
    assert list(map(str, rows(t))) == ["(7, 'x', None)", "(None, 'y', 'today')"]
    with pytest.raises(ValueError):
        BatchTable(spark, "x", layout, identity=Identity("nope", ("city",)))


def test_fold_replaces_the_batches_and_finishes_a_died_one(spark, monkeypatch):
    t = table(spark)
    for k in range(3):
        t.load(cities(spark, [f"c{k}"]), f"b{k}")
    with monkeypatch.context() as m:
        m.setattr(batches.files, "remove", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            t.fold("fold-1", lambda df: df)
    want = [(5, "c0", "today"), (10, "c1", "today"), (15, "c2", "today")]
    assert rows(t) == want and len(files.names(spark, f"{t.path}/data")) == 4
    assert not t.fold("fold-1", lambda df: df)
    assert rows(t) == want and len(files.names(spark, f"{t.path}/data")) == 1
    t.load(cities(spark, ["d"]), "b3")
    assert rows(t) == [*want, (20, "d", "today")]


# ---- flows


def run_flow(spark, smoke_dir, run_id, target, die_after=None):
    flow = Flow(spark, "test", run_id)

    def made(name, df):
        if die_after == name:
            raise RuntimeError("killed")
        return df

    a = flow.step("load", lambda: load(spark, smoke_dir, "customer").select("c_custkey", "c_name"))
    b = flow.step("number", lambda: made("load", with_identity(a, ["c_name"], "n")))
    c = flow.step("cut", lambda: made("number", materialize(b.where("n <= 50"), scratch_path(spark, "inner"))))
    if die_after == "cut":
        raise RuntimeError("killed")
    return flow, flow.finish({target: c})[target]


@pytest.mark.parametrize("after, left", [("load", ["number", "cut"]), ("number", ["cut"]), ("cut", [])])
def test_a_killed_flow_resumes_and_leaves_only_its_targets(spark, smoke_dir, tmp_path, after, left):
    run_id, target = uuid.uuid4().hex, f"file://{tmp_path}/target"
    with pytest.raises(RuntimeError):
        run_flow(spark, smoke_dir, run_id, target, after)
    assert Flow(spark, "test", run_id).finished()[-1] == after
    flow, out = run_flow(spark, smoke_dir, run_id, target)
    assert flow.ran == left
    want = sorted(r.c_name for r in load(spark, smoke_dir, "customer").select("c_name").collect())[:50]
    assert [(r.n, r.c_name) for r in out.orderBy("n").collect()] == list(enumerate(want, 1))
    assert not files.exists(spark, flow.root)


def test_a_steps_scratch_goes_with_the_step_and_order_is_held(spark, smoke_dir):
    flow = Flow(spark, "test", uuid.uuid4().hex)
    flow.step("number", lambda: with_identity(load(spark, smoke_dir, "nation").select("n_name"), ["n_name"], "n"))
    assert files.names(spark, flow.root) == ["journal", "scratch", "steps"]
    assert files.names(spark, f"{flow.root}/scratch") == []
    with pytest.raises(ValueError):
        Flow(spark, "test", flow.root.rsplit("/", 1)[1]).step("other", lambda: spark.range(1))


def test_scratch_tables_of_an_application_go_when_it_ends(tmp_path):
    code = f"""
from relprep.session import build_session, scratch_path
from relprep.sources.sinks import materialize
s = build_session("local[2]", 2, extra={{"spark.checkpoint.dir": "file://{tmp_path}/ckpt"}})
print("rows", materialize(s.range(5), scratch_path(s, "x")).count())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180, env={**os.environ, "PYTHONPATH": root})
    assert "rows 5" in done.stdout, done.stderr
    assert os.listdir(f"{tmp_path}/ckpt") and not any("part-" in n for _, _, ns in os.walk(tmp_path) for n in ns)


def test_records_are_whole_and_ordered(spark):
    folder = f"{checkpoint_dir(spark)}/records-{uuid.uuid4().hex}"
    assert files.records(spark, folder) == {} and files.names(spark, folder) == []
    for k in (2, 1):
        files.put_record(spark, f"{folder}/{k}.json", {"k": k, "s": "é"})
    assert list(files.records(spark, folder).values()) == [{"k": 1, "s": "é"}, {"k": 2, "s": "é"}]
    with pytest.raises(FileExistsError):
        files.put_record(spark, f"{folder}/1.json", {})
