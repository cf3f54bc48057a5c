"""DataFrame operators on small fixtures with NULLs, duplicates and boundaries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from relprep.operators import aggregates as A
from relprep.operators import keys as K
from relprep.operators import quality as Q
from relprep.operators import search as S
from relprep.operators import sorting as SO
from relprep.operators import updates as U


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_week_bucket_boundaries(spark):
    # UPD-5: 7, 8, 14, 15, 21, 22, 28 -> Prva, Druga, Druga, Treca, Treca, Cetvrta, Cetvrta
    days = [-3, 7, 8, 14, 15, 21, 22, 28, 29, None]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    out = [r[0] for r in df.select(U.week_bucket("d")).collect()]
    assert out == ["Prva", "Prva", "Druga", "Druga", "Treca", "Treca", "Cetvrta", "Cetvrta", None, None]


def test_fill_from_key_golden(spark):
    # UPD-6: NULL store and first digit 4/5 -> last 3 digits; 6/7 -> last 4
    df = spark.createDataFrame(
        [(43659, None), (67890, None), (12345, None), (43660, 99), (54321, None), (71234, None)],
        "k long, store long",
    )
    out = U.fill_from_key(df, "store", "k", [(["4", "5"], 3), (["6", "7"], 4)])
    assert rows(out, "k", "store") == [(12345, None), (43659, 659), (43660, 99), (54321, 321), (67890, 7890), (71234, 1234)]


def test_update_keeps_rows_with_null_predicate(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, "b"), (3, 0, "c")], "id int, v int, s string")
    out = U.update(df, F.col("v") > 1, {"s": F.lit("hit")})
    assert rows(out, "id", "s") == [(1, "a"), (2, "hit"), (3, "c")]


def test_delete_where_keeps_null_predicate(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 0)], "id int, v int")
    assert rows(U.delete_where(df, F.col("v") > 1), "id") == [(1,), (3,)]


def test_trim_prefix_skips_long_values(spark):
    # UPD-8: only values shorter than 25 lose their first two characters
    df = spark.createDataFrame([("x" * 25,), ("ab12345",), (None,)], "s string")
    assert [r[0] for r in U.trim_prefix(df, "s").collect()] == ["x" * 25, "12345", None]


def test_ordered_steps_fill_then_trim(spark):
    # UPD-2 -> UPD-8: the filled 25-char token must not be trimmed
    df = spark.createDataFrame([(1, None), (2, "PO123")], "k long, n string")
    from relprep.functions.text import keyed_token

    out = U.trim_prefix(U.fill_null(df, "n", keyed_token("k", salt="s", length=25)), "n")
    got = dict((r.k, r.n) for r in out.collect())
    assert len(got[1]) == 25 and got[2] == "123"


def test_reverse_code_branches(spark):
    df = spark.createDataFrame([(1, "STANDARD", "12209"), (2, "SMALL", "ab123"), (3, "LARGE", None)], "k long, unit string, pc string")
    out = U.reverse_code(U.add_column(df, "code", "string"), "code", "pc", "unit", ["k"], "s")
    got = {r.k: r.code for r in out.collect()}
    assert got[1] == "90221DRAD"
    assert len(got[2]) == 20 and got[3] is None


def test_email_rule_two_layouts(spark):
    df = spark.createDataFrame([(1, "Ana", "Kovac"), (2, "Ivo", "Horvat"), (3, "X", "Y")], "city int, f string, l string")
    out = U.email_rule(U.add_column(df, "email", "string"), "email", "city", 1, 2, "f", "l", "fit.ba")
    assert rows(out, "city", "email") == [(1, "Ana.Kovac@fit.ba"), (2, "Horvat.Ivo@fit.ba"), (3, None)]


def test_count_by_null_group_counts_zero(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    got = {r.c: r.n for r in A.count_by(df, ["c"], "c").collect()}
    assert got == {"a": 2, None: 0}


def test_length_histogram_golden(spark):
    # AGG-3: 1000 values of length 10 -> one row (10, 1000)
    df = spark.createDataFrame([("0123456789",)] * 1000, "s string")
    from relprep.functions.text import tsql_len

    n = tsql_len("s")
    out = A.count_by(df, [n.alias("len")], n, "cnt").collect()
    assert [(r.len, r.cnt) for r in out] == [(10, 1000)]


def test_int_avg_truncates(spark):
    df = spark.createDataFrame([(1,), (2,)], "n long")
    assert df.agg(A.int_avg("n")).first()[0] == 1


def test_above_average_uses_scalar_subquery(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "k int, v double")
    out = A.above_average(df, "v")
    assert rows(out, "k") == [(5,), (6,), (7,), (8,), (9,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_with_identity_dense_parallel(spark):
    # PRJ-6: 5,10,15... and equal to a global row_number, over many partitions
    n = 5000
    df = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), (F.col("id") % 3).alias("g")).repartition(13)
    out = K.with_identity(df, ["k"], "ident", seed=5, step=5, num_partitions=11)
    got = sorted((r.k, r.ident) for r in out.collect())
    assert got == [(i, 5 + 5 * i) for i in range(n)]


def test_with_identity_ties_are_dense(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("c",)], "city string")
    out = K.with_identity(df, ["city"], "id", seed=1, step=2, num_partitions=3)
    assert sorted(r.id for r in out.collect()) == [1, 3, 5, 7]
    assert rows(out.filter("city = 'c'"), "id") == [(7,)]


def test_with_identity_three_cities_golden(spark):
    df = spark.createDataFrame([("Oakland",), ("Berkeley",), ("San Francisco",)], "city string")
    a = K.with_identity(df, ["city"], "id", seed=5, step=5)
    b = K.with_identity(df, ["city"], "id", seed=1, step=2)
    assert rows(a, "city", "id") == [("Berkeley", 5), ("Oakland", 10), ("San Francisco", 15)]
    assert rows(b, "city", "id") == [("Berkeley", 1), ("Oakland", 3), ("San Francisco", 5)]


def test_top_n_plan_is_take_ordered(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 17)
    out = SO.top_n(df, 5, "v", "id")
    assert [r.id for r in out.collect()] == [0, 17, 34, 51, 68]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_assign_top_n(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 9) for i in range(1, 21)], "k long, city long")
    got = {r.k: r.city for r in SO.assign_top_n(df, 3, ["k"], "city", 100, 200).collect()}
    assert got == {k: 100 if k <= 3 else (200 if k % 2 else 9) for k in range(1, 21)}


def test_assign_top_n_with_repeated_and_null_keys(spark):
    # SRT-5: exactly n rows change and no row is lost or multiplied.
    keys = [2, 2, 2, 1, None, None, 3, 3]
    df = spark.createDataFrame([(k, None) for k in keys], "k long, city long")
    for n in range(len(keys) + 2):
        got = SO.assign_top_n(df, n, ["k"], "city", 100, 200).collect()
        assert sorted((r.k is not None, r.k or 0) for r in got) == sorted((k is not None, k or 0) for k in keys)
        assert sum(r.city == 100 for r in got) == min(n, len(keys))
    two = SO.assign_top_n(df, 2, ["k"], "city", 100, 200).collect()
    assert [r.k for r in two if r.city == 100] == [None, None]  # NULL sorts first


def test_reports_come_in_order(spark):
    # SRT-1, SRT-2: collected order, ties broken by the unique columns.
    values = [5, 3, 5, 1, 3, 5, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long").repartition(5)
    got = [(r.v, r.id) for r in SO.sort_report(df, F.desc("v"), unique=["id"]).collect()]
    assert got == [(5, 0), (5, 2), (5, 5), (3, 1), (3, 4), (1, 3), (None, 6)]
    got = [r.id for r in SO.sort_report(df, F.asc("v"), unique=["id"]).collect()]
    assert got == [6, 3, 1, 4, 0, 2, 5]


def test_shuffled_rows_come_in_key_order(spark):
    # SRT-3
    got = [r.shuffle_key for r in SO.keyed_shuffle(spark.range(500).repartition(7), ["id"], "s").collect()]
    assert got == sorted(got) and len(set(got)) == 500


def test_search_above_average_comes_in_order(spark):
    # FLT-12: sorted by the value, ties by the remaining columns.
    df = spark.createDataFrame([("a", i % 4, 10 - i % 3) for i in range(40)] + [("b", 0, 0)] * 9, "name string, k long, v long")
    got = [(r.v, r.name, r.k) for r in S.any_match_above_avg(df, {"name": "a"}, "v").collect()]
    assert got == sorted(got) and len(got) == 40


def test_keyed_shuffle_is_reproducible_and_whole(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    a = [r.k for r in SO.keyed_shuffle(df, ["k"], "salt").collect()]
    b = [r.k for r in SO.keyed_shuffle(df, ["k"], "salt").collect()]
    assert a == b and sorted(a) == list(range(200)) and a != list(range(200))


def test_any_match_semantics(spark):
    df = spark.createDataFrame([(1, "Produce"), (2, "Beverages"), (3, "Produce")], "id int, cat string")
    assert rows(S.any_match(df, {"id": None, "cat": "Produce"}), "id") == [(1,), (3,)]
    assert S.any_match(df, {"id": None, "cat": None}).count() == 0
    assert rows(S.any_match(df, {"id": 2, "cat": "Produce"}, guard=F.col("id") > 1), "id") == [(2,), (3,)]
    proc = S.procedure(df, ["id", "cat"])
    assert proc(cat="Beverages").count() == 1


def test_pk_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (2, None)], "a int, b int")
    single = {r.a: (r.n_rows, r.reason) for r in Q.pk_violations(df, ["a"]).collect()}
    assert single == {1: (3, "duplicate"), None: (1, "null_key")}
    out = {(r.a, r.b): (r.n_rows, r.reason) for r in Q.pk_violations(df, ["a", "b"]).collect()}
    assert out == {(1, 1): (2, "duplicate"), (None, 3): (1, "null_key"), (2, None): (1, "null_key")}


def test_fk_violations(spark):
    child = spark.createDataFrame([(1,), (1,), (5,), (5,), (5,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(Q.fk_violations(child, ["k"], parent, ["id"]), "k", "n_rows") == [(5, 3)]


def test_fk_query_holds_lines_against_the_orders_of_every_status(spark, tmp_path):
    from relprep.plans import CHECKS

    spark.createDataFrame([(1, "F"), (2, "O"), (3, "P"), (4, None)], "o_orderkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(k,) for k in (1, 2, 3, 3, 4, 5, 5, None)], "l_orderkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    assert rows(CHECKS["q_dq_fk"].fn(spark, str(tmp_path)), "l_orderkey", "n_rows") == [(5, 2)]


def test_unique_violations_counts_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "c string")
    got = {r.c: r.n_rows for r in Q.unique_violations(df, "c").collect()}
    assert got == {"a": 2, None: 2}


def test_profile_and_lengths(spark):
    df = spark.createDataFrame([("abc", None), ("abcdef  ", "x"), (None, "y")], "a string, b string")
    got = {r.column: (r.max_len, r.n_null, r.n_too_long) for r in Q.profile(df, {"a": 4}, ["b"]).collect()}
    assert got == {"a": (6, 1, 1), "b": (None, 1, None)}
    assert Q.length_violations(df, {"a": 4}).count() == 1


def test_check_violations_null_passes(spark):
    df = spark.createDataFrame([("x" * 15,), ("short",), (None,)], "s string")
    from relprep.functions.text import tsql_len

    assert [r.s for r in Q.check_violations(df, tsql_len("s") == 15).collect()] == ["short"]


def test_lookup_key_scalar(spark):
    from relprep.operators.joins import lookup_key

    dim = spark.createDataFrame([(5, "Berkeley"), (10, "Oakland")], "id int, name string")
    df = spark.range(3)
    out = df.select(lookup_key(dim, "name", "Oakland", "id").alias("k"), lookup_key(dim, "name", "Nowhere", "id").alias("m"))
    assert {(r.k, r.m) for r in out.collect()} == {(10, None)}


def test_row_number_reference_equivalence(spark):
    # The parallel identity equals an (unpartitioned) row_number on the same order.
    df = spark.range(300).select((F.col("id") % 37).alias("a"), F.col("id").alias("b"))
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("a", "b")))
    out = K.with_identity(df, ["a", "b"], "rn", num_partitions=7)
    assert sorted(map(tuple, ref.collect())) == sorted(map(tuple, out.select("a", "b", "rn").collect()))


def test_with_identity_hot_key_third_of_rows(spark):
    # One key value holds a third of all rows; tie-breakers spread it over
    # range partitions and numbering stays dense and ordered.
    rows_ = [(0, i) for i in range(1000)] + [(i, i) for i in range(1, 2001)]
    df = spark.createDataFrame(rows_, "k long, payload long")
    out = K.with_identity(df, ["k"], "id", num_partitions=8)
    got = sorted((r.k, r.payload, r.id) for r in out.collect())
    assert [g[2] for g in got] == list(range(1, 3001))
    assert {g[2] for g in got if g[0] == 0} == set(range(1, 1001))


def test_mask_by_prefix_invariants(spark, smoke_dir):
    # UPD-7: every value that started with 1 or 3 is replaced by a 25-char
    # token; all other values are untouched; row count is preserved.
    o = spark.read.parquet(f"{smoke_dir}/orders.parquet").select("o_orderkey", F.col("o_orderpriority").alias("v"))
    out = U.mask_by_prefix(o, "v", ["1", "3"], "o_orderkey", "salt")
    joined = o.alias("a").join(out.alias("b"), "o_orderkey")
    hit = F.left(F.col("a.v"), F.lit(1)).isin("1", "3")
    assert out.count() == o.count()
    assert joined.filter(hit & ((F.length("b.v") != 25) | (F.col("a.v") == F.col("b.v")))).count() == 0
    assert joined.filter(~hit & (F.col("a.v") != F.col("b.v"))).count() == 0


def test_keyed_shuffle_preserves_multiset(spark, smoke_dir):
    c = spark.read.parquet(f"{smoke_dir}/customer.parquet")
    out = SO.keyed_shuffle(c, ["c_custkey"], "s").drop("shuffle_key")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, c.collect()))


def test_evidence_number_script_and_sheet_rules(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 2), dt.date(2020, 1, 9)), (2, dt.date(2020, 3, 1), None)],
        "k long, ordered date, shipped date",
    )
    script = {r.k: r.ev for r in U.evidence_number(df, "ev", "shipped", "ordered", "k", "s").collect()}
    sheet = {r.k: r.ev for r in U.evidence_number(df, "ev", "shipped", "ordered", "k", "s", sep="_", ship_first=False).collect()}
    assert script[1] == "2020-01-09-2020-01-02" and sheet[1] == "2020-01-02_2020-01-09"
    assert len(script[2]) == 30 and script[2] == sheet[2]


def test_lookup_key_with_duplicate_names_raises(spark):
    # Trap 7: a scalar subquery returning two rows is an error, as in SQL.
    import pytest

    from relprep.operators.joins import lookup_key

    dim = spark.createDataFrame([(5, "Oakland"), (10, "Oakland")], "id int, name string")
    with pytest.raises(Exception):
        spark.range(1).select(lookup_key(dim, "name", "Oakland", "id")).collect()
    assert {r.name: r.n_rows for r in Q.unique_violations(dim, "name").collect()} == {"Oakland": 2}


def test_money_overflow_raises_under_ansi(spark):
    # Trap 11: ANSI mode is on; a value beyond decimal(19,4) raises instead of wrapping.
    import pytest

    from relprep.functions.money import money

    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([(1e16,)], "x double")
    with pytest.raises(Exception):
        df.select(money("x")).collect()


def test_sql_procedure_named_arguments_and_guard(spark):
    df = spark.createDataFrame(
        [(1, "(11) 500", "a"), (2, "500 555", "b"), (3, "(22) 700", "b")], "id bigint, phone string, pwd string"
    )
    name = S.sql_procedure(df, "proc_people", ["id", "phone", "pwd"], guard_sql="phone LIKE '%(%'")
    got = sorted(r.id for r in spark.sql(f"SELECT * FROM {name}(p_pwd => 'b')").collect())
    assert got == [3]  # id 2 matches the parameter but fails the guard
    assert spark.sql(f"SELECT * FROM {name}()").count() == 0
    assert sorted(r.id for r in spark.sql(f"SELECT * FROM {name}(p_id => 1, p_pwd => 'b')").collect()) == [1, 3]


def test_with_identity_more_partitions_than_rows(spark):
    # A caller's session may use 200 shuffle partitions for 25 distinct cities.
    df = spark.createDataFrame([(f"city{i:02d}",) for i in range(25)], "city string")
    out = K.with_identity(df, ["city"], "id", seed=5, step=5, num_partitions=200)
    assert rows(out, "city", "id") == [(f"city{i:02d}", 5 + 5 * i) for i in range(25)]
