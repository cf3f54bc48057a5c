"""Column adapters: golden cases from the task sheets and T-SQL semantic traps."""

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from relprep.functions import dates as D
from relprep.functions import money as M
from relprep.functions import predicates as P
from relprep.functions import text as T


def one(spark, expr, data=None, schema="x string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_floor_price_golden(spark):
    # PRJ-10: 3.60 -> 3.00
    assert one(spark, M.floor_price("x"), [(3.60,)], "x double") == [Decimal("3.0000")]


def test_round_up_golden(spark):
    # PRJ-9: whole 10, cents 90 -> 11; cents 49 is not rounded
    df = spark.createDataFrame([(10.90,), (10.49,), (10.50,)], "p double")
    out = df.select(M.rounded_up(M.whole_part("p"), M.cents_part("p")).alias("n")).collect()
    assert [r.n for r in out] == [Decimal("11.0000"), None, Decimal("11.0000")]


def test_money_parts(spark):
    df = spark.createDataFrame([(12.34,), (0.05,), (None,)], "p double")
    out = df.select(M.whole_part("p"), M.cents_part("p")).collect()
    assert [tuple(r) for r in out] == [
        (Decimal("12.0000"), Decimal("34.0000")),
        (Decimal("0.0000"), Decimal("5.0000")),
        (None, None),
    ]


def test_integral_quotient_rejects_fraction(spark):
    # FLT-13: a quantity of 1.23 is rejected; zero divisor gives NULL, not an error
    df = spark.createDataFrame([(12.3, 10.0), (20.0, 10.0), (5.0, 0.0)], "n double, d double")
    out = df.select(M.is_integral_quotient("n", "d").alias("ok"), M.safe_quotient("n", "d").alias("q")).collect()
    assert [r.ok for r in out] == [False, True, None]
    assert out[0].q == Decimal("1.2300") and out[2].q is None


def test_round_half_up(spark):
    df = spark.createDataFrame([(Decimal("2.345"),), (Decimal("2.355"),)], "x decimal(18,4)")
    out = df.select(M.round_money("x", 2, M.MONEY).alias("r")).collect()
    assert [r.r for r in out] == [Decimal("2.3500"), Decimal("2.3600")]


def test_discounted_sales_keep_eight_decimals(spark):
    # AGG-11: 900.1001 x 3 x (1 - 0.0503) = 2564.4751949... needs all eight decimals.
    df = spark.createDataFrame([(900.1001, 3.0, 0.0503)], "p double, q double, d double")
    (r,) = df.agg(M.discounted_units("q", "d").alias("u"), F.first("p").alias("p")).select((M.money("p") * F.col("u")).alias("s")).collect()
    assert r.s == Decimal("900.1001") * 3 * Decimal("0.9497")
    assert -r.s.as_tuple().exponent == 8


def test_money_holds_the_whole_range(spark):
    top = Decimal("922337203685477.5807")
    df = spark.createDataFrame([(top,), (-top,), (Decimal("900000000000000.0001"),)], "x decimal(30,4)")
    assert [r[0] for r in df.select(M.money("x")).collect()] == [top, -top, Decimal("900000000000000.0001")]
    assert [r[0] for r in df.select(M.is_integral_quotient("x", F.lit("0.0001"))).collect()] == [True] * 3


def test_keys_do_not_share_tokens(spark):
    # NULL, empty and joined keys are all told apart.
    pairs = [(None, "a"), ("a", None), ("", "a"), ("a|b", "c"), ("a", "b|c"), ("-", "a"), ("1:a", None)]
    df = spark.createDataFrame(pairs, "x string, y string")
    assert len({r[0] for r in df.select(T.keyed_guid("x", "y", salt="s")).collect()}) == len(pairs)


def test_sheet_text_options(spark):
    df = spark.createDataFrame([("12345678", "ab==", "1 (05) 7-7"), (None, None, None)], "a string, b string, c string")
    got = df.select(T.without_first("a", 4), T.without_trailing("b", "="), T.digits_only("c")).collect()
    assert [tuple(r) for r in got] == [("5678", "ab", "10577"), (None, None, None)]


def test_phone_has_area_code(spark):
    # FLT-11 guard: '(123) 456 789' contains '('
    assert one(spark, P.like("x", "%(%"), [("(123) 456 789",), ("123 456",)]) == [True, False]


def test_web_address_one_and_many_words(spark):
    # STR-11 / UPD-9
    out = one(spark, T.web_address("x"), [("Exotic",), ("Pavlova, Ltd.",), ("New Orleans Cajun",), (None,)])
    assert out == ["www.Exotic.com", "www.Pavlova,.com", "www.New.com", None]


def test_tsql_len_ignores_trailing_spaces(spark):
    assert one(spark, T.tsql_len("x"), [("ab  ",), ("  ab",), ("",), (None,)]) == [2, 4, 0, None]


def test_tsql_substring_start_zero(spark):
    # STR-5: SUBSTRING(s, 0, 100) gives 99 characters
    s = "x" * 150
    assert one(spark, F.length(T.tsql_substring("x", 0, 100)), [(s,)]) == [99]
    assert one(spark, T.tsql_substring("x", 0, 3), [("abcdef",)]) == ["ab"]
    assert one(spark, T.tsql_substring("x", 3, 22), [("abcdef",)]) == ["cdef"]


def test_left_right_on_integers(spark):
    df = spark.createDataFrame([(43659,)], "k long")
    r = df.select(T.left("k", 1).alias("l"), T.right("k", 3).alias("r")).first()
    assert (r.l, r.r) == ("4", "659")


def test_concat_strict_propagates_null(spark):
    out = one(spark, T.concat_strict(F.col("x"), " - ", F.lit("b")), [("a",), (None,)])
    assert out == ["a - b", None]


def test_charindex_and_single_word(spark):
    data = [("Beverages",), ("Grains/Cereals",), ("Meat Poultry",), ("",)]
    assert one(spark, T.charindex(" ", "x"), data) == [0, 0, 5, 0]
    assert one(spark, P.is_single_word("x"), data) == [True, False, False, True]


def test_keyed_guid_shape_and_determinism(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "k long")
    a = [r[0] for r in df.select(T.keyed_guid("k", salt="s")).collect()]
    b = [r[0] for r in df.select(T.keyed_guid("k", salt="s")).collect()]
    assert a == b
    assert all(re.fullmatch(r"[0-9A-F]{8}-[0-9A-F]{4}-[0-9A-F]{4}-[0-9A-F]{4}-[0-9A-F]{12}", g) for g in a)
    assert len(set(a)) == 50
    c = [r[0] for r in df.select(T.keyed_guid("k", salt="other")).collect()]
    assert set(a).isdisjoint(c)


def test_password_token_lower_and_no_dash(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "k long")
    out = [r[0] for r in df.select(T.password_token("k", salt="p", length=16)).collect()]
    assert all(len(p) == 16 and "-" not in p and p == p.lower() for p in out)
    assert all(p[8] == "7" for p in out)  # the first GUID dash becomes 7


def test_prefix_in_is_textual(spark):
    # FLT-5: LEFT(x,1) IN (1,3) compared as text, no cast error on letters
    assert one(spark, P.prefix_in("x", ["1", "3"]), [("1-URGENT",), ("3x",), ("A1",), (None,)]) == [True, True, False, None]


def test_character_classes(spark):
    data = [("12345",), ("A1B2",), ("12-45",), ("x",)]
    assert one(spark, P.has_letter("x"), data) == [False, True, False, True]
    assert one(spark, P.starts_with_digit("x"), data) == [True, False, True, False]


def test_like_case_modes(spark):
    data = [("Blue",), ("blue",)]
    assert one(spark, P.like("x", "%B%"), data) == [True, False]
    assert one(spark, P.like("x", "%B%", ignore_case=True), data) == [True, True]


def test_year_diff_counts_boundaries(spark):
    # DAT-3: 31 Dec 2019 -> 1 Jan 2020 is 1
    df = spark.createDataFrame([(dt.date(2019, 12, 31), dt.date(2020, 1, 1))], "a date, b date")
    r = df.select(D.year_diff("a", "b").alias("y"), D.day_diff("a", "b").alias("d")).first()
    assert (r.y, r.d) == (1, 1)


def test_day_diff_negative_and_null(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 10), dt.date(2020, 1, 3)), (dt.date(2020, 1, 1), None)], "a date, b date")
    assert [r[0] for r in df.select(D.day_diff("a", "b")).collect()] == [-7, None]


def test_completed_years(spark):
    asof = dt.date(2024, 6, 30)
    df = spark.createDataFrame([(dt.date(2000, 6, 30),), (dt.date(2000, 7, 1),), (dt.date(2024, 1, 1),)], "h date")
    assert [r[0] for r in df.select(D.completed_years("h", asof)).collect()] == [24, 23, 0]


def test_any_equal_empty_is_false(spark):
    df = spark.createDataFrame([(1, "a")], "id int, c string")
    assert df.filter(P.any_equal({"id": None, "c": None})).count() == 0
    assert df.filter(P.any_equal({"id": 2, "c": "a"})).count() == 1


def test_integral_quotient_edges(spark):
    rows = [
        (Decimal("-12.3000"), Decimal("4.1000")),  # -3 exactly
        (Decimal("99999999999999.9999"), Decimal("0.0001")),  # largest money, smallest divisor
        (Decimal("10.0001"), Decimal("5.0000")),  # not integral by 1/10000
        (Decimal("7.5000"), Decimal("-2.5000")),  # -3 exactly
    ]
    df = spark.createDataFrame(rows, "n decimal(19,4), d decimal(19,4)")
    got = [r[0] for r in df.select(M.is_integral_quotient("n", "d")).collect()]
    ref = [r[0] for r in df.select((F.col("n") % F.col("d")) == 0).collect()]
    assert got == ref == [True, True, False, True]
