"""Loads in batches, resumable flows, load gates, change sets, maintained views, spread joins, ordered tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from relprep.fixed import ORDER_NO_TOKEN_LENGTH, STORE_FILL_RULES, TRIM_BELOW, TRIM_LENGTH, TRIM_START
from relprep.flows import Flow
from relprep.functions import money as M
from relprep.functions.dates import as_date
from relprep.functions.predicates import not_like
from relprep.functions.text import keyed_token, tsql_len, tsql_substring
from relprep.operators.gate import Constraints, Gated, gate
from relprep.operators.heavy import heavy_join
from relprep.operators.known_keys import KnownKeys, blocks_for
from relprep.operators.maintained import MaintainedView
from relprep.operators.quality import fk_violations_by_blocks
from relprep.operators.updates import fill_from_key, fill_null, trim_prefix, update
from relprep.plans import sqlfrag as S
from relprep.plans.registry import check
from relprep.plans.staged import _SQL_CARD_ORDERS, CARD_ORDER_LAYOUT, SALT_ORDER_NO
from relprep.session import scratch_path
from relprep.sources import ordered
from relprep.sources.batches import BatchTable, Identity
from relprep.sources.changes import apply_changes, change_set, read_partitioned, write_partitioned
from relprep.sources.sinks import with_defaults
from relprep.sources.tables import load

# ---- PRJ-6, SNK-1: an identity that goes on over two loads, each run twice -------

CLIENT_LAYOUT = StructType([
    StructField("client_id", LongType(), False),
    StructField("client_no", LongType(), True),
    StructField("name", StringType(), True),
    StructField("segment", StringType(), True),
])


@check(
    "q_identity_continues",
    """SELECT 5 + 5 * (row_number() OVER (ORDER BY c_acctbal < 0 NULLS LAST, c_custkey NULLS FIRST, c_name NULLS FIRST) - 1) AS client_id,
              c_custkey AS client_no, c_name AS name, 'unknown' AS segment
       FROM customer WHERE c_acctbal IS NOT NULL""",
    ("PRJ-6", "PRJ-7", "SNK-1"),
)
def q_identity_continues(spark: SparkSession, base: str) -> DataFrame:
    """Clients out of debt are loaded first, the others later; IDENTITY(5,5) goes on where it was."""
    c = load(spark, base, "customer")
    target = BatchTable(spark, scratch_path(spark, "clients"), CLIENT_LAYOUT, {"segment": "unknown"}, Identity("client_id", ("client_no",), 5, 5))
    for _ in range(2):  # the whole load is rerun
        for batch, part in (("in credit", F.col("c_acctbal") >= 0), ("in debt", F.col("c_acctbal") < 0)):
            target.load(c.filter(part).select(F.col("c_custkey").alias("client_no"), F.col("c_name").alias("name")), batch)
    return target.read()


# ---- SNK-1: a load in three batches, rerun ---------------------------------------


@check(
    "q_append_once",
    """SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS order_no, CAST(NULL AS BIGINT) AS store_id
       FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
    ("SNK-1", "PRJ-7", "FLT-1"),
)
def q_append_once(spark: SparkSession, base: str) -> DataFrame:
    o = load(spark, base, "orders")
    target = BatchTable(spark, scratch_path(spark, "orders-once"), CARD_ORDER_LAYOUT)
    for _ in range(2):
        for status in ("F", "O", "P"):
            rows = o.filter(F.col("o_orderstatus") == status)
            target.load(rows.select(F.col("o_orderkey").alias("order_id"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("order_no")), status)
    return target.read()


# ---- PRM-5: the card orders' steps, stopped after the second and resumed -----------


class Stopped(Exception):
    """The flow was stopped on purpose."""


def card_order_flow(spark: SparkSession, base: str, run_id: str, target: str, stop_after: str | None = None) -> DataFrame:
    """Load -> 7a order numbers -> 7b/7c stores -> 8 trimmed numbers, one journaled step each."""
    flow = Flow(spark, "card-orders", run_id)

    def loaded() -> DataFrame:
        j = load(spark, base, "orders").join(load(spark, base, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        rows = j.select(
            F.col("o_orderkey").alias("order_id"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("order_no"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("store_id"),
        )
        return with_defaults(rows, CARD_ORDER_LAYOUT)

    steps = {
        "load": lambda _: loaded(),
        "numbers": lambda t: fill_null(t, "order_no", keyed_token("order_id", salt=SALT_ORDER_NO, length=ORDER_NO_TOKEN_LENGTH)),
        "stores": lambda t: fill_from_key(t, "store_id", "order_id", STORE_FILL_RULES),
        "trim": lambda t: trim_prefix(t, "order_no"),
    }
    table = None
    for name, make in steps.items():
        table = flow.step(name, lambda make=make, table=table: make(table))
        if name == stop_after:
            raise Stopped(name)
    return flow.finish({target: table})[target]


@check("q_flow_resumed", _SQL_CARD_ORDERS, ("PRM-5", "UPD-2", "UPD-6", "UPD-8", "SNK-1"))
def q_flow_resumed(spark: SparkSession, base: str) -> DataFrame:
    run_id, target = uuid.uuid4().hex, scratch_path(spark, "card-orders")
    try:
        card_order_flow(spark, base, run_id, target, stop_after="numbers")
    except Stopped:
        pass
    return card_order_flow(spark, base, run_id, target)


# ---- DQ-1..7: order lines through a gate --------------------------------------------
# Check parameters: the longest flag, the highest discount, the type of parts that are not in the catalogue.
MAX_FLAG, MAX_DISCOUNT, MISSING_TYPE = 1, "0.09", "S%"


def gated_lines(spark: SparkSession, base: str) -> Gated:
    """Order lines against a catalogue that lacks a third of the parts; a line's flags are ``returned/status``."""
    li, p = load(spark, base, "lineitem"), load(spark, base, "part")
    lines = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_linestatus") == "F", "final").otherwise("O").alias("status"), M.money("l_discount").alias("discount"),
    )
    return gate(lines, Constraints(
        not_null=["flag"], max_length={"status": MAX_FLAG}, checks={"discount": F.col("discount") <= F.lit(MAX_DISCOUNT).cast(M.MONEY)},
        primary=["l_orderkey", "l_linenumber"], foreign=[(["l_partkey"], p.filter(not_like("p_type", MISSING_TYPE)), ["p_partkey"])],
    ))


_SQL_GATED = f"""
    WITH lines AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag,
                          CASE WHEN l_linestatus = 'F' THEN 'final' ELSE 'O' END AS status, {S.money('l_discount')} AS discount FROM lineitem),
    catalogue AS (SELECT DISTINCT p_partkey FROM part WHERE p_type NOT LIKE 'S%'),
    broken AS (SELECT lines.*,
                 CASE WHEN discount > 0.09 THEN 'check:discount' END AS r1,
                 CASE WHEN l_partkey IS NOT NULL AND p_partkey IS NULL THEN 'foreign:l_partkey' END AS r2,
                 CASE WHEN length(status) > 1 THEN 'length:status' END AS r3,
                 CASE WHEN flag IS NULL THEN 'not_null:flag' END AS r4,
                 CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' END AS r5,
                 CASE WHEN l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'primary:l_orderkey,l_linenumber' END AS r6
               FROM lines LEFT JOIN catalogue ON l_partkey = p_partkey),
    judged AS (SELECT *, concat_ws(' ', r1, r2, r3, r4, r5, r6) AS reasons FROM broken)"""


@check(
    "q_load_gate",
    _SQL_GATED + " SELECT l_orderkey, l_linenumber, l_partkey, flag, status, discount, reasons FROM judged WHERE reasons <> ''",
    ("DQ-1", "DQ-2", "DQ-3", "DQ-5", "DQ-6", "DQ-7"),
)
def q_load_gate(spark: SparkSession, base: str) -> DataFrame:
    """The rejected lines, each with all of its reasons."""
    return gated_lines(spark, base).rejected.withColumn("reasons", F.array_join("reasons", " "))


@check(
    "q_load_gate_accepted",
    _SQL_GATED + " SELECT l_orderkey, l_linenumber, l_partkey, flag, status, discount FROM judged WHERE reasons = ''",
    ("DQ-2", "DQ-3", "DQ-5", "DQ-6", "DQ-7"),
)
def q_load_gate_accepted(spark: SparkSession, base: str) -> DataFrame:
    return gated_lines(spark, base).accepted


# ---- UPD-1, UPD-2, UPD-8, DEL-1: a stored table changed in the partitions that a rule touches --


@check(
    "q_change_set",
    f"""WITH filled AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN COALESCE(no, 'none given') ELSE no END AS no
                        FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END AS no FROM orders))
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'P' AND {S.tsql_len('no')} < 25 THEN substr(no, 3, 22) ELSE no END AS no
        FROM filled WHERE NOT COALESCE(o_orderstatus = 'F' AND no LIKE '5%', FALSE)""",
    ("UPD-1", "UPD-2", "UPD-8", "DEL-1"),
)
def q_change_set(spark: SparkSession, base: str) -> DataFrame:
    """Orders stored by status: numbers of one status are filled and trimmed, some of another deleted, the third stays as it is."""
    o = load(spark, base, "orders")
    path = scratch_path(spark, "orders-by-status")
    rows = o.select("o_orderkey", F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderpriority")).alias("no"), "o_orderstatus")
    schema = write_partitioned(rows, path, "o_orderstatus")
    table = read_partitioned(spark, path, schema)
    part = F.col("o_orderstatus") == "P"

    def rule(df: DataFrame) -> DataFrame:
        df = update(df, part, {"no": F.coalesce("no", F.lit("none given"))})
        return update(df, part & (tsql_len("no") < TRIM_BELOW), {"no": tsql_substring("no", TRIM_START, TRIM_LENGTH)})

    gone = (F.col("o_orderstatus") == "F") & F.col("no").like("5%")
    apply_changes(spark, path, schema, change_set(table, "o_orderstatus", rule, delete=gone, repeated_keys=["o_orderkey"]), ["o_orderkey"], "o_orderstatus")
    return read_partitioned(spark, path, schema)


# ---- PRM-4, AGG-1, AGG-4, AGG-6: a view maintained over three loads ------------------


@check(
    "q_view_maintained",
    f"""SELECT l_suppkey, SUM({S.money('l_extendedprice')}) AS total, COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned,
               CAST(MIN(l_shipdate) AS DATE) AS first_ship, CAST(MAX(l_shipdate) AS DATE) AS last_ship
        FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY l_suppkey""",
    ("PRM-4", "AGG-1", "AGG-4", "AGG-6", "SNK-1"),
)
def q_view_maintained(spark: SparkSession, base: str) -> DataFrame:
    """Totals a supplier, folded from three loads, one of them rerun, and merged for good after the second."""
    li = load(spark, base, "lineitem").select(
        "l_suppkey", "l_returnflag", M.money("l_extendedprice").alias("value"), F.when(F.col("l_returnflag") == "R", 1).alias("returned"), as_date("l_shipdate").alias("ship")
    )
    measures = {"total": ("sum", "value"), "n_returned": ("count", "returned"), "first_ship": ("min", "ship"), "last_ship": ("max", "ship")}
    view = MaintainedView(spark, scratch_path(spark, "supplier-view"), li, ["l_suppkey"], measures)
    for flag in ("A", "N", "A", "R"):
        view.load(li.filter(F.col("l_returnflag") == flag), flag)
        if flag == "N":
            view.fold("after N")
    return view.read()


# ---- JOIN-4, JOIN-6: a left join whose null-supplying side has a hot key --------------
# Check parameters: what counts as heavy, and how many rows a part of a heavy key has.
HEAVY_SHARE, PART_ROWS = 0.01, 2_000


@check(
    "q_heavy_left_join",
    """SELECT c_custkey AS client_id, c_name, o_orderkey, o_orderpriority
       FROM customer LEFT JOIN (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS client FROM orders) ON c_custkey = client""",
    ("JOIN-4", "JOIN-6"),
)
def q_heavy_left_join(spark: SparkSession, base: str) -> DataFrame:
    """One client has a third of all orders, on the side that supplies the nulls."""
    c = load(spark, base, "customer").select(F.col("c_custkey").alias("client_id"), "c_name")
    client = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")).cast("long")
    o = load(spark, base, "orders").select(client.alias("client_id"), "o_orderkey", "o_orderpriority")
    return heavy_join(c, o, ["client_id"], "left", share=HEAVY_SHARE, rows_per_part=PART_ROWS)


# ---- DQ-1, DQ-4: keys that come again in a later load ---------------------------------


@check(
    "q_keys_across_loads",
    """SELECT DISTINCT o_custkey AS client_id FROM orders
       WHERE o_orderstatus = 'P' AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_custkey IS NOT NULL)""",
    ("DQ-1", "DQ-4"),
)
def q_keys_across_loads(spark: SparkSession, base: str) -> DataFrame:
    """Clients of the third load of orders that the first two had."""
    o = load(spark, base, "orders").select("o_orderstatus", F.col("o_custkey").alias("client_id"))
    layout = o.select("client_id").schema
    known = KnownKeys(spark, scratch_path(spark, "known-clients"), layout, blocks_for(o.count()))
    for status in ("F", "O"):
        known.add(o.filter(F.col("o_orderstatus") == status).select("client_id"), status)
    return known.repeated(o.filter(F.col("o_orderstatus") == "P").select("client_id"))


# ---- DQ-3: orphans found by blocks of keys --------------------------------------------


@check(
    "q_dq_fk_blocks",
    """SELECT l_partkey, COUNT(*) AS n_rows FROM lineitem
       WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type NOT LIKE 'S%' AND p_partkey IS NOT NULL)
       GROUP BY l_partkey""",
    ("DQ-3",),
)
def q_dq_fk_blocks(spark: SparkSession, base: str) -> DataFrame:
    """Order lines whose part is not in a catalogue without the parts of some types."""
    catalogue = load(spark, base, "part").filter(not_like("p_type", MISSING_TYPE))
    return fk_violations_by_blocks(load(spark, base, "lineitem"), "l_partkey", catalogue, "p_partkey")


# ---- SRT-1, SRT-2: a table that keeps its order ------------------------------------------


@check(
    "q_ordered_table",
    """SELECT priority, ordered, order_id, row_number() OVER (ORDER BY priority NULLS FIRST, ordered NULLS FIRST, order_id NULLS FIRST) AS position
       FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE o_orderpriority END AS priority, CAST(o_orderdate AS DATE) AS ordered, o_orderkey AS order_id FROM orders)""",
    ("SRT-1", "SRT-2"),
)
def q_ordered_table(spark: SparkSession, base: str) -> DataFrame:
    """Orders stored by priority (a third share one) and day, and read back with their places, without a sort."""
    o = load(spark, base, "orders")
    rows = o.select(F.when(F.col("o_orderkey") % 3 == 0, "hot").otherwise(F.col("o_orderpriority")).alias("priority"), as_date("o_orderdate").alias("ordered"), F.col("o_orderkey").alias("order_id"))
    path = scratch_path(spark, "orders-in-order")
    return ordered.read_positions(spark, path, ordered.write_ordered(rows, path, ["priority", "ordered"]))
