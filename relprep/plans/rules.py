"""Rule-driven updates, deletes, tokens and optional-parameter search
(UPD-*, DEL-1, STR-*, FLT-5/9/10/11, JOIN-6, PRM-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relprep.fixed import (
    CARD_DIGITS_KEPT,
    CODE_CHECK_LENGTH,
    CODE_LENGTH,
    CODE_TOKEN_LENGTH,
    MAIL_DOMAIN,
    MAIL_PASSWORD_LENGTH,
    MAIL_PASSWORD_START,
    MASK_FIRST_DIGITS,
    MIN_PRODUCTS,
    MISSING_TITLE,
    ORDER_NO_TOKEN_LENGTH,
    SHORT_CODE_LENGTH,
    STORE_FILL_RULES,
    TRIM_BELOW,
    TRIM_LENGTH,
    TRIM_START,
)
from relprep.functions import money as M
from relprep.functions.predicates import all_of, like, not_like
from relprep.functions.text import concat_strict, date_text, keyed_token, password_token, right, tsql_len, tsql_substring
from relprep.operators.joins import left_join_default, lookup_key
from relprep.operators.keys import with_identity
from relprep.operators.quality import check_violations
from relprep.operators.search import any_match, procedure, sql_procedure
from relprep.operators.updates import (
    add_column,
    delete_where,
    email_rule,
    evidence_number,
    fill_from_key,
    fill_null,
    mask_by_prefix,
    reverse_code,
    shorten_code,
    supplier_web,
    trim_prefix,
    update,
)
from relprep.plans import sqlfrag as S
from relprep.plans.common import catalog, postcode
from relprep.plans.registry import check
from relprep.operators.sorting import sort_report
from relprep.sources.sinks import stage
from relprep.sources.tables import load

# Salts of the keyed tokens that stand in for NEWID().
SALT_PASSWORD = "password"
SALT_EVIDENCE = "evidence"
SALT_CODE = "code"
SALT_SHORT = "short"
SALT_MASK = "mask"
SALT_ORDER_NO = "order-no"

# ---- STR-7 / STR-8 / STR-12: GUID-shaped keyed tokens ------------------------


@check(
    "q_random_token",
    f"""SELECT o_orderkey,
               {S.token('o_orderkey', salt=SALT_MASK, length=16)} AS token_16,
               {S.token('o_orderkey', salt=SALT_MASK, length=24)} AS token_24,
               {S.token('o_orderkey', salt=SALT_MASK, length=25)} AS token_25,
               {S.token('o_orderkey', salt=SALT_MASK, length=30)} AS token_30,
               {S.password('o_orderkey', salt=SALT_PASSWORD)} AS password
        FROM orders""",
    ("STR-12", "STR-7", "STR-8"),
)
def q_random_token(spark: SparkSession, base: str) -> DataFrame:
    o = load(spark, base, "orders").select("o_orderkey")
    return o.select(
        "o_orderkey",
        *[keyed_token("o_orderkey", salt=SALT_MASK, length=n).alias(f"token_{n}") for n in (16, 24, 25, 30)],
        password_token("o_orderkey", salt=SALT_PASSWORD).alias("password"),
    )


# ---- JOIN-6 / STR-15 / SNK-4 / SRT-1: contact sheet with optional cards -----------
# Check parameter: order value above which an order counts as a "card".
CARD_ORDER_VALUE = 400_000


_SQL_CARDS = "(SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS card_date FROM lineitem GROUP BY l_orderkey)"


def contact_sheet(spark: SparkSession, base: str) -> DataFrame:
    c = load(spark, base, "customer")
    n = load(spark, base, "nation")
    o = load(spark, base, "orders").filter(F.col("o_totalprice") > CARD_ORDER_VALUE)
    # The "card" behind the optional link: one row per order (last ship date).
    # Only lines of the orders kept above are read into it.
    cards = (
        load(spark, base, "lineitem")
        .join(o.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
        .groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("card_date"))
    )
    first = F.substring_index("c_name", "#", 1)
    last = F.substring_index("c_name", "#", -1)
    # The optional side in two parts: clients with such orders (orders on the
    # left, so a client with a third of them is split) and clients without.
    clients = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "c_name", "n_name")
    held = o.select("o_custkey", "o_orderkey", "o_orderstatus").join(cards, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    with_card = held.join(clients, F.col("o_custkey") == F.col("c_custkey"))
    without = clients.join(o.select("o_custkey").distinct(), F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    j = with_card.drop("o_custkey").unionByName(without, allowMissingColumns=True)
    return j.select(
        F.coalesce(F.col("o_orderstatus"), F.lit(MISSING_TITLE)).alias("title"),
        last.alias("last_name"),
        first.alias("first_name"),
        F.col("n_name").alias("nation"),
        F.col("o_orderkey").alias("card_number"),
        F.col("card_date"),
        concat_strict(first, ".", last).alias("username"),
        password_token("c_custkey", "o_orderkey", salt=SALT_PASSWORD).alias("password"),
    )


@check(
    "q_contact_sheet",
    f"""SELECT COALESCE(o.o_orderstatus, 'N/A') AS title, split_part(c_name, '#', 2) AS last_name,
               split_part(c_name, '#', 1) AS first_name, n_name AS nation, o.o_orderkey AS card_number,
               card_date,
               split_part(c_name, '#', 1) || '.' || split_part(c_name, '#', 2) AS username,
               {S.password('c_custkey', 'o.o_orderkey', salt=SALT_PASSWORD)} AS password
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > {CARD_ORDER_VALUE}) o ON c_custkey = o.o_custkey
        LEFT JOIN {_SQL_CARDS} cards ON o.o_orderkey = cards.l_orderkey""",
    ("JOIN-6", "STR-15", "STR-7", "STR-8"),
)
def q_contact_sheet(spark: SparkSession, base: str) -> DataFrame:
    return contact_sheet(spark, base)


@check(
    "q_contact_sheet_sorted",
    f"""SELECT last_name, first_name, card_number,
               row_number() OVER (ORDER BY last_name NULLS FIRST, first_name NULLS FIRST, card_number NULLS FIRST) AS position
        FROM (SELECT split_part(c_name, '#', 2) AS last_name, split_part(c_name, '#', 1) AS first_name, o.o_orderkey AS card_number
              FROM customer JOIN nation ON c_nationkey = n_nationkey
              LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > {CARD_ORDER_VALUE}) o ON c_custkey = o.o_custkey)""",
    ("SRT-1", "SNK-4", "JOIN-6"),
)
def q_contact_sheet_sorted(spark: SparkSession, base: str) -> DataFrame:
    """The sheet staged in name order: a table keeps no order, so each row carries its position."""
    sheet = contact_sheet(spark, base).select("last_name", "first_name", "card_number")
    # The numbered rows come from a written table already.
    return stage(with_identity(sheet, ["last_name", "first_name"], "position"), "contact_sheet_sorted")


@check(
    "q_contact_sheet_filtered",
    f"""SELECT * FROM (
          SELECT COALESCE(o.o_orderstatus, 'N/A') AS title, split_part(c_name, '#', 2) AS last_name,
                 split_part(c_name, '#', 1) AS first_name, n_name AS nation, o.o_orderkey AS card_number,
                 card_date,
                 split_part(c_name, '#', 1) || '.' || split_part(c_name, '#', 2) AS username,
                 {S.password('c_custkey', 'o.o_orderkey', salt=SALT_PASSWORD)} AS password
          FROM customer JOIN nation ON c_nationkey = n_nationkey
          LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > {CARD_ORDER_VALUE}) o ON c_custkey = o.o_custkey
          LEFT JOIN {_SQL_CARDS} cards ON o.o_orderkey = cards.l_orderkey)
        WHERE last_name LIKE '%5%' AND nation NOT LIKE 'NATION_1%' AND password NOT LIKE 'a%'""",
    ("FLT-7", "FLT-9", "SNK-4"),
)
def q_contact_sheet_filtered(spark: SparkSession, base: str) -> DataFrame:
    """The query the covering index served: pattern filters on the staged sheet (#temp table)."""
    sheet = stage(contact_sheet(spark, base), "contact_sheet", deterministic=False)  # written, as #temp tables are
    return sheet.filter(all_of(like("last_name", "%5%"), not_like("nation", "NATION_1%"), not_like("password", "a%")))


@check(
    "q_contact_docs",
    f"""SELECT documents.doc_id, lang, COALESCE(CAST(quality AS VARCHAR), 'N/A') AS quality_label
       FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id""",
    ("JOIN-6", "STR-15"),
)
def q_contact_docs(spark: SparkSession, base: str) -> DataFrame:
    d = load(spark, base, "documents").select("doc_id", "lang")
    lab = load(spark, base, "labels").select("doc_id", F.col("quality").cast("string").alias("quality_label"))
    return left_join_default(d, lab, "doc_id", {"quality_label": MISSING_TITLE})


# ---- DEL-1 / FLT-6: deletes on a left-joined stage ----------------------------------


def _docs_with_labels(spark: SparkSession, base: str) -> DataFrame:
    d = load(spark, base, "documents").select("doc_id", "lang", "source")
    lab = load(spark, base, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left")


_SQL_DOCS_LABELS = """SELECT documents.doc_id, lang, source, quality
    FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id"""


@check(
    "q_delete_unlabelled",
    f"SELECT * FROM ({_SQL_DOCS_LABELS}) WHERE NOT (quality IS NULL)",
    ("DEL-1", "FLT-6"),
)
def q_delete_unlabelled(spark: SparkSession, base: str) -> DataFrame:
    return delete_where(_docs_with_labels(spark, base), F.col("quality").isNull())


@check(
    "q_delete_labelled",
    f"SELECT * FROM ({_SQL_DOCS_LABELS}) WHERE NOT (quality IS NOT NULL)",
    ("DEL-1", "FLT-6"),
)
def q_delete_labelled(spark: SparkSession, base: str) -> DataFrame:
    return delete_where(_docs_with_labels(spark, base), F.col("quality").isNotNull())


# ---- UPD-3 / STR-14: evidence number from ship and order dates ------------------------

_SQL_SHIPPED = """
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
           CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(max(l_shipdate) AS DATE) END AS ship_date
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY o_orderkey, o_orderdate, o_orderstatus"""


def shipped_orders(spark: SparkSession, base: str) -> DataFrame:
    """All orders with a ship date (last line shipped); open orders, and orders
    without lines, are not shipped (NULL)."""
    li = load(spark, base, "lineitem")
    last_ship = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_ship"))
    o = load(spark, base, "orders")
    j = o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(F.col("o_orderstatus") != "O", F.col("_ship").cast("date")).alias("ship_date"),
    )


@check(
    "q_evidence_number",
    f"""SELECT order_id, order_date, ship_date,
               CASE WHEN ship_date IS NULL THEN {S.token('order_id', salt=SALT_EVIDENCE, length=30)}
                    ELSE strftime(ship_date, '%Y-%m-%d') || '-' || strftime(order_date, '%Y-%m-%d') END AS evidence_no
        FROM ({_SQL_SHIPPED})""",
    ("UPD-3", "STR-14", "PRJ-4", "FLT-6"),
)
def q_evidence_number(spark: SparkSession, base: str) -> DataFrame:
    o = add_column(shipped_orders(spark, base), "evidence_no", "string")
    return evidence_number(o, "evidence_no", "ship_date", "order_date", "order_id", SALT_EVIDENCE)


# ---- UPD-4 / UPD-11 / STR-9: reversed codes and their shortening ------------------------

_SQL_CATALOG_CODES = f"""
    SELECT p_partkey AS product_id, s_suppkey AS supplier_id, p_type AS unit,
           {S.postcode('s_suppkey')} AS postcode
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) pairs
    JOIN part ON pairs.l_partkey = p_partkey JOIN supplier ON pairs.l_suppkey = s_suppkey"""


def _sql_code() -> str:
    return f"""
    SELECT product_id, supplier_id, unit, postcode,
           CASE WHEN NOT regexp_matches(postcode, '[A-Za-z]') THEN reverse(right(unit, 4) || postcode)
                WHEN regexp_matches(postcode, '[A-Za-z]')
                     THEN reverse({S.token('product_id', 'supplier_id', salt=SALT_CODE, length=20)}) END AS code
    FROM ({_SQL_CATALOG_CODES})"""


def catalog_codes(spark: SparkSession, base: str) -> DataFrame:
    """Catalog rows with a supplier postcode and the code rule applied (UPD-4)."""
    cat = catalog(spark, base).select("product_id", "supplier_id", "unit").withColumn("postcode", postcode("supplier_id"))
    cat = add_column(cat, "code", "string")
    return reverse_code(cat, "code", "postcode", "unit", ["product_id", "supplier_id"], SALT_CODE)


@check("q_reverse_code", _sql_code(), ("UPD-4", "STR-9", "STR-3", "FLT-8", "PRJ-4"))
def q_reverse_code(spark: SparkSession, base: str) -> DataFrame:
    return catalog_codes(spark, base).select("product_id", "supplier_id", "unit", "postcode", "code")


@check(
    "q_shorten_code",
    f"""SELECT product_id, supplier_id,
               CASE WHEN {S.tsql_len('code')} = 20
                    THEN {S.token('product_id', 'supplier_id', salt=SALT_SHORT, length=4)}
                    ELSE code END AS code
        FROM ({_sql_code()})""",
    ("UPD-11", "STR-6"),
)
def q_shorten_code(spark: SparkSession, base: str) -> DataFrame:
    coded = catalog_codes(spark, base)
    return shorten_code(coded, "code", ["product_id", "supplier_id"], SALT_SHORT).select("product_id", "supplier_id", "code")


# ---- UPD-9 / STR-11: web address from the first word --------------------------------


@check(
    "q_web_address",
    "SELECT p_partkey AS product_id, p_name, 'www.' || split_part(p_name, ' ', 1) || '.com' AS web FROM part",
    ("UPD-9", "STR-11", "STR-10"),
)
def q_web_address(spark: SparkSession, base: str) -> DataFrame:
    p = load(spark, base, "part").select(F.col("p_partkey").alias("product_id"), "p_name")
    return supplier_web(p, "web", "p_name")


# ---- UPD-1 / UPD-10 / PRM-5: two e-mail layouts by city ----------------------------
# The two cities of the e-mail rule (the mail domain is a fixed value).
MAIL_CITY_A, MAIL_CITY_B = "NATION_3", "NATION_7"


@check(
    "q_email_rule",
    f"""SELECT c_custkey, c_nationkey,
               CASE WHEN c_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = '{MAIL_CITY_A}')
                         THEN split_part(c_name, '#', 1) || '.' || split_part(c_name, '#', 2) || '@fit.ba'
                    WHEN c_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = '{MAIL_CITY_B}')
                         THEN split_part(c_name, '#', 2) || '.' || split_part(c_name, '#', 1) || '@fit.ba'
               END AS email
        FROM customer""",
    ("UPD-1", "UPD-10", "PRM-5", "JOIN-7"),
)
def q_email_rule(spark: SparkSession, base: str) -> DataFrame:
    c = load(spark, base, "customer").select(
        "c_custkey", "c_nationkey",
        F.substring_index("c_name", "#", 1).alias("_first"), F.substring_index("c_name", "#", -1).alias("_last"),
    )
    n = load(spark, base, "nation")
    c = add_column(c, "email", "string")
    out = c.transform(
        lambda df: email_rule(
            df, "email", "c_nationkey",
            lookup_key(n, "n_name", MAIL_CITY_A, "n_nationkey"), lookup_key(n, "n_name", MAIL_CITY_B, "n_nationkey"),
            "_first", "_last", MAIL_DOMAIN,
        )
    )
    return out.select("c_custkey", "c_nationkey", "email")


# ---- UPD-7 / FLT-5 / STR-2: mask values by first character -------------------------


@check(
    "q_mask_by_prefix",
    f"""SELECT o_orderkey,
               CASE WHEN left(o_orderpriority, 1) IN ('1', '3')
                    THEN {S.token('o_orderkey', salt=SALT_MASK, length=25)} ELSE o_orderpriority END AS order_no
        FROM orders""",
    ("UPD-7", "FLT-5", "STR-2", "CST-1"),
)
def q_mask_by_prefix(spark: SparkSession, base: str) -> DataFrame:
    o = load(spark, base, "orders").select("o_orderkey", F.col("o_orderpriority").alias("order_no"))
    return mask_by_prefix(o, "order_no", MASK_FIRST_DIGITS, "o_orderkey", SALT_MASK)


# ---- UPD-2 / UPD-6 / UPD-8: ordered fill, fill-from-key, trim ------------------------------

_SQL_STORES = """
    SELECT o_orderkey, o_orderpriority,
           CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS store_id
    FROM orders JOIN customer ON o_custkey = c_custkey"""


def orders_with_store(spark: SparkSession, base: str) -> DataFrame:
    """Orders with a nullable store id (clients with a negative balance have none)."""
    o = load(spark, base, "orders")
    c = load(spark, base, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select("o_orderkey", "o_orderpriority", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("long")).alias("store_id"))


@check(
    "q_fill_from_key",
    f"""SELECT o_orderkey,
               {S.fill_from_key_case('store_id', 'o_orderkey')} AS store_id
        FROM ({_SQL_STORES})""",
    ("UPD-6", "STR-3", "STR-2", "CST-1"),
)
def q_fill_from_key(spark: SparkSession, base: str) -> DataFrame:
    o = orders_with_store(spark, base).select("o_orderkey", "store_id")
    return fill_from_key(o, "store_id", "o_orderkey", STORE_FILL_RULES)


@check(
    "q_trim_prefix",
    f"""WITH masked AS (
          SELECT o_orderkey,
                 CASE WHEN left(o_orderpriority, 1) IN ('1', '3')
                      THEN {S.token('o_orderkey', salt=SALT_MASK, length=25)} ELSE o_orderpriority END AS order_no
          FROM orders),
        filled AS (
          SELECT o_orderkey, COALESCE(order_no, {S.token('o_orderkey', salt=SALT_ORDER_NO, length=25)}) AS order_no
          FROM masked)
        SELECT o_orderkey,
               CASE WHEN {S.tsql_len('order_no')} < 25 THEN substr(order_no, 3, 22)
                    ELSE order_no END AS order_no
        FROM filled""",
    ("UPD-8", "UPD-2", "STR-4", "PRM-5"),
)
def q_trim_prefix(spark: SparkSession, base: str) -> DataFrame:
    o = load(spark, base, "orders").select("o_orderkey", F.col("o_orderpriority").alias("order_no"))
    return (
        o.transform(lambda df: mask_by_prefix(df, "order_no", MASK_FIRST_DIGITS, "o_orderkey", SALT_MASK))
        .transform(lambda df: fill_null(df, "order_no", keyed_token("o_orderkey", salt=SALT_ORDER_NO, length=ORDER_NO_TOKEN_LENGTH)))
        .transform(lambda df: trim_prefix(df, "order_no"))
    )


# ---- FLT-10 / PRM-1 / PRM-2: optional-parameter search ----------------------------------
# Check parameters: the arguments of the procedure calls.
SEARCH_CATEGORY = "Brand#13"
SEARCH_ORDER, SEARCH_PRICE = 7, "901.0"

_SQL_LINES_VIEW = f"""
    SELECT l_orderkey AS order_id, l_partkey AS product_id, p_brand AS category,
           {S.money('p_retailprice')} AS unit_price, {S.money('l_extendedprice')} AS line_total
    FROM lineitem JOIN part ON l_partkey = p_partkey"""


def lines_view(spark: SparkSession, base: str) -> DataFrame:
    li = load(spark, base, "lineitem")
    p = load(spark, base, "part")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("p_brand").alias("category"), M.money("p_retailprice").alias("unit_price"),
        M.money("l_extendedprice").alias("line_total"),
    )


_LINE_COLUMNS = ["order_id", "product_id", "category", "unit_price", "line_total"]


@check(
    "q_optional_params",
    f"SELECT * FROM ({_SQL_LINES_VIEW}) WHERE category = '{SEARCH_CATEGORY}'",
    ("FLT-10", "PRM-1", "PRM-2"),
)
def q_optional_params(spark: SparkSession, base: str) -> DataFrame:
    search = procedure(lines_view(spark, base), _LINE_COLUMNS)
    return search(category=SEARCH_CATEGORY)


@check(
    "q_optional_params_two",
    f"SELECT * FROM ({_SQL_LINES_VIEW}) WHERE order_id = {SEARCH_ORDER} OR unit_price = {SEARCH_PRICE}",
    ("FLT-10", "FLT-9", "PRM-1", "PRM-2"),
)
def q_optional_params_two(spark: SparkSession, base: str) -> DataFrame:
    search = procedure(lines_view(spark, base), _LINE_COLUMNS)
    return search(order_id=SEARCH_ORDER, unit_price=M.money(F.lit(SEARCH_PRICE)))


@check(
    "q_optional_params_none",
    f"SELECT * FROM ({_SQL_LINES_VIEW}) WHERE false",
    ("FLT-10",),
)
def q_optional_params_none(spark: SparkSession, base: str) -> DataFrame:
    search = procedure(lines_view(spark, base), _LINE_COLUMNS)
    return search()


@check(
    "q_optional_params_sql",
    f"SELECT * FROM ({_SQL_LINES_VIEW}) WHERE category = '{SEARCH_CATEGORY}'",
    ("FLT-10", "PRM-1", "PRM-2"),
)
def q_optional_params_sql(spark: SparkSession, base: str) -> DataFrame:
    """The same procedure as a SQL table function called with a named argument."""
    fn = sql_procedure(lines_view(spark, base), "proc_lines", _LINE_COLUMNS)
    return spark.sql(f"SELECT * FROM {fn}(p_category => :category)", args={"category": SEARCH_CATEGORY})


# ---- FLT-11 / FLT-9: guarded optional-parameter search -------------------------------
# Check parameters: the guard character and the two arguments.
GUARD_CHAR, SEARCH_LANG, SEARCH_SOURCE = "(", "fr", "src7"


@check(
    "q_optional_params_guarded",
    f"""SELECT doc_id, lang, source, n_chars FROM documents
        WHERE text LIKE '%{GUARD_CHAR}%' AND (lang = '{SEARCH_LANG}' OR source = '{SEARCH_SOURCE}')""",
    ("FLT-11", "FLT-9", "FLT-7"),
)
def q_optional_params_guarded(spark: SparkSession, base: str) -> DataFrame:
    d = load(spark, base, "documents")
    guard = like("text", f"%{GUARD_CHAR}%")
    return any_match(d, {"doc_id": None, "lang": SEARCH_LANG, "source": SEARCH_SOURCE}, guard).select(
        "doc_id", "lang", "source", "n_chars"
    )


# ---- UPD-11 / UPD-7 (suffix form) / FLT-15 / AGG-10: employee codes ---------------
# Employee -> client, employee city -> the client's nation, hire date -> order date.
# Check parameters: the city suffix whose codes are replaced, and the token salts.
CODE_CITY_SUFFIX = "7"
SALT_EMPLOYEE_CODE = "employee-code"
SALT_EMPLOYEE_SHORT = "employee-short"

_SQL_EMPLOYEE_CODES = f"""
    SELECT order_id, employee,
           CASE WHEN city LIKE '%{CODE_CITY_SUFFIX}' THEN {S.token('order_id', salt=SALT_EMPLOYEE_CODE, length=20)}
                ELSE code END AS code
    FROM (SELECT o_orderkey AS order_id, c_name AS employee, n_name AS city,
                 reverse(n_name || ' ' || left(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 10)) AS code
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def employee_codes(spark: SparkSession, base: str) -> DataFrame:
    """Code = REVERSE(city + ' ' + LEFT(hire date, 10)); codes of cities ending
    in the suffix are then replaced by a 20-character token (UPD-11, UPD-7)."""
    o = load(spark, base, "orders")
    c = load(spark, base, "customer")
    n = load(spark, base, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    coded = j.select(
        F.col("o_orderkey").alias("order_id"), F.col("c_name").alias("employee"), F.col("n_name").alias("city"),
        F.reverse(concat_strict(F.col("n_name"), " ", F.left(date_text("o_orderdate"), F.lit(10)))).alias("code"),
    )
    masked = update(coded, like("city", f"%{CODE_CITY_SUFFIX}"),
                    {"code": keyed_token("order_id", salt=SALT_EMPLOYEE_CODE, length=CODE_TOKEN_LENGTH)})
    return masked.drop("city")


@check("q_employee_code", _SQL_EMPLOYEE_CODES, ("UPD-11", "UPD-7", "STR-9", "STR-14", "FLT-7"))
def q_employee_code(spark: SparkSession, base: str) -> DataFrame:
    return employee_codes(spark, base)


@check(
    "q_employee_code_counts",
    f"""SELECT employee, code, COUNT(p_name) AS n_products
        FROM ({_SQL_EMPLOYEE_CODES}) e JOIN lineitem ON e.order_id = l_orderkey JOIN part ON l_partkey = p_partkey
        WHERE {S.tsql_len('code')} = 20
        GROUP BY employee, code HAVING COUNT(p_name) > 2 ORDER BY n_products DESC""",
    ("AGG-10", "FLT-15", "SRT-2", "JOIN-3"),
)
def q_employee_code_counts(spark: SparkSession, base: str) -> DataFrame:
    """Per employee and 20-character code, the number of products ordered (> 2)."""
    codes = employee_codes(spark, base).filter(tsql_len("code") == CODE_LENGTH)
    li = load(spark, base, "lineitem")
    p = load(spark, base, "part")
    # Only lines of the kept codes' orders are joined with their product and counted.
    li = li.join(codes.select("order_id").distinct(), F.col("l_orderkey") == F.col("order_id"), "left_semi")
    per_order = li.join(p, li.l_partkey == p.p_partkey).groupBy("l_orderkey").agg(F.count("p_name").alias("_n"))
    j = codes.join(per_order, codes.order_id == per_order.l_orderkey)
    out = j.groupBy("employee", "code").agg(F.sum("_n").alias("n_products")).filter(F.col("n_products") > MIN_PRODUCTS)
    return sort_report(out, F.desc("n_products"), unique=["employee", "code"])


@check(
    "q_employee_code_short",
    f"""SELECT order_id, employee,
               CASE WHEN {S.tsql_len('code')} = 20
                    THEN {S.token('order_id', salt=SALT_EMPLOYEE_SHORT, length=4)}
                    ELSE code END AS code
        FROM ({_SQL_EMPLOYEE_CODES})""",
    ("UPD-11", "STR-6"),
)
def q_employee_code_short(spark: SparkSession, base: str) -> DataFrame:
    return shorten_code(employee_codes(spark, base), "code", ["order_id"], SALT_EMPLOYEE_SHORT)


@check(
    "q_dq_employee_code_check",
    f"""SELECT order_id, employee, code FROM (
          SELECT order_id, employee, CASE WHEN {S.tsql_len('code')} = 20 THEN {S.token('order_id', salt=SALT_EMPLOYEE_SHORT, length=15)} ELSE code END AS code
          FROM ({_SQL_EMPLOYEE_CODES})) WHERE NOT ({S.tsql_len('code')} = 15)""",
    ("DQ-7", "UPD-11"),
)
def q_dq_employee_code_check(spark: SparkSession, base: str) -> DataFrame:
    """CHECK (LEN(code) = 15) once 20-character codes were cut to 15: other lengths violate, NULL passes."""
    cut = shorten_code(employee_codes(spark, base), "code", ["order_id"], SALT_EMPLOYEE_SHORT, to_len=CODE_CHECK_LENGTH)
    return check_violations(cut, tsql_len("code") == CODE_CHECK_LENGTH).select("order_id", "employee", "code")


# ---- DEL-1 on the staged contact sheet: people without a card are deleted -----------


@check(
    "q_contact_sheet_with_cards",
    f"""SELECT * FROM (
          SELECT COALESCE(o.o_orderstatus, 'N/A') AS title, split_part(c_name, '#', 2) AS last_name,
                 split_part(c_name, '#', 1) AS first_name, n_name AS nation, o.o_orderkey AS card_number,
                 card_date,
                 split_part(c_name, '#', 1) || '.' || split_part(c_name, '#', 2) AS username,
                 {S.password('c_custkey', 'o.o_orderkey', salt=SALT_PASSWORD)} AS password
          FROM customer JOIN nation ON c_nationkey = n_nationkey
          LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > {CARD_ORDER_VALUE}) o ON c_custkey = o.o_custkey
          LEFT JOIN {_SQL_CARDS} cards ON o.o_orderkey = cards.l_orderkey)
        WHERE NOT (card_number IS NULL)""",
    ("DEL-1", "FLT-6", "SNK-4", "JOIN-6"),
)
def q_contact_sheet_with_cards(spark: SparkSession, base: str) -> DataFrame:
    sheet = stage(contact_sheet(spark, base), "contact_sheet", deterministic=False)  # written, as #temp tables are
    return delete_where(sheet, F.col("card_number").isNull())


# ---- STR-3 / STR-4 / STR-6: card and mail view ------------------------------------
# Person -> client; card -> the client's orders above the card value (card number:
# the order key as 14 digits); mail password -> base64 of sha-256 of the name
# (44 characters, like a stored password hash); phone -> built from nation and key.


def card_mail_view(spark: SparkSession, base: str) -> DataFrame:
    c = load(spark, base, "customer")
    o = load(spark, base, "orders").filter(F.col("o_totalprice") > CARD_ORDER_VALUE)
    j = c.join(o, c.c_custkey == o.o_custkey)
    card = F.lpad(F.col("o_orderkey").cast("string"), 14, "0")
    mail_password = F.base64(F.unhex(F.sha2(F.col("c_name"), 256)))
    phone = concat_strict("1 (", F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), ") 500 555-",
                          F.lpad(right("c_custkey", 4), 4, "0"))
    return j.select(
        F.col("c_custkey").alias("person_id"),
        right(card, CARD_DIGITS_KEPT).alias("new_card_number"),
        tsql_substring(mail_password, MAIL_PASSWORD_START, MAIL_PASSWORD_LENGTH).alias("new_mail_password"),
        phone.alias("phone"),
        tsql_len(phone).alias("phone_length"),
    )


@check(
    "q_card_mail_view",
    f"""SELECT c_custkey AS person_id,
               right(lpad(CAST(o_orderkey AS VARCHAR), 14, '0'), 11) AS new_card_number,
               substr(to_base64(unhex(sha256(c_name))), 10, 34) AS new_mail_password,
               phone, {S.tsql_len('phone')} AS phone_length
        FROM (SELECT *, '1 (' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || ') 500 555-'
                        || lpad(right(CAST(c_custkey AS VARCHAR), 4), 4, '0') AS phone FROM customer) c
        JOIN orders ON c_custkey = o_custkey
        WHERE o_totalprice > {CARD_ORDER_VALUE}""",
    ("STR-3", "STR-4", "STR-6", "JOIN-1"),
)
def q_card_mail_view(spark: SparkSession, base: str) -> DataFrame:
    return card_mail_view(spark, base)
