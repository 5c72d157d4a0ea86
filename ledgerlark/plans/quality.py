"""Constraint checks over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import cents, count_rows, line_cents
from ledgerlark.operators import changes, quality
from ledgerlark.operators.quality import Check, ForeignKey, NotNull, Unique
from ledgerlark.operators.sets import union_all
from ledgerlark.plans.incoming import INCOMING_SQL, ORDER_RULES, incoming_orders, row_key
from ledgerlark.plans.joining import order_totals
from ledgerlark.plans.registry import query
from ledgerlark.sources.tables import CANCELLED, REFERENCES, STATUSES, TABLE_NAMES, Tables

_TABLE = "incoming_orders"


def _line_key() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


_LINE_KEY_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def _contract(kind: str, name: str, column: str, table: str = _TABLE, key: str = "seq") -> str:
    """The SELECT list every check returns."""
    return f"""SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS row_key,
        '{kind}' AS rule_kind, '{name}' AS rule_name, '{column}' AS column_name,
        '{kind} failed: {name}' AS message"""


@query(INCOMING_SQL + " UNION ALL ".join(
    f"{_contract('NOT NULL', f'nn_{column}', column)} FROM incoming WHERE {column} IS NULL"
    for column in ("customer_id", "status")
))
def dq_not_null(t: Tables) -> DataFrame:
    """Required columns that are missing."""
    rules = [rule for rule in ORDER_RULES if isinstance(rule, NotNull)]
    return quality.row_violations(incoming_orders(t), _TABLE, row_key(), rules)


@query(INCOMING_SQL + f"""
    {_contract('CHECK', 'chk_order_status', 'status')} FROM incoming
    WHERE status <> 'F' AND status <> 'O' AND status <> 'P'
    UNION ALL {_contract('CHECK', 'chk_order_total', 'total_cents')} FROM incoming
    WHERE total_cents < 0
""")
def dq_check(t: Tables) -> DataFrame:
    """Rules that are FALSE; a missing status is UNKNOWN and passes."""
    rules = [rule for rule in ORDER_RULES if isinstance(rule, Check)]
    return quality.row_violations(incoming_orders(t), _TABLE, row_key(), rules)


@query(f"""
    {_contract('CHECK', 'chk_tax_covers_discount', 'l_tax', 'lineitem', _LINE_KEY_SQL)}
    FROM lineitem WHERE l_discount > l_tax
""")
def dq_check_columns(t: Tables) -> DataFrame:
    """A rule over two columns of the same row."""
    rule = Check("chk_tax_covers_discount", "l_tax", "l_tax >= l_discount")
    return quality.row_violations(t.lineitem, "lineitem", _line_key(), [rule])


@query(INCOMING_SQL + f"""
    {_contract('UNIQUE', 'uq_order_id', 'order_id')} FROM incoming
    QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY seq) > 1
""")
def dq_unique(t: Tables) -> DataFrame:
    """Later rows that repeat a key inside the batch."""
    rule = Unique("uq_order_id", ("order_id",))
    return quality.unique_violations(incoming_orders(t), _TABLE, row_key(), rule, F.col("seq"))


def mailing_list(t: Tables) -> DataFrame:
    """Customers' addresses, and a second entry in capitals for those in debt."""
    mail = F.concat(F.lower("c_name"), F.lit("@example.org"))
    once = t.customer.select(
        (F.col("c_custkey") * 2).alias("seq"), mail.alias("email"), "c_acctbal", "c_mktsegment"
    )
    again = once.where(F.col("c_acctbal") < 0).withColumns({
        "seq": F.col("seq") + 1, "email": F.upper("email"),
    })
    return once.unionByName(again)


_MAIL_SQL = """
    WITH mail AS (
        SELECT c_custkey * 2 AS seq, lower(c_name) || '@example.org' AS email, c_mktsegment FROM customer
        UNION ALL SELECT c_custkey * 2 + 1, upper(c_name) || '@EXAMPLE.ORG', c_mktsegment FROM customer
        WHERE c_acctbal < 0)
"""


@query(_MAIL_SQL + f"""
    {_contract('UNIQUE', 'uq_email', 'email', 'mailing_list')} FROM mail
    WHERE email <> lower(email)
""")
def dq_unique_nocase(t: Tables) -> DataFrame:
    """Addresses that differ only in case clash under the case-blind rule."""
    rule = Unique("uq_email", ("email",), ignore_case=True)
    return quality.unique_violations(
        mailing_list(t), "mailing_list", row_key(), rule, F.col("seq")
    )


@query(_MAIL_SQL + f"""
    , holed AS (SELECT seq, CASE WHEN c_mktsegment <> 'BUILDING' THEN lower(email) END AS email
                FROM mail)
    {_contract('UNIQUE', 'uq_email_null_equal', 'email', 'mailing_list')} FROM holed
    QUALIFY ROW_NUMBER() OVER (PARTITION BY email ORDER BY seq) > 1
""")
def dq_nulls_not_distinct(t: Tables) -> DataFrame:
    """Uniqueness that counts NULLs as equal, so only one may be missing."""
    holed = mailing_list(t).withColumn(
        "email", F.when(F.col("c_mktsegment") != "BUILDING", F.lower("email"))
    )
    rule = Unique("uq_email_null_equal", ("email",), nulls_distinct=False)
    return quality.unique_violations(holed, "mailing_list", row_key(), rule, F.col("seq"))


@query(f"""
    WITH l AS (SELECT l_orderkey, NULLIF(l_linenumber, 7) AS line_no, {_LINE_KEY_SQL} AS k
               FROM lineitem)
    {_contract('NOT NULL', 'nn_line_no', 'line_no', 'lineitem', 'k')} FROM l WHERE line_no IS NULL
    UNION ALL
    {_contract('UNIQUE', 'pk_line', 'l_orderkey,line_no', 'lineitem', 'k')}
    FROM l WHERE line_no IS NOT NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, line_no ORDER BY k) > 1
""")
def dq_pk(t: Tables) -> DataFrame:
    """A composite primary key: no NULL in it, and no pair twice."""
    lines = t.lineitem.withColumns({
        "line_no": F.nullif("l_linenumber", F.lit(7)), "k": _line_key(),
    })
    missing = quality.row_violations(lines, "lineitem", F.col("k"), [NotNull("line_no")])
    twice = quality.unique_violations(
        lines, "lineitem", F.col("k"), Unique("pk_line", ("l_orderkey", "line_no")), F.col("k")
    )
    return missing.unionByName(twice)


@query(INCOMING_SQL + f"""
    {_contract('FOREIGN KEY', 'fk_order_customer', 'customer_id')} FROM incoming
    LEFT JOIN customer ON c_custkey = customer_id
    WHERE customer_id IS NOT NULL AND c_custkey IS NULL
""")
def dq_fk(t: Tables) -> DataFrame:
    """Children whose parent does not exist; a missing reference is not looked up."""
    rule = ForeignKey("fk_order_customer", "customer_id", "customer", "c_custkey")
    return quality.reference_violations(
        incoming_orders(t), _TABLE, row_key(), rule, t.customer
    )


def _audit_sql() -> str:
    parts = []
    for ref in REFERENCES:
        parent = f"(SELECT * FROM {ref.parent} WHERE o_orderstatus <> 'P')" \
            if ref.parent == "orders" else ref.parent
        parts.append(f"""
            SELECT '{ref.child}' AS child, '{ref.column}' AS fk_column, '{ref.parent}' AS parent,
                   COUNT(*) AS child_rows, COUNT(*) - COUNT(p.{ref.parent_column}) AS orphans
            FROM {ref.child} c LEFT JOIN {parent} p ON p.{ref.parent_column} = c.{ref.column}""")
    return " UNION ALL ".join(parts)


@query(_audit_sql())
def dq_fk_audit(t: Tables) -> DataFrame:
    """Orphans under every reference after cancelled headers were deleted unchecked."""
    tables = {name: t.read(name) for ref in REFERENCES for name in (ref.child, ref.parent)}
    parents = dict(tables)
    parents["orders"] = changes.delete_rows(
        tables["orders"], F.col("o_orderstatus") == CANCELLED
    )
    reports = []
    for ref in REFERENCES:
        found = tables[ref.child].groupBy(F.col(ref.column).alias("k")).agg(
            count_rows().alias("n")
        )
        known = parents[ref.parent].select(
            F.col(ref.parent_column).alias("k"), F.lit(True).alias("known")
        ).distinct()
        reports.append(
            found.join(known, "k", "left").agg(
                F.lit(ref.child).alias("child"), F.lit(ref.column).alias("fk_column"),
                F.lit(ref.parent).alias("parent"), F.sum("n").alias("child_rows"),
                F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("orphans"),
            )
        )
    return union_all(reports)


@query(INCOMING_SQL + """
    SELECT seq, customer_id, FALSE AS immediate_ok, c_acctbal >= 0 AS deferred_ok
    FROM incoming JOIN customer ON c_custkey + 10000000 = customer_id
""")
def dq_fk_deferred(t: Tables) -> DataFrame:
    """A child may come before its parent when the check waits for the whole batch."""
    batch = incoming_orders(t)
    late_parents = t.customer.where(F.col("c_acctbal") >= 0).select(
        (F.col("c_custkey") + 10_000_000).alias("c_custkey")
    )
    rule = ForeignKey("fk_order_customer", "customer_id", "customer", "c_custkey")
    now = quality.reference_violations(batch, _TABLE, row_key(), rule, t.customer)
    later = quality.reference_violations(
        batch, _TABLE, row_key(), rule, t.customer.select("c_custkey").union(late_parents)
    )
    failed_now = now.select(F.col("row_key").cast("bigint").alias("seq"))
    failed_later = later.select(
        F.col("row_key").cast("bigint").alias("seq"), F.lit(False).alias("later_ok")
    )
    return (
        batch.join(failed_now, "seq")
        .join(failed_later, "seq", "left")
        .select(
            "seq", "customer_id", F.lit(False).alias("immediate_ok"),
            F.coalesce("later_ok", F.lit(True)).alias("deferred_ok"),
        )
    )


def order_violations(t: Tables) -> DataFrame:
    return quality.violations(
        incoming_orders(t), _TABLE, row_key(), list(ORDER_RULES), {"customer": t.customer}
    )


_ALL_SQL = INCOMING_SQL + f"""
    , broken AS (
        {_contract('NOT NULL', 'nn_customer_id', 'customer_id')} FROM incoming
            WHERE customer_id IS NULL
        UNION ALL {_contract('NOT NULL', 'nn_status', 'status')} FROM incoming WHERE status IS NULL
        UNION ALL {_contract('CHECK', 'chk_order_status', 'status')} FROM incoming
            WHERE status NOT IN ('F', 'O', 'P')
        UNION ALL {_contract('CHECK', 'chk_order_total', 'total_cents')} FROM incoming
            WHERE total_cents < 0
        UNION ALL {_contract('UNIQUE', 'uq_order_id', 'order_id')} FROM incoming WHERE copy = 1
        UNION ALL {_contract('FOREIGN KEY', 'fk_order_customer', 'customer_id')} FROM incoming
            WHERE customer_id > (SELECT MAX(c_custkey) FROM customer))
"""


@query(_ALL_SQL + """
    SELECT row_key, rule_kind, rule_name, CAST(broken_rules AS BIGINT) AS broken FROM (
        SELECT *, COUNT(*) OVER (PARTITION BY row_key) AS broken_rules,
               ROW_NUMBER() OVER (PARTITION BY row_key ORDER BY CASE rule_kind
                   WHEN 'NOT NULL' THEN 1 WHEN 'CHECK' THEN 2 WHEN 'UNIQUE' THEN 3 ELSE 4 END,
                   rule_name) AS place
        FROM broken) WHERE place = 1
""")
def dq_precedence(t: Tables) -> DataFrame:
    """The one rule each bad row is refused for, among all it breaks."""
    return quality.first_violation(order_violations(t)).select(
        "row_key", "rule_kind", "rule_name", "broken"
    )


@query(f"""
    {_contract('CHECK', 'chk_line_below_list', 'l_extendedprice', 'lineitem', _LINE_KEY_SQL)}
    FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE CAST(ROUND(l_extendedprice * 100) AS BIGINT)
        > CAST(l_quantity AS BIGINT) * CAST(ROUND(p_retailprice * 100) AS BIGINT)
""")
def dq_cross_table(t: Tables) -> DataFrame:
    """A rule a CHECK cannot state: no line above the list price."""
    listed = t.part.select(
        F.col("p_partkey").alias("l_partkey"), cents("p_retailprice").alias("list_cents")
    )
    lines = t.lineitem.join(listed, "l_partkey").select(
        _line_key().alias("k"), line_cents().alias("line_cents"),
        (F.col("l_quantity").cast("bigint") * F.col("list_cents")).alias("limit_cents"),
    )
    rule = Check("chk_line_below_list", "l_extendedprice", "line_cents <= limit_cents")
    return quality.row_violations(lines, "lineitem", F.col("k"), [rule])


@query(f"""
    {_contract('CHECK', 'chk_order_limit', 'l_extendedprice', 'orders', 'l_orderkey')}
    FROM lineitem GROUP BY l_orderkey
    HAVING SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) > 30000000
""")
def dq_group_limit(t: Tables) -> DataFrame:
    """Orders whose lines add up to more than the limit."""
    rule = Check("chk_order_limit", "l_extendedprice", "order_cents <= 30000000")
    return quality.row_violations(order_totals(t), "orders", F.col("o_orderkey"), [rule])


@query("""
    SELECT p_partkey, CASE WHEN p_size = 13 THEN 'n/a' ELSE '' END AS price_text
    FROM part WHERE p_size = 13 OR p_size = 7
""")
def dq_type(t: Tables) -> DataFrame:
    """Texts that are no number although the column is declared as one."""
    text = (
        F.when(F.col("p_size") == 13, "n/a").when(F.col("p_size") == 7, "")
        .otherwise(cents("p_retailprice").cast("string"))
    )
    read = t.part.select("p_partkey", text.alias("price_text"))
    return read.where(
        F.col("price_text").isNotNull() & F.col("price_text").try_cast("bigint").isNull()
    )


# Texts shown to users; a rule without its own text gets the text of its kind.
USER_TEXTS = (
    ("CHECK", "chk_order_status", "The order status must be F, O or P."),
    ("CHECK", None, "A value is outside its allowed range."),
    ("NOT NULL", None, "A required field is empty."),
    ("UNIQUE", "uq_order_id", "This order has been entered already."),
    ("UNIQUE", None, "This value is taken."),
    ("FOREIGN KEY", None, "The customer or product does not exist."),
)


@query(_ALL_SQL + """
    SELECT rule_kind, rule_name, COUNT(*) AS n, CASE rule_name
        WHEN 'chk_order_status' THEN 'The order status must be F, O or P.'
        WHEN 'chk_order_total' THEN 'A value is outside its allowed range.'
        WHEN 'uq_order_id' THEN 'This order has been entered already.'
        WHEN 'fk_order_customer' THEN 'The customer or product does not exist.'
        ELSE 'A required field is empty.' END AS user_text
    FROM broken GROUP BY rule_kind, rule_name
""")
def dq_messages(t: Tables) -> DataFrame:
    """Broken rules with the text a user may read."""
    texts = t.spark.createDataFrame(
        list(USER_TEXTS), "rule_kind string, rule_name string, user_text string"
    )
    return (
        quality.with_messages(order_violations(t), texts)
        .groupBy("rule_kind", "rule_name", "user_text")
        .agg(count_rows().alias("n"))
    )


@query(_ALL_SQL + """
    SELECT 'accepted' AS output, COUNT(*) AS n, CAST(SUM(total_cents) AS BIGINT) AS total_cents
    FROM incoming WHERE CAST(seq AS VARCHAR) NOT IN (SELECT row_key FROM broken)
    UNION ALL SELECT 'quarantined', COUNT(*), CAST(SUM(total_cents) AS BIGINT)
    FROM incoming WHERE CAST(seq AS VARCHAR) IN (SELECT row_key FROM broken)
""")
def dq_split(t: Tables) -> DataFrame:
    """The batch divided into accepted and quarantined rows."""
    outputs = quality.split(incoming_orders(t), row_key(), order_violations(t))
    return union_all([
        rows.agg(
            F.lit(name).alias("output"), count_rows().alias("n"),
            F.sum("total_cents").alias("total_cents"),
        )
        for name, rows in zip(("accepted", "quarantined"), outputs)
    ])


MIN_ROWS = 5


# What the incoming batch is made to break, by message.
BROKEN = (
    "NOT NULL failed: nn_customer_id", "NOT NULL failed: nn_status", "CHECK failed: chk_order_status",
    "CHECK failed: chk_order_total", "UNIQUE failed: uq_order_id", "FOREIGN KEY failed: fk_order_customer",
)


def table_lines(t: Tables, name: str) -> DataFrame:
    """Whether a table has rows, and what else one look at them tells."""
    lines = [quality.expectation(
        f"rows of {name} missing", 0, F.greatest(F.lit(MIN_ROWS) - count_rows(), F.lit(0)))]
    if name == "orders":
        lines.append(quality.expectation(
            "orders with unknown status", 0, F.count_if(~F.col("o_orderstatus").isin(*STATUSES))))
    return t.read(name).agg(F.array(*lines).alias("lines"))


def reference_lines(t: Tables) -> DataFrame:
    """Orphans of all references, and the lines a cascade leaves, from one pass over each child.

    The keys of a child's references are counted together, so rows shrink to keys before they
    are shuffled, and keys instead of rows meet the parents. A parent key is unique, as declared.
    """
    held, gone = F.col("cancelled").isNotNull(), F.coalesce("cancelled", F.lit(False))
    parents = union_all([
        t.read(ref.parent).select(
            F.lit(i).alias("reference"), F.col(ref.parent_column).cast("bigint").alias("key"),
            (F.coalesce(F.col("o_orderstatus") == CANCELLED, F.lit(False)) if ref.parent == "orders" else F.lit(False)).alias("cancelled"))
        for i, ref in enumerate(REFERENCES)
    ])
    children = union_all([
        t.read(child).select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("reference"), F.col(ref.column).cast("bigint").alias("key"))
            for i, ref in enumerate(REFERENCES) if ref.child == child])))
        for child in dict.fromkeys(ref.child for ref in REFERENCES)
    ])
    counted = children.groupBy("reference", "key").agg(count_rows().alias("n")).join(parents, ["reference", "key"], "left")

    def rows(i: int, which: Column) -> Column:
        return F.coalesce(F.sum(F.when((F.col("reference") == i) & which, F.col("n"))), F.lit(0))

    lines = [
        quality.expectation(f"orphans of {ref.child}.{ref.column}", 0, rows(i, F.col("key").isNotNull() & ~held))
        for i, ref in enumerate(REFERENCES)
    ]
    cascade = next(i for i, ref in enumerate(REFERENCES) if ref.on_delete == "CASCADE")
    lines.append(quality.expectation("lines after cascade", rows(cascade, held & ~gone), rows(cascade, ~gone)))
    return counted.agg(F.array(*lines).alias("lines"))


@query(_ALL_SQL + " UNION ALL ".join(
    [f"SELECT 'rows of {name} missing' AS \"check\", CAST(0 AS BIGINT) AS expected, "
     f"CAST(GREATEST(5 - COUNT(*), 0) AS BIGINT) AS actual, COUNT(*) >= 5 AS ok FROM {name}"
     for name in TABLE_NAMES]
    + [f"SELECT 'orphans of {r.child}.{r.column}', 0, COUNT(*), COUNT(*) = 0 FROM {r.child} "
       f"WHERE {r.column} NOT IN (SELECT {r.parent_column} FROM {r.parent})" for r in REFERENCES]
    + ["SELECT 'orders with unknown status', 0, COUNT(*), COUNT(*) = 0 FROM orders "
       "WHERE o_orderstatus NOT IN ('F', 'O', 'P')",
       "SELECT 'cancelled orders after delete', 0, COUNT(*), COUNT(*) = 0 FROM "
       "(SELECT * FROM orders EXCEPT ALL SELECT * FROM orders WHERE o_orderstatus = 'P') WHERE o_orderstatus = 'P'",
       "SELECT 'lines after cascade', kept, left_over, kept = left_over FROM "
       "(SELECT COUNT(*) AS kept FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'), "
       "(SELECT COUNT(*) AS left_over FROM lineitem WHERE l_orderkey NOT IN "
       "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'))"]
    + [f"SELECT 'batch broke {message}', 1, LEAST(COUNT(*), 1), COUNT(*) > 0 FROM broken WHERE message = '{message}'"
       for message in BROKEN]
))
def dq_expectations(t: Tables) -> DataFrame:
    """All expectations in one report, each with what was expected and found."""
    cancelled = F.col("o_orderstatus") == CANCELLED
    reports = [table_lines(t, name) for name in TABLE_NAMES]
    reports += [
        reference_lines(t),
        changes.delete_rows(t.orders, cancelled).agg(F.array(quality.expectation(
            "cancelled orders after delete", 0, F.count_if(cancelled))).alias("lines")),
        order_violations(t).agg(F.array(*[
            quality.expectation(
                f"batch broke {message}", 1, F.least(F.count_if(F.col("message") == message), F.lit(1)))
            for message in BROKEN
        ]).alias("lines")),
    ]
    return union_all(reports).select(F.inline("lines"))
