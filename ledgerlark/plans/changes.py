"""Inserts, updates, deletes and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import cents, count_rows
from ledgerlark.operators import changes, closure, joins, quality
from ledgerlark.operators.ranking import with_new_ids
from ledgerlark.operators.sets import union_all
from ledgerlark.plans.incoming import INCOMING_SQL, ORDER_RULES, incoming_orders, row_key
from ledgerlark.plans.joining import named_lines, urgent_orders
from ledgerlark.plans.registry import query
from ledgerlark.sources.scratch import run_folder
from ledgerlark.sources.sinks import VersionedTable
from ledgerlark.sources.tables import CANCELLED, PENDING, Reference, Tables


@query("""
    SELECT (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY c_custkey) AS o_orderkey,
           c_custkey AS o_custkey, 'O' AS o_orderstatus,
           (SELECT MAX(o_orderdate) FROM orders) AS o_orderdate
    FROM customer WHERE c_acctbal < 0
""")
def insert_defaults(t: Tables) -> DataFrame:
    """New orders that name only the customer; key, status and date are filled in."""
    batch = t.customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    bounds = t.orders.agg(F.max("o_orderkey").alias("k"), F.max("o_orderdate").alias("d"))
    numbered = with_new_ids(
        batch, [F.asc("o_custkey")], bounds.select("k").scalar(), "o_orderkey"
    )
    filled = changes.with_defaults(numbered, {
        "o_orderstatus": F.lit(PENDING), "o_orderdate": bounds.select("d").scalar(),
    })
    return filled.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


@query("""
    SELECT event_id, ts, (SELECT c_custkey FROM customer
        WHERE c_name = 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0')) AS customer_id
    FROM events WHERE event_type = 'purchase'
""")
def insert_lookup(t: Tables) -> DataFrame:
    """Child rows that know their parent only by its natural key."""
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
    batch = t.events.where(F.col("event_type") == "purchase").select(
        "event_id", "ts", name.alias("c_name")
    )
    return batch.join(t.customer, "c_name", "left").select(
        "event_id", "ts", F.col("c_custkey").alias("customer_id")
    )


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS part_code, upper(p_name) AS p_name,
           CAST(ROUND(p_retailprice * 100) AS BIGINT) AS price_cents, p_size > 10 AS available
    FROM part
""")
def copy_rewrite(t: Tables) -> DataFrame:
    """A table copied into a re-declared shape; readers switch to the new version."""
    table = VersionedTable(t.spark, run_folder(t.spark, "part"))
    table.write(t.part, 1)
    table.switch(1)
    redeclared = table.read().select(
        F.col("p_partkey").cast("string").alias("part_code"), F.upper("p_name").alias("p_name"),
        cents("p_retailprice").alias("price_cents"), (F.col("p_size") > 10).alias("available"),
    )
    fresh = table.write(redeclared, 2)
    sold = t.lineitem.select(F.col("l_partkey").cast("string").alias("part_code"))
    table.switch(2, {"lines without their part": joins.without_match(sold, "part_code", fresh, "part_code", unique=True)})
    return table.read()


@query("""
    SELECT p_partkey, p_name, CASE p_name WHEN 'small ring' THEN 99900
           ELSE CAST(ROUND(p_retailprice * 100) AS BIGINT) END AS price_cents
    FROM part
""")
def upd_absolute(t: Tables) -> DataFrame:
    """Set one product's price; doing it again changes nothing."""
    prices = t.part.select("p_partkey", "p_name", cents("p_retailprice").alias("price_cents"))
    return changes.update_rows(
        prices, F.col("p_name") == "small ring", {"price_cents": F.lit(99_900).cast("bigint")}
    )


@query("""
    SELECT p_partkey, CAST(ROUND(p_retailprice * 100) AS BIGINT)
               + CASE WHEN p_name = 'small ring' THEN 2 * 500 ELSE 0 END AS price_cents
    FROM part
""")
def upd_relative(t: Tables) -> DataFrame:
    """A relative raise applied twice drifts by twice the amount."""
    prices = t.part.select("p_partkey", "p_name", cents("p_retailprice").alias("price_cents"))
    for _ in range(2):
        prices = changes.update_rows(
            prices, F.col("p_name") == "small ring", {"price_cents": F.col("price_cents") + 500}
        )
    return prices.select("p_partkey", "price_cents")


@query("""
    SELECT COALESCE(st, '(none)') AS status, COUNT(*) AS n
    FROM (SELECT NULLIF(o_orderstatus, CASE o_orderpriority WHEN '5-LOW' THEN 'F' END) AS st FROM orders)
    WHERE st IS DISTINCT FROM 'P' GROUP BY 1
""")
def del_filter(t: Tables) -> DataFrame:
    """Status distribution after deleting the cancelled; unknown status stays."""
    unknown = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F")
    orders = t.orders.select(F.when(~unknown, F.col("o_orderstatus")).alias("status"))
    left = changes.delete_rows(orders, F.col("status") == CANCELLED)
    return left.groupBy(F.coalesce("status", F.lit("(none)")).alias("status")).agg(
        count_rows().alias("n")
    )


@query("""
    SELECT 'orders' AS table_name, COUNT(*) AS before_rows,
           COUNT(*) - COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS after_rows FROM orders
    UNION ALL
    SELECT 'lineitem', (SELECT COUNT(*) FROM lineitem), COUNT(*)
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus IN ('F', 'O')
""")
def del_cascade(t: Tables) -> DataFrame:
    """Deleting cancelled headers takes their lines along."""
    orders, lines = changes.delete_cascade(
        t.orders, "o_orderkey", F.col("o_orderstatus") == CANCELLED, t.lineitem, "l_orderkey"
    )
    return union_all([
        before.agg(F.lit(name).alias("table_name"), count_rows().alias("before_rows")).withColumn(
            "after_rows", after.agg(count_rows()).scalar()
        )
        for name, before, after in (
            ("orders", t.orders, orders), ("lineitem", t.lineitem, lines)
        )
    ])


# Deleting a region takes all below it along; products and suppliers hold back.
SHOP = (
    Reference("nation", "n_regionkey", "region", "r_regionkey", "CASCADE"),
    Reference("customer", "c_nationkey", "nation", "n_nationkey", "CASCADE"),
    Reference("supplier", "s_nationkey", "nation", "n_nationkey", "SET NULL"),
    Reference("orders", "o_custkey", "customer", "c_custkey", "CASCADE"),
    Reference("lineitem", "l_orderkey", "orders", "o_orderkey", "CASCADE"),
)


@query("""
    WITH RECURSIVE gone(tab, k) AS (
        SELECT 'region', CAST(1 AS BIGINT)
        UNION SELECT e.child, e.k FROM gone JOIN (
            SELECT 'nation' AS child, 'region' AS parent, n_nationkey AS k, n_regionkey AS p FROM nation
            UNION ALL SELECT 'customer', 'nation', c_custkey, c_nationkey FROM customer
            UNION ALL SELECT 'orders', 'customer', o_orderkey, o_custkey FROM orders) e ON e.parent = tab AND e.p = gone.k),
    n AS (SELECT k FROM gone WHERE tab = 'nation'), c AS (SELECT k FROM gone WHERE tab = 'customer'),
    o AS (SELECT k FROM gone WHERE tab = 'orders')
    SELECT 'region' AS table_name, COUNT(*) AS before_rows, COUNT(*) FILTER (r_regionkey <> 1) AS after_rows, CAST(0 AS BIGINT) AS emptied
    FROM region
    UNION ALL SELECT 'nation', COUNT(*), COUNT(*) FILTER (n_nationkey NOT IN (FROM n)), 0 FROM nation
    UNION ALL SELECT 'customer', COUNT(*), COUNT(*) FILTER (c_custkey NOT IN (FROM c)), 0 FROM customer
    UNION ALL SELECT 'supplier', COUNT(*), COUNT(*), COUNT(*) FILTER (s_nationkey IN (FROM n)) FROM supplier
    UNION ALL SELECT 'orders', COUNT(*), COUNT(*) FILTER (o_orderkey NOT IN (FROM o)), 0 FROM orders
    UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*) FILTER (l_orderkey NOT IN (FROM o)), 0 FROM lineitem
""")
def del_cascade_closure(t: Tables) -> DataFrame:
    """A region goes with its nations, customers, orders and lines; its suppliers lose their nation."""
    names = ("region", "nation", "customer", "supplier", "orders", "lineitem")
    tables = {name: t.read(name) for name in names}
    victims = t.region.where(F.col("r_regionkey") == 1).select("r_regionkey")
    after = closure.delete_through(tables, list(SHOP), "region", victims).tables
    return union_all([
        tables[name].agg(F.lit(name).alias("table_name"), count_rows().alias("before_rows")).withColumn(
            "after_rows", after[name].agg(count_rows()).scalar()
        ).withColumn("emptied", after[name].agg(
            F.count_if(F.col("s_nationkey").isNull()) if name == "supplier" else F.lit(0).cast("bigint")).scalar())
        for name in names
    ])


_RING_SQL = """
    WITH RECURSIVE member AS (
        SELECT c_custkey, c_acctbal,
               c_custkey // 10 * 10 + CASE WHEN c_custkey % 10 < 5 THEN (c_custkey + 1) % 5 ELSE c_custkey % 10 - 5 END AS sponsor
        FROM customer),
    gone AS (SELECT c_custkey FROM member WHERE c_acctbal < -900
             UNION SELECT m.c_custkey FROM member m JOIN gone g ON m.sponsor = g.c_custkey)
"""


@query(_RING_SQL + """
    SELECT c_custkey, sponsor FROM member WHERE c_custkey NOT IN (SELECT c_custkey FROM gone)
""")
def del_cascade_cycle(t: Tables) -> DataFrame:
    """Customers sponsor each other in rings of five, with five more behind each ring; who loses
    the sponsor goes too."""
    last = F.col("c_custkey") % 10
    sponsor = F.floor(F.col("c_custkey") / 10) * 10 + F.when(last < 5, (F.col("c_custkey") + 1) % 5).otherwise(last - 5)
    members = t.customer.select("c_custkey", "c_acctbal", sponsor.cast("bigint").alias("sponsor"))
    victims = members.where(F.col("c_acctbal") < -900).select("c_custkey")
    ring = [Reference("member", "sponsor", "member", "c_custkey", "CASCADE")]
    return closure.delete_through({"member": members}, ring, "member", victims).tables["member"].select("c_custkey", "sponsor")


@query("""
    SELECT c_custkey, COUNT(o_orderkey) AS children, COUNT(o_orderkey) > 0 AS refused
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'
    WHERE c_acctbal < 0 GROUP BY c_custkey
""")
def del_no_action(t: Tables) -> DataFrame:
    """Customers asked to be deleted; those with urgent orders are refused."""
    return changes.delete_verdicts(
        t.customer, "c_custkey", F.col("c_acctbal") < 0, urgent_orders(t), "o_custkey"
    )


@query("""
    SELECT c_custkey, n AS children, back AS inserted_again, n = 0 AS restrict_allows,
           n = 0 OR back AS no_action_allows
    FROM (SELECT c_custkey, c_mktsegment = 'BUILDING' AS back, (SELECT COUNT(*) FROM orders
              WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS n
          FROM customer WHERE c_acctbal < 0)
""")
def del_restrict_vs_noaction(t: Tables) -> DataFrame:
    """A batch deletes customers and inserts some of them again."""
    victim = F.col("c_acctbal") < 0
    verdicts = changes.delete_verdicts(
        t.customer, "c_custkey", victim, urgent_orders(t), "o_custkey"
    )
    again = t.customer.where(victim & (F.col("c_mktsegment") == "BUILDING"))
    return changes.restrict_and_no_action(verdicts, "c_custkey", again)


@query("""
    SELECT o_orderkey, CASE WHEN c_acctbal >= 0 THEN o_custkey END AS o_custkey,
           c_acctbal < 0 AS breaks_not_null
    FROM orders JOIN customer ON c_custkey = o_custkey
""")
def del_set_null(t: Tables) -> DataFrame:
    """Orders of deleted customers lose their customer, which NOT NULL forbids."""
    orders = changes.delete_set_null(
        t.customer, "c_custkey", F.col("c_acctbal") < 0,
        t.orders.select("o_orderkey", "o_custkey"), "o_custkey",
    )
    return orders.withColumn("breaks_not_null", F.col("o_custkey").isNull())


def customer_batch(t: Tables) -> DataFrame:
    """Customers sent again with a new balance, some twice, and as many new ones."""
    people = t.customer.where(F.col("c_acctbal") < 0).select(
        "c_custkey", "c_name", cents("c_acctbal").alias("balance_cents")
    )
    known = people.withColumn("balance_cents", F.col("balance_cents") + 100_000)
    twice = people.where(F.col("balance_cents") < -50_000).withColumns({
        "balance_cents": F.col("balance_cents") + 200_000, "c_name": F.upper("c_name"),
    })
    first = known.unionByName(
        known.withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
    ).withColumn("seq", F.lit(1))
    second = twice.unionByName(
        twice.withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
    ).withColumn("seq", F.lit(2))
    return first.unionByName(second)


_BATCH_SQL = """
    WITH c AS (SELECT c_custkey, c_name, CAST(ROUND(c_acctbal * 100) AS BIGINT) AS balance_cents
               FROM customer),
         shift AS (SELECT unnest([0, 10000000]) AS s),
         batch AS (SELECT c_custkey + s AS c_custkey, c_name, balance_cents + 100000 AS balance_cents,
                          1 AS seq FROM c, shift WHERE balance_cents < 0
                   UNION ALL SELECT c_custkey + s, upper(c_name), balance_cents + 200000, 2
                   FROM c, shift WHERE balance_cents < -50000)
"""


def balances(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", cents("c_acctbal").alias("balance_cents"))


@query(_BATCH_SQL + """
    SELECT * FROM c UNION ALL
    SELECT c_custkey, c_name, balance_cents FROM batch b
    WHERE seq = 1 AND NOT EXISTS (SELECT 1 FROM c WHERE c.c_custkey = b.c_custkey)
""")
def upsert_ignore(t: Tables) -> DataFrame:
    return changes.upsert_ignore(balances(t), customer_batch(t), "c_custkey", "seq")


@query(_BATCH_SQL + """
    SELECT k AS c_custkey,
           COALESCE((SELECT c_name FROM c WHERE c.c_custkey = k),
                    (SELECT c_name FROM batch b WHERE b.c_custkey = k AND seq = 1)) AS c_name,
           COALESCE((SELECT balance_cents FROM batch b WHERE b.c_custkey = k AND seq = 2),
                    (SELECT balance_cents FROM batch b WHERE b.c_custkey = k AND seq = 1),
                    (SELECT balance_cents FROM c WHERE c.c_custkey = k)) AS balance_cents
    FROM (SELECT c_custkey AS k FROM c UNION SELECT c_custkey FROM batch)
""")
def upsert_update(t: Tables) -> DataFrame:
    return changes.upsert_update(
        balances(t), customer_batch(t), "c_custkey", ["balance_cents"], "seq"
    )


def contact_batch(t: Tables) -> DataFrame:
    """Contacts without ids: known addresses again, new ones, some sent twice or without an address."""
    mail = F.concat(F.lower("c_name"), F.when(F.col("c_nationkey") % 2 == 0, "@example.org").otherwise("@new.example"))
    once = t.customer.where(F.col("c_acctbal") < 0).select(
        F.when(F.col("c_mktsegment") != "BUILDING", mail).alias("email"), "c_mktsegment",
        (F.col("c_custkey") * 2).alias("seq"),
    )
    again = once.where("seq % 3 = 0").withColumns({"seq": F.col("seq") + 1, "c_mktsegment": F.lower("c_mktsegment")})
    return once.unionByName(again)


def contacts(t: Tables) -> DataFrame:
    mail = F.concat(F.lower("c_name"), F.lit("@example.org"))
    return t.customer.select(F.col("c_custkey").alias("contact_id"), mail.alias("email"), "c_mktsegment")


_CONTACT_SQL = """
    WITH now AS (SELECT c_custkey AS contact_id, lower(c_name) || '@example.org' AS email, c_mktsegment FROM customer),
    once AS (SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN lower(c_name)
                    || CASE WHEN c_nationkey % 2 = 0 THEN '@example.org' ELSE '@new.example' END END AS email,
                    c_mktsegment, c_custkey * 2 AS seq FROM customer WHERE c_acctbal < 0),
    batch AS (SELECT * FROM once UNION ALL SELECT email, lower(c_mktsegment), seq + 1 FROM once WHERE seq % 3 = 0),
    entering AS (SELECT email, c_mktsegment, seq, 1 AS nth FROM batch WHERE email IS NULL
                 UNION ALL SELECT email, c_mktsegment, seq, row_number() OVER (PARTITION BY email ORDER BY seq)
                 FROM batch WHERE email IS NOT NULL AND email NOT IN (SELECT email FROM now)),
    numbered AS (SELECT row_number() OVER (ORDER BY seq) + (SELECT MAX(contact_id) FROM now) AS contact_id,
                        email, c_mktsegment FROM entering WHERE nth = 1)
"""


@query(_CONTACT_SQL + "SELECT * FROM now UNION ALL SELECT * FROM numbered")
def upsert_natural_ignore(t: Tables) -> DataFrame:
    """ON CONFLICT (email) DO NOTHING; new contacts get the next ids."""
    return changes.upsert_natural(contacts(t), contact_batch(t), "contact_id", ["email"], [], "seq", ["seq"])


@query(_CONTACT_SQL + """
    , latest AS (SELECT email, arg_max(c_mktsegment, seq) AS newest FROM batch WHERE email IS NOT NULL GROUP BY email)
    SELECT contact_id, a.email, COALESCE(newest, c_mktsegment) AS c_mktsegment
    FROM (SELECT * FROM now UNION ALL SELECT * FROM numbered) a LEFT JOIN latest USING (email)
""")
def upsert_natural_update(t: Tables) -> DataFrame:
    """ON CONFLICT (email) DO UPDATE of the segment; new contacts get the next ids."""
    return changes.upsert_natural(
        contacts(t), contact_batch(t), "contact_id", ["email"], ["c_mktsegment"], "seq", ["seq"])


@query(INCOMING_SQL + """
    , bad AS (SELECT seq, CASE
            WHEN order_id IS NULL OR customer_id IS NULL OR status IS NULL OR total_cents IS NULL
                THEN 'NOT NULL'
            WHEN NOT (status IN ('F', 'O', 'P')) OR NOT (total_cents >= 0) THEN 'CHECK'
            WHEN copy = 1 THEN 'UNIQUE'
            WHEN customer_id NOT IN (SELECT c_custkey FROM customer) THEN 'FOREIGN KEY' END AS kind
        FROM incoming)
    SELECT CASE kind WHEN 'FOREIGN KEY' THEN 'fails' ELSE 'ignored' END AS outcome,
           kind AS refused_for, COUNT(*) AS n
    FROM bad WHERE kind IS NOT NULL GROUP BY kind
    UNION ALL SELECT 'inserted', '', COUNT(*) FROM bad WHERE kind IS NULL
""")
def insert_or_ignore(t: Tables) -> DataFrame:
    """INSERT OR IGNORE with its silent losses counted; a missing parent still fails."""
    batch = incoming_orders(t)
    broken = quality.violations(
        batch, "incoming_orders", row_key(), list(ORDER_RULES), {"customer": t.customer}
    )
    kind = F.col("refused_for")
    outcome = (
        F.when(kind.isNull(), "inserted").when(kind == "FOREIGN KEY", "fails").otherwise("ignored")
    )
    return (
        quality.judged(batch, row_key(), broken)
        .groupBy(outcome.alias("outcome"), F.coalesce(kind, F.lit("")).alias("refused_for"))
        .agg(count_rows().alias("n"))
    )


@query("""
    WITH l AS (SELECT l_orderkey AS k, COUNT(*) AS n,
                      COUNT(CASE WHEN l_quantity >= 50 OR l_tax >= 0.08 AND l_discount >= 0.1
                                 THEN 1 END) AS bad
               FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, COALESCE(n, 0) AS line_count, COALESCE(bad, 0) AS bad_lines,
           CASE WHEN n IS NULL THEN 'no lines' WHEN bad > 0 THEN 'bad line' ELSE 'accepted' END
               AS verdict
    FROM orders LEFT JOIN l ON k = o_orderkey
""")
def batch_atomic_orders(t: Tables) -> DataFrame:
    """Orders go in with all their lines or not at all."""
    line_ok = (F.col("l_quantity") < 50) & ((F.col("l_tax") < 0.08) | (F.col("l_discount") < 0.1))
    return changes.atomic_orders(t.orders, "o_orderkey", t.lineitem, "l_orderkey", line_ok)


@query("""
    SELECT 'before' AS moment, COUNT(*) AS customers FROM customer
    UNION ALL SELECT 'during', COUNT(*) + COUNT(CASE WHEN c_acctbal < 0 THEN 1 END) FROM customer
    UNION ALL SELECT 'after rollback', COUNT(*) FROM customer
""")
def whatif_rollback(t: Tables) -> DataFrame:
    """A tried insert lives in a derived table; the base never changes."""
    newcomers = t.customer.where(F.col("c_acctbal") < 0).withColumn(
        "c_custkey", F.col("c_custkey") + 10_000_000
    )
    tried = t.customer.unionByName(newcomers)
    moments = {"before": t.customer, "during": tried, "after rollback": t.customer}
    return union_all([
        rows.agg(F.lit(name).alias("moment"), count_rows().alias("customers"))
        for name, rows in moments.items()
    ])


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN sha256(c_name) ELSE c_name END AS c_name,
           c_acctbal < 0 AS deleted
    FROM customer
""")
def soft_delete(t: Tables) -> DataFrame:
    """Leaving customers are marked and made anonymous, their orders stay."""
    return changes.anonymise(t.customer, F.col("c_acctbal") < 0, ["c_name"]).select(
        "c_custkey", "c_name", "deleted"
    )


@query("""
    SELECT 'raise price' AS change, COUNT(*) AS changed_rows FROM part WHERE p_name = 'small ring'
    UNION ALL SELECT 'delete cancelled', COUNT(*) FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'cascade to lines', COUNT(*) FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
    UNION ALL SELECT 'delete again', COUNT(*) FROM orders WHERE o_orderstatus = 'none'
""")
def changed_rows(t: Tables) -> DataFrame:
    """Rows each change affects."""
    cancelled = F.col("o_orderstatus") == CANCELLED
    left = changes.delete_rows(t.orders, cancelled)
    cascaded = joins.having_match(
        t.lineitem, "l_orderkey", t.orders.where(cancelled), "o_orderkey", unique=True
    )
    affected = {
        "raise price": t.part.where(F.col("p_name") == "small ring"),
        "delete cancelled": t.orders.where(cancelled),
        "cascade to lines": cascaded,
        "delete again": left.where(cancelled),
    }
    return union_all([
        rows.agg(F.lit(name).alias("change"), count_rows().alias("changed_rows"))
        for name, rows in affected.items()
    ])


@query("""
    SELECT 'before delete' AS moment, COUNT(DISTINCT o_custkey) AS customers
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
    WHERE p_name = 'small ring'
    UNION ALL SELECT 'after delete', COUNT(DISTINCT o_custkey)
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
    WHERE p_name = 'small ring' AND o_orderstatus <> 'P'
""")
def order_dependence(t: Tables) -> DataFrame:
    """The same read gives fewer buyers once cancelled orders are deleted."""
    lines = named_lines(t)
    versions = {
        "before delete": t.orders,
        "after delete": changes.delete_rows(t.orders, F.col("o_orderstatus") == CANCELLED),
    }
    return union_all([
        joins.having_match(t.customer, "c_custkey",
                           joins.having_match(orders, "o_orderkey", lines, "l_orderkey"), "o_custkey")
        .agg(F.lit(name).alias("moment"), count_rows().alias("customers"))
        for name, orders in versions.items()
    ])


@query("""
    SELECT i + o_orderkey * 10 AS order_id,
           ((o_orderkey * 10 + i) % 2147483647 * 1103515245 + 12345) % 2147483648 // 65536
               % (SELECT COUNT(*) FROM customer) AS customer_id,
           CASE ((o_orderkey * 10 + i) % 2147483647 * 69069 + 1) % 2147483648 // 65536 % 3
               WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS status,
           o_orderdate + INTERVAL (i) DAY AS ordered_at
    FROM orders, (SELECT unnest(generate_series(0, 9)) AS i)
""")
def synth_orders(t: Tables) -> DataFrame:
    """Ten generated orders for every given one, the same on any partitioning."""
    customers = t.customer.agg(count_rows()).scalar()

    def spread(factor: int, add: int):
        mixed = (F.col("order_id") % 2147483647) * factor + add
        return F.floor((mixed % 2147483648) / 65536).cast("bigint")

    copies = t.orders.select(
        "o_orderkey", "o_orderdate", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i")
    ).withColumn("order_id", F.col("o_orderkey") * 10 + F.col("i"))
    status = F.element_at(
        F.array(F.lit("F"), F.lit("O"), F.lit("P")), (spread(69069, 1) % 3 + 1).cast("int")
    )
    return copies.select(
        "order_id",
        (spread(1103515245, 12345) % customers).alias("customer_id"),
        status.alias("status"),
        (F.col("o_orderdate") + F.make_dt_interval("i")).alias("ordered_at"),
    )
