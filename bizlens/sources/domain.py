"""Domain tables of the seven case studies, derived from the input tables.

Each domain table is a lazy DataFrame over the parquet inputs, so its size and
the work of every query on it grow with the inputs. The same derivation is
written twice: as DataFrame code (``Domain.<name>``) and as SQL
(``DOMAIN_SQL[name]``) for the independent oracle. Keep the two in step.

Derivation rules (all integer arithmetic on keys, so both engines agree):

- diner: ``sales`` = lineitem x orders; ``menu`` = part (``PROMO`` is sushi);
  ``members`` = customers of two segments, joined on a date set by their key
- pizza: an item is a lineitem, an order an order, a pizza a part (name by key
  parity); text columns carry the dirty markers and unit suffixes of the
  original data; recipes are 8 of the 12 toppings chosen by key
- subscriptions: a plan start is an order, plan = order priority - 1
- bank: a transaction is an order (status O/F/P -> deposit/withdrawal/purchase);
  node stints run from one order to the customer's next
- retail: weekly sales = lineitem by order week, platform, segment, type
- clickstream: a visit is a user-day of ``events``; page from ``props.k``
- ad metrics: a metric row is a lineitem folded onto 14 months; the interest
  map is ``part``
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.functions.calendar import ntz_text, ymd_text
from bizlens.operators.ordered import lead_lag, row_number
from bizlens.session import TableStore
from bizlens.sources import fixed
from bizlens.sources.driver import table

OPEN_END = "9999-12-31"


def _date(s: str) -> Column:
    return F.lit(s).cast("date")


def _ts(s: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{s}'")


def _s(c: Column) -> Column:
    return c.cast("string")


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    """Bank transactions from orders (batch or streaming input)."""
    st = F.col("o_orderstatus")
    return orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("txn_date"),
        F.when(st == "O", "deposit").when(st == "F", "withdrawal").otherwise("purchase").alias("txn_type"),
        F.floor(F.col("o_totalprice") / 500).cast("int").alias("txn_amount"))


def click_events_from_events(events: DataFrame, keep: tuple = ()) -> DataFrame:
    """Clickstream events (without the in-visit sequence number) from the
    ``events`` table (batch or streaming input), plus ``event_id`` and ``keep``."""
    et = F.col("event_type")
    visit = F.concat(_s(F.col("user_id")), F.lit("-"), ymd_text("ts", ""))
    cookie = F.concat(F.lit("c"), _s(F.col("user_id")),
                      F.when((F.col("user_id") % 3 == 0) & (F.dayofmonth("ts") % 2 == 1), "b").otherwise("a"))
    return events.select(
        visit.alias("visit_id"), cookie.alias("cookie_id"),
        (F.get_json_object("props", "$.k").cast("int") % 13 + 1).alias("page_id"),
        (F.when(et == "view", 1).when(et == "click", 2).when(et == "purchase", 3)
         .when(et == "signup", 4).otherwise(5)).alias("event_type"),
        F.col("ts").alias("event_time"), "event_id", *keep)


class Domain:
    """Domain tables over one input folder. Attributes are DataFrames.

    Every table is derived when it is read. With a ``store`` the tables whose
    derivation joins, aggregates or numbers rows (``plans.STORED_TABLES``) are
    read from there, as the original keeps them as tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, store: TableStore | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.store = store

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def lookup(self, name: str) -> DataFrame:
        return fixed.lookup(self.spark, name)

    def saved(self, name: str, build) -> DataFrame:
        """The stored form of a derived table where there is one, else its derivation."""
        if self.store is not None and name in self.store.names:
            return self.store.read(name)
        return build()

    # ------------------------------------------------------------------ diner
    @cached_property
    def sales(self) -> DataFrame:
        return self.saved("sales", self._build_sales)

    def _build_sales(self) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_partkey")
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("l_partkey").alias("product_id"))

    @cached_property
    def menu(self) -> DataFrame:
        p = self.t("part")
        return p.select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_type") == "PROMO", "sushi").otherwise(F.lower("p_type")).alias("product_name"),
            F.round("p_retailprice").cast("int").alias("price"))

    @cached_property
    def members(self) -> DataFrame:
        c = self.t("customer")
        return c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
            F.col("c_custkey").alias("customer_id"),
            F.date_add(_date("1995-01-01"), (F.col("c_custkey") % 2000).cast("int")).alias("join_date"))

    # ------------------------------------------------------------------ pizza
    @cached_property
    def customer_orders(self) -> DataFrame:
        return self.saved("customer_orders", self._build_customer_orders)

    def _build_customer_orders(self) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        pk, sk = F.col("l_partkey"), F.col("l_suppkey")
        one = lambda k: _s(k % 12 + 1)
        ex_sel = (F.col("l_partkey") + F.col("l_linenumber")) % 6
        exclusions = (F.when(ex_sel == 0, F.lit(None).cast("string"))
                      .when(ex_sel == 1, "").when(ex_sel == 2, "null")
                      .when(ex_sel == 3, one(pk))
                      .when(ex_sel == 4, F.concat(one(pk), F.lit(", "), one(pk + 5)))
                      .otherwise(""))
        x_sel = (F.col("l_orderkey") + F.col("l_linenumber")) % 5
        extras = (F.when(x_sel == 0, F.lit(None).cast("string"))
                  .when(x_sel == 1, "").when(x_sel == 2, "null")
                  .when(x_sel == 3, one(sk))
                  .otherwise(F.concat(one(sk), F.lit(", "), one(sk + 3))))
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("pizza_id"),
            exclusions.alias("exclusions"),
            extras.alias("extras"),
            F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, F.col("o_orderdate")).alias("order_time"))

    @cached_property
    def runner_orders(self) -> DataFrame:
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        k = F.col("o_orderkey")
        sel = (k * 7 + F.col("o_custkey")) % 10
        cancelled = sel < 2
        order_time = F.timestamp_add("MINUTE", k % 1440, F.col("o_orderdate"))
        pickup = F.timestamp_add("SECOND", k % 60, F.timestamp_add("MINUTE", k % 50 + 1, order_time))
        unit_d = F.when(k % 3 == 0, "km").when(k % 3 == 1, " km").otherwise("")
        unit_t = (F.when(k % 4 == 0, " minutes").when(k % 4 == 1, "mins")
                  .when(k % 4 == 2, "").otherwise(" minute"))
        return o.select(
            k.alias("order_id"),
            (k % 10 + 1).cast("int").alias("runner_id"),
            F.when(cancelled, "null").otherwise(ntz_text(pickup)).alias("pickup_time"),
            F.when(cancelled, "null").otherwise(
                F.concat(_s(k % 25 + 5), F.lit("."), F.lpad(_s(k % 100), 2, "0"), unit_d)).alias("distance"),
            F.when(cancelled, "null").otherwise(F.concat(_s(k % 31), unit_t)).alias("duration"),
            (F.when(sel == 0, "Restaurant Cancellation").when(sel == 1, "Customer Cancellation")
             .when(sel.isin(2, 3), "").when(sel.isin(4, 5), "null")
             .otherwise(F.lit(None).cast("string"))).alias("cancellation"))

    @cached_property
    def ratings(self) -> DataFrame:
        o = self.t("orders").select("o_orderkey", "o_custkey")
        k = F.col("o_orderkey")
        return o.filter((k * 7 + F.col("o_custkey")) % 10 >= 2).select(
            k.alias("order_id"), (k % 5 + 1).cast("int").alias("rating"))

    @cached_property
    def runners(self) -> DataFrame:
        s = self.t("supplier").select("s_suppkey")
        return s.select(F.col("s_suppkey").alias("runner_id"),
                        F.date_add(_date("2020-12-01"), (F.col("s_suppkey") % 90).cast("int"))
                        .alias("registration_date"))

    @cached_property
    def pizza_names(self) -> DataFrame:
        p = self.t("part").select("p_partkey")
        return p.select(F.col("p_partkey").alias("pizza_id"),
                        F.when(F.col("p_partkey") % 2 == 0, fixed.PIZZA_NAMES[0])
                        .otherwise(fixed.PIZZA_NAMES[1]).alias("pizza_name"))

    def _recipe_ids(self) -> Column:
        mult = F.col("p_size") % 2 + 1
        return F.filter(F.sequence(F.lit(1), F.lit(12)),
                        lambda t: (F.col("p_partkey") + t * mult) % 3 != 0)

    @cached_property
    def pizza_recipes_csv(self) -> DataFrame:
        p = self.t("part").select("p_partkey", "p_size")
        return p.select(F.col("p_partkey").alias("pizza_id"),
                        F.array_join(F.transform(self._recipe_ids(), lambda t: t.cast("string")), ", ")
                        .alias("toppings"))

    @cached_property
    def pizza_recipes(self) -> DataFrame:
        p = self.t("part").select("p_partkey", "p_size")
        return p.select(F.col("p_partkey").alias("pizza_id"),
                        F.explode(self._recipe_ids()).alias("toppings"))

    @cached_property
    def pizza_toppings(self) -> DataFrame:
        return self.lookup("pizza_toppings")

    # ---------------------------------------------------------- subscriptions
    @cached_property
    def subscriptions(self) -> DataFrame:
        o = self.t("orders").select("o_custkey", "o_orderpriority", "o_orderdate")
        return o.select(F.col("o_custkey").alias("customer_id"),
                        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("plan_id"),
                        F.to_date("o_orderdate").alias("start_date"))

    @cached_property
    def plans(self) -> DataFrame:
        return self.lookup("plans")

    # ------------------------------------------------------------------- bank
    @cached_property
    def customer_transactions(self) -> DataFrame:
        return transactions_from_orders(self.t("orders"))

    @cached_property
    def customer_nodes(self) -> DataFrame:
        return self.saved("customer_nodes", self._build_customer_nodes)

    def _build_customer_nodes(self) -> DataFrame:
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        c = self.t("customer").select("c_custkey", "c_nationkey")
        n = self.t("nation").select("n_nationkey", "n_regionkey")
        region = c.join(n, c.c_nationkey == n.n_nationkey).select(
            "c_custkey", (F.col("n_regionkey") + 1).alias("region_id"))
        stints = o.select("o_custkey", "o_orderkey", "o_orderdate",
                          (F.col("o_orderkey") % 5 + 1).cast("int").alias("node_id"),
                          F.to_date("o_orderdate").alias("start_date"))
        # the next stint's start, per customer in date order (bucketed by day, see operators.ordered)
        stints = lead_lag(stints, "o_custkey", ["o_orderdate", "o_orderkey"], {"start_date": "next_start"},
                          F.col("start_date"))
        stints = stints.withColumn("end_date", F.coalesce("next_start", _date(OPEN_END)))
        return stints.join(region, stints.o_custkey == region.c_custkey).select(
            F.col("o_custkey").alias("customer_id"), "region_id", "node_id", "start_date", "end_date")

    @cached_property
    def regions(self) -> DataFrame:
        r = self.t("region")
        return r.select((F.col("r_regionkey") + 1).alias("region_id"), F.col("r_name").alias("region_name"))

    # ----------------------------------------------------------------- retail
    @cached_property
    def weekly_sales(self) -> DataFrame:
        return self.saved("weekly_sales", self._build_weekly_sales)

    def _build_weekly_sales(self) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_extendedprice", "l_returnflag", "l_linestatus")
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        c = self.t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        n = self.t("nation").select("n_nationkey", "n_regionkey")
        r = self.t("region").select("r_regionkey", "r_name")
        seg = F.col("c_mktsegment")
        j = (li.join(o, li.l_orderkey == o.o_orderkey)
             .join(c, F.col("o_custkey") == c.c_custkey)
             .join(n, F.col("c_nationkey") == n.n_nationkey)
             .join(r, F.col("n_regionkey") == r.r_regionkey))
        g = j.groupBy(
            F.to_date(F.date_trunc("week", "o_orderdate")).alias("__week"),
            F.col("r_name").alias("region"),
            F.when(F.col("l_linestatus") == "O", "Shopify").otherwise("Retail").alias("platform"),
            (F.when(seg == "AUTOMOBILE", "C1").when(seg == "BUILDING", "C2")
             .when(seg == "FURNITURE", "F3").when(seg == "HOUSEHOLD", "F1")
             .otherwise("null")).alias("segment"),
            (F.when(F.col("l_returnflag") == "A", "Existing").when(F.col("l_returnflag") == "N", "New")
             .otherwise("Guest")).alias("customer_type"),
        ).agg(F.count("*").cast("int").alias("transactions"),
              F.sum(F.round("l_extendedprice").cast("bigint")).alias("sales"))
        # the week start is grouped as a date and written as text once per group
        return g.select(ymd_text("__week").alias("week_date"), "region", "platform", "segment",
                        "customer_type", "transactions", "sales")

    # ------------------------------------------------------------ clickstream
    @cached_property
    def click_events(self) -> DataFrame:
        return self.saved("click_events", self._build_click_events)

    def _build_click_events(self) -> DataFrame:
        base = click_events_from_events(self.t("events"))
        # position in the visit; bucketed by hour so a huge visit is numbered in pieces
        return row_number(base, "visit_id", ["event_time", "event_id"], F.hour("event_time"),
                          "sequence_number").drop("event_id")

    @cached_property
    def users(self) -> DataFrame:
        return self.saved("users", self._build_users)

    def _build_users(self) -> DataFrame:
        e = self.t("events").select("ts", "user_id")
        cookie = F.concat(F.lit("c"), _s(F.col("user_id")),
                          F.when((F.col("user_id") % 3 == 0) & (F.dayofmonth("ts") % 2 == 1), "b")
                          .otherwise("a"))
        return e.select(F.col("user_id"), cookie.alias("cookie_id")).distinct()

    @cached_property
    def page_hierarchy(self) -> DataFrame:
        return self.lookup("page_hierarchy")

    @cached_property
    def event_identifier(self) -> DataFrame:
        return self.lookup("event_identifier")

    @cached_property
    def campaign_identifier(self) -> DataFrame:
        return self.lookup("campaign_identifier")

    # ------------------------------------------------------------- ad metrics
    @cached_property
    def interest_metrics(self) -> DataFrame:
        """Raw form: ``month_year`` is text ``MM-yyyy``; NULL rows included."""
        li = self.t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                       "l_discount", "l_tax", "l_shipdate")
        is_null = F.col("l_orderkey") % 12 == 0
        idx = (F.year("l_shipdate") * 12 + F.month("l_shipdate")) % 14
        month = F.add_months(_date("2018-07-01"), idx.cast("int"))
        pk = F.col("l_partkey")
        interest = (F.when(is_null, F.lit(None).cast("bigint"))
                    .when(pk % 2 == 0, pk % 200)
                    .when(F.col("l_linenumber") == 7, pk + 100000)
                    .otherwise(pk))
        nul = lambda c: F.when(is_null, F.lit(None)).otherwise(c)
        return li.select(
            nul(F.month(month)).cast("int").alias("_month"),
            nul(F.year(month)).cast("int").alias("_year"),
            nul(F.concat(F.lpad(F.month(month).cast("string"), 2, "0"), F.lit("-"), F.year(month).cast("string")))
            .cast("string").alias("month_year"),
            interest.alias("interest_id"),
            F.col("l_quantity").alias("composition"),
            F.col("l_discount").alias("index_value"),
            F.col("l_linenumber").alias("ranking"),
            F.col("l_tax").alias("percentile_ranking"))

    @cached_property
    def interest_metrics_dated(self) -> DataFrame:
        """S8-1: ``month_year`` as the DATE of the month start (the original retypes the column in place)."""
        return self.saved("interest_metrics_dated", self._build_interest_metrics_dated)

    def _build_interest_metrics_dated(self) -> DataFrame:
        text = F.col("month_year")
        month = F.make_date(F.substring(text, 4, 4).cast("int"), F.substring(text, 1, 2).cast("int"), F.lit(1))
        return self.interest_metrics.withColumn("month_year", month)

    @cached_property
    def interest_map(self) -> DataFrame:
        p = self.t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
        created = F.timestamp_add("HOUR", F.col("p_partkey") % 24,
                                  F.timestamp_add("DAY", F.col("p_partkey") % 500, _ts("2018-05-01 00:00:00")))
        return p.select(
            F.col("p_partkey").alias("id"),
            F.concat_ws(" ", "p_name", "p_brand").alias("interest_name"),
            F.col("p_type").alias("interest_summary"),
            created.alias("created_at"),
            F.timestamp_add("DAY", F.col("p_size"), created).alias("last_modified"))


# ---------------------------------------------------------------------------
# The same derivations as SQL, for the oracle. Base inputs are views named
# after the parquet tables; each entry may use entries defined before it.
# ---------------------------------------------------------------------------

_MIN = "* INTERVAL 1 MINUTE"

DOMAIN_SQL: dict[str, str] = {
    "sales": """
SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date, l.l_partkey AS product_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "menu": """
SELECT p_partkey AS product_id,
       CASE WHEN p_type = 'PROMO' THEN 'sushi' ELSE lower(p_type) END AS product_name,
       CAST(round(p_retailprice) AS INTEGER) AS price
FROM part""",
    "members": """
SELECT c_custkey AS customer_id, DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS join_date
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "customer_orders": f"""
SELECT l.l_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS pizza_id,
  CASE (l.l_partkey + l.l_linenumber) % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'null'
    WHEN 3 THEN CAST(l.l_partkey % 12 + 1 AS VARCHAR)
    WHEN 4 THEN CAST(l.l_partkey % 12 + 1 AS VARCHAR) || ', ' || CAST((l.l_partkey + 5) % 12 + 1 AS VARCHAR)
    ELSE '' END AS exclusions,
  CASE (l.l_orderkey + l.l_linenumber) % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'null'
    WHEN 3 THEN CAST(l.l_suppkey % 12 + 1 AS VARCHAR)
    ELSE CAST(l.l_suppkey % 12 + 1 AS VARCHAR) || ', ' || CAST((l.l_suppkey + 3) % 12 + 1 AS VARCHAR) END AS extras,
  o.o_orderdate + (o.o_orderkey % 1440) {_MIN} AS order_time
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "runner_orders": f"""
SELECT o_orderkey AS order_id, CAST(o_orderkey % 10 + 1 AS INTEGER) AS runner_id,
  CASE WHEN (o_orderkey * 7 + o_custkey) % 10 < 2 THEN 'null'
       ELSE strftime(o_orderdate + (o_orderkey % 1440) {_MIN} + (o_orderkey % 50 + 1) {_MIN}
                     + (o_orderkey % 60) * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') END AS pickup_time,
  CASE WHEN (o_orderkey * 7 + o_custkey) % 10 < 2 THEN 'null'
       ELSE CAST(o_orderkey % 25 + 5 AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')
            || CASE o_orderkey % 3 WHEN 0 THEN 'km' WHEN 1 THEN ' km' ELSE '' END END AS distance,
  CASE WHEN (o_orderkey * 7 + o_custkey) % 10 < 2 THEN 'null'
       ELSE CAST(o_orderkey % 31 AS VARCHAR)
            || CASE o_orderkey % 4 WHEN 0 THEN ' minutes' WHEN 1 THEN 'mins' WHEN 2 THEN '' ELSE ' minute' END
       END AS duration,
  CASE (o_orderkey * 7 + o_custkey) % 10 WHEN 0 THEN 'Restaurant Cancellation'
       WHEN 1 THEN 'Customer Cancellation' WHEN 2 THEN '' WHEN 3 THEN '' WHEN 4 THEN 'null'
       WHEN 5 THEN 'null' ELSE NULL END AS cancellation
FROM orders""",
    "ratings": """
SELECT o_orderkey AS order_id, CAST(o_orderkey % 5 + 1 AS INTEGER) AS rating
FROM orders WHERE (o_orderkey * 7 + o_custkey) % 10 >= 2""",
    "runners": """
SELECT s_suppkey AS runner_id, DATE '2020-12-01' + CAST(s_suppkey % 90 AS INTEGER) AS registration_date
FROM supplier""",
    "pizza_names": f"""
SELECT p_partkey AS pizza_id,
       CASE WHEN p_partkey % 2 = 0 THEN '{fixed.PIZZA_NAMES[0]}' ELSE '{fixed.PIZZA_NAMES[1]}' END AS pizza_name
FROM part""",
    "pizza_recipes_csv": """
SELECT p_partkey AS pizza_id,
       array_to_string(list_transform(
         list_filter(range(1, 13), lambda t: (p_partkey + t * (p_size % 2 + 1)) % 3 <> 0),
         lambda t: CAST(t AS VARCHAR)), ', ') AS toppings
FROM part""",
    "pizza_recipes": """
SELECT p_partkey AS pizza_id,
       CAST(unnest(list_filter(range(1, 13), lambda t: (p_partkey + t * (p_size % 2 + 1)) % 3 <> 0))
            AS INTEGER) AS toppings
FROM part""",
    "pizza_toppings": fixed.lookup_sql("pizza_toppings"),
    "subscriptions": """
SELECT o_custkey AS customer_id, CAST(left(o_orderpriority, 1) AS INTEGER) - 1 AS plan_id,
       CAST(o_orderdate AS DATE) AS start_date
FROM orders""",
    "plans": fixed.lookup_sql("plans"),
    "customer_transactions": """
SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS txn_date,
       CASE o_orderstatus WHEN 'O' THEN 'deposit' WHEN 'F' THEN 'withdrawal' ELSE 'purchase' END AS txn_type,
       CAST(floor(o_totalprice / 500) AS INTEGER) AS txn_amount
FROM orders""",
    "customer_nodes": """
SELECT s.o_custkey AS customer_id, n.n_regionkey + 1 AS region_id, s.node_id, s.start_date, s.end_date
FROM (SELECT o_custkey, CAST(o_orderkey % 5 + 1 AS INTEGER) AS node_id,
             CAST(o_orderdate AS DATE) AS start_date,
             coalesce(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
                      DATE '9999-12-31') AS end_date
      FROM orders) s
JOIN customer c ON s.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "regions": "SELECT r_regionkey + 1 AS region_id, r_name AS region_name FROM region",
    "weekly_sales": """
SELECT strftime(date_trunc('week', o.o_orderdate), '%Y-%m-%d') AS week_date,
       r.r_name AS region,
       CASE WHEN l.l_linestatus = 'O' THEN 'Shopify' ELSE 'Retail' END AS platform,
       CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'C1' WHEN 'BUILDING' THEN 'C2'
            WHEN 'FURNITURE' THEN 'F3' WHEN 'HOUSEHOLD' THEN 'F1' ELSE 'null' END AS segment,
       CASE l.l_returnflag WHEN 'A' THEN 'Existing' WHEN 'N' THEN 'New' ELSE 'Guest' END AS customer_type,
       CAST(count(*) AS INTEGER) AS transactions,
       CAST(sum(CAST(round(l.l_extendedprice) AS BIGINT)) AS BIGINT) AS sales
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY ALL""",
    "click_events": """
SELECT visit_id, cookie_id, page_id, event_type, event_time,
       CAST(row_number() OVER (PARTITION BY visit_id ORDER BY event_time, event_id) AS INTEGER) AS sequence_number
FROM (SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS visit_id,
             'c' || CAST(user_id AS VARCHAR)
                 || CASE WHEN user_id % 3 = 0 AND day(ts) % 2 = 1 THEN 'b' ELSE 'a' END AS cookie_id,
             CAST(json_extract_string(props, '$.k') AS INTEGER) % 13 + 1 AS page_id,
             CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
                  WHEN 'signup' THEN 4 ELSE 5 END AS event_type,
             ts AS event_time, event_id
      FROM events) e""",
    "users": """
SELECT DISTINCT user_id,
       'c' || CAST(user_id AS VARCHAR) || CASE WHEN user_id % 3 = 0 AND day(ts) % 2 = 1 THEN 'b' ELSE 'a' END
         AS cookie_id
FROM events""",
    "page_hierarchy": fixed.lookup_sql("page_hierarchy"),
    "event_identifier": fixed.lookup_sql("event_identifier"),
    "campaign_identifier": fixed.lookup_sql("campaign_identifier"),
    "interest_metrics": """
SELECT CASE WHEN l_orderkey % 12 = 0 THEN NULL ELSE CAST(month(m) AS INTEGER) END AS _month,
       CASE WHEN l_orderkey % 12 = 0 THEN NULL ELSE CAST(year(m) AS INTEGER) END AS _year,
       CASE WHEN l_orderkey % 12 = 0 THEN NULL ELSE strftime(m, '%m-%Y') END AS month_year,
       CASE WHEN l_orderkey % 12 = 0 THEN NULL WHEN l_partkey % 2 = 0 THEN l_partkey % 200
            WHEN l_linenumber = 7 THEN l_partkey + 100000 ELSE l_partkey END AS interest_id,
       l_quantity AS composition, l_discount AS index_value, l_linenumber AS ranking,
       l_tax AS percentile_ranking
FROM (SELECT *, CAST(DATE '2018-07-01'
                     + to_months(CAST((year(l_shipdate) * 12 + month(l_shipdate)) % 14 AS INTEGER)) AS DATE) AS m
      FROM lineitem) l""",
    "interest_metrics_dated": """
SELECT * REPLACE (CAST(strptime('01-' || month_year, '%d-%m-%Y') AS DATE) AS month_year)
FROM interest_metrics""",
    "interest_map": """
SELECT p_partkey AS id, concat_ws(' ', p_name, p_brand) AS interest_name, p_type AS interest_summary,
       TIMESTAMP '2018-05-01 00:00:00' + to_days(CAST(p_partkey % 500 AS INTEGER))
         + to_hours(CAST(p_partkey % 24 AS INTEGER)) AS created_at,
       TIMESTAMP '2018-05-01 00:00:00' + to_days(CAST(p_partkey % 500 AS INTEGER))
         + to_hours(CAST(p_partkey % 24 AS INTEGER)) + to_days(p_size) AS last_modified
FROM part""",
}
