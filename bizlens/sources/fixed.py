"""Small fixed lookup tables (bounded size, safe to broadcast).

Each table is held once as plain rows so that the Spark side
(``createDataFrame``) and the SQL oracle side (``VALUES``) use the same data.
"""

from __future__ import annotations

import re
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: must equal the reference's lookup data -------------------
# pizza names by parity of the pizza key; toppings; plans; event names
PIZZA_NAMES = ("Meatlovers", "Vegetarian")
PIZZA_TOPPINGS = [
    (1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"),
    (6, "Mushrooms"), (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"),
    (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce"),
]
PLANS = [
    (0, "trial", Decimal("0.00")), (1, "basic monthly", Decimal("9.90")),
    (2, "pro monthly", Decimal("19.90")), (3, "pro annual", Decimal("199.00")),
    (4, "churn", None),
]
EVENT_IDENTIFIER = [
    (1, "Page View"), (2, "Add to Cart"), (3, "Purchase"),
    (4, "Ad Impression"), (5, "Ad Click"),
]
# --- end of fixed values -----------------------------------------------------

# Our own choice (the reference has no data for these): 13 shop pages, 9 with
# a product, and three campaigns with gaps and noon borders.
PAGE_HIERARCHY = [
    (1, "Home Page", None, None), (2, "All Products", None, None),
    (3, "Anchovy", "Fish", 1), (4, "Herring", "Fish", 2), (5, "Mackerel", "Fish", 3),
    (6, "Saffron", "Spice", 4), (7, "Vanilla", "Spice", 5),
    (8, "Clam", "Shellfish", 6), (9, "Mussel", "Shellfish", 7),
    (10, "Prawn", "Shellfish", 8), (11, "Scallop", "Shellfish", 9),
    (12, "Checkout", None, None), (13, "Confirmation", None, None),
]
CAMPAIGNS = [
    ("Spring Sale", datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 10, 12, 0)),
    ("Member Week", datetime(2024, 1, 12, 0, 0), datetime(2024, 1, 20, 12, 0)),
    ("Clearance", datetime(2024, 1, 22, 0, 0), datetime(2024, 1, 28, 0, 0)),
]

SCHEMAS = {
    "pizza_toppings": ("topping_id int, topping_name string", PIZZA_TOPPINGS),
    "plans": ("plan_id int, plan_name string, price decimal(5,2)", PLANS),
    "event_identifier": ("event_type int, event_name string", EVENT_IDENTIFIER),
    "page_hierarchy": ("page_id int, page_name string, product_category string, product_id int",
                       PAGE_HIERARCHY),
    "campaign_identifier": ("campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz",
                            CAMPAIGNS),
}


def _spark_literal(v, typ: str) -> str:
    if v is None:
        return f"CAST(NULL AS {typ})"
    if isinstance(v, datetime):
        return f"TIMESTAMP_NTZ '{v:%Y-%m-%d %H:%M:%S}'"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({v} AS {typ})"


def lookup(spark: SparkSession, name: str) -> DataFrame:
    """The rows as an inline VALUES relation: planned as a local table scan in
    the JVM (no Python worker), small enough to broadcast."""
    schema, rows = SCHEMAS[name]
    cols = [c.strip().split(" ") for c in re.split(r",(?![^()]*\))", schema)]
    values = ", ".join("(" + ", ".join(_spark_literal(v, t) for v, (_, t) in zip(r, cols)) + ")" for r in rows)
    names = ", ".join(c for c, _ in cols)
    return spark.sql(f"SELECT * FROM VALUES {values} AS v({names})")


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, datetime):
        return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"
    return str(v)


_SQL_TYPES = {"int": "INTEGER", "string": "VARCHAR", "decimal(5,2)": "DECIMAL(5,2)",
              "timestamp_ntz": "TIMESTAMP"}


def lookup_sql(name: str) -> str:
    """The same rows as a SQL ``SELECT ... FROM (VALUES ...)`` for the oracle."""
    schema, rows = SCHEMAS[name]
    cols = [c.strip().split(" ") for c in re.split(r",(?![^()]*\))", schema)]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(c for c, _ in cols)
    casts = ", ".join(f"CAST({c} AS {_SQL_TYPES[t]}) AS {c}" for c, t in cols)
    return f"SELECT {casts} FROM (VALUES {values}) AS v({names})"
