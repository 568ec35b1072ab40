"""Named queries: one per business question of the seven case studies.

Each query is a function ``Domain -> DataFrame`` registered with ``@query``
together with its SQL oracle. The oracle is written against the domain tables;
``oracle_sql(name)`` prefixes the SQL definitions of the domain tables it
references (``DOMAIN_SQL`` and the derived views in ``VIEW_SQL``) so that it
runs on the raw input tables alone.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bizlens.session import TableStore
from bizlens.sources.domain import DOMAIN_SQL, Domain


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[Domain], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}
# views derived from domain tables (materialised tables of the reference)
VIEW_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Callable[[Domain], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def view_sql(name: str, sql: str) -> None:
    VIEW_SQL[name] = sql


# result tables that the original keeps (CREATE TABLE AS SELECT), by name
KEPT: dict[str, Callable[[Domain], DataFrame]] = {}


def kept(name: str):
    """Registers the derivation of a result table that a store may hold; a plan
    reads it with ``kept_table``."""
    def deco(fn: Callable[[Domain], DataFrame]):
        KEPT[name] = fn
        return fn
    return deco


def kept_table(d: Domain, name: str) -> DataFrame:
    """The stored form of a result table where there is one, else its derivation."""
    return d.saved(name, lambda: KEPT[name](d))


def _all_views() -> dict[str, str]:
    return {**DOMAIN_SQL, **VIEW_SQL}


def _refs(sql: str, names) -> set[str]:
    """Views used as tables (after FROM or JOIN) in ``sql``."""
    return {n for n in names if re.search(rf"(?i)\b(?:from|join)\s+{re.escape(n)}\b", sql)}


def with_views(sql: str) -> str:
    """``sql`` with the view definitions it needs as leading CTEs."""
    views = _all_views()
    need = _refs(sql, views)
    frontier = set(need)
    while frontier:
        nxt = set()
        for n in frontier:
            nxt |= _refs(views[n], views) - need - {n}
        need |= nxt
        frontier = nxt
    if not need:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({views[n].strip()})" for n in views if n in need)
    body = sql.strip()
    m = re.match(r"(?is)^with\s+(recursive\s+)?", body)
    if m:
        return f"WITH {ctes},\n{body[m.end():]}"
    return f"WITH {ctes}\n{body}"


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    from bizlens.plans import (  # noqa: F401
        bank, clickstream, diner, pizza, retail, segments, subscriptions)
    return REGISTRY


def spark_queries(store: TableStore | None = None) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query as ``(spark, input_dir) -> DataFrame``. Tables are opened and
    derived anew on each call, so a changed input is seen; no job runs before
    the result is asked for. With a ``store`` (see ``store_tables``) derived
    tables are read from it."""
    out = {}
    for name, q in load_all().items():
        out[name] = (lambda fn: lambda spark, sf_dir: fn(Domain(spark, sf_dir, store)))(q.fn)
    return out


def oracle_queries() -> dict[str, str]:
    return {name: with_views(q.sql) for name, q in load_all().items() if q.sql}


# what a store may hold, in the order of their derivation, and the columns that the queries join or group it
# by: domain tables whose derivation joins, numbers or parses rows, and result tables that the original keeps
STORED_TABLES: dict[str, tuple[str, ...]] = {
    "sales": ("customer_id",), "customer_orders": ("order_id",), "customer_nodes": ("customer_id",), "weekly_sales": (),
    "click_events": ("visit_id",), "users": ("cookie_id",), "interest_metrics_dated": ("interest_id",),
    "clean_weekly_sales": (), "product_analysis": ()}


def store_tables(spark: SparkSession, sf_dir: str, names=tuple(STORED_TABLES), buckets: int | None = None, took: dict | None = None) -> TableStore:
    """Writes tables once, for many queries over one input; a later one is
    derived from the earlier ones in the store. With ``buckets`` tables that are
    joined by a column are laid out in as many buckets of it, sorted, so such
    joins and groupings need no exchange. ``took`` receives the seconds of each.
    The caller drops the store."""
    load_all()
    store = TableStore(spark)
    for name in names:
        t0 = time.perf_counter()
        d = Domain(spark, sf_dir, store)
        table = KEPT[name](d) if name in KEPT else getattr(d, name)
        store.write(name, table, STORED_TABLES.get(name, ()), buckets)
        if took is not None:
            took[name] = round(time.perf_counter() - t0, 3)
    return store


DOMAIN_TABLES = ("sales", "menu", "members", "customer_orders", "runner_orders", "ratings", "runners",
                 "pizza_names", "pizza_recipes", "pizza_recipes_csv", "pizza_toppings", "subscriptions", "plans",
                 "customer_transactions", "customer_nodes", "regions", "weekly_sales", "click_events", "users",
                 "page_hierarchy", "event_identifier", "campaign_identifier", "interest_metrics",
                 "interest_metrics_dated", "interest_map")


def register_views(spark: SparkSession, sf_dir: str, queries: bool = True) -> list[str]:
    """CREATE VIEW for every domain table and (optionally) every query result,
    as temporary views of this session, so they can also be used from SQL.
    Views are lazy: nothing runs until a query reads them."""
    d = Domain(spark, sf_dir)
    names = []
    for t in DOMAIN_TABLES:
        getattr(d, t).createOrReplaceTempView(t)
        names.append(t)
    if queries:
        for name, q in load_all().items():
            q.fn(d).createOrReplaceTempView(name)
            names.append(name)
    return names
