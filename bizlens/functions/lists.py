"""Ordered string lists per group (the ``GROUP_CONCAT ... ORDER BY`` of SQL).

The list is built by Spark's ``listagg ... WITHIN GROUP (ORDER BY ...)``
aggregate: partial aggregation happens map-side, the order is total (callers
pass a tie-break), NULL items are skipped and the result is never truncated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_list(value: str, order: Sequence[str] | str, sep: str = ", ") -> Column:
    """Aggregate expression: ``value`` items joined by ``sep`` in ``order``."""
    if isinstance(order, str):
        order = [order]
    sep_sql = sep.replace("'", "''")
    return F.expr(f"listagg({value}, '{sep_sql}') WITHIN GROUP (ORDER BY {', '.join(order)})")
