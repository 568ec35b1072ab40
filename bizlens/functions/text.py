"""Dirty-text rules, as column expressions (all JVM-side, no UDF).

- missing markers: ``''``, ``'null'`` (any case, padded) and NULL all mean "none"
- numbers held as text with units (``'20km'``, ``'23.4 km'``, ``'15 minute'``)
- comma-separated lists in text (``'1, 4'``)
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING_TOKENS = ("", "null")
NUMBER_PREFIX = r"^\s*([+-]?[0-9]*\.?[0-9]+)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_token(c, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """``c`` with the missing markers turned into NULL."""
    c = _col(c)
    return F.when(F.lower(F.trim(c)).isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def clean_null_tokens(df: DataFrame, cols: Iterable[str],
                      tokens: Iterable[str] = MISSING_TOKENS) -> DataFrame:
    """O1: replace missing markers by NULL in ``cols``."""
    tokens = tuple(tokens)
    return df.withColumns({c: null_token(c, tokens) for c in cols})


def parse_measure(c) -> Column:
    """O2: the leading number of a text value with a unit, as double.

    ``'20km'`` -> 20.0, ``'23.4 km'`` -> 23.4, ``'null'``/``''``/NULL -> NULL.
    """
    digits = F.regexp_extract(_col(c), NUMBER_PREFIX, 1)
    return F.when(digits != "", digits).cast("string").try_cast("double")


def csv_items(c) -> Column:
    """CSV text -> array of trimmed, non-empty items (NULL/markers -> empty)."""
    cleaned = null_token(c)
    arr = F.split(F.trim(cleaned), r"\s*,\s*")
    return F.when(cleaned.isNull(), F.array().cast("array<string>")).otherwise(F.array_remove(arr, ""))


def explode_csv(df: DataFrame, col: str, out: str, as_type: str | None = None) -> DataFrame:
    """O3: one row per item of a CSV text column (rows with no item vanish)."""
    df = df.withColumn(out, F.explode(csv_items(col)))
    return df.withColumn(out, F.col(out).try_cast(as_type)) if as_type else df


def csv_count(c) -> Column:
    """Number of items in a CSV text column."""
    return F.size(csv_items(c))
