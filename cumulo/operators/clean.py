"""Projections, filters and dedup (inventory section 2B)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.operators.analytics import dedup  # noqa: F401  (B11 lives with its users)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns by a map."""
    return df.withColumnsRenamed(dict(mapping))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """DISTINCT (or GROUP BY all columns) - one aggregate, map-side combined."""
    return (df.select(*cols) if cols else df).dropDuplicates()


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "num_rows") -> DataFrame:
    """Keys occurring more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill missing values column by column (`coalesce`, no row lambdas)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def upper_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Case change as a column expression."""
    return df.withColumns({c: F.upper(F.col(c)) for c in cols})
