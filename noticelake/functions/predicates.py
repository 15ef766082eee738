"""Optional filters.

Each helper returns a condition, or None when its argument is empty; ``every``
joins what is left. An empty argument adds nothing.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions import dates, text, values


def every(*conditions: Column | None) -> Column:
    """F7."""
    return reduce(and_, [c for c in conditions if c is not None], F.lit(True))


def state_is(uf: str | None, column: str = "uf") -> Column | None:
    """F2."""
    return F.col(column) == uf.upper() if uf else None


def period_is(period: str | None) -> Column | None:
    """F3 on the two period columns the tables have (defect D2)."""
    if not period:
        return None
    start, end = dates.split_period(period)
    return (F.col("periodo_inicio") == start) & (F.col("periodo_fim") == end)


def year_is(year: int | str | None) -> Column | None:
    """F4."""
    return F.col("ano") == int(year) if year else None


def category_is(label: str | None) -> Column | None:
    """F6."""
    return F.col("ramo_mei") == label if label else None


def modality_is(code: int | None, column: str = "modalidadeId") -> Column | None:
    """F8."""
    return values.to_whole(F.col(column)) == int(code) if code else None


def text_has(pattern: str | None, column: str = "objeto_compra") -> Column | None:
    return text.search(F.col(column), pattern) if pattern else None


def published(start: str | None, end: str | None, column: str = "data_publicacao_pncp") -> Column | None:
    """F1 as an optional filter: needs both ends."""
    return dates.published_between(F.col(column), start, end) if start and end else None
