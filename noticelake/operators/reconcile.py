"""Keyed upsert as a join (K1, K2, K4, K5)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUS = "estado"
INSERTED, UPDATED, UNCHANGED, KEPT = "inserido", "atualizado", "inalterado", "mantido"
COUNTS = {INSERTED: "inseridos", UPDATED: "atualizados", UNCHANGED: "inalterados", KEPT: "mantidos"}


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality, as a null key is a key like any other here."""
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def reconcile(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    merge_fields: bool = False,
    ignore: Iterable[str] = (),
    before: Mapping[str, str] | None = None,
    nulls: str | None = None,
) -> DataFrame:
    """The table after the upsert, each row with what became of it in ``estado``.

    Keys are unique on either side (``latest`` collapses a batch), so the join
    has no hot key whatever the data looks like.

    ``merge_fields=False`` (K2): a batch row replaces the stored row whole.
    ``merge_fields=True`` (K1): non-null top-level fields of the batch row
    replace the stored ones, the others survive; a nested object is one field (see ``nulls``).
    ``ignore``: columns that do not make a row "updated" (defect D14).
    ``before``: columns whose stored value is given too, under another name.
    ``nulls``: a batch column that names the row's fields that were given as null, which empties the stored
    field in a merge; a field that was left out is null too and survives.
    """
    if nulls is not None and nulls not in batch.columns:
        nulls = None
    fields = [c for c in batch.columns if c != nulls]
    stored = current.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.struct(*current.columns).alias("_old"))
    after = batch.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.struct(*batch.columns).alias("_new"))
    joined = stored.join(
        after, reduce(and_, [F.col(f"_b_{k}").eqNullSafe(F.col(f"_a_{k}")) for k in keys]), "full_outer"
    )

    def emptied(name: str) -> Column:
        return F.coalesce(F.array_contains(f"_new.{nulls}", name), F.lit(False)) if nulls else F.lit(False)

    def value(name: str) -> Column:
        if name not in fields:
            return F.col(f"_old.{name}")
        new = F.col(f"_new.{name}")
        if name not in current.columns:
            return new
        old = F.col(f"_old.{name}")
        if merge_fields:
            return F.when(~emptied(name), F.coalesce(new, old)) if nulls else F.coalesce(new, old)
        return F.when(F.col("_new").isNotNull(), new).otherwise(old)

    def changed(name: str) -> Column:
        # only asked where both rows are there
        old = F.col(f"_old.{name}") if name in current.columns else F.lit(None)
        new = F.col(f"_new.{name}")
        differs = ~new.eqNullSafe(old)
        return (new.isNotNull() | emptied(name)) & differs if merge_fields else differs

    columns = current.columns + [c for c in fields if c not in current.columns]
    skipped = set(ignore)
    unchanged = ~reduce(or_, [changed(c) for c in fields if c not in skipped], F.lit(False))
    status = (
        F.when(F.col("_old").isNull(), INSERTED)
        .when(F.col("_new").isNull(), KEPT)
        .when(unchanged, UNCHANGED)
        .otherwise(UPDATED)
    )
    were = [F.col(f"_old.{c}").alias(name) for c, name in (before or {}).items()]
    return joined.select(*[value(c).alias(c) for c in columns], status.alias(STATUS), *were)


def upsert(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], merge_fields: bool = False, nulls: str | None = None
) -> DataFrame:
    """K1/K2 without the status."""
    return reconcile(current, batch, keys, merge_fields, nulls=nulls).drop(STATUS)


def outcome_counts() -> list[Column]:
    return [F.count_if(F.col(STATUS) == status).alias(name) for status, name in COUNTS.items()]


def change_counts(reconciled: DataFrame, *more: Column) -> DataFrame:
    """K4: one row of counts by outcome."""
    return reconciled.agg(*outcome_counts(), *more)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K5: the keys that break uniqueness, with how often they occur."""
    return df.groupBy(*keys).agg(F.count("*").alias("ocorrencias")).filter("ocorrencias > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K5 as a guard: raises when a key occurs twice."""
    if not repeated_keys(df, keys).isEmpty():
        raise ValueError(f"key {tuple(keys)} is not unique")
    return df
