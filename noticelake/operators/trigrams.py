"""Which storage partitions can hold a text (F5): a Bloom filter of trigrams for each.

The filter of a partition is a set of bits, one for each trigram that a text of it has, hashed to ``BITS``
places and kept in rows of 4 KB by Spark's bitmap functions. Texts and patterns are brought to one form
first in which whatever the case-insensitive search takes as equal is equal. A filter can say that a partition holds
a trigram when it does not, never the other way round.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.schemas import PARTITION

#: Places of a filter; 16 rows of 4 KB at most.
BITS = 1 << 19
SCHEMA = f"balde long, bits binary, {PARTITION} string"

_ANYTHING_BETWEEN = re.compile(r"\.[*+]")
_REGEX_CHARACTERS = re.compile(r"[\\.^$*+?()\[\]{}]")


def common_form(text: Column) -> Column:
    """Upper case, then lower case, as some letters have a common upper case alone; without the dot that a
    lower-cased dotted I leaves behind. (Taken out in between as well: Spark would drop an upper case right
    below a lower case.)"""
    dot = F.lit("\u0307")
    return F.replace(F.lower(F.replace(F.upper(text), dot, F.lit(""))), dot, F.lit(""))


def trigrams_of(text: Column) -> Column:
    """All runs of three characters, overlapping, in one pass."""
    return F.regexp_extract_all(common_form(text), F.lit("(?s)(?=(...))"), F.lit(1))


def _place(trigram: Column) -> Column:
    return F.pmod(F.xxhash64(trigram), F.lit(BITS)) + 1


def filters(rows: DataFrame, column: str = "objeto_compra") -> DataFrame:
    """The filters of the partitions of ``rows``. Bits are set in the map tasks, so what is shuffled is filters."""
    place = _place(F.col("_trigrama"))
    each = rows.select(PARTITION, F.explode(F.array_distinct(trigrams_of(F.col(column)))).alias("_trigrama"))
    set_bits = each.select(PARTITION, F.bitmap_bucket_number(place).alias("balde"), F.bitmap_bit_position(place).alias("_bit"))
    return set_bits.groupBy("balde", PARTITION).agg(F.bitmap_construct_agg("_bit").alias("bits")).select("balde", "bits", PARTITION)


def fixed_places(spark: SparkSession, pattern: str) -> list[list[tuple[int, int]]] | None:
    """For each alternative of a pattern the bits that a text which matches must have set; None if an alternative has
    no fixed trigram, or the pattern is more than words and "anything between"."""
    alternatives = [_ANYTHING_BETWEEN.split(a) for a in pattern.split("|")]
    if any(_REGEX_CHARACTERS.search(piece) for pieces in alternatives for piece in pieces):
        return None
    asked = [F.flatten(F.array(*[trigrams_of(F.lit(piece)) for piece in pieces])) for pieces in alternatives]
    bits = [F.transform(t, lambda x: F.struct(F.bitmap_bucket_number(_place(x)), F.bitmap_bit_position(_place(x)))) for t in asked]
    found = [sorted({tuple(r) for r in row}) for row in spark.range(1).select(F.array(*bits)).first()[0]]
    return found if all(found) else None


def partitions_with(table: DataFrame, wanted: list[list[tuple[int, int]]]) -> set[str | None]:
    """Partitions whose filter has all bits of an alternative: bounded by the number of partitions."""
    bits = sorted({bit for alternative in wanted for bit in alternative})

    def is_set(bucket: int, position: int) -> Column:
        byte = F.conv(F.hex(F.substring("bits", position // 8 + 1, 1)), 16, 10).cast("int")
        return F.coalesce(F.max((F.col("balde") == bucket) & (byte.bitwiseAND(1 << position % 8) != 0)), F.lit(False))

    names = {bit: f"_{i}" for i, bit in enumerate(bits)}
    rows = table.filter(F.col("balde").isin(sorted({bucket for bucket, _ in bits})))
    seen = rows.groupBy(PARTITION).agg(*[is_set(*bit).alias(name) for bit, name in names.items()])
    possible = reduce(or_, [reduce(and_, [F.col(names[bit]) for bit in alternative]) for alternative in wanted])
    return {r[0] for r in seen.filter(possible).select(PARTITION).collect()}
