"""Order-independent fingerprints of tables, for comparing what sums cannot tell apart.

A row's fingerprint is a pair of 64-bit hashes of its columns, which also tell NULL from
nothing; a table's is the pair of their sums with the number of rows. Sums are exact decimals,
so fingerprints of parts add up to that of the whole, in any order, and repeated rows count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 64
_WIDE = "decimal(38,0)"


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of the columns. NULLs are hashed as such, not skipped."""
    values = [F.col(c) for c in columns]
    empty = [F.col(c).isNull() for c in columns]
    return (F.xxhash64(F.lit(1), *values, *empty), F.xxhash64(F.lit(2), *empty, *values))


def part_of(key: str, parts: int = PARTS) -> Column:
    """The part of the key space a key belongs to."""
    return F.pmod(F.xxhash64(F.lit(3), F.col(key)), F.lit(parts)).cast("int")


def _sides(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str],
           parts: int) -> DataFrame:
    """Both tables as narrow rows: key, part, sign, hashes."""
    one, two = row_hashes([key, *columns])
    picked = [F.col(key), part_of(key, parts).alias("part"),
              one.cast(_WIDE).alias("_one"), two.cast(_WIDE).alias("_two")]
    return left.select(*picked, F.lit(1).alias("_sign")).unionByName(
        right.select(*picked, F.lit(-1).alias("_sign")))


def _balance() -> list[Column]:
    """Signed sums, all zero where both sides have the same rows."""
    return [F.sum("_sign").alias("_rows"), F.sum(F.col("_sign") * F.col("_one")).alias("_a"),
            F.sum(F.col("_sign") * F.col("_two")).alias("_b")]


def _is_equal() -> Column:
    return (F.col("_rows") == 0) & (F.col("_a") == 0) & (F.col("_b") == 0)


def compare_parts(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str],
                  parts: int = PARTS) -> DataFrame:
    """``part, left_rows, right_rows, passed`` for every part of the key space with rows.

    Tasks send one row for each part and side, whatever the tables hold.
    """
    sides = _sides(left, right, key, columns, parts)
    return sides.groupBy("part").agg(
        F.count_if(F.col("_sign") == 1).alias("left_rows"),
        F.count_if(F.col("_sign") == -1).alias("right_rows"), *_balance(),
    ).select("part", "left_rows", "right_rows", _is_equal().alias("passed"))


def differing_keys(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str],
                   wrong: Sequence[int], parts: int = PARTS) -> DataFrame:
    """Keys whose rows differ between the tables, with the surplus of rows on the left.

    ``wrong`` are the parts that :func:`compare_parts` found to differ; only their rows are
    shuffled by key.
    """
    sides = _sides(left, right, key, columns, parts).filter(F.col("part").isin(list(wrong)))
    return sides.groupBy(key).agg(*_balance()).filter(~_is_equal()).select(
        key, F.col("_rows").alias("surplus"))
