"""Number of distinct items from registers: a small table that merges by maximum (HyperLogLog).

An item's hash names a register and a rank, one more than the leading zeros of the rest. A register keeps
its highest rank, so tables of parts, of batches or of a stream merge into that of the whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 12  # 4096 registers: a standard error of 1.6 %
HASH_BITS = 52
MOST_BITS = 20


def register_and_rank(item: Column, bits: int = BITS) -> tuple[Column, Column]:
    """From the first 52 bits of the MD5 digest of the item as text: the top ``bits``, and the rank of the rest."""
    if not 4 <= bits <= MOST_BITS:
        raise ValueError(f"bits must be from 4 to {MOST_BITS}")
    left = HASH_BITS - bits
    hashed = F.conv(F.substring(F.md5(item.cast("string").cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")
    rest = hashed.bitwiseAND(F.lit((1 << left) - 1))
    zeros = F.when(rest == 0, left).otherwise(left - F.length(F.bin(rest)))
    return F.shiftright(hashed, left).cast("int"), (zeros + 1).cast("int")


def item_registers(items: DataFrame, bits: int = BITS, column: str = "item") -> DataFrame:
    """(register, rank) of batch or streaming items, one partial aggregate; nulls are no items."""
    register, rank = register_and_rank(F.col(column), bits)
    rows = items.where(F.col(column).isNotNull()).select(register.alias("register"), rank.alias("rank"))
    return rows.groupBy("register").agg(F.max("rank").alias("rank"))


def merge_registers(*tables: DataFrame) -> DataFrame:
    """The registers of all items together; all tables must have as many bits."""
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    return rows.groupBy("register").agg(F.max("rank").alias("rank"))


def standard_error(bits: int = BITS) -> float:
    """Of the estimate, relative."""
    return 1.04 / math.sqrt(1 << bits)


def estimate_distinct(registers: DataFrame, bits: int = BITS) -> DataFrame:
    """One row (n_distinct): the harmonic mean over all registers, or their empty ones while these are many.

    Fixed values of the published estimator: the factor 0.7213 / (1 + 1.079 / m), and 2.5 m as the bound
    for counting empty registers. No registers give 0.
    """
    m = float(1 << bits)
    factor = {4: 0.673, 5: 0.697, 6: 0.709}.get(bits, 0.7213 / (1 + 1.079 / m))
    sums = registers.agg(F.count(F.lit(1)).alias("used"), F.coalesce(F.sum(F.pow(F.lit(2.0), -F.col("rank"))), F.lit(0.0)).alias("mass"))
    empty = m - F.col("used")
    mean = F.lit(factor * m * m) / (F.col("mass") + empty)
    counted = F.lit(m) * F.log(F.lit(m) / F.greatest(empty, F.lit(1.0)))
    return sums.select(F.when((mean <= 2.5 * m) & (empty > 0), counted).otherwise(mean).alias("n_distinct"))
