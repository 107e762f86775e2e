"""Distinct-count registers: by hand, merged, streamed, and the error of the estimate."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from fairtally.operators.registers import estimate_distinct, item_registers, merge_registers, standard_error
from fairtally.streaming import running


def by_hand(items, bits):
    found = {}
    for x in items:
        h = int(hashlib.md5(str(x).encode()).hexdigest()[:13], 16)
        left = 52 - bits
        rest = h & ((1 << left) - 1)
        rank = left - rest.bit_length() + 1
        found[h >> left] = max(found.get(h >> left, 0), rank)
    return found


def table(df):
    return {r["register"]: r["rank"] for r in df.collect()}


@pytest.mark.parametrize("bits", [4, 12, 16])
def test_registers_by_hand(spark, bits):
    items = [*range(-50, 2000), 7, 7, 7]
    df = spark.createDataFrame([(x,) for x in [*items, None]], "item bigint").repartition(5)
    assert table(item_registers(df, bits)) == by_hand(items, bits)


def test_merge_equals_whole(spark):
    parts = [spark.range(a, a + 3000).select(F.col("id").alias("item")) for a in (0, 2000, 9000)]
    whole = parts[0].union(parts[1]).union(parts[2])
    assert table(merge_registers(*[item_registers(p) for p in parts])) == table(item_registers(whole))


@pytest.mark.parametrize("n", [0, 1, 100, 5000, 9000, 60_000, 1_000_000])
def test_error_of_the_estimate(spark, n):
    df = spark.range(n).select((F.col("id") * 7919).alias("item"))
    got = estimate_distinct(item_registers(df.union(df))).first()[0]
    assert abs(got - n) <= max(1, 3 * standard_error() * n)


def test_stream_and_compaction(spark, tmp_path):
    for i in range(3):
        spark.range(i * 700, i * 700 + 1000).select(F.col("id").alias("item")).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("item bigint").option("maxFilesPerTrigger", 4).parquet(str(tmp_path / "in"))
    running.start_registers(stream, str(tmp_path / "t"), str(tmp_path / "ck"), availableNow=True).awaitTermination()
    want = by_hand(range(2400), 12)
    assert table(running.read_registers(spark, str(tmp_path / "t"))) == want
    running.compact_registers(spark, str(tmp_path / "t"))
    assert table(running.read_registers(spark, str(tmp_path / "t"))) == want


def test_refuses_bits(spark):
    for bits in (3, 21):
        with pytest.raises(ValueError):
            item_registers(spark.range(3).withColumnRenamed("id", "item"), bits)
    assert math.isclose(standard_error(10), 0.0325)
