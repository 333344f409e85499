from __future__ import annotations

import random
import struct

from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio, two_places


def test_two_places_prints_what_python_prints(spark):
    rng = random.Random(5)
    values = [0.0, 0.004, 0.005, 0.015, 0.125, 0.995, 0.999, 1.005, 1.015, 2.675, 3.125, 3.375]
    values += [99.995, 100.0, 123456789.125, 2.0**40 + 0.375, 1e-300, -0.001, -2.675, -3.125]
    values += [rng.randrange(0, 10**6) / 1000 for _ in range(3000)]
    values += [rng.randrange(1, 999) / rng.randrange(1, 999) * 100 for _ in range(3000)]
    for _ in range(2000):
        x = abs(struct.unpack("d", rng.randbytes(8))[0])
        if x < 1e12:
            values.append(x)
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for row in frame.select("v", two_places(F.col("v")).alias("t")).collect():
        assert row.t == f"{row.v:.2f}", row.v


def test_two_places_of_null(spark):
    frame = spark.createDataFrame([(None,)], "v double")
    assert frame.select(two_places(F.col("v"))).first()[0] is None


def test_ratio(spark):
    frame = spark.createDataFrame([(1, 2), (1, 0), (0, 0)], "a bigint, b bigint")
    assert [r[0] for r in frame.select(ratio(F.col("a"), F.col("b"))).collect()] == [
        0.5,
        None,
        None,
    ]
