"""Running sums along arrays."""

import random

import pytest
from pyspark.sql import functions as F

from augury.functions.scans import running_sums


@pytest.mark.parametrize("floor", [False, True])
def test_running_sums(spark, floor):
    r = random.Random(7)
    arrays = [[r.randint(-3, 3) for _ in range(n)] for n in (0, 1, 2, 63, 64, 65, 127, 128, 129, 5000)] + [None, [2**40] * 70]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, a array<long>")
    got = {x["i"]: x["s"] for x in df.select("i", running_sums(F.col("a"), floor).alias("s")).collect()}
    for i, array in enumerate(arrays):
        total, sums = 0, []
        for x in array or []:
            total = max(total + x, 0) if floor else total + x
            sums.append(total)
        assert got[i] == (None if array is None else sums)
