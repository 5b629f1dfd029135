from __future__ import annotations

import numpy as np

from chronoloom.functions.numeric import half_precision


def test_half_precision_is_numpys(spark):
    rng = np.random.default_rng(4)
    values = [0.0, -0.0, 20.3, -17.25, 65504.0, 65519.0, 65520.0, 7e4, -1e9, 6e-5, 6.1e-5, 5.96e-8, 2.9e-8, 2.98e-8, 1e-9, 2048.5, 2049.0, 2051.0, 0.1]
    values += list(rng.normal(0, 30, 300)) + list(10.0 ** rng.uniform(-9, 5, 300))
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    for row in df.select("v", half_precision(df["v"]).alias("h")).collect():
        assert row.h is None if row.v is None else row.h == float(np.float16(row.v)), row.v
