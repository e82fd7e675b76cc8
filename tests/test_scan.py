"""The range-chunked first-drawdown scan equals a plain per-group window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickline.operators.scan import first_drawdown


def test_first_drawdown_matches_window(spark):
    rnd = random.Random(7)
    rows = []
    for g in range(6):
        n = [3000, 50, 1, 400, 2500, 10][g]            # one hot group, small ones
        price = 100.0
        for i in range(n):
            price += rnd.choice([-0.75, -0.5, -0.25, 0.0, 0.25, 0.5, 0.75])
            rows.append((f"c{g % 2}", g, i // 7, i, price, None if g % 3 else 101.0, 2.0 + g % 3))
    df = spark.createDataFrame(rows, "contract string, day int, t int, rec int, q double, seed double, depth double")
    got = first_drawdown(df, ["contract", "day"], ["t", "rec"], "q", "seed", "depth", chunks=16)
    got = {(r.contract, r.day): (r.hit.t, r.hit.rec, r.hit.q, r.hit.ext) for r in got.collect()}

    w = Window.partitionBy("contract", "day").orderBy("t", "rec").rowsBetween(Window.unboundedPreceding, 0)
    ref = (df.withColumn("ext", F.greatest("seed", F.max("q").over(w)))
             .where(F.col("q") <= F.col("ext") - F.col("depth"))
             .groupBy("contract", "day").agg(F.min(F.struct("t", "rec", "q", "ext")).alias("h")))
    want = {(r.contract, r.day): (r.h.t, r.h.rec, r.h.q, r.h.ext) for r in ref.collect()}
    assert got == want and len(want) >= 3
