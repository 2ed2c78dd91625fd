"""Global positions inside large groups (W1/T2 without a top-k)."""

import random

from pyspark.sql import functions as F

from newsfold.operators.ranking import positions


def test_positions_match_sorted_order(spark):
    rnd = random.Random(3)
    rows = [(g, rnd.randint(0, 10_000), i) for i in range(3000) for g in ["a" if i % 5 else "b"]]
    rows += [("c", 1, 99_999)]
    df = spark.createDataFrame(rows, "g string, score int, id long").repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = positions(df, ["g"], [F.col("score").desc(), F.col("id").asc()]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for g in ("a", "b", "c"):
        mine = sorted((r["position"], r["id"]) for r in got if r["g"] == g)
        want = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [p for p, _ in mine] == list(range(1, len(want) + 1))
        assert [i for _, i in mine] == [r[2] for r in want]
