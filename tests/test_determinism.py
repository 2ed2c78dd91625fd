
import sys

import pytest

from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ["q1_triage", "c2_components"])
def test_partition_count_does_not_change_results(spark, name):
    import __spark_entry__ as E

    fn = E.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(_rows(fn(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]
    assert results[0]
