"""Line deduplication against its SQL and plain Python."""

import hashlib
from collections import defaultdict

import pytest
from cases import DOCS, awkward, frame, pandas_docs, prose, spark_rows, sql_rows

from newsfold.llm import line_dedup

WHITE = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

LICENCE = "Licensed under the  Public Terms, Ünicode too"
TWO_TIMES = "a line that stands in two documents only"


def lined() -> list[tuple]:
    rows = [(200 + i, f"{prose(i, 6)} own line of document {i}\n\t{LICENCE} \r\nshort\n{LICENCE.upper().replace('Ü', 'ü')}\n", "en", "a", 1) for i in range(40)]
    rows += [(300 + i, f"{TWO_TIMES}\n{TWO_TIMES.title()}\nno line of more" + "\n" * i, "en", "a", 1) for i in range(2)]
    rows += [(400 + i, "19 code points here\n20 code points heree\n ünïcödé ünïcödé ünïcö", "en", "a", 1) for i in range(3)]
    rows += [(500 + i, f"{LICENCE}\n" * 3 + LICENCE, "en", "a", 1) for i in range(2)]
    rows += [(600, "\n".join(f"line {i % 7_000} of a very long text" for i in range(60_000)), "en", "a", 1)]
    rows += [(601 + i, "\n".join(f"line {j} of a very long text" for j in range(3_000)), "en", "a", 1) for i in range(2)]
    return rows


def by_hand(rows, min_length=20, min_documents=3):
    key = lambda line: line.strip(WHITE).translate(LOWER)
    holders = defaultdict(set)
    for r, (_, text, *_) in enumerate(rows):
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_length:
                holders[key(line)].add(r)
    keeper = {}
    for k, found in holders.items():
        ids = [rows[r][0] for r in found if rows[r][0] is not None]
        if len(found) >= min_documents and ids:
            keeper[k] = max(ids)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc_id]
        out.append((doc_id, hashlib.sha256("\n".join(kept).encode()).hexdigest(), len(lines) - len(kept), len(lines)))
    return sorted(out, key=repr)


def test_by_hand(spark):
    rows = awkward() + lined() + [(None, LICENCE, None, None, None), (240, LICENCE, "en", "a", 1), (240, LICENCE, "en", "a", 1)]
    rows += [(None, "a line of documents without any id", None, None, None)] * 4
    expected = by_hand(rows)
    assert sum(r[2] for r in expected) > 100
    assert spark_rows(line_dedup.dedup(frame(spark, rows))) == expected
    assert spark_rows(line_dedup.dedup(frame(spark, rows[::-1]).repartition(5))) == expected


@pytest.mark.parametrize("hot_share", [0.0, 1e-9, 1.0, 2.0])
def test_hot_lines_take_the_same_decision(spark, hot_share):
    rows = lined()
    assert spark_rows(line_dedup.dedup(frame(spark, rows), hot_share=hot_share)) == by_hand(rows)


def test_oracle(spark):
    rows = awkward() + lined()
    assert spark_rows(line_dedup.dedup(frame(spark, rows))) == sql_rows(line_dedup.ORACLE_SQL, documents=pandas_docs(rows))


@pytest.mark.parametrize("min_length, min_documents", [(0, 1), (1, 2), (44, 41)])
def test_parameters(spark, min_length, min_documents):
    rows = awkward()[:10] + lined()[:20]
    got = line_dedup.dedup(frame(spark, rows), min_length=min_length, min_documents=min_documents)
    assert spark_rows(got) == by_hand(rows, min_length, min_documents)


def test_text_that_stays(spark):
    rows = [(i, f"own {i}\n{LICENCE}", "en", "a", 1) for i in range(5)]
    got = {r.doc_id: r.kept_text for r in line_dedup.drop_lines(frame(spark, rows)).collect()}
    assert got == {i: f"own {i}" for i in range(4)} | {4: f"own 4\n{LICENCE}"}


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "", "en", "a", 0), (None, "\n\n", "en", "b", 1)]])
def test_few_rows(spark, rows):
    assert spark_rows(line_dedup.dedup(frame(spark, rows))) == by_hand(rows)


def test_no_python_and_bounded_broadcasts(spark):
    docs = spark.createDataFrame(lined(), DOCS)
    plan = line_dedup.dedup(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "MapInPandas", "CartesianProduct"))
    assert "BroadcastNestedLoop" not in plan
