"""Ranked search against plain Python and its SQL."""

import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from cases import awkward, frame, pandas_docs, prose, spark_rows, sql_rows

from newsfold.llm import ranked_search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def by_hand(rows, items, k=10):
    docs = [(doc_id, Counter(terms(text))) for doc_id, text, *_ in rows]
    docs = [(doc_id, own, own.total()) for doc_id, own in docs if own]
    whole, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, own, _ in docs for t in own)
    asked: dict = {}
    for item_id, text in items:
        asked.setdefault(item_id, Counter()).update(terms(text))
    out = []
    for item_id, own in asked.items():
        found = []
        for doc_id, tf, n in docs:
            m = 100 - 75 + (75 * n * whole) // length
            score = sum(c * math.floor(1000 * math.log((2 * whole + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t, c in own.items() if t in tf)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (minus, missing, doc_id) in enumerate(sorted(found)[:k], 1):
            out.append((None if missing else doc_id, item_id, rank, -minus))
    return sorted(out, key=repr)


def corpus():
    r = random.Random(3)
    rows = awkward() + [(3000 + i, prose(i, r.choice([3, 20, 20, 60, 300]), 400), "en", "a", 1) for i in range(500)]
    rows += [(4000 + i, "the same Text in many rows, W17 w3!", "en", "a", 1) for i in range(200)]
    rows += [(9000 + i, f"w{i % 3} " * 50, "en", "a", 1) for i in range(30)]
    return rows


def asked():
    items = [(i, prose(1000 + i, 25, 400)) for i in range(12)]
    return items + [(20, "THE same text, the same"), (21, None), (22, ""), (23, "!?"), (24, "nowhereinanydocument"), (25, "w1 w1 w2"), (25, "w3"), (None, "中文 é 123"), (26, "one"), (-3, prose(2, 45, 10_000))]


@pytest.mark.parametrize("bucket, seed_rows", [(1024, 2048), (7, 3), (64, 30)])
def test_by_hand(spark, bucket, seed_rows):
    rows, items = corpus(), asked()
    table = spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' AS doc_id", "1 AS rank", "2 AS score", "3 AS item")
    got = ranked_search.search(frame(spark, rows), table, bucket=bucket, seed_rows=seed_rows)
    assert spark_rows(got) == by_hand(rows, items)


def test_batches_of_items_and_other_k(spark):
    rows, items = corpus(), asked()
    got = ranked_search.search(frame(spark, rows).repartition(3), spark.createDataFrame(items, ITEMS), k=3, batch_bytes=500)
    assert spark_rows(got) == by_hand(rows, items, 3)


def test_oracle(spark):
    rows, items = corpus(), asked()
    table = pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"})
    got = ranked_search.search(frame(spark, rows), spark.createDataFrame(items, ITEMS))
    assert spark_rows(got) == sql_rows(ranked_search.ORACLE_SQL, documents=pandas_docs(rows), benchmark=table)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "w1", "en", "a", 0)], [(1, "w1", "en", "a", 0), (1, "w1 w2", None, None, None), (None, "w1 w2", None, None, None)]])
def test_few_rows(spark, rows):
    for items in ([], [(1, None)], [(1, "w1 w2")]):
        assert spark_rows(ranked_search.search(frame(spark, rows), spark.createDataFrame(items, ITEMS))) == by_hand(rows, items)


def vectors(seed: int, n: int, vocabulary: int):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        own = np.sort(r.choice(vocabulary, r.integers(1, 12), replace=False)).astype(np.int32)
        impacts = (10 ** r.uniform(3, 6, len(own))).astype(np.int32)
        out.append((i, math.sqrt(float((impacts.astype(float) ** 2).sum())), own.tobytes(), impacts.tobytes()))
    return sorted(out, key=lambda row: -row[1])


def test_bounds_hold_and_exclude():
    vocabulary = 60
    rows = vectors(1, 3000, vocabulary)
    r = random.Random(5)
    items = ranked_search.Items([{t: r.randrange(1, 9000) for t in r.sample(range(vocabulary), r.randrange(1, 15))} for _ in range(20)] + [{}])
    search = ranked_search.Search(items, vocabulary, 10, np.zeros(len(items)))
    every = []
    for at in range(0, len(rows), 100):
        bucket = ranked_search.Bucket(*zip(*rows[at : at + 100]), vocabulary)
        for q in range(20):
            dense = np.zeros(vocabulary, np.int64)
            dense[items.terms[q]] = items.weights[q]
            scores = bucket.scores(np.arange(100), dense)
            assert (bucket.bounds(items, q) * ranked_search.SLACK >= scores).all()
            assert (items.norms[q] * bucket.norms * ranked_search.SLACK >= scores).all()
            every += [(q, -s, i) for s, i in zip(scores.tolist(), bucket.ids.tolist()) if s > 0]
        search.see(bucket)
    got = search.rows().to_pydict()
    expected = sorted(every)
    for q in range(21):
        assert [(-s, i) for x, i, s in zip(got["item"], got["doc_id"], got["score"]) if x == q] == [(s, i) for x, s, i in expected if x == q][:10]
    pairs = 20 * len(rows)
    assert search.buckets < 0.9 * 20 * 30 and search.scored < 0.25 * pairs  # buckets left out by length, documents by coordinates
