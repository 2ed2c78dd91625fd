"""The pipeline's stages one by one, and the registration."""

from collections import Counter

from cases import DOCS, awkward, frame, prose, words
from conftest import SF_CHECK, SF_SMALL
from test_models import many_languages

import __spark_entry__ as entry
import corpus_pipeline
from newsfold.llm import mixing, simhash


def corpus():
    base = prose(9, 900, 3000).split()
    rows = awkward()
    for i in range(6):
        copy = list(base)
        copy[i * 50] = f"other{i}"
        rows.append((200 + i, " ".join(copy), "en", "a", 1))
    return rows + [(1000 + i, prose(100 + i, 80, 800), "en", f"s{i % 4}", 1) for i in range(60)]


def held(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark):
    docs = frame(spark, corpus())
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    named = stages["language_id"](spark, docs, None)
    assert named.columns == columns
    kept = Counter(held(named))
    foreign = {15}  # in letters that no training text has
    assert kept == Counter((d, t) for d, t, *_ in corpus() if any(c.isalpha() for c in t or "") and d not in foreign)

    exact = stages["exact_dedup"](spark, named, None).localCheckpoint()
    assert exact.columns == columns
    texts = {t for _, t in kept}
    expected = {(max((d for d, x in kept if x == t and d is not None), default=None), t) for t in texts}
    assert Counter(held(exact)) == Counter(expected)

    near = stages["simhash_near_dedup"](spark, exact, None).localCheckpoint()
    assert near.columns == columns
    component = {r.doc_id: r.component_id for r in simhash.near_dedup(exact).collect() if r.doc_id is not None}
    assert Counter(held(near)) == Counter((d, t) for d, t in expected if d is None or component[d] == d)
    assert sum(200 <= d < 206 for d, _ in held(near) if d) == 1

    mixed = stages["mixing"](spark, near, None)
    assert mixed.columns == columns
    copies = {}
    for r in mixing.mix(near).collect():
        copies[r.doc_id] = max(copies.get(r.doc_id, 0), r.copies)
    assert Counter(held(mixed)) == Counter({x: n for x, n in ((x, copies[x[0]] * k) for x, k in Counter(held(near)).items()) if n})

    packed = stages["best_fit_packing"](spark, mixed, None)
    assert packed.filter("piece = 0").count() == mixed.count()


def test_rare_languages_stay(spark):
    rows = many_languages()
    kept = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, DOCS), None)
    assert Counter(held(kept)) == Counter((d, t) for d, t, *_ in rows)


def test_length_does_not_decide_on_the_language(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    times = (1, 2, 5, 20, 100)
    passages = ["中", "ж", "Привет мир, как дела сегодня? ", "dziękuję bardzo "]
    rows = [(-1000 * i - n, p * n, None, "a", 1) for i, p in enumerate(passages, 1) for n in times]
    kept = {d for d, _ in held(corpus_pipeline.language_id(spark, docs.union(spark.createDataFrame(rows, DOCS)), None)) if d < 0}
    assert kept == {-4000 - n for n in times}  # the letters of the last one are mostly known


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, None)
        assert out.collect() == []
        if out.columns == docs.columns:
            docs = out


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    places = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    got = places(corpus_pipeline.run(spark, SF_SMALL))
    assert got == places(docs) and len(got) > 50


def test_registration():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert {"op1_lm_score", "op3_mixing", "op9_exact_top_k", "op10_exact_dedup"} <= set(entry.oracle_sql())


def test_words_of_helpers():
    assert words("a\x85b\x0bc d") == ["a\x85b", "c", "d"]
