"""The phrase dictionary gives what testing every phrase gives, at a cost that follows the texts."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from newsfold.operators import hits as HT
from newsfold.operators import phrases as PH
from newsfold.operators.pages import page_base
from newsfold.sources import tables
from newsfold.sources.tasks import PROSE_CONFIG

FORMULAS = "q int, alt int, clause int, phrase string"


def by_hand(texts, formulas):
    out = set()
    for id_, text in texts:
        held = {}
        for q, alt, clause, phrase in formulas:
            held.setdefault((q, alt, clause), []).append(phrase in text)
        alternatives = {}
        for (q, alt, _), found in held.items():
            alternatives.setdefault((q, alt), []).append(any(found))
        out |= {(id_, q) for (q, _), clauses in alternatives.items() if all(clauses)}
    return out


def random_case(seed):
    r = random.Random(seed)
    text = lambda n: "".join(r.choices("ab cé中\n", k=n))
    texts = [(i, text(r.choice([0, 3, 40, 200]))) for i in range(40)]
    formulas = []
    for q in range(25):
        for alt in range(r.randrange(1, 3)):
            for clause in range(r.choice([1, 2, 3])):
                formulas += [(q, alt, clause, text(r.choice([0, 1, 2, 3, 4, 6, 7, 9]))) for _ in range(r.randrange(1, 4))]
    formulas += [(99, 0, c, r.choice("ab")) for c in range(140)]  # more clauses than a word has bits
    return texts, formulas


def matches(spark, texts, formulas, **options):
    rows = PH.phrase_matches(spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame(formulas, FORMULAS), ["q"], **options)
    found = [tuple(r) for r in rows.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_equals_every_phrase_on_every_text(spark):
    for seed, gram in ((1, 6), (2, 2)):
        texts, formulas = random_case(seed)
        assert matches(spark, texts, formulas, gram=gram) == by_hand(texts, formulas)


def test_empty_dictionary_and_texts(spark):
    assert matches(spark, [(1, "a")], []) == set()
    assert matches(spark, [], [(1, 0, 0, "a")]) == set()


def test_hits_by_dictionary_equal_hits_by_literals(spark, monkeypatch):
    base = page_base(tables.pages(spark, SF_SMALL), with_main=False)
    columns = ["task_name", "query_idx", "page_id", "valid", "top_k", "src_pos", "title", "snippet"]
    literal = sorted(map(tuple, HT.keyword_hits(base, PROSE_CONFIG, PROSE_CONFIG.blocked_host_tokens).select(*columns).collect()))
    monkeypatch.setattr(HT, "DICTIONARY_FROM", 0)
    filed = sorted(map(tuple, HT.keyword_hits(base, PROSE_CONFIG, PROSE_CONFIG.blocked_host_tokens).select(*columns).collect()))
    assert filed == literal and literal


def test_phrases_are_filed_apart(spark):
    """30,000 phrases that begin alike: a text meets few of them, since each is filed under a sequence that few others have."""
    formulas = spark.createDataFrame([(i, 0, 0, f"the same beginning {i * 7919 % 100_003:06d}") for i in range(30_000)], FORMULAS)
    filed = PH.dictionary(formulas).groupBy("gram").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert filed[0] <= 30 and filed[1] > 5_000
    texts = [(i, f"page {i} of the same beginning {i * 7919 % 100_003:06d} and more") for i in range(50)]
    rows = PH.phrase_matches(spark.createDataFrame(texts, "id long, text string"), formulas, ["q"])
    assert {tuple(r) for r in rows.collect()} == {(i, i) for i in range(50)}
