"""Language ID, toxicity, language-model scores and top-k search."""

import math
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import regex
import xxhash
from cases import CLASHES, DOCS, awkward, frame, pandas_docs, prose, spark_rows, sql_rows, words
from conftest import SF_CHECK
from pyspark.sql import functions as F

from newsfold.llm import langid, lm_score, topk, toxicity

# ------------------------------------------------------------------ language ID


def ppm_by_hand(training, text):
    tree = defaultdict(lambda: defaultdict(int))
    for t in training:
        t = langid.START + t
        for i in range(langid.ORDER, len(t)):
            for o in range(langid.ORDER + 1):
                tree[t[i - o : i]][t[i]] += 1
    text, bits = langid.START + text, 0.0
    for i in range(langid.ORDER, len(text)):
        ruled_out = set()
        for o in range(langid.ORDER, -1, -1):
            followed = {k: v for k, v in tree.get(text[i - o : i], {}).items() if k not in ruled_out}
            if not followed:
                continue
            n, d = sum(followed.values()), len(followed)
            if text[i] in followed:
                bits -= math.log2(followed[text[i]] / (n + d))
                break
            bits -= math.log2(d / (n + d))
            ruled_out |= set(followed)
        else:
            bits += math.log2(256 - len(ruled_out))
    return bits


@pytest.mark.parametrize("chunk", [1 << 20, 7])
def test_code_lengths(monkeypatch, chunk):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    training = {"a": [b"abracadabra", "héé l'eau".encode(), b""], "b": [b"the cat sat on the mat\n\n\n the"]}
    model = langid.Model({k: langid.gram_counts(v) for k, v in training.items()}, min_seen=1)
    texts = [b"abra cat", b"", "l'été zz".encode(), b"the cat sat on the mat", b"zzzz\n\n\nq", b"\xff"]
    expected = [[ppm_by_hand(training[k], t) for k in "ab"] for t in texts]
    assert np.allclose(model.code_lengths(texts), expected, atol=1e-4)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(got) > 200 and (got.lang == got.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_of_awkward_rows(spark):
    got = langid.predict(frame(spark, awkward())).toPandas()
    assert len(got) == len(awkward())
    by_id = got.set_index("doc_id")
    assert all(by_id.loc[i].lang_pred == "und" and by_id.loc[i].score == 0 for i in (1, 2, 3, 16))
    assert set(got.lang_pred) <= {"und", "en", "de", "fr", "es"}


def many_languages():
    """90 languages of their own words each, the later the rarer, the last ones in a script of their own; the last two have 14 and 13 rows."""
    rows = []
    for k in range(90):
        r = random.Random(k)
        letters = "ႠႡႢႣႤႥႦႧႨႩႪႫ" if k == 89 else "ԱԲԳԴԵԶԷԸԹԺԻԼ" if k == 88 else "abcdefghijklmnopqrstuvwxyz"
        vocabulary = ["".join(r.choices(letters, k=r.randint(3, 7))) for _ in range(25)]
        rows += [(1000 * k + i, " ".join(r.choices(vocabulary, k=40)), f"l{k:02}", "a", 1) for i in range(102 - k)]
    return rows


def test_languages_beyond_any_number(spark):
    docs = spark.createDataFrame(many_languages(), DOCS)
    got = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert got.lang.nunique() == 90 and (got[got.lang.isin(["l88", "l89"])].groupby("lang").size() >= 2).all()
    assert (got.lang == got.lang_pred).groupby(got.lang).mean().min() == 1


def test_rare_contexts_count():
    training = {"big": [prose(1, 500).encode()] * 3, "rare": [b"the cat sat on the mat", b"a cat ran"]}
    model = langid.Model({k: langid.gram_counts(v) for k, v in training.items()})
    texts = [b"the cat ran", b"w1 w2 mat", b""]
    assert np.allclose(model.code_lengths(texts), [[ppm_by_hand(training[k], t) for k in ("big", "rare")] for t in texts], atol=1e-4)


def test_language_without_training(spark):
    got = langid.predict(spark.createDataFrame([(1, "abc", None, None, 1)], DOCS)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert langid.predict(spark.createDataFrame([], DOCS)).collect() == []


# ------------------------------------------------------------------ toxicity


def segments_by_hand(scores):
    """Take the best run (the shortest, then leftmost of equal ones), then the best of what lies left and right of it."""
    out = []

    def take(a, b):
        runs = [(sum(scores[i : j + 1]), -(j - i), -i, j) for i in range(a, b) for j in range(i, b)]
        if not runs or max(runs)[0] <= 0:
            return
        total, _, first, last = max(runs)
        out.append((-first, last, round(total, 9)))
        take(a, -first)
        take(last + 1, b)

    take(0, len(scores))
    return sorted(out)


def test_maximal_segments():
    r = random.Random(1)
    for k in range(400):
        scores = [r.uniform(0.1, 5) if r.random() < 0.4 else r.choice([-1.0, 0.0, -r.random()]) for _ in range(r.randint(0, 20))]
        got = toxicity.maximal_segments(np.array(scores, float))
        assert [round(s, 9) for _, _, s in got] == [s for _, _, s in segments_by_hand(scores)]
        assert toxicity.best_score(np.array(scores, float)) == pytest.approx(max((s for _, _, s in got), default=0))
        if k % 2:  # without neutral tokens, which leave ties, the places are the same too
            scores = [x or -0.5 for x in scores]
            got = toxicity.maximal_segments(np.array(scores, float))
            assert [(a, b, round(s, 9)) for a, b, s in got] == segments_by_hand(scores)


def test_segments_of_a_very_long_text():
    """A falling sum, where no segment joins an earlier one: one step a segment."""
    scores = np.tile([1.0, -2.0], 300_000)
    began = time.process_time()
    assert len(toxicity.maximal_segments(scores)) == 300_000
    assert time.process_time() - began < 10


def test_lambda_solves_its_equation():
    values, share = np.array([-2.0, 1.0, 4.0]), np.array([0.95, 0.04, 0.01])
    lam = toxicity.solve_lambda(values, share)
    assert abs((share * np.exp(lam * values)).sum() - 1) < 1e-9


def toxicity_by_hand(training, texts):
    """The whole training and score in plain Python: training is (text, label), texts are scored."""
    cut = lambda t: regex.findall(toxicity.TOKEN, t.lower())
    labels = {}
    for t, y in training:
        labels[t] = max(y, labels.get(t, 0))
    half = {t: xxhash.xxh64_intdigest(t.encode(), 42) & 1 for t in labels}
    whole = Counter(w for t in labels for w in set(cut(t)))

    def odds_from(chosen):
        words, begins, all_ = (defaultdict(lambda: [0, 0]) for _ in range(3))
        for t in chosen:
            for w in set(cut(t)):
                for cell in (words[w], begins[w[: toxicity.BEGINNING]], all_[0]):
                    cell[0] += labels[t]
                    cell[1] += 1
        rate = lambda cell, prior: (cell[0] + toxicity.PRIOR * prior) / (cell[1] + toxicity.PRIOR)
        logit = lambda p: math.log(p / (1 - p))
        p = all_[0][0] / all_[0][1]

        def odds(text):
            out, past = [], None
            for w in cut(text):
                begin = rate(begins[w[: toxicity.BEGINNING]], p) if w[: toxicity.BEGINNING] in begins else p
                own = w in words and words[w][1] >= toxicity.MIN_TEXTS and whole[w] >= toxicity.MIN_TEXTS
                out.append(None if w == past else logit(rate(words[w], begin) if own else begin) - logit(p))
                past = w
            return out

        return odds

    by_other = [odds_from([t for t in labels if half[t] != h]) for h in (0, 1)]
    scored = lambda odds, drift: [0.0 if x is None else x - drift for x in odds]
    found = [(by_other[half[t]](t), y) for t, y in labels.items()]
    laws = []
    for drift in toxicity.DRIFTS:
        values = [x for odds, y in found if not y for x in scored([None if x is None else round(x, 2) for x in odds], drift)]
        low, high = 1e-9, 1.0
        solvable = max(values) > 0 > sum(values)
        while solvable and sum(math.exp(high * v) for v in values) <= len(values):
            high *= 2
        for _ in range(80 if solvable else 0):
            middle = (low + high) / 2
            low, high = (low, middle) if sum(math.exp(middle * v) for v in values) > len(values) else (middle, high)
        x = [(high * max(s for *_, s in segs) - math.log(len(odds))) for odds, y in found if not y and (segs := segments_by_hand(scored(odds, drift)))]
        mean = sum(x) / max(1, len(x))
        scale = max(math.sqrt(6 * sum((v - mean) ** 2 for v in x) / len(x)) / math.pi, 0.5) if len(x) > 1 else 1.0
        law = (drift, high, mean - 0.5772156649 * scale if x else 0.0, scale)
        laws.append((law, *fit_by_hand([(evidence_by_hand(odds, law, False), y) for odds, y in found])))
    law, *_ = max(laws, key=lambda x: x[3])
    slope, shift, _ = fit_by_hand([(evidence_by_hand(odds, law, True), y) for odds, y in found])
    final = odds_from(list(labels))
    return [1 / (1 + math.exp(-(slope * evidence_by_hand(final(t), law, True) + shift))) for t in texts]


def evidence_by_hand(odds, law, together):
    drift, lam, place, scale = law
    segments = segments_by_hand([0.0 if x is None else x - drift for x in odds])
    z = sorted(((lam * s - math.log(len(odds)) - place) / scale for *_, s in segments), reverse=True)
    p = [-math.expm1(-math.exp(-x)) for x in z]
    best = max((-math.log(x) for x in p), default=0.0)
    z = [x for x, q in zip(z, p) if q <= toxicity.PASSAGE] if together else []
    for r in range(2, len(z) + 1):
        t = sum(z[:r])
        best = max(best, -math.log(math.exp(-t) * t ** (r - 1) / (math.factorial(r) * math.factorial(r - 1)) * 2**r))
    return best


def fit_by_hand(rows):
    a, b = 0.0, 0.0
    for _ in range(100):
        g = [-0.1 * a, -1e-6 * b]
        h = [0.1, 0.0, 1e-6]
        for e, y in rows:
            p = 1 / (1 + math.exp(-max(-50, min(50, a * e + b))))
            g = [g[0] + (y - p) * e, g[1] + y - p]
            h = [h[0] + p * (1 - p) * e * e, h[1] + p * (1 - p) * e, h[2] + p * (1 - p)]
        det = h[0] * h[2] - h[1] ** 2
        a, b = a + (h[2] * g[0] - h[1] * g[1]) / det, b + (h[0] * g[1] - h[1] * g[0]) / det
    p = [1 / (1 + math.exp(-(a * e + b))) for e, _ in rows]
    return a, b, sum(math.log(x if y else 1 - x) for x, (_, y) in zip(p, rows))


def test_toxicity_equals_plain_python(spark):
    r = random.Random(8)
    bad, rows = ["scoundrel", "wretch", "fiend", "fiendish"], []
    for i in range(130):
        w = prose(i, 14, 40).split()
        for at in r.sample(range(14), r.choice([1, 2, 3]) if i % 4 == 0 else i % 9 == 0):
            w[at] = r.choice(bad)
        rows.append((i, " ".join(w + w[-1:] * (i % 2)), "en", "a", 1))
    rows += [(200, rows[0][1], "en", "a", 1), (201, None, "en", "a", 1), (202, "wretch fiend wretch, fiend of a scoundrel", "en", "a", 1)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, *_ in rows if i != 202], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, DOCS)
    got = {x.doc_id: x.score for x in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    expected = toxicity_by_hand([(t or "", int(i % 4 == 0)) for i, t, *_ in rows if i != 202], [t or "" for _, t, *_ in rows])
    assert [got[i] for i, *_ in rows] == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("each", [1, toxicity.MIN_EACH - 1, toxicity.MIN_EACH])
def test_toxicity_of_few_training_texts(spark, each):
    rows = [(i, f"scoundrel wretch {prose(i, 20)}" if i % 2 else prose(i, 20), "en", "a", 1) for i in range(2 * each)]
    rows += [(1000, rows[1][1], "en", "a", 1), (1001, None, "en", "a", 1)]
    labels = spark.createDataFrame([(i, i % 2) for i, *_ in rows if i != 1001], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.train(docs, labels.filter("doc_id < 1000"))
    assert (model is None) == (each < toxicity.MIN_EACH)
    if model is None:
        assert {(x.score, x.predicted) for x in toxicity.score(docs, model).collect()} == {(0.0, 0)}


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.predict(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    clean, toxic = got[got.toxic == 0], got[got.toxic == 1]
    assert (clean.predicted == 0).mean() > 0.97 and (toxic.predicted == 1).mean() > 0.6
    auc = np.mean([(t > c) + (t == c) / 2 for t in toxic.score for c in clean.score])
    assert auc > 0.9


def test_toxicity_finds_planted_passages(spark):
    r = random.Random(3)
    bad, labels, rows = ["scoundrel", "wretch", "fiend"], [], []
    for i in range(400):
        w = prose(i, 60, 500).split()
        if i % 5 == 0:
            w[20:20] = r.choices(bad, k=3)
        rows.append((i, " ".join(w), "en", "a", 1))
        labels.append((i, 0, int(i % 5 == 0)))
    rows += awkward()
    table = spark.createDataFrame(labels + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.predict(frame(spark, rows), table).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    found = got[got.doc_id.between(20, 399)]
    assert (found.predicted == (found.doc_id % 5 == 0)).mean() > 0.99


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.predict(frame(spark, awkward()), none).collect()} == {0}
    assert toxicity.predict(spark.createDataFrame([], DOCS), none).collect() == []


# ------------------------------------------------------------------ language-model scores


def backoff_by_hand(rows, order, alpha, min_count):
    texts = [words(t) for _, t, *_ in rows]
    counts = [defaultdict(int) for _ in range(order + 1)]
    for w in texts:
        for m in range(1, order + 1):
            for i in range(len(w) - m + 1):
                counts[m][tuple(w[i : i + m])] += 1
    n = sum(counts[1].values())
    out = []
    for (doc_id, *_), w in zip(rows, texts):
        total = 0.0
        for i in range(len(w)):
            for back, m in enumerate(range(min(order, i + 1), 0, -1)):
                gram = tuple(w[i - m + 1 : i + 1])
                if m == 1 or counts[m][gram] >= min_count:
                    total += math.log10(counts[m][gram] / (counts[m - 1][gram[:-1]] if m > 1 else n)) + back * math.log10(alpha)
                    break
        out.append((doc_id, len(w), total))
    return sorted(out, key=lambda r: repr(r[:2]) + f"{r[2]:.3f}")


@pytest.mark.parametrize("order,min_count,block", [(3, 1, 16 << 20), (4, 1, 4000), (3, 2, 4000), (1, 1, 4000), (4, 3, 9000)])
def test_backoff(spark, order, min_count, block):
    rows = awkward() + [(100 + i, prose(i, 50, 30), "en", "a", 1) for i in range(40)]
    got = lm_score.score(frame(spark, rows), order, 0.4, min_count, block_bytes=block).collect()
    found = sorted(((r.doc_id, r.n_words, r.score) for r in got), key=lambda r: repr(r[:2]) + f"{r[2]:.3f}")
    assert all(a == pytest.approx(b, abs=2e-6) for a, b in zip(found, backoff_by_hand(rows, order, 0.4, min_count), strict=True))
    assert all(r["mean"] is None if not r.n_words else abs(r["mean"] - r.score / r.n_words) < 1e-9 for r in got)


def test_backoff_oracle(spark):
    rows = [(100 + i, prose(i, 50, 30), "en", "a", 1) for i in range(40)] + [(1, None, None, None, None), (2, "", "", "", 0)]
    got, expected = spark_rows(lm_score.score(frame(spark, rows))), sql_rows(lm_score.ORACLE_SQL, documents=pandas_docs(rows))
    assert len(got) == len(expected) and all(a == pytest.approx(b, abs=1e-5) for a, b in zip(got, expected))
    assert lm_score.score(spark.createDataFrame([], DOCS)).collect() == []


# ------------------------------------------------------------------ top-k search

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors():
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(0, 0.3, 8).astype(np.float32)], 0) for i in range(160)]
    rows += [(200 + i, rows[7][1], 1) for i in range(45)]  # ties
    rows += [(400, None, 0), (401, [0.1, None], 0), (402, [float("nan")] * 8, 0), (403, [float("inf")] * 8, 0), (420, None, 0)]
    return rows + [(500, [0.5, 0.25], 0), (520, [], 0), (540, [30000.0] * 8, 0), (541, [-30000.0] * 8, 0)]


def top_by_hand(rows, k):
    fine = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q)[:k]
            out += [(q, rank, -s, i) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(512, 32, 4096), (8, 3, 2), (5, 1, 3)])
def test_top_k(spark, sizes):
    rows = vectors()
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", *[f"'{c}' AS {c}" for c in [*CLASHES, "group", "batch", "v", "rank"] if c not in ("key",)])
    got = topk.top_k(table, F.col("vec_id") % 20 == 0, block=sizes[0], blocks_per_group=sizes[1], queries_per_batch=sizes[2])
    assert spark_rows(got) == top_by_hand(rows, 20)


def test_top_k_oracle(spark):
    rows = [r for r in vectors() if r[1] is None or len(r[1]) == 8]
    got = topk.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0)
    assert spark_rows(got) == sql_rows(topk.ORACLE_SQL, embeddings=pd.DataFrame(rows, columns=["vec_id", "embedding", "label"]))


@pytest.mark.parametrize("rows", [[], [(20, [1.0], 0)], [(21, [1.0], 0), (22, [2.0], 0)], [(20, [1.0], 0), (21, [2.0], 0)]])
def test_top_k_of_few(spark, rows):
    got = topk.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0)
    assert spark_rows(got) == top_by_hand(rows, 20)


def test_blocks_below_the_kth_score_are_not_scored():
    near, far = np.full((50, 4), 9), np.full((50, 4), -9)
    blocks = [(np.arange(50) + 50 * i, far if i else near) for i in range(6)]
    best, scored = topk.search_group(np.array([1000]), np.full((1, 4), 5), blocks, 20)
    assert scored == 1 and best.ids[0].tolist() == list(range(20))
