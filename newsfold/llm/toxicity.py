"""Toxicity by maximum-scoring segments of token log-odds.

Training counts, over distinct labelled texts, in how many toxic and other
texts each token occurs.  A token's rate of toxic texts has a Dirichlet prior
whose mean is the rate of the tokens that share its first letters (inflected
and unseen forms), whose prior in turn has the rate of all tokens.  Its score
is the log-odds of that rate against the rate of all tokens, less a drift, so
that neutral text has a negative expected score; a token said again at once scores 0.

A text is scanned once in linear time for all its maximal scoring segments
(every segment that no longer one improves and no shorter part exceeds); every token enters with its own score.
The scores of segments in clean text follow an extreme-value law: lambda is
solved from the clean texts' token scores, a segment of score S in a text of n
tokens gets x = lambda * S - ln n, and location and scale of x are fitted on the best segments
of clean training texts, which gives its p-value.  A segment is a toxic passage if its
p-value is at most PASSAGE.  A text's evidence is -ln(p) of its best segment or, if that is more, of the sum of its
r best passages under the law's sum statistic, p = exp(-T) T^(r-1) / (r! (r-1)!), halved for each r tried.
The text's score is a logistic function of the evidence, fitted on the training texts, so that it estimates the chance of label 1.

The training texts stand in two halves by their hash; lambda, the law and the logistic function are fitted on texts scored by the
other half's counts.  The drift is the one of DRIFTS under which the best segments make the training labels likeliest.
All texts are then scored by the counts of both halves.

Training uses at most LABELLED rows (those with the smallest hash of their id); all texts are scored whole.
Null and empty texts have no segment: evidence 0.  With fewer than MIN_EACH distinct training texts of either label
nothing can be told from chance: every text scores 0 and none is predicted toxic.
Ids that repeat in the labels count as toxic if one of their rows is; rows of docs are scored one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

LABELLED = 20_000
THRESHOLD = 0.3
#: Tokens of fewer training texts have only their beginning's rate.
MIN_TEXTS = 3
BEGINNING = 4
PRIOR = 5.0
#: Drifts tried on the training texts.
DRIFTS = (0.5, 1.0, 1.5, 2.0, 2.5, 3.0)
PASSAGE = 1e-3
MIN_EACH = 10
TOKEN = r"[\p{L}\p{N}]+"
COUNTS = ["toxic0", "n0", "toxic1", "n1"]
BESTS = [f"best{i}" for i in range(len(DRIFTS))]
SEGMENTS = "array<struct<first_token:int,last_token:int,score:double,p_value:double>>"


def tokens(text: str) -> list[str]:
    return regex.findall(TOKEN, text.lower())


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a text's token scores (Ruzzo and Tompa's scan, which
    stops at positive scores only): first place, last place, score."""
    sums = np.cumsum(scores)
    at = np.flatnonzero(scores > 0)
    found: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum after
    lower: list[int] = []  # for each found one, the nearest earlier one with a smaller sum before; -1: none
    for place, before, after in zip(at.tolist(), (sums[at] - scores[at]).tolist(), sums[at].tolist()):
        first, j = place, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= before:
                j = lower[j]
            if j < 0 or found[j][3] >= after:
                break
            (first, _, before, _), up = found[j], lower[j]
            del found[j:], lower[j:]
            j = up
        found.append((first, place, before, after))
        lower.append(j)
    return [(a, b, after - before) for a, b, before, after in found]


class Scores:
    """Log-odds of tokens; those not kept one by one take the log-odds of their beginning, and 0 without one."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float]) -> None:
        self.words, self.beginnings = words, beginnings

    def odds(self, text: str) -> np.ndarray:
        """The log-odds of each token of a text; nan for one said again at once."""
        get, begin = self.words.get, self.beginnings.get
        memo: dict[str, float] = {}
        out, past = [], None
        for token in tokens(text):
            if token == past:  # a run of one token is one occurrence
                out.append(math.nan)
                continue
            past = token
            score = memo.get(token)
            if score is None:
                score = get(token)
                if score is None:
                    score = begin(token[:BEGINNING], 0.0)
                memo[token] = score
            out.append(score)
        return np.array(out, float)


def drifted(odds: np.ndarray, drift: float) -> np.ndarray:
    return np.nan_to_num(odds - drift, nan=0.0)


def best_score(scores: np.ndarray) -> float:
    """The score of the best segment; 0 without one."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    return float((sums - np.minimum.accumulate(sums)).max())


def _rate(toxic: np.ndarray, n: np.ndarray, prior) -> np.ndarray:
    return (toxic + PRIOR * prior) / (n + PRIOR)


def token_scores(token: np.ndarray, rare: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> Scores:
    """From each token's number of toxic and of all training texts; rare rows are sums over a beginning."""
    everything = toxic.sum() / max(1, n.sum())
    if not 0 < everything < 1:
        return Scores({}, {})
    begins, which = np.unique(np.array([t[:BEGINNING] for t in token], dtype=str), return_inverse=True)
    base = math.log(everything / (1 - everything))
    odds = lambda rate: np.log(rate / (1 - rate)) - base
    begin_rate = _rate(np.bincount(which, toxic), np.bincount(which, n), everything)
    word_odds = odds(_rate(toxic, n, begin_rate[which]))
    keep = ~rare & (n >= MIN_TEXTS)
    return Scores(
        dict(zip(token[keep].tolist(), word_odds[keep].tolist())),
        dict(zip(begins.tolist(), odds(begin_rate).tolist())),
    )


def solve_lambda(values: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum(share * exp(lambda * value)) = 1 for a negative mean value; 1 if there is none."""
    if not len(values) or values.max() <= 0 or (values * share).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    over = lambda x: (share * np.exp(np.minimum(x * values, 700))).sum() > 1
    while not over(high):
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) else (middle, high)
    return high


def logistic(e: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Slope and shift of the chance of label 1 by the evidence, and the log-likelihood of the labels."""
    x = np.stack([e, np.ones_like(e)], axis=1)
    w, y, ridge = np.zeros(2), toxic.astype(float), np.array([0.1, 1e-6])
    chance = lambda: 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
    for _ in range(50):  # Newton steps with a small ridge, so that separable labels converge too
        p = chance()
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    p = chance()
    return float(w[0]), float(w[1]), float(np.log(np.where(toxic, p, 1 - p)).sum())


class Calibration:
    """Drift, extreme-value law of the best segments of clean texts, and logistic function of the evidence."""

    def __init__(self, drift: float, lam: float, best: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> None:
        self.drift, self.lam = drift, lam
        clean = (lam * best - np.log(np.maximum(n, 1)))[~toxic & (best > 0)]
        self.scale = max(math.sqrt(6) / math.pi * clean.std(), 0.5) if len(clean) > 1 else 1.0
        self.place = clean.mean() - 0.5772156649 * self.scale if len(clean) else 0.0
        self.fit(self.evidence(best, n), toxic)

    def fit(self, evidence: np.ndarray, toxic: np.ndarray) -> None:
        self.slope, self.shift, self.likelihood = logistic(evidence, toxic)

    def reduced(self, scores: np.ndarray, n) -> np.ndarray:
        return (self.lam * scores - np.log(np.maximum(n, 1)) - self.place) / self.scale

    def evidence(self, scores: np.ndarray, n) -> np.ndarray:
        """-ln of the p-value of segments; 0 without one."""
        tail = np.exp(-np.clip(self.reduced(scores, n), -30, 700))
        return np.where(scores > 0, -np.log(np.maximum(-np.expm1(-tail), 1e-300)), 0.0)

    def of_text(self, scores: np.ndarray, n: int) -> tuple[float, np.ndarray]:
        """A text's evidence from the scores of all its segments, and that of each segment."""
        each = self.evidence(scores, n)
        passages = np.sort(self.reduced(scores[each >= -math.log(PASSAGE)], n))[::-1]
        most = float(each.max(initial=0.0))
        if len(passages) > 1:
            r = np.arange(1, len(passages) + 1)
            logs = np.cumsum(np.log(r))  # ln r!
            total = np.cumsum(passages)
            together = total - (r - 1) * np.log(total) + logs + (logs - np.log(r)) - r * math.log(2)
            most = max(most, float(together[1:].max()))
        return most, each

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.shift, -50, 50)))


def sample(labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, toxic of at most so many labelled documents."""
    each = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def train(docs: DataFrame, labels: DataFrame, rows: int = LABELLED) -> tuple[Scores, Calibration] | None:
    """docs: doc_id, text; labels: doc_id, toxic, of the rows to learn from.  None if they are too few."""
    chosen = F.broadcast(sample(labels, rows))  # as bounded as the sample
    texts = docs.select("doc_id", text_of("text").alias("text")).join(chosen, "doc_id").select("text", "toxic")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list[int]] = {}
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns)):
                for token in set(tokens(text)):
                    cell = out.setdefault(token, [0, 0, 0, 0])
                    cell[2 * half] += toxic
                    cell[2 * half + 1] += 1
            if out:
                columns = np.array(list(out.values()), np.int64).T
                yield pa.record_batch([pa.array(list(out)), *map(pa.array, columns)], ["token", *COUNTS])

    distinct = (
        texts.groupBy(F.xxhash64("text").alias("hash"), F.length("text"))
        .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic", F.col("hash").bitwiseAND(1).cast("int").alias("half"))
    )
    sums = [F.sum(c).alias(c) for c in COUNTS]
    per_token = distinct.mapInArrow(counted, "token string, " + ", ".join(f"{c} long" for c in COUNTS)).groupBy("token").agg(*sums)
    rare = F.col("n0") + F.col("n1") < MIN_TEXTS  # tokens of few texts are only needed summed by beginning
    named = F.when(rare, F.substring("token", 1, BEGINNING)).otherwise(F.col("token"))
    table = per_token.groupBy(named.alias("token"), rare.alias("rare")).agg(*sums).orderBy("token", "rare").toArrow()
    if not table.num_rows:
        return None
    toxic0, n0, toxic1, n1 = (table[c].to_numpy().astype(float) for c in COUNTS)
    of = lambda toxic, n: token_scores(np.array(table["token"].to_pylist(), object), table["rare"].to_numpy(), toxic, n)
    by_other = of(toxic1, n1), of(toxic0, n0)  # scores for the texts of either half

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns)):
                odds = by_other[half].odds(text)
                out.append((*(best_score(drifted(odds, d)) for d in DRIFTS), len(odds), toxic))
            yield pa.record_batch([pa.array(c, pa.float64()) for c in zip(*out)], [*BESTS, "n", "toxic"])

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [by_other[half].odds(text) for text, half in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            values, times = np.unique(np.round(np.concatenate(held), 2), return_counts=True)
            yield pa.record_batch([pa.array(values), pa.array(times.astype(np.int64))], ["value", "n"])

    found = distinct.mapInArrow(measured, ", ".join(f"{c} double" for c in [*BESTS, "n", "toxic"])).toPandas()
    is_toxic, n = found["toxic"].to_numpy() == 1, found["n"].to_numpy()
    if min(is_toxic.sum(), (~is_toxic).sum()) < MIN_EACH:
        return None
    clean = distinct.filter("toxic = 0").select("text", "half").mapInArrow(valued, "value double, n long").groupBy("value").agg(F.sum("n").alias("n")).toPandas()
    share = clean["n"].to_numpy() / max(1, clean["n"].sum())
    tried = [
        Calibration(d, solve_lambda(drifted(clean["value"].to_numpy(), d), share), found[c].to_numpy(), n, is_toxic)
        for d, c in zip(DRIFTS, BESTS)
    ]
    chosen_law = max(tried, key=lambda c: c.likelihood)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns)):
                scores = drifted(by_other[half].odds(text), chosen_law.drift)
                segments = np.array([s for _, _, s in maximal_segments(scores)])
                out.append((chosen_law.of_text(segments, len(scores))[0], float(toxic)))
            yield pa.record_batch([pa.array(c, pa.float64()) for c in zip(*out)], ["evidence", "toxic"])

    texts_evidence = distinct.mapInArrow(weighed, "evidence double, toxic double").toPandas()
    chosen_law.fit(texts_evidence["evidence"].to_numpy(), texts_evidence["toxic"].to_numpy() == 1)
    return of(toxic0 + toxic1, n0 + n1), chosen_law


def score(docs: DataFrame, model: tuple[Scores, Calibration] | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, passages (the significant segments) for every row of docs."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence, passages = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for i, text in enumerate(batch.column(1).to_pylist() if model else []):
                scores = drifted(model[0].odds(text), model[1].drift)
                segments = maximal_segments(scores)
                evidence[i], each = model[1].of_text(np.array([s for _, _, s in segments]), len(scores))
                passages[i] = [
                    {"first_token": a, "last_token": b, "score": s, "p_value": math.exp(-e)}
                    for (a, b, s), e in zip(segments, each.tolist())
                    if e >= -math.log(PASSAGE)
                ]
            value = model[1].score(evidence) if model else evidence
            kind = pa.list_(pa.struct([("first_token", pa.int32()), ("last_token", pa.int32()), ("score", pa.float64()), ("p_value", pa.float64())]))
            yield pa.record_batch([batch.column(0), pa.array(value), pa.array((value >= threshold).astype(np.int32)), pa.array(passages, kind)], ["doc_id", "score", "predicted", "passages"])

    return docs.select(F.col("doc_id").cast("long"), text_of("text")).mapInArrow(scored, f"doc_id long, score double, predicted int, passages {SEGMENTS}")


def held_out() -> "F.Column":
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, labels: DataFrame, rows: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages; learns from labels that are not held out."""
    model = train(docs, labels.filter(~held_out()), rows)
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", F.size("passages").cast("long").alias("n_passages"))
