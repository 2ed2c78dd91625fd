"""Mixing against its SQL and its contract; packing by exact round trips."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import DOCS, awkward, frame, pandas_docs, prose, spark_rows, sql_rows, words
from tokenizers import Tokenizer

from newsfold.llm import mixing, packing


def test_mixing_oracle(spark):
    rows = awkward(repeats=False) + [(100 + i, prose(i, 5 + i % 40), "en", "abc"[i % 3], 1) for i in range(200)]
    assert spark_rows(mixing.mix(frame(spark, rows))) == sql_rows(mixing.ORACLE_SQL, documents=pandas_docs(rows))


def shared_out(sizes, weights, budget):
    """Targets by sharing out again until none is above its cap."""
    capped = {}
    while True:
        rest = {k: w for k, w in weights.items() if k not in capped}
        left = budget - sum(capped.values())
        level = left / sum(rest.values()) if rest else 0
        over = {k: 2 * sizes[k] for k, w in rest.items() if level * w > 2 * sizes[k]}
        if not over:
            return {k: float(capped.get(k, level * weights[k])) for k in sizes}
        capped |= over


def test_mixing_contract_with_repeated_rows(spark):
    rows = awkward() + [(100 + i, prose(i, 30), "en", "hot" if i % 3 else f"s{i % 20}", 1) for i in range(900)]
    got = mixing.mix(frame(spark, rows)).collect()
    assert spark_rows(mixing.mix(frame(spark, rows[::-1]))) == sorted((tuple(r[c] for c in sorted(r.asDict())) for r in got), key=repr)
    assert sorted(((r.doc_id, r["size"]) for r in got), key=repr) == sorted(((d, len(words(t))) for d, t, *_ in rows), key=repr)
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(words(text))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget = 1.5 * sum(sizes.values())
    by_target = defaultdict(int)
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"])
        by_target[round(r.target, 6)] += r.taken
    expected = defaultdict(float)
    for t in shared_out(sizes, weights, budget).values():
        expected[round(t, 6)] += t
    assert {k for k in by_target} == set(expected)
    longest = max(len(words(t)) for _, t, *_ in rows if len(words(t)) < 20_000)
    for target, taken in by_target.items():
        if target < 25_000:  # the source of the two longest texts cannot be hit closer than one of them
            assert abs(taken - expected[target]) <= 30 + 2 * longest
    assert sum(r.taken for r in got) <= budget


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "", "en", "a", 0), (2, " ", "en", "b", 1)]])
def test_mixing_without_words(spark, rows):
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows) and all(r.taken == 0 and r.target == 0 for r in got)


def token_ids(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*t.encode(text or "", add_special_tokens=False).ids, 2]


def check_places(placed, sequence):
    held = defaultdict(list)
    for r in placed:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sequence
    return len(held)


def test_packing_round_trip(spark):
    rows = awkward() + [(300 + i, prose(i, 10 + 37 * i % 900, 500), "en", "a", 1) for i in range(150)]
    placed = packing.pack(frame(spark, rows)).collect()
    expected, total = [], 0
    for doc_id, text, *_ in rows:
        ids, start = token_ids(text), 0
        total += len(ids)
        first = len(ids) % 1024 or 1024
        for piece, end in enumerate(range(first, len(ids) + 1, 1024)):
            expected.append((doc_id, piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
            start = end
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed), key=repr) == sorted(expected, key=repr)
    sequences = check_places(placed, 1024)
    assert sequences <= 1.05 * total / 1024 + 2


def test_packing_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).collect() == []


def best_fit(lengths, sequence):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= n]
        if fits:
            gaps[min(fits, key=gaps.__getitem__)] -= n
        else:
            gaps.append(sequence - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece(seed):
    r = np.random.default_rng(seed)
    lengths = np.minimum(1024, r.integers(1, 1400, 3000)) if seed % 2 else r.integers(1, 500, 3000)
    values, times = np.unique(lengths, return_counts=True)
    plan = packing.Plan.shortest(dict(zip(values.tolist(), times.tolist())), 1024)
    used = defaultdict(list)
    for length, (at, first, offset) in plan.by_length().items():
        numbers = np.arange(int(plan.used[length]))
        run = np.searchsorted(at, numbers, side="right") - 1
        for s, o in zip((first[run] + numbers - at[run]).tolist(), offset[run].tolist()):
            used[s].append((o, length))
    assert sum(map(len, used.values())) == 3000 and len(used) == plan.sequences
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert plan.sequences <= best_fit(lengths.tolist(), 1024)


def test_exact_sums_of_lengths_that_occur_once():
    lengths = [500, 300, 224, 400, 350, 274]
    assert best_fit(lengths, 1024) == 3
    assert packing.Plan.shortest(dict.fromkeys(lengths, 1), 1024).sequences == 2
    for way in packing.WAYS:  # every plan takes pairs and triples, of short lengths too
        for n, exact in ((3, [900, 100, 24]), (4, [850, 90, 60, 24]), (4, [400, 300, 200, 124])):
            assert packing.Plan(dict.fromkeys(exact, 1), 1024, *way).filled[n - 1] == 1


@pytest.mark.parametrize("text", ["", "It's  a\n\n test\t\x85 \xa0x", "naïve – “x” …", "<|endoftext|>", "a<|endoftext|> b", "中文 and ﷽", "ǅ ʰ é́"])
def test_encoder_gives_the_tokenizers_ids(text):
    assert [*packing.make_encoder("byte_bpe_50k", None)(text), 2] == token_ids(text)
