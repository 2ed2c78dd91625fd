"""The four deduplicating operators against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from cases import DOCS, awkward, frame, pandas_docs, prose, spark_rows, sql_rows, words
from pyspark.sql import functions as F

from newsfold.llm import exact_dedup, simhash, substring_dedup, suffix_dedup
from newsfold.llm.graph import component_roots


def sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


# ------------------------------------------------------------------ exact copies


def exact_by_hand(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, len(ids), keep, doc_id is not None and doc_id == keep, sha((text or "").encode())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("historical", ["half", "none", "all", "some"])
def test_exact(spark, historical):
    rows = awkward() + [(100 + i, prose(i % 7, 5), "en", "a", 1) for i in range(60)]
    marks = {"half": None, "none": F.lit(False), "all": F.lit(True), "some": F.col("doc_id") % 3 == 1}
    got = exact_dedup.exact_dedup(frame(spark, rows), marks[historical])
    assert spark_rows(got) == exact_by_hand(rows)


def test_exact_oracle(spark):
    rows = awkward(repeats=False)
    assert spark_rows(exact_dedup.exact_dedup(frame(spark, rows))) == sql_rows(exact_dedup.ORACLE_SQL, documents=pandas_docs(rows))


def test_perfect_hash_is_minimal():
    digests = np.random.default_rng(1).integers(0, 1 << 63, (5000, 4)).astype(np.uint64)
    digests[1, :2] = digests[0, :2]  # digests that agree in their first half
    levels = exact_dedup.build_levels(digests)
    assert sorted(exact_dedup.slots_of(digests, levels).tolist()) == list(range(5000))
    assert sum(int(x.sum()) for x in levels) == 5000


# ------------------------------------------------------------------ near copies


def fingerprint_by_hand(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = words(lowered)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(fps, distance=3):
    found, left = {}, set(fps)
    for fp in fps:
        if fp in left:
            left.discard(fp)
            reach, todo = [fp], [fp]
            while todo:
                x = todo.pop()
                near = [y for y in left if (x ^ y).bit_count() <= distance]
                left.difference_update(near)
                reach += near
                todo += near
            found |= dict.fromkeys(reach, frozenset(reach))
    return found


def near_by_hand(rows):
    fps = [(doc_id, fingerprint_by_hand(text)) for doc_id, text, *_ in rows]
    reach = components_by_hand({fp for _, fp in fps})
    out = []
    for doc_id, fp in fps:
        least = min((i for i, x in fps if x in reach[fp] and i is not None), default=None)
        out.append((least, doc_id, f"{fp:016x}", doc_id is not None and doc_id == least))
    return sorted(out, key=repr)


def test_near(spark):
    base = prose(9, 900, 3000).split()
    rows = awkward()
    for i in range(12):  # near copies: few words differ
        copy = list(base)
        copy[i * 50] = f"other{i}"
        rows.append((200 + i, " ".join(copy).upper() if i % 2 else " ".join(copy), "en", "a", 1))
    got = simhash.near_dedup(frame(spark, rows))
    assert spark_rows(got) == near_by_hand(rows)


@pytest.mark.parametrize("distance,group", [(3, 60), (3, 1024), (2, 1024), (6, 1024), (0, 1024)])
def test_links_of_crowded_fingerprints(spark, distance, group):
    """Many fingerprints under one key, so that keys grow longer when a group is small."""
    r = random.Random(4)
    fps = set()
    for centre in (r.getrandbits(64) for _ in range(6)):
        for _ in range(120):
            fp = centre
            for bit in r.sample(range(64), r.randrange(5)):
                fp ^= 1 << bit
            fps.add(fp)
    signed = {simhash._signed(fp): fp for fp in fps}
    roots = {x.node: x.root for x in component_roots(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), distance, group)).collect()}
    got = defaultdict(set)
    for x, fp in signed.items():
        got[roots.get(x, x)].add(fp)
    assert set(map(frozenset, got.values())) == set(components_by_hand(fps, distance).values())


@pytest.mark.parametrize("distance", [1, 3, 5])
def test_chain_condition_keeps_every_link(distance):
    r = random.Random(5)
    keys = simhash.first_masks(distance)
    for _ in range(5000):
        x = sum(1 << b for b in r.sample(range(64), r.randrange(distance + 1)))
        met = [i for i, mask in keys if x & mask == 0]
        assert any(simhash._linked(np.array([x], np.uint64), np.array([i]), distance)[0] for i in met)


# ------------------------------------------------------------------ repeated passages


def substrings_by_hand(rows, window):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), []
    for i in order:
        w = words(rows[i][1])
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            run = tuple(w[p : p + window])
            if run in seen:
                gone[p : p + window] = [True] * window
            seen.add(run)
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((rows[i][0], sha(" ".join(kept).encode()), len(w) - len(kept), len(w)))
    return sorted(((d, s, n, r) for d, s, r, n in out), key=repr)


@pytest.mark.parametrize("window,block", [(20, 16 << 20), (20, 5000), (7, 3000), (1, 5000)])
def test_substrings(spark, window, block):
    rows = awkward()
    got = substring_dedup.dedup(frame(spark, rows), window, block_bytes=block).select("doc_id", "kept_sha256", "n_removed", "n_words")
    assert sorted(((r.doc_id, r.kept_sha256, r.n_words, r.n_removed) for r in got.collect()), key=repr) == substrings_by_hand(rows, window)


def bytes_by_hand(rows, threshold):
    texts = [(doc_id, (text or "").encode()) for doc_id, text, *_ in rows]
    seen = Counter(t[p : p + threshold] for _, t in texts for p in range(len(t) - threshold + 1))
    out = []
    for doc_id, t in texts:
        gone = np.zeros(len(t) + 1, int)
        for p in range(len(t) - threshold + 1):
            if seen[t[p : p + threshold]] > 1:
                gone[p] += 1
                gone[p + threshold if p + threshold < len(gone) else -1] -= 1
        gone = np.cumsum(gone)[: len(t)] > 0
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((doc_id, sha(bytes(b for b, g in zip(t, gone) if not g)), len(t), int(gone.sum()), spans))
    return sorted(out, key=repr)


@pytest.mark.parametrize("threshold,block", [(400, 16 << 20), (400, 40_000), (72, 3000), (130, 9000)])
def test_suffixes(spark, threshold, block):
    rows = [r for r in awkward() if len(r[1] or "") < 50_000] + [(50, prose(3, 3000, 5000), "fr", "c", 1), (51, "x " + prose(3, 3000, 5000) + " y", "fr", "c", 1)]
    r = random.Random(threshold)
    pool = ["".join(r.choice("abé \n") for _ in range(r.randrange(20, 300))) for _ in range(12)]
    rows += [(300 + i, "".join(r.choices(pool, k=r.randrange(1, 12))), "en", "a", 1) for i in range(60)]  # overlapping mosaics
    got = suffix_dedup.dedup(frame(spark, rows), threshold, block_bytes=block)
    assert spark_rows(got.select("doc_id", F.col("kept_sha256").alias("k"), F.col("n_bytes").alias("n"), F.col("n_removed").alias("o"), F.col("n_spans").alias("p"))) == bytes_by_hand(rows, threshold)


def test_suffix_threshold_has_a_floor(spark):
    with pytest.raises(ValueError):
        suffix_dedup.dedup(frame(spark, awkward()), 10)


# ------------------------------------------------------------------ empty tables


@pytest.mark.parametrize("operator", [exact_dedup.exact_dedup, simhash.near_dedup, substring_dedup.dedup, suffix_dedup.dedup])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], DOCS)).collect() == []


def test_words_with_one_hash_are_told_apart(spark, monkeypatch):
    """Two words that share their first hash differ in the second one, so windows over them are not taken for equal."""
    from newsfold.llm import substring_dedup as SD

    found = SD.word_hashes

    def weak(texts, seed=0):
        return found([t.replace(b"other", b"equal") for t in texts] if seed == 0 else texts, seed)

    monkeypatch.setattr(SD, "word_hashes", weak)
    windows = [SD.Windows([b"a b equal c d"], 5, 64), SD.Windows([b"a b other c d"], 5, 64)]
    for w in windows:
        while w.level < len(w.lengths) - 1:
            w.double(np.ones(len(w.keys()[0]), bool))
    first, second = ([w.hashes[0] for w in windows], [w.second_hashes()[0] for w in windows])
    assert first[0] == first[1] and second[0] != second[1]
