"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import DOCS, awkward, frame, spark_rows

from newsfold.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_by_hand(rows, min_length=7, min_count=2, every=31):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :]


def near_by_hand(n):
    return {w: [x for x in n if one_edit(w, x)] for w in n}


def by_hand(rows, **options):
    n = counts_by_hand(rows, **options)
    near = near_by_hand(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((form[w], n.get(form[w]), n[w], len(near[w]), root, w))
    return sorted(out, key=repr)


def variants_of(r: random.Random, word: str) -> str:
    i, c = r.randrange(len(word) + 1), r.choice("abcàÿz")
    return r.choice([word[:i] + c + word[i:], word[:i] + c + word[i + 1 :], word[:i] + word[i + 1 :]])


def misspelt(seed: int, n: int) -> list[tuple]:
    r = random.Random(seed)
    stems = ["aaaaaaaa", "abababababab", "Abendländisch", "çàéèùÿþ", "straßenbahn", "internationalisation", "zzzzzzz"] + ["".join(r.choices("abcd", k=r.randrange(7, 12))) for _ in range(30)]
    words = []
    for i in range(n):
        w = stems[int(r.random() ** 4 * len(stems))]
        for _ in range(r.choice([0, 0, 0, 0, 0, 1, 2])):
            w = variants_of(r, w)
        words += [w.upper() if i % 7 == 0 else w] * r.choice([1, 2, 30])
    return [(1000 + i, " ".join(words[i::60]), "en", "a", 1) for i in range(60)]


def test_by_hand(spark):
    rows = awkward() + misspelt(1, 1500) + [(7000 + i, "çàéèùÿþ1çàéèùÿþ,Wörterbücher_ЖÇàéèùÿþЖ×÷×÷×÷×", "en", "a", 1) for i in range(3)]
    rows += [(None, "Wörterbücher " * 40 + "Wörterbucher", None, None, None)] * 2 + [(8000, "x" * 5000 + " " + "x" * 5001 + " " + "x" * 2500 + "y" + "x" * 2499, "en", "a", 1)] * 2
    expected = by_hand(rows)
    assert sum(r[0] is not None for r in expected) > 60 and any(r[0] != r[4] for r in expected if r[0])
    assert spark_rows(spelling.variants(frame(spark, rows))) == expected
    assert spark_rows(spelling.variants(frame(spark, rows[::-1]), list_words=5)) == expected


def test_forms_follow_each_other(spark):
    chain = [("abcdefgh", 4), ("abcdefgi", 40), ("abcdefii", 400), ("abcdeiii", 4000), ("abcdeiij", 39), ("tiedaaaa", 30), ("tiedaaac", 30), ("tiedaaab", 3)]
    rows = [(i, f"{w} " * n, "en", "a", 1) for i, (w, n) in enumerate(chain)]
    got = {r.word: r for r in spelling.variants(frame(spark, rows), delete_every=1 << 40).collect()}
    assert got["abcdefgh"].root == got["abcdefii"].root == "abcdeiii" and got["abcdefgh"].form == "abcdefgi"
    assert got["tiedaaab"].form == "tiedaaaa" and got["tiedaaab"].n_near == 2 and got["tiedaaaa"].form is None
    assert got["abcdeiii"].root == "abcdeiii" and got["abcdeiij"].form == "abcdeiii" and got["abcdeiij"].form_n == 4000


@pytest.mark.parametrize("min_length, min_count", [(1, 1), (2, 3), (9, 2)])
def test_parameters(spark, min_length, min_count):
    rows = misspelt(2, 120) + [(1, "a b a ab ba aa é éa a", "en", "a", 1)]
    expected = by_hand(rows, min_length=min_length, min_count=min_count)
    assert spark_rows(spelling.variants(frame(spark, rows), min_length=min_length, min_count=min_count, list_words=3)) == expected


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("frontier", [1, 50, 1 << 19])
def test_matrix_rows_of_prefixes(seed, frontier):
    r = random.Random(seed)
    m = r.randrange(1, 5)
    middles = sorted({"".join(r.choices("abcÿ", k=r.choice([m, m + 1]))).encode("latin-1") for _ in range(60)})
    cut = r.randrange(len(middles) + 1)
    group = np.array([0] * cut + [1] * (len(middles) - cut))
    a, b = spelling.Lists(middles, group, np.full(len(middles), m)).near(frontier)
    expected = {
        (i, j)
        for i, x in enumerate(middles)
        for j, y in enumerate(middles)
        if len(x) == m and group[i] == group[j] and one_edit(x.decode("latin-1"), y.decode("latin-1"))
    }
    assert set(zip(a.tolist(), b.tolist())) == expected and len(a) == len(expected)


def test_lists_stay_short(spark):
    words = spark.createDataFrame([("prefix" + chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676) + "suffix", 2) for i in range(2000)], "word string, n long")
    sizes = spelling.lists(words, 7, 50).groupBy(*spelling.LIST).count()
    wide = sizes.filter("past - first > 1").agg({"count": "max"}).first()[0]
    assert wide <= 50
    got = {r.word: r.n_near for r in spelling.near_words(words, list_words=50).collect()}
    assert got["prefixaaasuffix"] == 25 + 25 + 2 and len(got) == 2000  # 26 x 26 x 2 full grids and a third of 648 words


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "", "en", "a", 0), (2, "abcdefgh", "en", "a", 0)]])
def test_few_rows(spark, rows):
    assert spelling.variants(spark.createDataFrame(rows, DOCS)).collect() == []
