"""Spelling variants against brute force; the pieces that it is made of."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs

from scissile.llm import spelling
from tests.llm.test_llm import docs, empty


def brute_words(rows):
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    words = brute_words(rows)
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def rows_of(seed, many, common=()):
    """Texts of few syllables, so that words are near each other, with hot words and typing errors of theirs."""
    rng = random.Random(seed)
    syllables = ["ab", "ba", "é", "ÿa", "×", "aa", "B", "a", "÷c", "À"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 7)))
    texts = [" ".join(word() for _ in range(rng.randrange(60))) + rng.choice([".", "1", "Ā", "µ", "\x00"]) for _ in range(many)]
    for i, w in enumerate(common):
        texts += [f"{w} " * 60 + f"{w[:3]}{w[4:]} {w}x q{w}"] * (1 + i % 3) * 3
    return [(rng.choice([None, -3, i, i]), t) for i, t in enumerate(texts)] + [(1, None), (2, ""), (3, "A" * 40_000 + " " + "a" * 40_000)]


@pytest.mark.parametrize("crowd", [3, 64])
def test_variants_against_brute_force(spark, crowd):
    rows = rows_of(crowd, 120, ["chairman", "chairmen", "charman", "aaaaaaaaaa", "aaaaaaaaa", "éàéàéàéà"])
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), crowd=crowd).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(brute(rows))
    assert any(r["form"] for r in got) and any(r["n_near"] > 3 for r in got)


def test_a_family_of_one_prefix(spark):
    """Thousands of words that share all but their end: windows are halved until few meet; shards have few rows."""
    rng = random.Random(7)
    words = {"commonprefix" + "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))): rng.randrange(2, 99) for _ in range(700)}
    got = spelling.near_words(spark.createDataFrame(sorted(words.items()), "word string, n long").repartition(3), crowd=8, shard_rows=500).collect()
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    want = {w: (len(vs), max(words[v] for v in vs), min(vs, key=lambda v: (-words[v], v))) for w, vs in near.items() if vs}
    assert {r["word"]: (r["n_near"], r["near_n"], r["near"]) for r in got} == want


def test_chains_of_forms(spark):
    """A form of a form: roots are found over several links."""
    counts = {"abcdefghij": 3, "abcdefghijk": 40, "abcdefghijkl": 500}
    rows = [(10_000 + i, w) for w, n in counts.items() for i in range(n)]
    got = {r["word"]: r for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = {r[0]: r for r in brute(rows)}
    assert {w: tuple(r) for w, r in got.items()} == want and got["abcdefghij"]["root"] == "abcdefghijkl"


@given(hs.lists(hs.tuples(hs.binary(max_size=9), hs.binary(max_size=70)), min_size=1, max_size=30))
@settings(max_examples=60, deadline=None)
def test_crc_of_joined_strings(pairs):
    left, right = (np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1))
    got = spelling.joined_crc(left, right, np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


@given(hs.text("ab", min_size=7, max_size=12), hs.text("ab", min_size=7, max_size=12))
@settings(max_examples=300, deadline=None)
def test_one_window_holds_the_parting(a, b):
    if a != b:
        for cuts in ([0, len(a) // 2, len(a)], range(len(a) + 1)):
            found = 0
            for lo, hi in zip(cuts, cuts[1:]):
                end = hi + len(b) - len(a)
                if abs(len(a) - len(b)) <= 1 and end >= lo and a[:lo] == b[:lo] and a[hi:] == b[end:]:
                    found += spelling._parting(a, b, lo, hi)
            assert found == is_near(a, b)


def test_awkward_tables(spark):
    got = spelling.variants(docs(spark, "word")).collect()
    assert {tuple(r) for r in got} == brute([(r["doc_id"], r["text"]) for r in docs(spark, "word").collect()])
    assert spelling.variants(empty(spark, "n")).collect() == []
