"""Collocations against brute force; minimal perfect hashes; sums as a tree; exact scores."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs

from scissile.llm import phrases
from tests.llm.test_llm import docs, empty


def brute(rows, least, longest=5, top=2000):
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    kept = {g: n for g, n in f.items() if n >= least}
    by_lang = defaultdict(list)
    for (lang, g), a in kept.items():
        if len(g) < 2 or any(n >= a and m == lang and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h))) for (m, h), n in kept.items()):
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g))]
        score, _, left, right = min(cuts)
        by_lang[lang].append((-score, -a, " ".join(g).encode(), left, right))
    return {(lang, i, p.decode(), -a, left, right, total[lang], -s) for lang, found in by_lang.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def texts(seed, many):
    rng = random.Random(seed)
    common = ["the big red dog", "New York City", "a a a", "é b", "x y z", "w1 w2 w3 w4 w5 w6", "\x00 ü"]
    words = [f"v{i}" for i in range(12)] + ["The", "THE", "a", "'", "ß", " "]
    out = []
    for _ in range(many):
        parts = [rng.choice(common) if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randrange(30))]
        out.append(("".join(p + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "  "]) for p in parts), rng.choice(["en", "en", "en", "de", None, "und", "e\tn"])))
    return out + [(None, "en"), ("", "fr"), (None, None), ("the big red dog " * 3000, "en")]


@pytest.mark.parametrize("least,block_keys", [(8, 1 << 21), (8, 20), (3, 64)])
def test_phrases_against_brute_force(spark, monkeypatch, least, block_keys):
    rows = texts(least, 150)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    monkeypatch.setattr(phrases, "SLICE_KEYS", 300 if least == 3 else 1 << 21)
    got = phrases.mine(df, least=least, top=40, block_keys=block_keys).collect()
    assert {tuple(r) for r in got} == brute(rows, least, top=40) and len(got) > 30
    assert max(len(r["phrase"].split(" ")) for r in got) == 5


def test_awkward_tables(spark):
    rows = [(r["text"], r["lang"]) for r in docs(spark, "phrase").collect()]
    assert {tuple(r) for r in phrases.mine(docs(spark, "phrase"), least=20).collect()} == brute(rows, 20)
    assert phrases.mine(empty(spark)).collect() == [] == phrases.mine(docs(spark), least=10**6).collect()


@given(hs.sets(hs.integers(0, (1 << 64) - 1), max_size=400))
@settings(max_examples=50, deadline=None)
def test_perfect_hash_is_minimal(keys):
    keys = np.array(sorted(keys), np.uint64)
    table = phrases.PerfectHash.of(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    assert table.slots(np.arange(50, dtype=np.uint64)).max(initial=-1) < max(1, len(keys))


def test_perfect_hash_is_small():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 100_000).astype(np.uint64)
    assert 8 * len(phrases.PerfectHash.of(keys).bits) / len(keys) < 4


def test_words_of_one_hash_are_told_apart(spark, monkeypatch):
    """All words on four hashes: each block has a file for every word of a hash, and the stored bytes decide."""
    monkeypatch.setattr(phrases, "_word_keys", lambda lang, words: np.array([len(w) % 4 for w in words.to_pylist()], np.uint64))
    folder = [spark.createDataFrame([("en", w, 5) for w in ("a", "b", "abcde", "bb", "cc", "ccc", "é")], "lang string, word string, f long")]
    built = {}
    for uri, at, word in _built(folder[0], phrases):
        built[uri, at] = word
        got = phrases.word_slots(uri, "en", pa.array([word.encode(), b"zzz", b"zz"], pa.large_binary()))
        assert got.tolist() == [at, -1, -1]
    assert len(built) == 7


def _built(words, module):
    """(file, slot in it, word) as word_blocks's task writes them, run here."""
    held = {}
    real = module.once
    module.once = lambda f: held.setdefault("build", real(f))
    try:
        module.word_blocks(words, 1 << 20)
    except Exception:
        pass
    finally:
        module.once = real
    table = held["build"](pa.Table.from_pylist([r.asDict() | {"block": 0} for r in words.collect()]))
    uri = None
    for r in table.to_pylist():
        uri = r["uri"] or uri
        yield uri, r["at"], r["word"]


@pytest.mark.parametrize("parts", [1, 5, 70])
def test_tree_sum(spark, monkeypatch, parts):
    monkeypatch.setattr(phrases, "FAN_IN", 4)
    rng = np.random.default_rng(parts)
    rows, want = [], defaultdict(lambda: np.zeros(7, np.int64))
    for p in range(parts):
        for s in range(3):
            x = rng.integers(0, 90, 7 - s)
            want[s][: 7 - s] += x
            rows.append((0, s, p, bytearray(x.astype(np.int64).tobytes())))
    got = phrases.tree_sum(spark.createDataFrame(rows, phrases.PARTS)).collect()
    assert {r["slice"]: np.frombuffer(r["counts"], np.int64).tolist() for r in got} == {s: x[: 7 - s].tolist() for s, x in want.items()}


@given(hs.integers(1, 10**13), hs.integers(1, 10**13), hs.integers(1, 10**13), hs.integers(1, 10**13))
@settings(max_examples=15, deadline=None)
def test_scores_are_exact(spark, a, n, left, right):
    a, left, right = min(a, left, right, n), min(left, n), min(right, n)
    got = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").select(phrases.score(*(phrases.F.col(c) for c in "anlr"))).first()[0]
    assert got == 1000 * a * n // (left * right)
