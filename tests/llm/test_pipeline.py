"""The pipeline's stages against brute force on a small folder of tables."""

from collections import defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from scissile.llm import byte_cnn, queries
from tests.llm.test_llm import LONG, brute_components, brute_fingerprint, brute_hits, brute_repeats

BENCH = "measure twice and cut once said the old carpenter to his very young apprentice before noon on monday"


def make_docs():
    import random

    rng = random.Random(9)
    syllables = {"aa": ["ban", "dor", "fil", "gam", "hul"], "bb": ["çé", "xiö", "zuß", "yñ", "wü"]}

    def prose(lang, n):
        return " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))

    rows = [(i, prose(lang := "ab"[i % 2] * 2, rng.randint(60, 160)), lang) for i in range(60)]
    passage = prose("aa", 70)
    rows += [(60, prose("aa", 50) + " " + passage + " " + prose("aa", 50), "aa"), (61, prose("aa", 40) + " " + passage, "aa")]
    rows += [(62, rows[3][1], "bb"), (63, rows[3][1], "bb"), (64, prose("aa", 20) + " " + BENCH, "aa"), (65, "12345 !!! 67890", None), (66, None, None), (67, "", "aa")]
    rows += [(None, prose("bb", 80), "bb"), (5, rows[5][1], "bb")]
    return [(d, t, g, "s", 0 if t is None else len(t), "kept", d, "l", "f", "i", "r") for d, t, g in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __kept string, __bench long, __lang string, __fp string, __id string, __row string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(make_docs(), SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, BENCH), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_match_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = byte_cnn.fit(docs)
    scored = byte_cnn.identify(docs, model).collect()
    kept = [(r["doc_id"], r["text"]) for r in scored if r["lang_pred"] != "und" and r["lang_score"] >= corpus_pipeline.least_score(len(model.names))]
    assert {65, 66, 67}.isdisjoint(d for d, _ in kept) and {0, 1, 2, 60, 64} <= {d for d, _ in kept}
    own = docs
    key = lambda x: (str(x[0]), x[1] or "")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        own = stage(spark, own, folder)
        assert own.columns == docs.columns
        rows = own.collect()
        own = spark.createDataFrame(rows, docs.schema)
        got = sorted([(r["doc_id"], r["text"]) for r in rows], key=key)
        if k == 1:
            roots = brute_components([brute_fingerprint(t) for _, t in kept])
            groups = defaultdict(list)
            for row, root in zip(kept, roots):
                groups[root].append(row)
            kept = [min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()]
        elif k == 2:
            kept = [(d, left.decode(errors="ignore")) for d, _, _, left in brute_repeats(kept, 50)]
        elif k == 3:
            kept = [(d, t) for d, t in kept if not (lambda n, h, _: h and 20 * h >= n)(*brute_hits(t, [(1, BENCH), (2, None)]))]
        assert got == sorted(kept, key=key), name
    assert {62, 63, 64}.isdisjoint(d for d, _ in kept) and sum(d == 5 for d, _ in kept) == 1
    from tokenizers import Tokenizer

    own_tokens = Tokenizer.from_file(queries.tokenizer_paths()[0])
    want = {d: len(own_tokens.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in kept}
    packed = corpus_pipeline.run(spark, folder)
    total = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert total == want
    room = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).collect()
    assert all(r["n"] == r["m"] <= 2048 for r in room)


def test_empty_documents(spark, folder, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_long_repeated_passage_goes(spark, folder):
    docs = spark.createDataFrame([(1, "first " + LONG * 4), (2, "second " + LONG * 4 + " end")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_passages(spark, docs, folder).collect()}
    assert got[1] == "first " + LONG * 4 and len(got[2]) < 20


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_copies_of_similarity_0_8_go(spark, folder):
    import random

    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    alike = lambda a, b: len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    rows, expected, dropped = [], [], 0
    for i in range(60):
        own = [word() for _ in range(rng.choice([40, 150, 1000]))]
        rows.append((10 * i, " ".join(own)))
        expected.append(10 * i)
        changed = list(own)
        while alike(" ".join(own), " ".join(changed)) > (0.95, 0.9, 0.86)[i % 3]:
            before, changed[rng.randrange(len(own))] = list(changed), word()
        changed = " ".join(changed if alike(" ".join(own), " ".join(changed)) >= 0.8 else before)
        assert 0.8 <= alike(rows[-1][1], changed)
        rows.append((10 * i + 1, changed))
        dropped += 1
        # Half of it is new: no copy, though some keys may be shared.
        rows.append((10 * i + 2, " ".join(own[: len(own) // 2] + [word() for _ in range(len(own) // 2)])))
        expected.append(10 * i + 2)
    chain = [word() for _ in range(200)]
    for k in range(6):  # each is like the next only
        rows.append((1000 + k, " ".join(chain[15 * k : 15 * k + 150])))
    expected.append(1000)
    rows += [(None, rows[0][1] + " more"), (None, "alone " * 3), (None, "alone " * 3), (7000, " ".join(["same"] * 30)), (7001, " ".join(["same"] * 40))]
    expected += [7000, None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_large_families_are_compared_in_blocks(spark, monkeypatch):
    """Families over the limit give the groups that one task gives."""
    import random

    from scissile.llm import near_copies

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for f in range(3):
        own = [word() for _ in range(150)]
        for k in range(40):
            changed = list(own)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
                changed[rng.randrange(150)] = word()
            rows.append((1000 * f + k, " ".join(changed)))
    texts = dict(rows)
    ids = sorted(texts)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids:
            if j < i and i // 1000 == j // 1000 and len(shingles(texts[i]) & shingles(texts[j])) >= 0.8 * len(shingles(texts[i]) | shingles(texts[j])):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {i: find(i) for i in ids}
    assert {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()} == want
    monkeypatch.setattr(near_copies, "FAMILY_BYTES", 20_000)
    monkeypatch.setattr(near_copies, "BLOCK_BYTES", 3_000)
    assert {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()} == want


def flipped(rng, bits, most):
    import numpy as np

    out = bits.copy()
    for k in rng.choice(256, most, replace=False):
        out[k >> 6] ^= np.uint64(1) << np.uint64(k & 63)
    return out


def test_one_of_a_crowd_stands_for_its_equals():
    import numpy as np

    from scissile.llm import near_copies

    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 4).astype(np.uint64)
    bits = np.array([flipped(rng, centre, 12) for _ in range(600)])
    node = np.arange(10, 610, dtype=np.uint64)
    plan, high = near_copies.segment_plan(1000)
    value = near_copies.values(bits, plan[0])
    low = len(plan[0]) - high
    group = int(np.bincount((value >> np.uint64(low)).astype(np.int64)).argmax())
    near = (value >> np.uint64(low)) == np.uint64(group)
    a, b, keep, wide = near_copies.meet(value[near], low, group, bits[near], node[near])
    left = set(node[near][keep].tolist())
    assert len(a) > 100 and len(left) < near.sum() - 60 and 0 < wide.sum() <= len(keep)
    assert left | set(a.tolist()) == set(node[near].tolist())
    kept = {int(v): bits[near][keep][value[near][keep] == v] for v in value[near]}
    for v, own in zip(value[near].tolist(), bits[near]):  # someone of the same value stands for every row
        assert near_copies.simhash.distances(kept[v], own[None, :]).min() <= near_copies.HELD


@pytest.mark.parametrize("spread", [8, 40])
def test_late_rows_meet_crowds_as_if_all_were_held(spread):
    import numpy as np

    from scissile.llm import near_copies
    from scissile.llm.arrays import min_labels

    def together(a, b, n):
        return min_labels(a.astype(np.int64), b.astype(np.int64), n)

    rng = np.random.default_rng(spread)
    plan, high = near_copies.segment_plan(1000)
    low, met = len(plan[0]) - high, 0
    for _ in range(12):
        centre = rng.integers(0, 1 << 63, 4).astype(np.uint64)
        crowd = np.array([centre] + [flipped(rng, centre, int(rng.integers(0, spread + 1))) for _ in range(149)])
        late = np.array([flipped(rng, crowd[rng.integers(150)], int(rng.integers(40, 73))) for _ in range(10)])
        bits, node = np.concatenate([crowd, late]), np.arange(160, dtype=np.uint64)
        for places in plan:
            value = near_copies.values(bits, places)
            group = int(value[0] >> np.uint64(low))
            at = np.flatnonzero((np.bitwise_count((value >> np.uint64(low)) ^ np.uint64(group)) <= 1) & ((value >> np.uint64(low)) & np.uint64(group) == value >> np.uint64(low)))
            whole = together(*near_copies.meet(value[at], low, group, bits[at], node[at])[:2], 160)
            early = at[at < 150]
            a, b, keep, wide = near_copies.meet(value[early], low, group, bits[early], node[early])
            held = np.concatenate([early[keep], at[at >= 150]])
            c, d, _, _ = near_copies.meet(value[held], low, group, bits[held], node[held], np.concatenate([wide, np.zeros(len(held) - len(keep), bool)]))
            split = together(np.concatenate([a, c]), np.concatenate([b, d]), 160)
            for i in range(160):
                assert split[i] == split[whole[i]]
            met += int((whole[150:] < 150).sum())
    assert met > 20


def test_small_chunks_lose_no_candidates(spark, monkeypatch):
    import numpy as np

    from scissile.llm import near_copies, simhash

    rng = np.random.default_rng(3)
    rows = []
    for _ in range(3):
        centre = rng.integers(0, 1 << 63, 4).astype(np.uint64)
        rows += [flipped(rng, centre, int(rng.integers(0, 37))).tobytes() for _ in range(400)]
    frame = spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate(rows)], "fp long, bits binary").repartition(8)

    def groups():
        found = {r["node"]: r["root"] for r in simhash.components(near_copies.candidates(frame, len(rows)), "test").collect()}
        return [found.get(i, i) for i in range(len(rows))]

    whole = groups()
    monkeypatch.setattr(near_copies, "CHUNK", 100)
    split = groups()
    assert len(set(whole)) < 100 and all(split[i] == split[w] for i, w in enumerate(whole))
