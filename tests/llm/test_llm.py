"""The training-data operators against brute force, and on awkward tables."""

import base64
import hashlib
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from scissile.llm import audio, byte_cnn, ftrl, maglev, packing, queries, simhash, suffix_dedup, warc, winnow, zstd_quality
from scissile.llm.arrays import min_labels, span_hashes, words

LONG = "the quick brown fox jumps over the lazy dog and runs far away into the deep green forest at night "
#: Nulls, empty and long texts, ties, repeated rows, other alphabets, control characters.
TEXTS = [None, "", " \n\t", "a", "Hello World", LONG * 2, LONG * 2, "X" + LONG, LONG[10:] + "tail of its own that nobody else has, at some length", "é" * 80, "日本語のテキスト" * 12, "\x00" * 70, "ab" * 3000, LONG.upper() * 2, "idiot 123 " * 40, LONG * 700]
DOCS = [(i, t, "en" if i % 2 else None, f"s{i % 3}", None if t is None else len(t), "clash") for i, t in enumerate(TEXTS)] + [(5, LONG * 2, "en", "s0", 1, "clash"), (None, LONG, None, None, None, None), (None, None, None, None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, {extra} string"


def docs(spark, extra="score", rows=DOCS):
    return spark.createDataFrame(rows, SCHEMA.format(extra=extra)).repartition(3)


def empty(spark, extra="score"):
    return spark.createDataFrame([], SCHEMA.format(extra=extra))


# ---- 1 WARC --------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    big, small = "<p>" + "x" * 1200, "tiny"
    rows = [(1, "http://a/ b", big), (2, None, big), (3, "u", small), (4, "u", small), (5, "u", None), (6, "u", ""), (None, "u", big), (7, "ü\r\nX: y", "é\r\n\r\nWARC/1.0\r\n" * 90), (8, "u", "y" * 300_000), (8, "u", "y" * 300_000)]
    out = warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert len(out) == len(rows)
    kinds = defaultdict(list)
    for r in out:
        html = next((h or "").encode() for i, _, h in rows if i == r["page_id"])
        assert r["payload_bytes"] == len(html) and r["payload_digest"] == hashlib.sha1(html).hexdigest()
        assert (r["payload"] == html) if r["record_type"] == "response" else r["payload"] is None
        kinds[r["page_id"]].append((r["record_type"], r["refers_to"]))
    assert kinds[1] == [("revisit", 2)] == kinds[None] and kinds[2] == [("response", None)] and kinds[8] == [("response", None)] * 2
    assert kinds[3] == kinds[4] == [("response", None)]


def test_warc_empty(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_normaliser_makes_members_that_stand_alone(spark, tmp_path):
    records = [warc._record(i, "u", b"p" * i, hashlib.sha1(b"p" * i).hexdigest(), None) for i in range(50)]
    path = tmp_path / "mono.warc.gz"
    pack = zlib.compressobj(6, wbits=31)
    path.write_bytes(pack.compress(b"".join(records)) + pack.flush())
    got = warc.normalise_archives(spark.createDataFrame([(f"file://{path}",)], "uri string"), f"file://{tmp_path}/out").collect()[0]
    data = open(got["uri"].removeprefix("file://"), "rb").read()
    import json

    index = [json.loads(x) for x in open(got["index_uri"].removeprefix("file://"))]
    assert [zlib.decompress(data[e["offset"] : e["offset"] + e["length"]], 31) for e in index] == records and sum(e["length"] for e in index) == len(data)


def test_damaged_archive_is_an_error():
    with pytest.raises(ValueError):
        list(warc.split_records([b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc"]))


# ---- 2 suffix dedup ------------------------------------------------------------------------------


def brute_repeats(rows, span):
    first = {}
    for d, t in sorted(r for r in rows if r[0] is not None):
        b = (t or "").encode()
        for i in range(len(b) - span + 1):
            first.setdefault(b[i : i + span], d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1 if d is not None else 0):
            if first[b[i : i + span]] < d:
                gone[i : i + span] = True
        out.append((d, int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out, key=str)


def test_repeats_match_brute_force(spark):
    own = docs(spark, "kept")
    got = suffix_dedup.remove_repeats(own)
    assert sorted(((r["doc_id"], r["n_removed"], r["n_spans"], r["kept"]) for r in got.collect()), key=str) == brute_repeats([(r[0], r[1]) for r in DOCS], 50)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_repeats_without_masks_are_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 1 << 20)
    text = LONG * 3
    ids = np.array([1, 2, 3], np.int64)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids), "text": [text, "q" * 10 + text, text[7:]]})
    sent = pa.Table.from_batches(list(suffix_dedup._send_runs(50, 20, 4, 7, "file:///nowhere")([batch])))
    flags = [suffix_dedup._sort_runs(50, 7)(sent.filter(pa.compute.equal(sent["bucket"], b))) for b in set(sent["bucket"].to_pylist())]
    blobs = [suffix_dedup._unpack(x, np.int64, np.uint32, np.int64, np.uint32) for f in flags for x in f["flags"].to_pylist()]
    found = {(int(d), int(w) + k) for doc, _, where, count in blobs for d, w, c in zip(doc, where, count) for k in range(c)}
    assert found == {(2, 10 + k) for k in range(len(text) - 49)} | {(3, k) for k in range(len(text) - 56)}


@settings(max_examples=60, deadline=None)
@given(hs.lists(hs.text(alphabet="abc", min_size=50, max_size=140), min_size=1, max_size=5), hs.sampled_from(["a" * 70, "", "the quick brown fox jumps over", "ab" * 30]))
def test_split_runs_keep_equal_windows_together(texts, phrase):
    """Every window stays in one run, and equal windows have equal marks, also where a phrase repeats."""
    raw = [(t[:30] + phrase + t[30:]).encode() for t in texts]
    off = np.append(0, np.cumsum([len(x) for x in raw]))
    data = np.frombuffer(b"".join(raw), np.uint8)
    start, count, mark, _, _ = suffix_dedup.cut_runs(data, off)
    run, first, many, fine, content = suffix_dedup.split_runs(data, start, count, mark)
    seen, marks, same = set(), {}, {}
    for r, f, n, m, c in zip(run.tolist(), first.tolist(), many.tolist(), fine.tolist(), content.tolist()):
        assert f + n <= count[r]
        a = int(start[r]) + f
        assert same.setdefault(c, data[a : a + n + 49].tobytes()) == data[a : a + n + 49].tobytes()
        for p in range(a, a + n):
            assert p not in seen and marks.setdefault(data[p : p + 50].tobytes(), m) == m
            seen.add(p)
    assert len(seen) == int(count.sum())


def test_crowded_marks_are_split(spark, monkeypatch):
    """The same removal with every repeated mark taken for a crowded one."""
    import sys

    rng = np.random.default_rng(6)
    letters = np.array(list("abcdefghij "))
    noise = lambda n: "".join(rng.choice(letters, n))
    phrase, tail = noise(32), noise(90)
    rows = [(i, noise(60) + phrase + noise(60) + (tail if i % 3 == 0 else "")) for i in range(40)]
    for f in (suffix_dedup._count_marks,):
        monkeypatch.setitem(f.__globals__, "CROWD", 2)
    assert sys.modules["scissile.llm.suffix_dedup"].CROWD == 2
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows]})
    told = {}
    for b in suffix_dedup._send_marks(50, 20, 1)([batch]):
        got = suffix_dedup._count_marks(pa.Table.from_batches([b]))
        told |= {c: suffix_dedup._pack(np.zeros(1, np.int64), np.array([len(m)], np.int64), np.frombuffer(m, np.uint8)) for c, m in zip(got["chunk"].to_pylist(), got["mask"].to_pylist())}
    monkeypatch.setattr(suffix_dedup, "get_file", lambda uri: told[uri.rpartition("/")[2]])
    sent = pa.Table.from_batches(list(suffix_dedup._send_runs(50, 20, 1, 7, "x")([batch])))
    gone = defaultdict(set)
    for b in set(sent["bucket"].to_pylist()):
        for blob in suffix_dedup._sort_runs(50, 7)(sent.filter(pa.compute.equal(sent["bucket"], b)))["flags"].to_pylist():
            for d, _, w, c in zip(*suffix_dedup._unpack(blob, np.int64, np.uint32, np.int64, np.uint32)):
                gone[int(d)] |= {k for p in range(int(w), int(w) + int(c)) for k in range(p, p + 50)}
    assert {d: n for d, n, *_ in brute_repeats(rows, 50)} == {d: len(gone[d]) for d, _ in rows} and any(gone.values())


@settings(max_examples=60, deadline=None)
@given(hs.lists(hs.text(alphabet="ab", min_size=0, max_size=160), min_size=1, max_size=6), hs.integers(1, 3))
def test_suffix_sort_groups_equal_windows(texts, block):
    span = 24
    raw = [t.encode() for t in texts if len(t) >= span]
    if not raw:
        return
    off = np.append(0, np.cumsum([len(x) for x in raw]))
    text = np.frombuffer(b"".join(raw), np.uint8)
    at = np.concatenate([np.arange(a, b - span + 1) for a, b in zip(off, off[1:])])
    seen, names, last = {}, {}, b""
    for place, group in suffix_dedup.sorted_windows(text, off, at, span, 1 << (4 * block)):
        for p, g in zip(place.tolist(), group.tolist()):
            w = text[p : p + span].tobytes()
            assert w >= last  # suffix order
            last = w
            assert seen.setdefault(w, g) == g and names.setdefault(g, w) == w
    assert len(seen) == len({text[p : p + span].tobytes() for p in at.tolist()})


def test_difference_cover():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


@pytest.mark.parametrize("name", ["__doc_bucket", "bucket", "doc_bucket", "flags"])
def test_repeats_with_clashing_columns(spark, name):
    got = suffix_dedup.remove_repeats(docs(spark, name)).collect()
    assert sorted(((r["doc_id"], r["n_removed"]) for r in got), key=str) == sorted(((d, n) for d, n, *_ in brute_repeats([(r[0], r[1]) for r in DOCS], 50)), key=str)
    assert {r[name] for r in got} == {"clash", None}


# ---- 3 SimHash -----------------------------------------------------------------------------------


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    s = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(fps, distance=4):
    parent = {i: i for i in range(len(fps))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_and_components(spark):
    base = (LONG * 5).split()
    near = []
    for k in range(25):
        w = list(base)
        w[3 * k] = f"word{k}"
        near.append((100 + k, " ".join(w)))
    rows = [(r[0], r[1]) for r in DOCS] + near
    got = {(r["doc_id"], r["fp"] & (1 << 64) - 1): r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps)
    for (d, _), f, r in zip(rows, fps, roots):
        members = [x[0] for x, y in zip(rows, roots) if y == r and x[0] is not None]
        assert got[d, f] == (min(members) if members else None)
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("n", [10, 1 << 16, 1 << 20, 1 << 30])
def test_links_reach_every_close_pair(spark, n):
    """Whatever the number of segments, links connect what brute force connects."""
    rng = np.random.default_rng(7)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 30)]
    for f in fps[:30]:
        for _ in range(4):
            fps.append(f ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 5), replace=False)))
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3), n).collect()
    at = {x: i for i, x in enumerate(signed)}
    got = min_labels(np.array([at[r["a"]] for r in edges]), np.array([at[r["b"]] for r in edges]), len(fps))
    assert got.tolist() == brute_components(fps)


@pytest.mark.parametrize("n", [10, 1 << 16, 1 << 30])
def test_every_close_pair_shares_a_table_value(n):
    rng = np.random.default_rng(1)
    plan = simhash.segment_plan(n)
    assert sum(b for _, b, _ in plan) <= 64
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63))
        flips = rng.choice(64, rng.integers(0, 5), replace=False)
        b = a ^ sum(1 << int(k) for k in flips)
        assert any(((a ^ b) >> first & (1 << bits) - 1).bit_count() <= radius for first, bits, radius in plan)


def test_crowded_value_keeps_its_links():
    rng = np.random.default_rng(2)
    fp = np.unique(np.array([sum(1 << int(k) for k in rng.choice(30, 3, replace=False)) for _ in range(200)], np.uint64))
    a, b = simhash.match_groups(np.zeros(len(fp), np.int64), np.ones(len(fp), bool), fp, 4)
    want = brute_components([int(x) for x in fp])
    at = {int(x): i for i, x in enumerate(fp)}
    got = min_labels(np.array([at[int(x)] for x in a]), np.array([at[int(x)] for x in b]), len(fp))
    assert len(a) < len(fp) and got.tolist() == want


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = dict(map(tuple, simhash.components(links).collect()))
    assert {got[i] for i in range(41)} == {0} and got[101] == 100


# ---- 4 winnowing ---------------------------------------------------------------------------------


def brute_hits(text, items):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, ids = find(text), set(), set()
    for i, t in items:
        v = find(t)
        k = min(13, len(v))
        wins = {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if v else set()
        for j in range(len(w) - k + 1):
            if v and i is not None and tuple(w[j : j + k]) in wins:
                hit |= set(range(j, j + k))
                ids.add(str(i))
    return len(w), len(hit), sorted(ids)


ITEMS = [(1, LONG), (2, "hello world"), (3, None), (4, "..."), (5, "é" * 80), (10, "one two three four five six seven eight nine ten eleven twelve thirteen"), (11, "a"), (None, "the lazy dog"), (1, "into the deep green forest at night the quick brown fox jumps over the lazy cat")]


@pytest.mark.parametrize("block", [1 << 24, 100])
def test_contamination_matches_brute_force(spark, block):
    more = [(200, "pre one two three four five six seven eight nine ten eleven twelve thirteen post"), (201, "one two three four five six seven eight nine ten eleven twelve, fourteen"), (202, "HELLO, world! hello world")]
    own = spark.createDataFrame([(r[0], r[1]) for r in DOCS] + more, "doc_id long, text string")
    got = winnow.find_contamination(own, spark.createDataFrame(ITEMS, "item_id long, text string"), block_bytes=block).collect()
    assert len(got) == len(DOCS) + len(more)
    for r in got:
        b = r["__bench"]
        assert (b["n_words"], b["n_hit"], b["item_ids"]) == brute_hits(r["text"], ITEMS), r["doc_id"]
        assert sum(s["length"] for s in b["spans"]) == b["n_hit"]
    assert winnow.find_contamination(empty(spark), spark.createDataFrame(ITEMS, "item_id long, text string"), block_bytes=block).count() == 0


@pytest.mark.parametrize("name", ["__bench", "__row", "n_hit"])
@pytest.mark.parametrize("block", [1 << 24, 100])
def test_contamination_with_clashing_columns(spark, name, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = winnow.find_contamination(docs(spark, name), items, block_bytes=block, name="found").collect()
    assert len(got) == len(DOCS) and {r[name] for r in got} == {"clash", None}
    assert all(r["found"]["n_hit"] == brute_hits(r["text"], ITEMS)[1] for r in got)
    assert winnow.find_contamination(docs(spark, name), items, block_bytes=block).select("__bench.n_hit").count() == len(DOCS)


def test_common_grams_are_followed_in_slices(monkeypatch):
    monkeypatch.setattr(winnow, "MATCHES", 50)
    item, text = "the " * 60 + "cat " + "the " * 60, "the " * 200 + "cat " + "the " * 200
    index = winnow.Index(["x", "y"], pa.array([item, "the the the"]))
    raw = np.frombuffer(text.encode(), np.uint8)
    n, hit, pairs, _ = index.search(raw, np.array([0, len(raw)]))
    assert (n[0], hit[0], pairs[1].tolist()) == (*brute_hits(text, [("x", item), ("y", "the the the")])[:2], [0, 1])


def test_empty_benchmark(spark):
    got = winnow.find_contamination(docs(spark), spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(got) == len(DOCS) and all(r["__bench"]["n_hit"] == 0 for r in got)


@settings(max_examples=50, deadline=None)
@given(hs.lists(hs.sampled_from("abcdef"), min_size=13, max_size=60), hs.integers(0, 40), hs.integers(0, 5))
def test_every_shared_window_is_found(item, start, pad):
    start = min(start, len(item) - 13)
    text = "z " * pad + " ".join(item[start : start + 13]) + " y" * pad
    index = winnow.Index(["x"], pa.array([" ".join(item)]))
    raw = np.frombuffer(text.encode(), np.uint8)
    assert index.search(raw, np.array([0, len(raw)]))[1][0] >= 13


# ---- 5, 6, 7 classifiers -------------------------------------------------------------------------


def labelled_tables(spark, n=600):
    rng = np.random.default_rng(4)
    good = ["river", "stone", "morning", "walked", "slowly", "under", "bright", "trees", "and", "the", "of"]
    bad = ["buy|", "$$$", "click!!", "FREE###", "win%%%", "now***"]
    rude = ["idiot", "moron", "scum"]
    rows, labels = [], []
    for i in range(n):
        quality, toxic = int(rng.random() < 0.6), int(rng.random() < 0.3)
        w = list(rng.choice(good if quality else bad, int(rng.integers(20, 120))))
        if toxic:
            for _ in range(4):
                w.insert(int(rng.integers(0, len(w))), str(rng.choice(rude)))
        lang = "xx" if i % 2 else "yy"
        w = [x[::-1] + ("ción" if i % 4 == 1 else "") for x in w] if lang == "xx" else w
        rows.append((i, " ".join(w), lang, "s", 1, "c"))
        labels.append((i, quality, toxic if lang == "yy" else 0))
    return docs(spark, "lang_pred", rows + [r for r in DOCS if r[1] is None or len(r[1]) < 3]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_scores(spark):
    own, labels = labelled_tables(spark)
    model = zstd_quality.fit(own, labels)
    got = zstd_quality.score_column(own, model).join(labels, "doc_id").where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1).collect()
    assert np.mean([(r["score"] >= 0.5) == (r["quality"] == 1) for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in zstd_quality.score_column(docs(spark), model).collect())
    none = zstd_quality.fit(empty(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["score"] for r in zstd_quality.score_column(docs(spark), none).collect()} == {0.5}
    assert zstd_quality.score_column(empty(spark), model).count() == 0


def test_toxicity_scores(spark):
    own, labels = labelled_tables(spark)
    own, labels = own.where("lang = 'yy'"), labels.where("doc_id % 2 = 0")
    model = ftrl.fit(own, labels)
    assert 0 < len(model.index) < 20_000
    got = zstd_quality.score_column(own, model).join(labels, "doc_id").where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1).collect()
    assert np.mean([(r["score"] >= 0.7) == (r["toxic"] == 1) for r in got]) > 0.95
    none = ftrl.fit(empty(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["score"] for r in zstd_quality.score_column(docs(spark), none).collect()} == {0.0}


def test_language(spark):
    own, _ = labelled_tables(spark)
    model = byte_cnn.fit(own.where("doc_id IS NOT NULL AND lang IN ('xx', 'yy')"), max_rows=300)
    got = byte_cnn.identify(own, model).where("doc_id > 15").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.95
    odd = {(r["text"] or "")[:3]: r["lang_pred"] for r in byte_cnn.identify(docs(spark), model).collect()}
    assert odd[""] == odd[" \n\t"] == odd["\x00\x00\x00"] == "und" and odd["日本語"] != "und"
    letters = [(1, "½ ² Ⅷ ①"), (2, "½ x"), (3, "١٢٣"), (4, "ª"), (5, "_ 12")]
    told = {r["doc_id"]: r["lang_pred"] != "und" for r in byte_cnn.identify(spark.createDataFrame(letters, "doc_id long, text string"), model).collect()}
    assert told == {d: any(map(str.isalpha, t)) for d, t in letters} and not told[1]
    none = byte_cnn.fit(own.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in byte_cnn.identify(docs(spark), none).collect()} == {"und"}
    assert byte_cnn.identify(empty(spark), model).count() == 0


def test_network_tables_agree_with_the_network():
    net = byte_cnn.Net(64, 3)
    model = byte_cnn.Model.__new__(byte_cnn.Model)
    model.names, model.net = ["a", "b", "c"], net
    x = np.random.default_rng(0).integers(0, 64, (5, byte_cnn.LENGTH)).astype(np.uint8)
    np.testing.assert_allclose(model.log_probabilities(x), net.forward(x.astype(np.int64))[0], atol=1e-4)


def test_network_gradients():
    net = byte_cnn.Net(64, 2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 64, (3, 20)), np.array([0, 1, 1])
    g = net.gradients(x, y)
    loss = lambda: -net.forward(x)[0][np.arange(3), y].mean()
    for name in net.p:
        flat = net.p[name].reshape(-1)
        for i in rng.integers(0, flat.size, 4):
            old = flat[i]
            flat[i] = old + 1e-6
            up = loss()
            flat[i] = old - 1e-6
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-6 - g[name].reshape(-1)[i]) < 1e-4, name


def plain_quality(model, text):
    """The score from its parts, piece by piece in plain Python."""
    import math

    import zstandard

    raw = (text or "").encode()
    if not raw:
        return model.prior
    packers = [zstandard.ZstdCompressor(level=zstd_quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_FULLDICT), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (model.good, model.bad)]
    good, bad = (sum(len(p.compress(raw[i : i + zstd_quality.PIECE])) for i in range(0, len(raw), zstd_quality.PIECE)) for p in packers)
    x = ((bad - good) / len(raw) - model.centre) / model.spread
    return 1 / (1 + math.exp(-max(-30, min(30, model.weights[0] + model.weights[1] * x))))


def plain_toxicity(model, text):
    """The score from the model's list of weights, a feature at a time."""
    import math

    w = [span_hashes(np.frombuffer(x, np.uint8), np.array([0]), np.array([len(x)]))[0] for x in re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))]
    weight = dict(zip(model.index.tolist(), model.weight.tolist()))
    one = lambda h: int(ftrl.mix(np.array([h], np.uint64))[0] >> np.uint64(64 - model.bits))
    found = {one(h) for h in w}
    with np.errstate(over="ignore"):
        for gap, salt in ((1, 0x9FB21C651E98DF25), (2, 0xD1342543DE82EF95)):
            found |= {one(np.uint64(a) * np.uint64(salt) + np.uint64(b)) for a, b in zip(w, w[gap:])}
    return 1 / (1 + math.exp(-max(-30, min(30, model.bias + sum(weight.get(k, 0.0) for k in found)))))


def plain_language(model, text):
    """The network a window at a time, without tables."""
    raw = np.frombuffer((text or "").encode().lower(), np.uint8)
    total, weight = 0, 0
    for i in range(0, max(1, len(raw)), byte_cnn.LENGTH):
        part = raw[i : i + byte_cnn.LENGTH]
        x = np.full((1, byte_cnn.LENGTH), byte_cnn.FILLER)
        x[0, : len(part)] = model.kind[part]
        own = ((part >= 97) & (part < 123) | (part >= 128)).sum() + 1e-3
        total, weight = total + own * model.net.forward(x)[0][0].astype(float), weight + own
    e = np.exp(total / weight - (total / weight).max())
    return model.names[int(e.argmax())], float(e.max() / e.sum())


def test_scores_equal_plain_ones(spark):
    own, labels = labelled_tables(spark)
    rows = DOCS + [(300, "the river, the stone.  IDIOT walked slowly FREE### " * 90, None, None, 1, None)]
    mixed = docs(spark, "score", rows)
    for model, plain in ((zstd_quality.fit(own, labels), plain_quality), (ftrl.fit(own, labels), plain_toxicity)):
        got = zstd_quality.score_column(mixed, model).collect()
        assert len(got) == len(rows)
        for r in got:
            assert abs(r["score"] - plain(model, r["text"])) < 1e-9, (plain, r["doc_id"])
    model = byte_cnn.fit(own.where("lang IN ('xx', 'yy')"), max_rows=200)
    for r in byte_cnn.identify(mixed, model).collect():
        name, p = plain_language(model, r["text"])
        letters = any(map(str.isalpha, r["text"] or ""))
        assert r["lang_pred"] == (name if letters else "und") and abs(r["lang_score"] - (p if letters else 0)) < 1e-4


def test_toxicity_scores_do_not_depend_on_the_mix(spark):
    """Twice the clean rows move scores little: both fits weight the labels alike."""
    own, labels = labelled_tables(spark, 1200)
    own, labels = own.where("lang = 'yy' AND doc_id > 15"), labels.where("doc_id % 2 = 0")
    rare = labels.where("toxic = 0 OR doc_id % 3 = 0")
    a, b = ftrl.fit(own, labels), ftrl.fit(own, rare)
    judge = [(f"river stone {w} morning walked under trees", w) for w in ("idiot", "moron", "scum", "bright", "slowly")]
    raw = [t.encode() for t, _ in judge]
    off = np.append(0, np.cumsum([len(x) for x in raw]))
    for model in (a, b):
        assert (model.scores(b"".join(raw), off) >= 0.7).tolist() == [True] * 3 + [False] * 2


def test_long_texts_are_sampled_all_over(spark):
    from scissile.llm.sampling import STRETCH, STRETCHES, stretches

    text = "".join(chr(0x4E00 + i // 1000) for i in range(400_000))
    short = "é" * (STRETCH * STRETCHES)
    got = [r[0] for r in spark.createDataFrame([(text,), (short,), (None,), ("",)], "text string").select(stretches(F.col("text"))).collect()]
    assert got[1:] == [short, None, ""] and len(got[0]) == STRETCH * STRETCHES + STRETCHES - 1
    places = [ord(p[0]) - 0x4E00 for p in got[0].split(" ")]
    assert [p * 8 // 400 for p in places] == list(range(8))


# ---- 8 shards ------------------------------------------------------------------------------------


def test_table_is_fair_and_moves_little():
    names = [f"n{i}" for i in range(20)]
    a, b = maglev.fill_table(names, 2003), maglev.fill_table(names[:-1], 2003)
    counts = np.bincount(a, minlength=20)
    assert counts.max() - counts.min() <= 1
    stay = a != 19
    assert (a[stay] == b[stay]).mean() > 0.85
    for bad in ([], ["x", "x"]):
        with pytest.raises(ValueError):
            maglev.fill_table(bad)
    with pytest.raises(ValueError):
        maglev.fill_table(["x"], 100)


def test_table_by_turns():
    names, slots = ["a", "b", "c"], 13
    order = {n: [(o + i * s) % slots for i in range(slots)] for n in names for o, s in [maglev.preference(n, slots)]}
    table, k = {}, 0
    while len(table) < slots:
        name = names[k % 3]
        table[next(s for s in order[name] if s not in table)] = k % 3
        k += 1
    assert maglev.fill_table(names, slots).tolist() == [table[i] for i in range(slots)]


def test_placement(spark):
    got = maglev.place(docs(spark, "slot"), "doc_id", ["x", "y"]).collect()
    table = maglev.fill_table(["x", "y"])
    assert len(got) == len(DOCS)
    for r in got:
        key = "null" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % maglev.SLOTS
        assert (r["slot"], r["shard"]) == (slot, "xy"[table[slot]])
    assert maglev.place(empty(spark), "doc_id", ["x"]).count() == 0
    clash = spark.createDataFrame([("a", 1), (None, 2)], "slot string, `x.y` int")
    assert {(r["x.y"], r["slot"]) for r in maglev.place(clash, "slot", ["x"]).collect()} == {(i, int(hashlib.md5(k.encode()).hexdigest()[:15], 16) % maglev.SLOTS) for i, k in ((1, "a"), (2, "null"))}
    for name in ("Slot", "shard"):
        assert maglev.place(docs(spark, name), name, ["x"]).count() == len(DOCS)


# ---- 9 audio -------------------------------------------------------------------------------------


def test_media(spark):
    out = queries_audio(docs(spark, "media")).collect()
    assert len(out) == len(DOCS)
    seen = {}
    for r in out:
        raw = (next(t for d, t, *_ in DOCS if d == r["doc_id"] and (d is not None or (t is None) == (r["n_bytes"] == 0))) or "").encode()
        payload = raw + b"\xff" * (576 if not raw else -len(raw) % 576)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert audio.from_wav(r["media"]) == (8000, payload) and struct.unpack_from("<I", r["media"], 4)[0] + 8 == len(r["media"])
        assert seen.setdefault(raw, r["feature"]) == r["feature"]
    assert queries_audio(empty(spark)).count() == 0
    for name in ("tensors", "segments", "payload_bytes", "media_bytes"):
        media = audio.encode(docs(spark)).withColumn(name, F.lit("clash"))
        assert audio.features(media).select("payload_bytes", "tensors", "segments").count() == len(DOCS)
    table = audio.tensor_table(pa.table({"tensors": pa.array([r["tensors"] for r in out], pa.list_(audio.TENSOR))}))
    assert table["values"].type.shape == [audio.FRAMES, audio.MELS] and table.num_rows == sum(len(r["tensors"]) for r in out)


def queries_audio(df):
    out = audio.features(audio.encode(df))
    return out.withColumn("feature", audio.feature_digest(F.col("tensors"), F.col("segments")))


def plain_features(payload):
    """Frames' log-mel energies by direct sums over the definition, without strides or transforms."""
    x = (np.frombuffer(payload, np.uint8).astype(float) - 128) / 128
    y = np.zeros(len(x) // audio.DOWN * audio.UP)
    for j in range(len(y)):
        q, phase = divmod(j, audio.UP)
        for t in range(audio.TAPS):
            i = q * audio.DOWN + t - (audio.TAPS // 2 - 1)
            if 0 <= i < len(x):
                y[j] += x[i] * audio.PHASES[t, phase]
    spin = np.exp(-2j * np.pi * np.outer(np.arange(audio.FRAME), np.arange(audio.FRAME // 2 + 1)) / audio.FRAME)
    frames = [y[k : k + audio.FRAME] for k in range(0, len(y) - audio.FRAME + 1, audio.HOP)]
    mel = [np.log(np.abs((f * audio.HANN) @ spin) ** 2 @ audio.BANK + 1e-6) for f in frames]
    loud = [10 * np.log10((f * f).mean() + 1e-9) for f in frames]
    on, spans, middle = False, [], np.median(loud)
    for i, v in enumerate([*loud, -1e9]):
        if not on and v > middle + audio.ENTER_DB:
            on, begin = True, i
        elif on and v < middle + audio.LEAVE_DB:
            on = False
            spans.append((begin, i))
    return np.array(mel), spans


def test_features_by_definition(spark):
    rng = np.random.default_rng(3)
    texts = ["short", LONG * 12, "".join(chr(int(c)) for c in rng.integers(32, 126, 900)) + "  " * 900 + "ZZZZ" * 300]
    rows = audio.features(audio.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    for r in rows:
        mel, spans = plain_features(audio.pad(texts[r["doc_id"]].encode()))
        got = np.concatenate([np.frombuffer(t["values"], np.float16).reshape(audio.FRAMES, audio.MELS) for t in r["tensors"]])
        np.testing.assert_allclose(got[: len(mel)], mel, atol=0.03)
        assert not got[len(mel) :].any()
        second = audio.HOP / audio.OUT_RATE
        assert [(round(s["start_s"] / second), round((s["end_s"] - audio.FRAME / audio.OUT_RATE) / second) + 1) for s in r["segments"]] == spans
        assert [round(t["start_s"] / second) for t in r["tensors"]] == list(range(0, len(mel), audio.FRAMES))


def test_resampler_keeps_a_tone():
    t = np.arange(5760)
    tone = (128 + 100 * np.sin(2 * np.pi * 440 * t / audio.RATE)).astype(np.uint8)
    y = audio.resample(tone.tobytes())
    assert len(y) == 3840
    peak = np.abs(np.fft.rfft(y[1000:1000 + 2048] * np.hanning(2048))).argmax() * audio.OUT_RATE / 2048
    assert abs(peak - 440) < 5 and abs(np.abs(y[500:3000]).max() - 100 / 128) < 0.05


def test_segments_have_hysteresis():
    loud = np.array([0, 0, 0, 5, 0.5, -0.5, 5, -5, -5, 0, 0], float)
    assert audio.segments(loud) == [(3, 7)]


# ---- 10 packing ----------------------------------------------------------------------------------


def plain_best_fit(lengths, capacity):
    import bisect

    bins, opened = [], 0
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(bins, n)
        room = bins.pop(i) if i < len(bins) else capacity
        opened += room == capacity
        if room > n:
            bisect.insort(bins, room - n)
    return opened


@settings(max_examples=150, deadline=None)
@given(hs.lists(hs.integers(1, 40), min_size=0, max_size=120))
def test_histogram_packing_is_best_fit_decreasing(lengths):
    counts = defaultdict(int)
    for n in lengths:
        counts[n] += 1
    plan, used = packing.best_fit_decreasing(dict(counts), 40)
    assert used == plain_best_fit(lengths, 40)
    bins = defaultdict(list)
    for length, rank, pieces, first, each, offset in plan:
        for k in range(pieces):
            bins[first + k // each].append((offset + k % each * length, length))
    assert sum(map(len, bins.values())) == len(lengths) and len(bins) == used
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 40


def test_pieces(spark):
    from tokenizers import Tokenizer

    paths = queries.tokenizer_paths()
    own = Tokenizer.from_file(paths[0])
    got = defaultdict(list)
    rows = [*DOCS, (90, "a <|endoftext|> b", None, None, 1, None), (91, "<|endoftext|>é日本<|endoftext|>", None, None, 1, None), (92, "<|endoftext", None, None, 1, None)]
    for r in packing.pack(docs(spark, "piece", rows), *paths).collect():
        got[r["doc_id"]].append(r)
    assert got[90][0]["length"] == 5
    for d, t, *_ in rows:
        if d is None or d == 5:
            continue
        ids = np.array(own.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(got[d], key=lambda r: r["piece"])
        assert sum(r["length"] for r in pieces) == len(ids) and all(r["length"] == 2048 for r in pieces[1:])
        for r in pieces:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    assert len(got[5]) == 2 and packing.pack(empty(spark), *paths).count() == 0


@settings(max_examples=150, deadline=None)
@given(hs.text(alphabet=hs.characters(codec="utf-8"), max_size=60))
def test_both_tokenizers_agree(text):
    fast, own = _encoders()
    assert list(fast([text])[0]) == list(own([text])[0])


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_both_tokenizers_agree_on_whole_documents(sf):
    import os

    import pyarrow.parquet as pq

    path = f"/root/testdata/{sf}/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no documents here")
    texts = [t or "" for t in pq.read_table(path, columns=["text"]).column(0).to_pylist()]
    fast, own = _encoders()
    assert [list(x) for x in fast(texts)] == [list(x) for x in own(texts)]


def _encoders(cache=[]):
    if not cache:
        a, b = queries.tokenizer_paths()
        cache += [packing.load_encoder(a, b), packing.load_encoder(a, None)]
    return cache


# ---- shared --------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(hs.lists(hs.text(alphabet="ab .é1", max_size=20), min_size=1, max_size=6))
def test_words_and_hashes(texts):
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw]))
    start, end, row = words(data, off, winnow.WORD)
    got = [(r, data[a:b].tobytes()) for a, b, r in zip(start, end, row)]
    assert got == [(i, w) for i, x in enumerate(raw) for w in re.findall(rb"[0-9a-z\x80-\xff]+", x)]
    h = span_hashes(data, start, end)
    assert len(set(zip(h.tolist(), [w for _, w in got]))) == len(set(h.tolist())) == len({w for _, w in got})


def test_sha1_header_form():
    assert base64.b32decode(base64.b32encode(hashlib.sha1(b"").digest())).hex() == hashlib.sha1(b"").hexdigest()
