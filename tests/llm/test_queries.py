"""The registered queries over a folder of small tables: against their SQL, or against brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest

from scissile.llm import audio, maglev, queries
from tests.llm.test_llm import LONG, TEXTS, brute_components, brute_fingerprint, brute_repeats

ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + k, LONG * 5 + f"tail number {k} of a longer text") for k in range(6)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    put = lambda rows, kind, name: spark.createDataFrame(rows, kind).repartition(2).write.parquet(f"{d}/{name}.parquet")
    put([(i, t, "en" if i % 3 else "de", "s", 1) for i, t in ROWS], "doc_id long, text string, lang string, source string, n_chars long", "documents")
    put([(i, int(i % 2), int(i % 5 == 0)) for i, _ in ROWS], "doc_id long, quality int, toxic int", "labels")
    put([(1, LONG), (2, "hello world"), (3, None)], "item_id long, text string", "benchmark")
    put([(i, f"http://x/{i}", h) for i, h in enumerate([None, "", "a" * 1500, "b" * 999, "a" * 1500, "b" * 999, "é" * 700, "é" * 700])], "page_id long, url string, html string", "pages")
    return d


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    got = queries.queries()[name](spark, folder)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_op2_rows(spark, folder):
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op2_suffix_dedup(spark, folder).collect()}
    assert got == {d: (n, s, hashlib.sha256(left).hexdigest()) for d, n, s, left in brute_repeats(ROWS, 50)}


def test_op3_rows(spark, folder):
    fps = [brute_fingerprint(t) for _, t in ROWS]
    roots = brute_components(fps)
    want = {(d, f"{f:016x}", ROWS[r][0]) for (d, _), f, r in zip(ROWS, fps, roots)}
    assert {tuple(r) for r in queries.op3_simhash(spark, folder).collect()} == want


def folds(modulus):
    return {d: zlib.crc32(str(d).encode()) % modulus for d, _ in ROWS}


@pytest.mark.parametrize("name,limit", [("op5_zstd_quality", 0.5), ("op7_ftrl", 0.7)])
def test_scores(spark, folder, name, limit):
    got = queries.queries()[name](spark, folder).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert r["held_out"] == (folds(3)[r["doc_id"]] == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit)


def test_languages(spark, folder):
    got = queries.op6_byte_cnn(spark, folder).collect()
    texts = dict(ROWS)
    for r in got:
        letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
        assert r["held_out"] == (folds(5)[r["doc_id"]] == 0) and (r["lang_pred"] == "und") == (not letters) and r["lang_pred"] in ("und", "en", "de")
    assert len(got) == len(ROWS)


def test_op8_rows(spark, folder):
    table = maglev.fill_table(queries.SHARDS)
    slot = lambda d: int(hashlib.md5(str(d).encode()).hexdigest()[:15], 16) % maglev.SLOTS
    assert {tuple(r) for r in queries.op8_maglev(spark, folder).collect()} == {(d, slot(d), queries.SHARDS[table[slot(d)]]) for d, _ in ROWS}


def test_op9_rows(spark, folder):
    seen = {}
    for r in queries.op9_audio(spark, folder).collect():
        raw = (dict(ROWS)[r["doc_id"]] or "").encode()
        payload = audio.pad(raw)
        media = audio.to_wav(payload)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest())
        assert len(payload) % 576 == 0 and len(payload) > 0 and seen.setdefault(raw, r["feature"]) == r["feature"]


def test_op10_rows(spark, folder):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_paths()[0])
    want = set()
    for d, t in ROWS:
        ids = np.array(own.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % 2048 or min(2048, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want |= {(d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    got = queries.op10_packing(spark, folder).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
