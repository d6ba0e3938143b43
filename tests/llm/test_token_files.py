"""Token files: the code of boundaries, encoding by stretches, and whole tables against the tokenizer itself."""

import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from scissile.llm import queries, token_files
from scissile.llm.token_files import EliasFano, Encoder
from tests.llm.test_llm import docs, empty


@given(hs.lists(hs.integers(0, 1 << 40), max_size=700))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values):
    values = sorted(values)
    code = EliasFano.from_bytes(EliasFano.of(np.array(values, np.uint64)).to_bytes())
    assert code.values().tolist() == values and [code.select(i) for i in range(len(values))] == values
    for x in values[:20]:
        assert code.first_at_least(x) == values.index(x) and code.first_at_least(x + 1) == sum(v <= x for v in values)
    with pytest.raises(IndexError):
        code.select(len(values))


def test_elias_fano_is_near_minimal():
    values = np.sort(np.random.default_rng(1).integers(0, 10**8, 20_000))
    bits = 8 * len(EliasFano.of(values).to_bytes()) / len(values)
    assert bits < 2 + np.log2(10**8 / 20_000) + 0.5 < 64 / 3


@pytest.fixture(scope="module")
def own():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.word_tokenizer_path())


def test_stretches_give_the_tokenizer_s_ids(own):
    rng = random.Random(3)
    signs = ["a", "B", "é", "é", "É", "×", "÷", " ", "\n", "\t", "'s", "'", "1", "ß", "İ", "Σ", "ς", "日", " ", "<|endoftext|>", "<|startoftext|>", "<|END", "́", "̸", "한", "ᄀ", "ᅡ", "!!", ".", ",", "=", "-", "…", "😀", "\x00", " ", "ﬁ", "\r", "\x0b", "\x85", "*&", '"', "µ", "ª"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(20_000)] + ["", "ab" * 5000]
    encoder = Encoder(queries.word_tokenizer_path())
    for i in range(0, len(texts), 5001):
        part = texts[i : i + 5001]
        ids, many = encoder.encode(pa.array(part))
        assert [x.tolist() for x in np.split(ids, np.cumsum(many)[:-1])] == [x.ids for x in own.encode_batch(part, add_special_tokens=False)]


def test_forgetting_changes_nothing(own, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 10)
    encoder = Encoder(queries.word_tokenizer_path())
    for n in range(5):
        texts = [f"word{n}{i} other, words {i * n}" for i in range(20)]
        ids, _ = encoder.encode(pa.array(texts))
        assert ids.tolist() == [y for t in texts for y in own.encode(t, add_special_tokens=False).ids]


def wanted(rows, own):
    """doc_id, start, n_tokens, crc by the tokenizer over whole texts, in ascending order of ids."""
    out, at = [], 0
    for d, t in rows:
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((d, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


@pytest.mark.parametrize("file_ids", [1, 300, 1 << 24])
def test_files_of_awkward_rows(spark, own, file_ids):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", file_ids > 300)
    table = docs(spark, "start")
    files = token_files.write(table, queries.word_tokenizer_path(), file_ids=file_ids).cache()
    got = [tuple(r) for r in token_files.read(files).orderBy("start").collect()]
    keyed = table.select("doc_id", "text", F.xxhash64("text").alias("h")).orderBy("doc_id", "h").collect()
    assert got == wanted([(r["doc_id"], r["text"]) for r in keyed], own)
    assert files.agg(F.sum("n_docs")).first()[0] == len(keyed) and (files.count() > 2) == (file_ids <= 300)
    found = token_files.fetch(files, spark.createDataFrame([(5,), (8,), (5,), (999,)], "doc_id long")).collect()
    texts = {r["doc_id"]: r["text"] for r in keyed}
    assert sorted((r["doc_id"], r["ids"]) for r in found) == sorted((d, [*own.encode(texts[d], add_special_tokens=False).ids, 2]) for d in (5, 5, 8))
    files.unpersist()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_negative_and_far_ids(spark, own):
    rows = [(-(1 << 62), "first one"), (-5, "b"), (0, "c d"), (1 << 62, "last"), ((1 << 63) - 1, None)]
    files = token_files.write(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), queries.word_tokenizer_path())
    assert [tuple(r) for r in token_files.read(files).orderBy("start").collect()] == wanted(rows, own)


def test_a_damaged_file_is_told(spark, tmp_path):
    chunks = b"".join(token_files.pack_file([1, 2], np.array([3, 1]), np.arange(4)))
    for name, data in (("cut", chunks[:-1]), ("turned", chunks[:9] + b"\x07" + chunks[10:])):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(ValueError):
            token_files.TokenFile(f"file://{tmp_path}/{name}").ids(0, 2)


def test_empty_table(spark):
    files = token_files.write(empty(spark), queries.word_tokenizer_path())
    assert files.count() == 0 and token_files.read(files).collect() == []


def test_op12_rows(spark, own, tmp_path):
    rows = [(7, "A word, another.\nAnd more"), (3, None), (5, "<|endoftext|> x"), (-2, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_token_files(spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == wanted(sorted(rows), own) and got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
