"""The operators over whole tables, with production parameters; digests as the query contract has them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, byte_cnn, ftrl, maglev, packing, phrases, simhash, spelling, suffix_dedup, token_files, warc, winnow, zstd_quality
from .sampling import residue

SHARDS = [f"shard-{i:03d}" for i in range(256)]


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark, sf_dir):
    read = warc.archive(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_simhash(spark, sf_dir):
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op4_winnow(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bench = winnow.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    ids = F.concat_ws(",", "__bench.item_ids")
    return bench.select("doc_id", "__bench.n_words", "__bench.n_hit", F.size("__bench.item_ids").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), winnow.is_contaminated(F.col("__bench")).alias("contaminated"))


def op5_zstd_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = zstd_quality.score_column(docs.select("doc_id", "text"), zstd_quality.fit(docs, labels))
    return out.select("doc_id", (residue("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_byte_cnn(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = byte_cnn.identify(docs.select("doc_id", "text"), byte_cnn.fit(docs))
    return out.select("doc_id", ((residue("doc_id", 5) == 0) & F.col("doc_id").isNotNull()).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op7_ftrl(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = zstd_quality.score_column(docs.select("doc_id", "text"), ftrl.fit(docs, labels))
    return out.select("doc_id", (residue("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_maglev(spark, sf_dir):
    return maglev.place(table(spark, sf_dir, "documents"), "doc_id", SHARDS).select("doc_id", "slot", "shard")


def op9_audio(spark, sf_dir):
    media = audio.encode(table(spark, sf_dir, "documents"))
    out = audio.features(media)
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), audio.feature_digest(F.col("tensors"), F.col("segments")).alias("feature"))


def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_paths())


def op11_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op12_token_files(spark, sf_dir):
    return token_files.read(token_files.write(table(spark, sf_dir, "documents"), word_tokenizer_path()))


def op13_phrases(spark, sf_dir):
    return phrases.mine(table(spark, sf_dir, "documents"))


def queries():
    return {f.__name__: f for f in (op1_warc, op2_suffix_dedup, op3_simhash, op4_winnow, op5_zstd_quality, op6_byte_cnn, op7_ftrl, op8_maglev, op9_audio, op10_packing, op11_spelling, op12_token_files, op13_phrases)}


ORACLES = {
    "op1_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
        k AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) END AS keeper FROM d)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
            CASE WHEN keeper > page_id OR (keeper IS NOT NULL AND page_id IS NULL) THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN keeper > page_id OR (keeper IS NOT NULL AND page_id IS NULL) THEN keeper END AS refers_to
        FROM k""",
    "op2_suffix_dedup": """
        WITH d AS (SELECT doc_id, upper(hex(encode(coalesce(text, '')))) AS h FROM documents),
        w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 49)) AS p FROM d WHERE length(h) >= 100)),
        f AS (SELECT doc_id, p FROM (SELECT w.doc_id, p, m FROM w JOIN (SELECT s, min(doc_id) AS m FROM w GROUP BY s HAVING count(*) > 1) USING (s)) WHERE m < doc_id),
        g AS (SELECT doc_id, p, p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 AS gap FROM f),
        r AS (SELECT doc_id, p, sum(CASE WHEN gap OR gap IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g),
        runs AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS z FROM r GROUP BY doc_id, run),
        cuts AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed FROM runs GROUP BY doc_id),
        parts AS (SELECT doc_id, run, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY run) AS b, a AS e FROM runs UNION ALL SELECT doc_id, 1000000000, max(z), 1000000000 FROM runs GROUP BY doc_id),
        kept AS (SELECT parts.doc_id, string_agg(substr(h, 2 * b + 1, 2 * (least(e, length(h) // 2) - b)), '' ORDER BY run) AS k FROM parts JOIN d USING (doc_id) GROUP BY parts.doc_id)
        SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
        FROM d LEFT JOIN cuts USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op4_winnow": r"""
        WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        iw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
        win AS (SELECT DISTINCT item, least(13, len(w)) AS k, array_to_string(w[i + 1 : i + least(13, len(w))], ' ') AS s
            FROM (SELECT item, w, unnest(range(greatest(1, len(w) - 12))) AS i FROM iw WHERE len(w) > 0)),
        ks AS (SELECT DISTINCT k FROM win),
        dwin AS (SELECT doc_id, k, i, array_to_string(w[i + 1 : i + k], ' ') AS s
            FROM (SELECT doc_id, w, k, unnest(range(greatest(0, len(w) - k + 1))) AS i FROM dw, ks)),
        m AS (SELECT d.doc_id, d.i, d.k, win.item FROM dwin d JOIN win ON d.s = win.s AND d.k = win.k),
        hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM m)) GROUP BY doc_id),
        its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM m GROUP BY doc_id)
        SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op11_spelling": r"""
        WITH RECURSIVE tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
        o AS (SELECT doc_id, run, count(*) AS m FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL),
        b AS (SELECT run, m, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS bytes FROM o),
        h AS (SELECT run, m, xor(list_reduce([4294967295] || bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM b, tab),
        s AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, m FROM h),
        w AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM s WHERE length(word) >= 7 GROUP BY word HAVING sum(m) >= 2),
        d AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS s FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
        near AS (SELECT x.word, y.word AS other, y.n FROM d x JOIN d y ON x.i = y.i AND x.s = y.s AND x.word <> y.word
            UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.s = w.word UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.s = w.word),
        best AS (SELECT word, count(*) AS n_near, min(other) FILTER (WHERE n = most) AS other, max(most) AS most FROM (SELECT *, max(n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word),
        f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN other END AS form, CASE WHEN most >= 10 * w.n THEN most END AS form_n FROM w LEFT JOIN best USING (word)),
        up AS (SELECT word, word AS root, 0 AS step FROM w UNION ALL SELECT up.word, f.form, step + 1 FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL),
        top AS (SELECT word, arg_max(root, step) AS root FROM up GROUP BY word)
        SELECT f.word, form, root, f.n, CAST(n_near AS BIGINT) AS n_near, form_n FROM f JOIN top USING (word)""",
    "op13_phrases": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS x FROM documents),
        w AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM p),
        g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s FROM w, range(1, 6) t(k)),
        f AS (SELECT lang, k, s, count(*) AS f FROM g GROUP BY lang, k, s HAVING count(*) >= 100),
        n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
        c AS (SELECT lang, k, s, f AS a, string_split(s, ' ') AS ws FROM f WHERE k > 1),
        cut AS (SELECT lang, k, s, a, j, array_to_string(ws[:j], ' ') AS s1, array_to_string(ws[j + 1 :], ' ') AS s2 FROM c, range(1, 5) t(j) WHERE j < k),
        sc AS (SELECT cut.*, x.f AS l, y.f AS r, n.n, CAST(CAST(1000 AS HUGEINT) * a * n.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM cut JOIN f x ON x.lang = cut.lang AND x.s = s1 JOIN f y ON y.lang = cut.lang AND y.s = s2 JOIN n ON n.lang = cut.lang),
        low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, j) = 1),
        inside AS (SELECT DISTINCT lang, array_to_string(ws[i : i + m - 1], ' ') AS s, a FROM c, range(2, 5) t(m), range(1, 5) u(i) WHERE m < k AND i + m - 1 <= k),
        kept AS (SELECT low.* FROM low WHERE NOT EXISTS (SELECT 1 FROM inside WHERE inside.lang = low.lang AND inside.s = low.s AND 100 * inside.a >= 100 * low.a))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank, s AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score
        FROM kept QUALIFY rank <= 2000""",
}


def op8_sql() -> str:
    """The lookup, with the table's shards as a list; how it is filled is tested by itself."""
    shards = ",".join(map(str, maglev.fill_table(SHARDS).tolist()))
    return f"""
        WITH lookup AS (SELECT unnest(range({maglev.SLOTS})) AS slot, unnest(string_split('{shards}', ',')) AS s),
        d AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) % {maglev.SLOTS} AS slot FROM documents)
        SELECT doc_id, CAST(slot AS BIGINT) AS slot, 'shard-' || lpad(s, 3, '0') AS shard FROM d JOIN lookup USING (slot)"""


def oracle_sql():
    return ORACLES | {"op8_maglev": op8_sql()}
