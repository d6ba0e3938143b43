"""Named queries of the break-site operators, each beside the SQL that must give the same rows.

The shared tables hold no genomics, so ranges, reads, genes and keys are fixed
projections of them, written the same way for both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequences as sq
from ..functions import strings as st
from ..operators import alignments, evaluation as ev, figures, graphs, intervals, reads as rd, targets as tg
from . import run_stats

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = "WITH " + sql.strip() if not sql.strip().upper().startswith("SELECT") else sql.strip()
        return f

    return add


def queries():
    from . import roundtrips  # noqa: F401  (adds its queries)

    return dict(QUERIES)


def oracle_sql():
    from . import roundtrips  # noqa: F401

    return dict(SQL)


# ---- projections ---------------------------------------------------------------------------------

FRAG = """frag AS (SELECT 'chr' || (l_suppkey % 5) AS seqnames, l_orderkey * 5 + l_linenumber AS s, l_orderkey * 5 + l_linenumber + CAST(l_quantity AS BIGINT) AS e,
  CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_returnflag AS specimen, l_returnflag || '-' || l_linenumber AS samplename,
  l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey % 97 AS VARCHAR) AS umi FROM lineitem)"""
READ = "reads AS (SELECT o_orderkey AS id, o_custkey AS cust, translate(md5(CAST(o_orderkey AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM orders)"
GENE = "gene AS (SELECT 'chr' || (p_partkey % 5) AS seqnames, p_partkey * 500 AS s, p_partkey * 500 + p_size * 40 AS e, p_brand AS symbol, p_type FROM part)"
TARGETS = {"T1": "ACGTNC", "T2": "GGRCAT", "T3": "TTYACG"}
BARCODES = ["ACGTAC", "GGTACC", "TTNACG", "CATGCA", "GTACGT"]


def t(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def frag(spark, d) -> DataFrame:
    s = "l_orderkey * 5 + l_linenumber"
    return t(spark, d, "lineitem").selectExpr("concat('chr', l_suppkey % 5) AS seqnames", f"{s} AS start", f"{s} + CAST(l_quantity AS BIGINT) AS end", "if(l_linestatus = 'O', '+', '-') AS strand", "l_returnflag AS specimen", "concat(l_returnflag, '-', l_linenumber) AS sampleName", "l_orderkey", "l_linenumber", "l_partkey", "CAST(l_suppkey % 97 AS STRING) AS umi")


def reads(spark, d) -> DataFrame:
    return t(spark, d, "orders").selectExpr("o_orderkey AS read_id", "o_custkey AS cust", "translate(md5(CAST(o_orderkey AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq")


def genes(spark, d) -> DataFrame:
    return t(spark, d, "part").selectExpr("concat('chr', p_partkey % 5) AS seqnames", "p_partkey * 500 AS start", "p_partkey * 500 + p_size * 40 AS end", "p_brand AS symbol", "p_type")


def island_sql(source: str, keys: str, name: str = "isl", gap: int = 0, s: str = "s", e: str = "e") -> str:
    """Islands by one ordered pass a key: `head` is the first start."""
    return f"""{name}_a AS (SELECT *, max({e}) OVER (PARTITION BY {keys} ORDER BY {s}, {e} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}),
  {name} AS (SELECT * EXCLUDE (reach), max(CASE WHEN reach IS NULL OR {s} > reach + {gap} THEN {s} END) OVER (PARTITION BY {keys} ORDER BY {s}, {e}, CASE WHEN reach IS NULL OR {s} > reach + {gap} THEN 0 ELSE 1 END ROWS UNBOUNDED PRECEDING) AS head FROM {name}_a)"""


def mis_sql(seq: str, pattern: str, at: str) -> str:
    """Mismatches of a pattern at 1-based `at`."""
    return " + ".join(f"CASE WHEN {at} + {i} >= 1 AND substr({seq}, CAST({at} + {i} AS BIGINT), 1) <> '' AND contains('{sq.overlapping_codes(c)}', substr({seq}, CAST({at} + {i} AS BIGINT), 1)) THEN 0 ELSE 1 END" for i, c in enumerate(pattern))


CLUSTER = f"""{FRAG}, {island_sql('frag', 'specimen, seqnames, strand')},
  pos AS (SELECT *, CASE WHEN strand = '-' THEN e ELSE s END AS p FROM isl),
  cnt AS (SELECT specimen, seqnames, strand, head, p, count(*) AS n FROM pos GROUP BY ALL),
  org AS (SELECT specimen, seqnames, strand, head, p AS origin FROM (SELECT *, row_number() OVER (PARTITION BY specimen, seqnames, strand, head ORDER BY n DESC, CASE WHEN strand = '-' THEN -p ELSE p END) AS r FROM cnt) WHERE r = 1),
  clus AS (SELECT pos.*, seqnames || ':' || strand || ':' || origin AS clus_ori FROM pos JOIN org USING (specimen, seqnames, strand, head))"""

PAIR = f"""{FRAG}, pts AS (SELECT DISTINCT specimen, seqnames, strand, CASE WHEN strand = '-' THEN e ELSE s END AS p FROM frag),
  edge AS (SELECT a.specimen, a.seqnames, a.strand, a.p, least(a.p, min(b.p)) AS lo, greatest(a.p, max(b.p)) AS hi FROM pts a JOIN pts b ON a.specimen = b.specimen AND a.seqnames = b.seqnames AND a.strand <> b.strand
    AND (CASE WHEN a.strand = '+' THEN a.p - b.p ELSE b.p - a.p END) BETWEEN -10 AND 21 GROUP BY a.specimen, a.seqnames, a.strand, a.p),
  {island_sql('edge', 'specimen, seqnames', 'pairs', 0, 'lo', 'hi')}"""


def components_sql(links: str, node: str = "x") -> str:
    """lab(x, r): the smallest end that each end of the links (x, y) reaches, by rounds of neighbours' minima."""
    return f"""und AS (SELECT x, y FROM {links} UNION SELECT y, x FROM {links}),
  lab(x, r) USING KEY (x) AS (SELECT DISTINCT x, x FROM und UNION SELECT l.x, min(u.r) FROM (SELECT und.x, n.r FROM lab n JOIN und ON n.x = und.y) u JOIN recurring.lab l ON l.x = u.x WHERE u.r < l.r GROUP BY l.x)"""


# ---- intervals -----------------------------------------------------------------------------------


@query(f"{FRAG}, {island_sql('(SELECT seqnames, strand, s, e FROM frag)', 'seqnames, strand')} SELECT seqnames, strand, head AS range_start, max(e) AS range_end, CAST(count(*) AS BIGINT) AS members FROM isl GROUP BY ALL")
def reduce_ranges(spark, d):
    return intervals.reduce_ranges(frag(spark, d), ["seqnames", "strand"]).select("seqnames", "strand", F.col("start").alias("range_start"), F.col("end").alias("range_end"), "members")


@query(f"{FRAG}, {island_sql('(SELECT seqnames, strand, s, e FROM frag)', 'seqnames, strand', gap=5)} SELECT seqnames, strand, head AS range_start, max(e) AS range_end, CAST(count(*) AS BIGINT) AS members FROM isl GROUP BY ALL")
def reduce_ranges_gap(spark, d):
    return intervals.reduce_ranges(frag(spark, d), ["seqnames", "strand"], 5).select("seqnames", "strand", F.col("start").alias("range_start"), F.col("end").alias("range_end"), "members")


@query(f"{CLUSTER} SELECT specimen, l_orderkey, l_linenumber, head AS island, clus_ori FROM clus")
def pileup_cluster(spark, d):
    return intervals.pileup_clusters(frag(spark, d), ["specimen"]).select("specimen", "l_orderkey", "l_linenumber", "island", "clus_ori")


@query(f"{CLUSTER} SELECT specimen, clus_ori, CAST(count(*) AS BIGINT) AS algns, CAST(count(DISTINCT p) AS BIGINT) AS points FROM clus GROUP BY ALL")
def pileup_origin(spark, d):
    own = intervals.pileup_clusters(frag(spark, d), ["specimen"]).withColumn("p", sq.five_prime(F.col("start"), F.col("end"), F.col("strand")))
    return own.groupBy("specimen", "clus_ori").agg(F.count("*").alias("algns"), F.count_distinct("p").alias("points"))


@query(f"{CLUSTER} SELECT clus_ori, CAST(dense_rank() OVER (ORDER BY clus_ori) AS BIGINT) AS clus_id FROM (SELECT DISTINCT clus_ori FROM clus)")
def pileup_ids(spark, d):
    return intervals.cluster_ids(intervals.pileup_clusters(frag(spark, d), ["specimen"])).select("clus_ori", F.col("clus_id").cast("long").alias("clus_id"))


@query(f"{PAIR} SELECT frag.l_orderkey, frag.l_linenumber, CASE WHEN pairs.head IS NOT NULL THEN frag.specimen || '.' || frag.seqnames || '.' || pairs.head END AS paired_algn FROM frag LEFT JOIN pairs ON frag.specimen = pairs.specimen AND frag.seqnames = pairs.seqnames AND frag.strand = pairs.strand AND pairs.p = CASE WHEN frag.strand = '-' THEN e ELSE s END")
def paired_alignments(spark, d):
    return intervals.identify_pairs(frag(spark, d), ["specimen"], 20, 10).select("l_orderkey", "l_linenumber", "paired_algn")


@query(f"""{PAIR}, own AS (SELECT frag.*, pairs.head FROM frag JOIN pairs ON frag.specimen = pairs.specimen AND frag.seqnames = pairs.seqnames AND frag.strand = pairs.strand AND pairs.p = CASE WHEN frag.strand = '-' THEN e ELSE s END),
  side AS (SELECT specimen, seqnames, head, strand, CASE WHEN strand = '+' THEN min(s) ELSE max(e) END AS p, sum(l_linenumber) AS n, sum(l_partkey % 3) AS u, sum(CAST(CASE WHEN l_partkey % 4 = 0 THEN 0.5 ELSE 1 END AS DOUBLE)) AS c, count(*) AS a FROM own GROUP BY specimen, seqnames, head, strand)
  SELECT specimen AS alt_specimen, specimen || '.' || seqnames || '.' || head AS paired_algn, seqnames, min(p) AS region_start, max(p) AS region_end, CAST(min(p) AS DOUBLE) + CAST(max(p) - min(p) AS DOUBLE) / 2 AS mid, max(p) - min(p) AS width, CAST(sum(n) AS BIGINT) AS count, CAST(sum(u) AS BIGINT) AS umitag, sum(c) AS algns, CAST(sum(a) AS BIGINT) AS abund FROM side GROUP BY specimen, seqnames, head""")
def paired_regions(spark, d):
    own = intervals.identify_pairs(frag(spark, d), ["specimen"], 20, 10).where("paired_algn IS NOT NULL").withColumn("alt_specimen", F.col("specimen")).withColumn("abund", F.lit(1))
    own = own.withColumn("count", F.col("l_linenumber")).withColumn("umitag", F.col("l_partkey") % 3).withColumn("contrib", F.when(F.col("l_partkey") % 4 == 0, 0.5).otherwise(1.0))
    return ev.paired_regions(own).select("alt_specimen", "paired_algn", "seqnames", F.col("start").alias("region_start"), F.col("end").alias("region_end"), "mid", "width", "count", "umitag", "algns", "abund")


@query(f"{FRAG}, pt AS (SELECT DISTINCT seqnames, s AS pos FROM frag), {GENE} SELECT pt.seqnames, pos, symbol, gene.s AS gene_start FROM pt JOIN gene ON pt.seqnames = gene.seqnames AND pos BETWEEN gene.s AND gene.e")
def interval_containment(spark, d):
    pts = frag(spark, d).select("seqnames", F.col("start").alias("pos")).distinct()
    return intervals.containing(pts, genes(spark, d), "pos").select("seqnames", "pos", "symbol", F.col("start").alias("gene_start"))


@query(f"""{FRAG}, pt AS (SELECT DISTINCT seqnames, s AS pos FROM frag), {GENE},
  held AS (SELECT pt.seqnames, pos, min(symbol) AS held FROM pt JOIN gene ON pt.seqnames = gene.seqnames AND pos BETWEEN gene.s AND gene.e GROUP BY ALL),
  lasts AS (SELECT seqnames, e, min(symbol) AS symbol FROM gene GROUP BY ALL), firsts AS (SELECT seqnames, s, min(symbol) AS symbol FROM gene GROUP BY ALL),
  b AS (SELECT pt.seqnames, pos, e, symbol FROM pt ASOF JOIN lasts ON pt.seqnames = lasts.seqnames AND pos >= lasts.e),
  a AS (SELECT pt.seqnames, pos, s, symbol FROM pt ASOF JOIN firsts ON pt.seqnames = firsts.seqnames AND pos <= firsts.s),
  near AS (SELECT pt.seqnames, pt.pos, CASE WHEN a.s IS NULL OR pt.pos - b.e <= a.s - pt.pos THEN b.symbol ELSE a.symbol END AS near FROM pt LEFT JOIN b USING (seqnames, pos) LEFT JOIN a USING (seqnames, pos))
  SELECT near.seqnames, near.pos, coalesce(held, near) || CASE WHEN held IS NOT NULL THEN '*' ELSE '' END || CASE WHEN coalesce(held, near) IN ('Brand#11', 'Brand#23') THEN '~' ELSE '' END || CASE WHEN coalesce(held, near) IN ('Brand#23', 'Brand#45') THEN '!' ELSE '' END AS gene_id FROM near LEFT JOIN held USING (seqnames, pos)""")
def gene_annotate(spark, d):
    pts = frag(spark, d).select("seqnames", F.col("start").alias("pos"))
    return intervals.annotate_genes(pts, genes(spark, d), "pos", ["Brand#11", "Brand#23"], ["Brand#23", "Brand#45"]).select("seqnames", "pos", "gene_id")


CONTIG = f"{FRAG}, contig AS (SELECT seqnames, max(e) AS len FROM frag GROUP BY ALL)"


def contigs(spark, d):
    return frag(spark, d).groupBy("seqnames").agg(F.max("end").alias("length"))


TILE = "tile AS (SELECT seqnames, s AS tile_start, least(s + 999, len) AS tile_end FROM (SELECT seqnames, len, unnest(generate_series(CAST(1 AS BIGINT), len, 1000)) AS s FROM contig))"


@query(f"{CONTIG}, {TILE} SELECT * FROM tile")
def genome_tiles(spark, d):
    return intervals.tiles(contigs(spark, d), 1000).select("seqnames", F.col("start").alias("tile_start"), F.col("end").alias("tile_end"))


@query(f"{CONTIG}, {TILE}, c AS (SELECT tile.seqnames, tile_start, count(frag.s) AS n FROM tile LEFT JOIN frag ON tile.seqnames = frag.seqnames AND frag.s <= tile_end AND frag.e >= tile_start GROUP BY ALL), m AS (SELECT max(log10(n + 1)) AS top FROM c) SELECT seqnames, tile_start, CAST(n AS BIGINT) AS n, round(log10(n + 1), 6) AS log_n, round(log10(n + 1) / top, 6) AS norm FROM c, m WHERE n >= 2")
def genomic_density(spark, d):
    out = intervals.genomic_density(frag(spark, d).select("seqnames", "start", "end"), contigs(spark, d), 1000)
    return out.select("seqnames", F.col("start").alias("tile_start"), F.col("count").alias("n"), F.round("log_count", 6).alias("log_n"), F.round("norm_log_count", 6).alias("norm"))


@query(f"{FRAG}, b AS (SELECT seqnames, min(s) AS lo, max(e) AS hi FROM frag GROUP BY ALL), w AS (SELECT seqnames, unnest(generate_series(lo, hi, CAST(2000 AS BIGINT))) AS ws, hi FROM b) SELECT w.seqnames, ws AS win_start, least(ws + 1999, hi) AS win_end, CAST(count(*) FILTER (strand = '+') AS BIGINT) AS plus, CAST(count(*) FILTER (strand = '-') AS BIGINT) AS minus FROM w LEFT JOIN frag ON w.seqnames = frag.seqnames AND s <= ws + 1999 AND e >= ws GROUP BY ALL")
def coverage(spark, d):
    out = intervals.coverage(frag(spark, d).select("seqnames", "start", "end", "strand"), 2000)
    return out.select("seqnames", F.col("start").alias("win_start"), F.col("end").alias("win_end"), "plus", "minus")


def permuted_sql(value: str, source: str) -> str:
    """(i, v): four Feistel rounds over the halves of a number; source has i, the number, half and total."""
    bits = lambda k: f"(CAST('0x' || substr(md5('1:{k}:' || b), 1, 15) AS BIGINT) >> (60 - half))"
    inner = f"SELECT *, {value} >> half AS a, {value} & ((CAST(1 AS BIGINT) << half) - 1) AS b FROM {source}"
    for k in range(4):
        inner = f"SELECT * EXCLUDE (a, b), b AS a, xor(a, {bits(k)}) AS b FROM ({inner})"
    return f"SELECT i, half, total, (a << half) | b AS v FROM ({inner})"


@query(f"""RECURSIVE {CONTIG}, ct AS (SELECT seqnames, len, sum(len) OVER (ORDER BY seqnames) - len AS lo, sum(len) OVER (ORDER BY seqnames) AS hi FROM contig),
  tot AS (SELECT CAST(total AS BIGINT) AS total, greatest(1, (length(bin(CAST(total - 1 AS BIGINT))) + 1) // 2) AS half FROM (SELECT sum(len) AS total FROM contig)),
  draw AS (SELECT i, total, half FROM (SELECT unnest(range(CAST(500 AS BIGINT))) AS i), tot),
  walk AS ({permuted_sql("i", "draw")} UNION ALL {permuted_sql("v", "(SELECT * FROM walk WHERE v >= total)")})
  SELECT seqnames, CAST(v - lo + 1 AS BIGINT) AS start, CASE WHEN CAST('0x' || substr(md5('1:side:' || i), 1, 15) AS BIGINT) >> 59 = 0 THEN '+' ELSE '-' END AS strand FROM walk JOIN ct ON v >= lo AND v < hi""")
def random_sites(spark, d):
    return intervals.random_sites(contigs(spark, d), 500)


@query(f"RECURSIVE kv AS (SELECT DISTINCT l_orderkey AS k, l_partkey AS v FROM lineitem), hub AS (SELECT kv.k AS x, m.k AS y FROM kv JOIN (SELECT v, min(k) AS k FROM kv GROUP BY v) m USING (v)), {components_sql('hub')} SELECT x AS k, r AS cluster FROM lab")
def cluster_kv(spark, d):
    return graphs.cluster_keys(keys_of_parts(spark, d), "k", "v")


def keys_of_parts(spark, d) -> DataFrame:
    return t(spark, d, "lineitem").selectExpr("l_orderkey AS k", "l_partkey AS v")


@query(f"""RECURSIVE {CLUSTER}, {PAIR.removeprefix(FRAG + ", ")}, own AS (SELECT clus.l_orderkey, clus.l_linenumber, clus.specimen || '|' || clus_ori || '|' || clus.head AS pile, clus.specimen || '.' || clus.seqnames || '.' || pairs.head AS pair FROM clus LEFT JOIN pairs USING (specimen, seqnames, strand, p)),
  hub AS (SELECT DISTINCT pile AS x, min(pile) OVER (PARTITION BY coalesce(pair, 'own|' || pile)) AS y FROM own), {components_sql('hub')}
  SELECT l_orderkey, l_linenumber, r AS locus FROM own JOIN lab ON pile = x""")
def assign_loci(spark, d):
    return graphs.assign_loci(frag(spark, d).select("seqnames", "start", "end", "strand", "specimen", "l_orderkey", "l_linenumber"), ["specimen"], 0, 20, 10).select("l_orderkey", "l_linenumber", "locus")


# ---- reads ---------------------------------------------------------------------------------------


@query(r"SELECT c_custkey, regexp_extract(c_name, '[\w\:\-\+]+', 0) AS key FROM customer")
def read_name_key(spark, d):
    return rd.with_key(t(spark, d, "customer"), id_column="c_name").select("c_custkey", "key")


def _barcode_sql(seq: str, length: int, k: int, name: str, source: str = "reads", max_n: int = 1) -> str:
    cut = f"substr({seq}, 1, {length})"
    hits = ", ".join("CASE WHEN (" + " + ".join(f"CASE WHEN {mis_sql('c', b, str(o + 1))} <= {k} THEN 1 ELSE 0 END" for o in range(length - len(b) + 1)) + f") = 1 THEN '{b}' END" for b in BARCODES)
    return f"{name} AS (SELECT id, CASE WHEN n > {max_n} THEN 'degenerate' WHEN len(h) > 1 THEN 'ambiguous' WHEN len(h) = 0 THEN 'unassigned' ELSE h[1] END AS barcode FROM (SELECT id, length(c) - length(replace(c, 'N', '')) AS n, list_filter([{hits}], lambda x: x IS NOT NULL) AS h FROM (SELECT id, {cut} AS c FROM {source})))"


READN = "readn AS (SELECT id, CASE WHEN id % 11 = 0 THEN 'N' || substr(seq, 2, 1) || 'N' || substr(seq, 4) ELSE seq END AS seq, substr(seq, 9) AS seq2 FROM reads)"


def reads_n(spark, d):
    return reads(spark, d).select("read_id", F.when(F.col("read_id") % 11 == 0, F.concat(F.lit("N"), F.substring("seq", 2, 1), F.lit("N"), F.substring("seq", 4, 100))).otherwise(F.col("seq")).alias("seq"), F.substring("seq", 9, 100).alias("seq2"))


@query(f"{READ}, {READN}, {_barcode_sql('seq', 8, 2, 'bc', 'readn')} SELECT id AS read_id, barcode FROM bc")
def barcode_classify(spark, d):
    return rd.classify_barcodes(reads_n(spark, d).select("read_id", "seq"), BARCODES, 8, 2).select("read_id", "barcode")


MANIFEST = [(f"s{i}{j}-1", a, b) for i, a in enumerate(BARCODES) for j, b in enumerate(BARCODES) if (i + j) % 2 == 0]


@query(f"""{READ}, {READN}, {_barcode_sql('seq', 8, 2, 'bc1', 'readn')}, {_barcode_sql('seq2', 8, 2, 'bc2', 'readn')}, man(samplename, a, b) AS (VALUES {', '.join(str(m) for m in MANIFEST)})
  SELECT id AS key, coalesce(samplename, CASE WHEN 'degenerate' IN (bc1.barcode, bc2.barcode) THEN 'degenerate' WHEN 'ambiguous' IN (bc1.barcode, bc2.barcode) THEN 'ambiguous' ELSE 'unassigned' END) AS sample FROM bc1 JOIN bc2 USING (id) LEFT JOIN man ON a = bc1.barcode AND b = bc2.barcode""")
def dual_demux(spark, d):
    own = reads_n(spark, d)
    one = rd.classify_barcodes(own.select(F.col("read_id").alias("key"), "seq"), BARCODES, 8, 2)
    two = rd.classify_barcodes(own.select(F.col("read_id").alias("key"), F.col("seq2").alias("seq")), BARCODES, 8, 2)
    manifest = spark.createDataFrame(MANIFEST, "sampleName string, barcode1 string, barcode2 string")
    return rd.assign_samples(one, two, manifest).select("key", F.col("sampleName").alias("sample"))


@query(f"{FRAG} SELECT DISTINCT samplename AS sample, regexp_replace(samplename, '-\\d+$', '') AS pooled FROM frag")
def pool_replicates(spark, d):
    return frag(spark, d).select(F.col("sampleName").alias("sample"), rd.pool_replicates(F.col("sampleName")).alias("pooled")).distinct()


@query("SELECT o_orderkey AS read_id, CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / (count(*) OVER () / CAST(7 AS DOUBLE))) AS INTEGER) AS bin FROM orders")
def bin_reads(spark, d):
    return rd.bins(t(spark, d, "orders").selectExpr("o_orderkey AS read_id"), 7, 100).select("read_id", "bin")


QUAL = "qual AS (SELECT id, seq, translate(md5('q' || id), '0123456789abcdef', '5678:<=>?@ABCDEF') AS q FROM reads)"


@query(f"{READ}, {QUAL}, pos AS (SELECT id, seq, q, unnest(range(1, 33)) AS i FROM qual), bad AS (SELECT id, min(i) AS cut_at FROM (SELECT id, i, len(list_filter(range(greatest(i - 5, 1), least(i + 5, 32) + 1), lambda j: ascii(substr(q, j, 1)) <= 63)) AS n FROM pos) WHERE n >= 5 GROUP BY id) SELECT id AS read_id, CASE WHEN cut_at IS NULL THEN seq ELSE substr(seq, 1, cut_at - 1) END AS seq FROM qual LEFT JOIN bad USING (id)")
def quality_trim(spark, d):
    own = reads(spark, d).withColumn("qual", F.translate(F.md5(F.concat(F.lit("q"), F.col("read_id").cast("string"))), "0123456789abcdef", "5678:<=>?@ABCDEF"))
    return rd.quality_trim(own).select("read_id", "seq")


@query(f"{READ}, m AS (SELECT id, seq, CASE WHEN {mis_sql('seq', 'ACGTRC', '1')} <= 3 THEN 1 ELSE 0 END AS a, CASE WHEN {mis_sql('seq', 'ACGTRC', '2')} <= 3 THEN 1 ELSE 0 END AS b FROM reads) SELECT id AS read_id, CASE WHEN a = 1 THEN substr(seq, 7) ELSE substr(seq, 8) END AS seq FROM m WHERE a + b = 1")
def lead_trim(spark, d):
    return rd.lead_trim(reads(spark, d), "ACGTRC", 0, 3).select("read_id", "seq")


@query(f"{READ}, m AS (SELECT id, seq, CASE WHEN {mis_sql('seq', 'ACG', '1')} + {mis_sql('seq', 'TAC', '8')} <= 3 THEN 1 ELSE 0 END AS a, CASE WHEN {mis_sql('seq', 'ACG', '2')} + {mis_sql('seq', 'TAC', '9')} <= 3 THEN 1 ELSE 0 END AS b FROM reads), o AS (SELECT *, CASE WHEN a = 1 THEN 1 ELSE 2 END AS o FROM m WHERE a + b = 1) SELECT id AS read_id, substr(seq, o + 3, 4) AS umi, substr(seq, o + 10) AS seq FROM o WHERE regexp_full_match(substr(seq, o + 3, 4), '[ACGT][ACGT][AG][ACGT]')")
def umi_collect(spark, d):
    return rd.lead_trim(reads(spark, d), "ACGNNRNTAC", 0, 3, collect="umi").select("read_id", "umi", "seq")


_TAIL = "GATTACAGAT"
_FULL = ", ".join(f"CASE WHEN {o + len(_TAIL) - 1} <= length(seq) AND {mis_sql('seq', _TAIL, str(o))} <= {round(len(_TAIL) * 0.3)} THEN {o} END" for o in range(1, 24))
_ENDS = ", ".join(f"CASE WHEN {mis_sql('seq', _TAIL[:n], f'(length(seq) - {n - 1})')} <= {round(n * 0.3)} THEN length(seq) - {n - 1} END" for n in range(3, len(_TAIL)))


@query(f"{READ}, m AS (SELECT id, seq, list_min([{_FULL}, {_ENDS}]) AS cut_at FROM reads) SELECT id AS read_id, CASE WHEN cut_at IS NULL THEN seq ELSE substr(seq, 1, CAST(cut_at AS BIGINT) - 1) END AS seq FROM m")
def over_trim(spark, d):
    return rd.overread_trim(reads(spark, d), _TAIL, 0.7).select("read_id", "seq")


@query("c AS (SELECT cust, count(*) AS n FROM (SELECT DISTINCT o_custkey AS cust, 0 AS f FROM orders WHERE o_orderstatus = 'O' UNION SELECT DISTINCT o_custkey, 1 FROM orders WHERE o_orderstatus = 'F' UNION SELECT DISTINCT o_custkey, 2 FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY cust) SELECT cust AS key, 'all' AS mode FROM c WHERE n = 3 UNION ALL SELECT cust, 'any' FROM c WHERE n > 1 UNION ALL SELECT cust, 'negative' FROM c WHERE n = 1")
def multi_file_filter(spark, d):
    o = t(spark, d, "orders").withColumn("key", F.col("o_custkey"))
    files = [o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'"), o.where("o_orderpriority = '1-URGENT'")]
    out = None
    for mode in ("all", "any", "negative"):
        own = rd.shared_keys(files, mode).withColumn("mode", F.lit(mode))
        out = own if out is None else out.unionByName(own)
    return out


@query("SELECT o_orderkey AS key FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def index_filter(spark, d):
    keys = t(spark, d, "lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey AS key").distinct()
    return rd.keep_keys(t(spark, d, "orders").selectExpr("o_orderkey AS key"), keys)


def _contains_sql(pattern: str, k: int) -> str:
    return "(" + " OR ".join(f"{mis_sql('seq', pattern, str(o))} <= {k}" for o in range(1, 33 - len(pattern) + 1)) + ")"


@query(f"{READ} SELECT id AS read_id, {_contains_sql('ACGTA', 1)} AND {_contains_sql('GTNAC', 0)} AS every, {_contains_sql('ACGTA', 1)} OR {_contains_sql('GTNAC', 0)} AS some, NOT {_contains_sql('ACGTA', 1)} AND NOT {_contains_sql('GTNAC', 0)} AS neither FROM reads")
def seq_filter(spark, d):
    s, p, k = F.col("seq"), ["ACGUA", "GTNAC"], [1, 0]
    return reads(spark, d).select("read_id", rd.contains_patterns(s, p, k).alias("every"), rd.contains_patterns(s, p, k, every=False).alias("some"), rd.contains_patterns(s, p, k, negative=True).alias("neither"))


@query(f"{READ} SELECT id AS read_id, translate(seq, 'AC', 'RB') AS seq FROM reads")
def substitution_adjust(spark, d):
    return reads(spark, d).select("read_id", rd.substitute(F.col("seq"), ["iAR", "rCB"]).alias("seq"))


@query(f"{READ} SELECT id AS read_id, 'seq' || dense_rank() OVER (ORDER BY substr(seq, 1, 5)) AS seq_id FROM reads")
def consolidate(spark, d):
    _, keys = rd.consolidate(reads(spark, d).withColumn("seq", F.substring("seq", 1, 5)))
    return keys.select("read_id", "seq_id")


@query(f"{READ} SELECT cust % 10 AS grp, CAST(count(*) AS BIGINT) AS reads, CAST(sum(length(seq)) AS BIGINT) AS bases, round(avg(length(seq)), 1) AS mean_length FROM reads GROUP BY cust % 10")
def sequence_stats(spark, d):
    return rd.sequence_stats(reads(spark, d).withColumn("grp", F.col("cust") % 10), ["grp"])


@query("SELECT o_custkey AS key, CAST(count(*) AS BIGINT) AS count FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return rd.duplicate_keys(t(spark, d, "orders").selectExpr("o_custkey AS key"), "key")


@query(f"{READ} SELECT id AS read_id, CASE WHEN length(trimmed) > 0 THEN trimmed ELSE seq END AS seq FROM (SELECT id, seq, CASE WHEN id % 3 = 0 THEN substr(seq, 5) ELSE '' END AS trimmed FROM reads)")
def untrimmed_union(spark, d):
    own = reads(spark, d).select("read_id", "seq")
    return rd.untrimmed_union(own, own.where("read_id % 3 = 0").withColumn("seq", F.substring("seq", 5, 100)))


# ---- alignments ----------------------------------------------------------------------------------

PSL = "psl AS (SELECT l_orderkey AS id, l_linenumber AS ln, 20 + l_suppkey % 31 AS matches, l_linenumber % 3 AS rep, 50 AS qsize, l_partkey % 9 AS qstart, 50 - l_partkey % 4 AS qend, l_suppkey % 8 AS tins, CASE WHEN l_suppkey % 40 = 0 THEN 'chr1_alt' ELSE 'chr' || (l_suppkey % 5) END AS tname, l_orderkey * 5 AS tstart, l_orderkey * 5 + 45 AS tend, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand FROM lineitem)"


def psl(spark, d):
    return t(spark, d, "lineitem").selectExpr("l_orderkey AS id", "l_linenumber AS ln", "CAST(l_orderkey AS STRING) AS qName", "20 + l_suppkey % 31 AS matches", "l_linenumber % 3 AS repMatches", "50 AS qSize", "l_partkey % 9 AS qStart", "50 - l_partkey % 4 AS qEnd", "l_suppkey % 8 AS tBaseInsert", "if(l_suppkey % 40 = 0, 'chr1_alt', concat('chr', l_suppkey % 5)) AS tName", "l_orderkey * 5 AS tStart", "l_orderkey * 5 + 45 AS tEnd", "if(l_linestatus = 'O', '+', '-') AS strand")


@query(f"{PSL} SELECT id, ln FROM psl WHERE 100 * (matches + rep) / CAST(qsize AS DOUBLE) >= 95 AND qstart <= 5 AND tins <= 5 AND NOT contains(tname, '_')")
def psl_quality(spark, d):
    return alignments.drop_alt(alignments.quality_filter(psl(spark, d))).select("id", "ln")


@query(f"{PSL} SELECT CAST(id AS VARCHAR) AS qname, tname AS seqnames, tstart - CASE WHEN strand = '+' THEN qstart ELSE qsize - qend END + 1 AS range_start, tend + CASE WHEN strand = '+' THEN qsize - qend ELSE qstart END AS range_end, strand FROM psl")
def psl_extended(spark, d):
    return alignments.extended_ranges(psl(spark, d)).select(F.col("qName").alias("qname"), "seqnames", F.col("start").alias("range_start"), F.col("end").alias("range_end"), "strand")


SAM = """sam AS (SELECT CAST(l_orderkey AS VARCHAR) AS qname, l_linenumber AS ln, CASE l_linenumber % 4 WHEN 0 THEN 99 WHEN 1 THEN 147 WHEN 2 THEN 83 ELSE 77 END AS flag, 30 + l_suppkey % 40 AS qwidth,
  (l_partkey % 7) || CASE WHEN l_partkey % 2 = 0 THEN 'S' ELSE 'H' END || (40 + l_suppkey % 20) || 'M' || CASE WHEN l_suppkey % 3 = 0 THEN '2I10M' ELSE '' END || (l_suppkey % 4) || 'S' AS cigar, '10A5^AC' || (20 + l_partkey % 9) || CASE WHEN l_partkey % 3 = 0 THEN 'G4' ELSE '' END AS md FROM lineitem)"""


def sam(spark, d):
    return t(spark, d, "lineitem").selectExpr("CAST(l_orderkey AS STRING) AS qname", "l_linenumber AS ln", "CASE l_linenumber % 4 WHEN 0 THEN 99 WHEN 1 THEN 147 WHEN 2 THEN 83 ELSE 77 END AS flag", "30 + l_suppkey % 40 AS qwidth", "concat(l_partkey % 7, if(l_partkey % 2 = 0, 'S', 'H'), 40 + l_suppkey % 20, 'M', if(l_suppkey % 3 = 0, '2I10M', ''), l_suppkey % 4, 'S') AS cigar", "concat('10A5^AC', 20 + l_partkey % 9, if(l_partkey % 3 = 0, 'G4', '')) AS MD")


PCT = r"round_even(100 * (list_sum(list_transform(regexp_extract_all(cigar, '(\d+)M', 1), lambda x: CAST(x AS BIGINT))) - len(regexp_extract_all(md, '[ACGT]'))) / CAST(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[HSMIDX=]', 1), lambda x: CAST(x AS BIGINT))) AS DOUBLE), 1)"


@query(f"{SAM} SELECT qname, ln, {PCT} AS pct_id FROM sam")
def cigar_pct_id(spark, d):
    return sam(spark, d).select("qname", "ln", sq.percent_identity(F.col("cigar"), F.col("MD")).alias("pct_id"))


@query(rf"{SAM} SELECT qname, ln, CAST(regexp_extract(cigar, '^(\d+)[HS]', 1) AS INTEGER) AS head_clip, CAST(regexp_extract(cigar, '(\d+)[HS]$', 1) AS INTEGER) AS tail_clip FROM sam")
def clip_count(spark, d):
    return sam(spark, d).select("qname", "ln", sq.clipped(F.col("cigar")).alias("head_clip"), sq.clipped(F.col("cigar"), "end").alias("tail_clip"))


@query(rf"{SAM}, dec AS (SELECT *, CASE WHEN (flag & 64) <> 0 THEN 'anchor' ELSE 'adrift' END AS role, CASE WHEN (flag & 16) <> 0 THEN '-' ELSE '+' END AS strand, {PCT} AS pct FROM sam WHERE (flag & 4) = 0 AND (flag & 8) = 0), good AS (SELECT * FROM dec WHERE pct >= 70 AND qwidth >= 35 AND CASE WHEN strand = '+' THEN CAST(regexp_extract(cigar, '^(\d+)[HS]', 1) AS INTEGER) ELSE CAST(regexp_extract(cigar, '(\d+)[HS]$', 1) AS INTEGER) END <= 5) SELECT qname, ln, role, strand FROM good WHERE qname IN (SELECT qname FROM good WHERE role = 'anchor') AND qname IN (SELECT qname FROM good WHERE role = 'adrift')")
def sam_filter(spark, d):
    return alignments.sam_filter(alignments.decode_flags(sam(spark, d)), 70, 35, 5).select("qname", "ln", F.col("end").alias("role"), "strand")


POINTS = f"{FRAG}, a AS (SELECT DISTINCT seqnames, strand, s AS p FROM frag WHERE l_linenumber % 2 = 1), b AS (SELECT DISTINCT seqnames, strand, s AS q FROM frag WHERE l_linenumber % 2 = 0)"


@query(f"{POINTS} SELECT a.seqnames, a.strand, p AS anchor_pos, q AS adrift_pos FROM a JOIN b ON a.seqnames = b.seqnames AND a.strand <> b.strand AND (CASE WHEN a.strand = '+' THEN q - p ELSE p - q END) BETWEEN 29 AND 101")
def loci_pairs(spark, d):
    pts = frag(spark, d).select("seqnames", "strand", F.col("start").alias("pos"), "l_linenumber")
    return alignments.loci_pairs(pts.where("l_linenumber % 2 = 1"), pts.where("l_linenumber % 2 = 0"), 30, 100).select("seqnames", "strand", "anchor_pos", "adrift_pos")


HITS = f"""{FRAG}, a AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS ak, seqnames, strand, CASE WHEN strand = '-' THEN e ELSE s END AS p FROM frag WHERE l_linenumber % 2 = 1), b AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS bk, seqnames, strand, CASE WHEN strand = '-' THEN e ELSE s END AS q FROM frag WHERE l_linenumber % 2 = 0),
  keys AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS ak, CAST(o_orderkey AS VARCHAR) AS bk FROM orders),
  loci AS (SELECT DISTINCT keys.ak, keys.bk, a.seqnames, a.strand, least(p, q) AS s, greatest(p, q) AS e FROM keys JOIN a ON keys.ak = a.ak JOIN b ON keys.bk = b.bk AND a.seqnames = b.seqnames AND a.strand <> b.strand WHERE (CASE WHEN a.strand = '+' THEN q - p ELSE p - q END) BETWEEN 29 AND 2501)"""


def hits(spark, d):
    f = frag(spark, d)
    a = f.where("l_linenumber % 2 = 1").withColumn("qName", F.col("l_partkey").cast("string"))
    b = f.where("l_linenumber % 2 = 0").withColumn("qName", F.col("l_orderkey").cast("string"))
    keys = t(spark, d, "orders").selectExpr("CAST(o_custkey AS STRING) AS anchor_key", "CAST(o_orderkey AS STRING) AS adrift_key").distinct().withColumn("read_pair", F.concat_ws(":", "anchor_key", "adrift_key"))
    return keys, a, b


@query(f"{HITS} SELECT ak || ':' || bk AS read_pair, seqnames, strand, s AS range_start, e AS range_end, CAST(count(*) OVER (PARTITION BY ak, bk) AS BIGINT) AS n_loci FROM loci")
def couple_reads(spark, d):
    return alignments.couple(*hits(spark, d), 30, 2500).select("read_pair", "seqnames", "strand", F.col("start").alias("range_start"), F.col("end").alias("range_end"), "n_loci")


@query(f"{HITS}, n AS (SELECT ak, bk, count(*) AS n FROM loci GROUP BY ALL) SELECT keys.ak || ':' || keys.bk AS read_pair, CASE WHEN n = 1 THEN 'unique' WHEN n > 1 THEN 'multihit' WHEN keys.ak IN (SELECT ak FROM a) AND keys.bk IN (SELECT bk FROM b) THEN 'chimera' ELSE 'failed' END AS class FROM keys LEFT JOIN n ON keys.ak = n.ak AND keys.bk = n.bk")
def classify_uniq_multi_chimera(spark, d):
    keys, a, b = hits(spark, d)
    return alignments.classify_pairs(keys, alignments.couple(keys, a, b, 30, 2500), a, b)


@query("k AS (SELECT l_orderkey AS r, 'A-' || min(l_partkey) AS a, 'B-' || min(l_suppkey) AS b FROM lineitem GROUP BY ALL) SELECT r AS read, a AS anchor_key, b AS adrift_key, a || ':' || b AS read_pair FROM k")
def key_join(spark, d):
    li = t(spark, d, "lineitem")
    first = lambda c, p: li.groupBy(F.col("l_orderkey").alias("readNames")).agg(F.concat(F.lit(p), F.min(c)).alias("seqID"))
    return alignments.join_keys(first("l_partkey", "A-"), first("l_suppkey", "B-"))


@query(f"{FRAG}, w AS (SELECT specimen, seqnames, strand, CASE WHEN strand = '-' THEN e ELSE s END AS pos, e - s + 1 AS width, count(*) AS n FROM frag GROUP BY ALL) SELECT specimen, seqnames, strand, pos, CAST(sum(n) AS BIGINT) AS reads, CAST(count(*) AS BIGINT) AS fragments, string_agg(width || ':' || n, ';' ORDER BY width) AS widths FROM w GROUP BY ALL")
def condense_sites(spark, d):
    return alignments.condense_sites(frag(spark, d), ["specimen"])


MULTI = f"{FRAG}, hit AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS rp, seqnames, strand, s, e, CASE WHEN strand = '-' THEN e ELSE s END AS pos FROM frag)"


@query(f"""RECURSIVE {MULTI}, {island_sql('(SELECT DISTINCT seqnames, strand, pos FROM hit)', 'seqnames, strand', gap=5, s='pos', e='pos')},
  own AS (SELECT hit.*, isl.head FROM hit JOIN isl USING (seqnames, strand, pos)), hub AS (SELECT DISTINCT rp AS x, min(rp) OVER (PARTITION BY seqnames, strand, head) AS y FROM own), {components_sql('hub')},
  wd AS (SELECT rp, CAST(round_even(median(e - s + 1), 0) AS BIGINT) AS width FROM hit GROUP BY rp)
  SELECT rp AS read_pair, r AS cluster, seqnames, strand, pos, s AS range_start, e AS range_end, width FROM own JOIN lab ON rp = x JOIN wd USING (rp)""")
def multihit_clusters(spark, d):
    return clustered(frag(spark, d))


def clustered(fragments: DataFrame) -> DataFrame:
    own = fragments.select(F.col("l_partkey").cast("string").alias("read_pair"), "seqnames", "strand", "start", "end").distinct()
    return alignments.multihit_clusters(own)["alignments"].select("read_pair", "cluster", "seqnames", "strand", "pos", F.col("start").alias("range_start"), F.col("end").alias("range_end"), "width")


@query(SQL["multihit_clusters"].removeprefix("WITH ").replace("SELECT rp AS read_pair, r AS cluster,", "SELECT DISTINCT rp AS read_pair, r AS cluster,").split(", seqnames, strand, pos, s AS range_start")[0] + " FROM own JOIN lab ON rp = x")
def multihit_runs_combined(spark, d):
    """Three runs one after another: every third part's fragments; equal to clustering all at once."""
    own = frag(spark, d).select(F.col("l_partkey").cast("string").alias("read_pair"), "seqnames", "strand", "start", "end", (F.col("l_partkey") % 3).alias("run")).distinct()
    run = lambda k: own.where(F.col("run") == k).drop("run")
    first = alignments.multihit_clusters(run(0))
    pairs, points = first["alignments"].select("read_pair", "cluster").distinct(), alignments.multihit_points(first)
    for k in (1, 2):
        more = alignments.combine_multihits(points, run(k))
        pairs = pairs.join(more["renamed"], "cluster", "left").select("read_pair", F.coalesce("combined", "cluster").alias("cluster")).union(more["pairs"])
        points = more["points"]
    return pairs


@query(f"""{FRAG}, src AS (SELECT samplename, seqnames, strand, s, e, l_orderkey AS id, CASE WHEN l_partkey % 3 = 0 THEN 'multi' ELSE 'uniq' END AS type FROM frag), {island_sql('src', 'samplename, seqnames, strand')},
  kept AS (SELECT * FROM isl WHERE type = 'uniq' OR (samplename, seqnames, strand, head) IN (SELECT (samplename, seqnames, strand, head) FROM isl WHERE type = 'uniq'))
  SELECT samplename AS sample, id, seqnames, strand, s AS range_start, e AS range_end, type, round(CASE WHEN type = 'uniq' THEN 1.0 ELSE 1.0 / count(*) OVER (PARTITION BY samplename, id, type) END, 6) AS contrib FROM kept""")
def multihit_recover(spark, d):
    own = frag(spark, d).select("sampleName", "seqnames", "strand", "start", "end", F.col("l_orderkey").alias("ID"), (F.col("l_partkey") % 3 == 0).alias("m"))
    out = alignments.recover_multihits(own.where("NOT m").drop("m"), own.where("m").drop("m"))
    return out.select(F.col("sampleName").alias("sample"), F.col("ID").alias("id"), "seqnames", "strand", F.col("start").alias("range_start"), F.col("end").alias("range_end"), "type", F.round("contrib", 6).alias("contrib"))


@query(f"{FRAG}, w AS (SELECT samplename, count(DISTINCT l_orderkey) AS reads, count(DISTINCT (seqnames, s, e, strand)) AS aligns, count(DISTINCT (seqnames, strand, CASE WHEN strand = '-' THEN e ELSE s END)) AS loci FROM frag GROUP BY ALL) SELECT samplename AS sample, 'reads' AS metric, CAST(reads AS BIGINT) AS count FROM w UNION ALL SELECT samplename, 'aligns', aligns FROM w UNION ALL SELECT samplename, 'loci', loci FROM w")
def assembly_stats(spark, d):
    return alignments.assembly_stats(frag(spark, d).withColumn("ID", F.col("l_orderkey"))).withColumnRenamed("sampleName", "sample")


@query(f"{FRAG} SELECT l_orderkey, l_linenumber, umi AS umitag FROM frag LEFT JOIN (SELECT l_partkey AS p, min(CAST(l_suppkey % 97 AS VARCHAR)) AS umi FROM lineitem WHERE l_linenumber = 2 GROUP BY ALL) u ON frag.l_partkey = u.p".replace("umi AS umitag", "u.umi AS umitag"))
def umi_attach(spark, d):
    umis = t(spark, d, "lineitem").where("l_linenumber = 2").selectExpr("l_partkey AS ID", "CAST(l_suppkey % 97 AS STRING) AS umitag")
    return alignments.attach_umis(frag(spark, d).withColumn("ID", F.col("l_partkey")), umis).select("l_orderkey", "l_linenumber", "umitag")


@query("k AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS q FROM orders INTERSECT SELECT DISTINCT CAST(c_custkey AS VARCHAR) FROM customer) SELECT q AS \"readNames\", q AS \"seqID\" FROM k")
def default_keys(spark, d):
    return shared_names(t(spark, d, "orders"), t(spark, d, "customer"))


def shared_names(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return alignments.default_keys(orders.selectExpr("CAST(o_custkey AS STRING) AS qName"), customers.selectExpr("CAST(c_custkey AS STRING) AS qName"))


@query(f"{PSL} SELECT id, ln FROM psl WHERE CAST(id AS VARCHAR) IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')")
def known_hits(spark, d):
    keys = t(spark, d, "orders").where("o_orderstatus = 'F'").selectExpr("CAST(o_orderkey AS STRING) AS anchor_key")
    return alignments.known_hits(psl(spark, d), keys, "anchor_key").select("id", "ln")


_SAMPAIR = f"""{FRAG}, al AS (SELECT l_orderkey % 300 AS id, l_linenumber % 2 AS side, seqnames, strand, CASE WHEN strand = '-' THEN e ELSE s END AS p FROM frag),
  pr AS (SELECT DISTINCT a.id, a.seqnames, a.strand, least(a.p, b.p) AS s, greatest(a.p, b.p) AS e FROM al a JOIN al b ON a.id = b.id AND a.seqnames = b.seqnames AND a.strand <> b.strand AND a.side = 1 AND b.side = 0 WHERE (CASE WHEN a.strand = '+' THEN b.p - a.p ELSE a.p - b.p END) + 1 BETWEEN 30 AND 2500)"""


def sam_pairs(fragments: DataFrame) -> DataFrame:
    own = fragments.select((F.col("l_orderkey") % 300).alias("qname"), F.when(F.col("l_linenumber") % 2 == 1, "anchor").otherwise("adrift").alias("end"), F.col("seqnames").alias("rname"), "strand", F.col("start").alias("pos"), (F.col("end") - F.col("start") + 1).alias("span"))
    return alignments.pair_sam(own)


@query(f"{_SAMPAIR} SELECT id, seqnames, strand, s AS range_start, e AS range_end FROM pr")
def sam_pair_expansion(spark, d):
    return expanded(frag(spark, d))


def expanded(fragments: DataFrame) -> DataFrame:
    return sam_pairs(fragments).select(F.col("ID").alias("id"), "seqnames", "strand", F.col("start").alias("range_start"), F.col("end").alias("range_end"))


@query(f"{_SAMPAIR} SELECT id, s AS range_start, e AS range_end, seqnames, strand, CASE WHEN count(*) OVER (PARTITION BY id) = 1 THEN 'unique' ELSE 'multihit' END AS class FROM pr")
def sam_unique_multihit(spark, d):
    return split(frag(spark, d))


def split(fragments: DataFrame) -> DataFrame:
    return alignments.split_hits(sam_pairs(fragments)).select(F.col("ID").alias("id"), F.col("start").alias("range_start"), F.col("end").alias("range_end"), "seqnames", "strand", "class")


@query(f"{HITS}, n AS (SELECT *, count(*) OVER (PARTITION BY ak, bk) AS n FROM loci) SELECT seqnames, s AS range_start, e AS range_end, e - s + 1 AS width, strand, ak || ':' || bk AS read_pair, ak AS sample FROM n WHERE n = 1")
def unique_sites(spark, d):
    keys, a, b = hits(spark, d)
    out = alignments.unique_reads(keys.withColumn("read", F.col("read_pair")), alignments.couple(keys, a, b, 30, 2500))
    return out.select("seqnames", F.col("start").alias("range_start"), F.col("end").alias("range_end"), "width", "strand", "read_pair", F.col("sampleName").alias("sample"))


# ---- targets -------------------------------------------------------------------------------------


@query(f"{READ} SELECT id AS read_id, CAST(o AS INTEGER) AS offset_at, m AS mismatch FROM (SELECT id, o, {mis_sql('seq', 'ACGTNRC', 'o')} AS m FROM (SELECT id, seq, unnest(range(1, 27)) AS o FROM reads)) WHERE m <= 1")
def iupac_match(spark, d):
    own = reads(spark, d).withColumn("m", F.explode(sq.match_offsets(F.col("seq"), "ACGTNRC", 1)))
    return own.select("read_id", F.col("m.offset").alias("offset_at"), F.col("m.mismatch").alias("mismatch"))


def _scan_sql(seq: str, k: int, source: str, extra: str) -> str:
    return " UNION ALL ".join(f"SELECT {extra}, '{n}' AS target, CAST(greatest(o, 1) AS INTEGER) AS first, CAST(least(o + {len(p) - 1}, length({seq})) AS INTEGER) AS last, m AS mismatch FROM (SELECT *, {mis_sql(seq, p, 'o')} AS m FROM (SELECT *, unnest(range({1 - k}, 32 - {len(p)} + {2 + k})) AS o FROM {source})) WHERE m <= {k}" for n, p in TARGETS.items())


@query(f"{READ} {_scan_sql('seq', 1, 'reads', 'id AS read_id')}")
def target_scan(spark, d):
    return tg.align_targets(reads(spark, d), TARGETS, 1, "seq").select("read_id", "target", "first", "last", "mismatch")


@query(f"""{READ}, guide AS (SELECT n_nationkey AS k, left(translate(md5('guide' || n_nationkey), '0123456789abcdef', 'ACGTACGTACGTACGT'), 20) AS g FROM nation),
  at_ AS (SELECT id, seq, k, g, o FROM reads, guide, unnest(range(-5, 20)) AS u(o)),
  m AS (SELECT *, {" + ".join(f"CASE WHEN o + {i} >= 1 AND substr(seq, o + {i}, 1) = substr(g, {i + 1}, 1) THEN 0 ELSE 1 END" for i in range(20))} AS n FROM at_)
  SELECT id AS read_id, 'G' || k AS target, greatest(o, 1) AS first, least(o + 19, 32) AS last, n AS mismatch FROM m WHERE n <= 6""")
def target_scan_guides(spark, d):
    """A panel of guides of 20 bases with up to six mismatches, found by seeds."""
    code = F.left(F.translate(F.md5(F.concat(F.lit("guide"), F.col("n_nationkey"))), "0123456789abcdef", "ACGTACGTACGTACGT"), F.lit(20))
    panel = {f"G{r['n_nationkey']}": r["g"] for r in t(spark, d, "nation").select("n_nationkey", code.alias("g")).collect()}  # a panel is a table of some rows
    return tg.align_targets(reads(spark, d), panel, 6, "seq").select("read_id", "target", "first", "last", "mismatch")


PROFILE = {"PAM": "NG", "PAM_Loc": "3p", "PAM_Tol": 0, "Cut_Offset": -4, "Insert_size": None}
SITE = "site AS (SELECT 'chr' || (id % 5) AS seqnames, id AS pos, CASE WHEN cust % 2 = 0 THEN '+' ELSE '-' END AS strand, seq FROM reads)"
_BOTH = f"both_ AS ({_scan_sql('w', 1, 'fw', 'seqnames, pos, strand, w, 1 AS sense')} UNION ALL {_scan_sql('w', 1, 'rv', 'seqnames, pos, strand, w, 0 AS sense')})"


@query(f"""{READ}, {SITE}, fw AS (SELECT seqnames, pos, strand, seq AS w FROM site), rv AS (SELECT seqnames, pos, strand, reverse(translate(seq, 'ACGT', 'TGCA')) AS w FROM site), {_BOTH},
  pam AS (SELECT *, last + 2 AS z FROM both_ WHERE last + 2 <= 32 AND {mis_sql('w', 'NG', '(last + 1)')} <= 0),
  cut AS (SELECT *, CASE WHEN sense = 1 THEN first ELSE 32 - z + 1 END AS p, CASE WHEN sense = 1 THEN z ELSE 32 - first + 1 END AS q FROM pam),
  along AS (SELECT *, CASE WHEN sense = 1 THEN q - 2 + 1 - 4 ELSE p + 2 - 1 + 4 END AS along FROM cut),
  ed AS (SELECT *, CASE WHEN strand = '+' THEN pos - 20 + along - 1 ELSE pos + 20 - along + 1 END AS site, CASE WHEN sense = 1 THEN strand WHEN strand = '+' THEN '-' ELSE '+' END AS facing FROM along),
  rk AS (SELECT *, rank() OVER (PARTITION BY seqnames, pos, strand ORDER BY mismatch, abs(site - pos)) AS r FROM ed),
  best AS (SELECT DISTINCT seqnames, pos, strand, target || ':(' || CASE WHEN sense = 1 THEN 'sense' ELSE 'antisense' END || ')' AS target_match, mismatch, substr(w, CAST(first AS BIGINT), CAST(z - first + 1 AS BIGINT)) AS aligned_sequence, seqnames || ':' || facing || ':' || site AS edit_site FROM rk WHERE r = 1)
  SELECT site.seqnames, site.pos, site.strand, coalesce(target_match, 'No_valid_match') AS target_match, mismatch AS target_mismatch, aligned_sequence, edit_site FROM site LEFT JOIN best ON site.seqnames = best.seqnames AND site.pos = best.pos AND site.strand = best.strand""")
def edit_site(spark, d):
    sites = reads(spark, d).select(F.concat(F.lit("chr"), F.col("read_id") % 5).alias("seqnames"), F.col("read_id").alias("pos"), F.when(F.col("cust") % 2 == 0, "+").otherwise("-").alias("strand"), F.col("seq").alias("site_seq"))
    return tg.compare_targets(sites, TARGETS, PROFILE, 20, 11, 1).select("seqnames", "pos", "strand", "target_match", "target_mismatch", "aligned_sequence", "edit_site")


@query(f"{READ}, con AS (SELECT 'chr' || (id % 5) AS seqnames, string_agg(seq, '' ORDER BY id) AS dna FROM reads GROUP BY ALL), pt AS (SELECT DISTINCT 'chr' || (id % 5) AS seqnames, id % 700 + 1 AS pos, CASE WHEN cust % 2 = 0 THEN '+' ELSE '-' END AS strand FROM reads), w AS (SELECT pt.*, CASE WHEN strand = '-' THEN pos - 8 ELSE pos - 20 END AS lo, dna FROM pt JOIN con USING (seqnames)), c AS (SELECT *, substr(dna, CAST(greatest(lo, 1) AS BIGINT), CAST(lo + 29 - greatest(lo, 1) AS BIGINT)) AS x FROM w WHERE greatest(lo, 1) <= length(dna)) SELECT seqnames, pos, strand, CASE WHEN strand = '-' THEN reverse(translate(x, 'ACGT', 'TGCA')) ELSE x END AS site_seq FROM c")
def site_sequences(spark, d):
    r = reads(spark, d)
    return flanks(r, r)


def flanks(r: DataFrame, parts: DataFrame) -> DataFrame:
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("read_id", "seq"))), lambda x: x["seq"]), "")
    con = parts.groupBy(F.concat(F.lit("chr"), F.col("read_id") % 5).alias("seqnames")).agg(seq.alias("seq"))
    pts = r.select(F.concat(F.lit("chr"), F.col("read_id") % 5).alias("seqnames"), (F.col("read_id") % 700 + 1).alias("pos"), F.when(F.col("cust") % 2 == 0, "+").otherwise("-").alias("strand"))
    return tg.site_sequences(pts, con, 20, 8, chunk=256)


@query("SELECT s_suppkey, CASE WHEN (s_suppkey % 3 = 0 AND n_name IN ('A')) OR (s_suppkey % 3 = 1 AND regexp_extract(m, '[\\w\\-\\.]+', 0) IN ('T1', 'T2')) OR s_suppkey % 3 = 2 THEN m ELSE 'No_valid_match' END AS target_match FROM (SELECT s_suppkey, 'none' AS n_name, 'T' || (s_suppkey % 4) || ':(sense)' AS m FROM supplier)")
def treated_only(spark, d):
    m = t(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 3).cast("string").alias("specimen"), F.concat(F.lit("T"), F.col("s_suppkey") % 4, F.lit(":(sense)")).alias("target_match"))
    treat = spark.createDataFrame([("0", ["none"]), ("1", ["T1", "T2"]), ("2", ["all"])], "specimen string, treatment array<string>")
    return tg.treated_only(m, treat).select("s_suppkey", "target_match")


# ---- evaluation ----------------------------------------------------------------------------------

EVREADS = f"{FRAG}, er AS (SELECT seqnames, s, e, strand, specimen, samplename, CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE umi END AS umi, CASE WHEN l_partkey % 4 = 0 THEN 0.5 ELSE 1.0 END AS contrib FROM (SELECT * REPLACE (s // 20 * 20 AS s, s // 20 * 20 + 30 AS e) FROM frag))"


def ev_reads(spark, d):
    return frag(spark, d).withColumn("start", F.floor(F.col("start") / 20) * 20).withColumn("end", F.col("start") + 30).select("seqnames", "start", "end", "strand", "specimen", "sampleName", F.when(F.col("l_partkey") % 10 != 0, F.col("umi")).alias("umitag"), F.when(F.col("l_partkey") % 4 == 0, 0.5).otherwise(1.0).alias("contrib"))


_FRAGS = "fr AS (SELECT seqnames, s, e, strand, specimen, samplename, sum(c) AS count, coalesce(sum(m) FILTER (umi IS NOT NULL), 0.0) AS umitag, max(m) AS contrib FROM (SELECT seqnames, s, e, strand, specimen, samplename, umi, CAST(sum(contrib) AS DOUBLE) AS c, CAST(max(contrib) AS DOUBLE) AS m FROM er GROUP BY ALL) GROUP BY seqnames, s, e, strand, specimen, samplename)"


def _abundance(mode):
    column = {"umi": "umitag", "read": "count", "fragment": "contrib"}[mode]

    def f(spark, d):
        out = ev.with_abundance(ev.fragments(ev_reads(spark, d)), mode)
        return out.select("seqnames", F.col("start").alias("range_start"), "strand", F.col("sampleName").alias("sample"), "abund")

    f.__name__ = f"fragment_abundance_{mode}"
    query(f"{EVREADS}, {_FRAGS} SELECT seqnames, s AS range_start, strand, samplename AS sample, {column} AS abund FROM fr")(f)


for _mode in ("fragment", "umi", "read"):
    _abundance(_mode)

SPEC = "spec AS (SELECT 'n' || n_nationkey AS specimen, n_nationkey AS ord, CASE n_nationkey % 4 WHEN 0 THEN 'Cas9' WHEN 1 THEN 'Cpf1' ELSE CASE WHEN n_nationkey % 8 = 2 THEN 'none' ELSE 'Cas9' END END AS nuc, CASE n_regionkey WHEN 0 THEN 'control' WHEN 1 THEN 'T1' WHEN 2 THEN 'T2' ELSE 'T1;T3' END AS trt FROM nation), norm AS (SELECT specimen, ord, CASE WHEN lower(nuc) IN ('mock', 'none', 'control') THEN 'Mock' ELSE nuc END AS nuc, CASE WHEN lower(trt) IN ('mock', 'none', 'control') THEN 'Mock' ELSE trt END AS trt FROM spec), com AS (SELECT chr(CAST(64 + row_number() OVER (ORDER BY o) AS INTEGER)) AS combo, nuc, trt FROM (SELECT nuc, trt, min(ord) AS o FROM norm WHERE nuc <> 'Mock' AND trt <> 'Mock' GROUP BY ALL))"


def specimens(spark, d):
    s = t(spark, d, "nation").selectExpr("concat('n', n_nationkey) AS specimen", "n_nationkey AS ord", "CASE n_nationkey % 4 WHEN 0 THEN 'Cas9' WHEN 1 THEN 'Cpf1' ELSE CASE WHEN n_nationkey % 8 = 2 THEN 'none' ELSE 'Cas9' END END AS nuclease", "CASE n_regionkey WHEN 0 THEN 'control' WHEN 1 THEN 'T1' WHEN 2 THEN 'T2' ELSE 'T1;T3' END AS treatment")
    return s.withColumn("nuclease", ev.normalise_mock(F.col("nuclease"))).withColumn("treatment", ev.normalise_mock(F.col("treatment")))


@query(f"{SPEC} SELECT specimen, nuc AS nuclease, trt AS treatment FROM norm")
def mock_normalise(spark, d):
    return specimens(spark, d).select("specimen", "nuclease", "treatment")


@query(f"{SPEC} SELECT combo, nuc AS nuclease, trt AS treatment FROM com")
def combos(spark, d):
    return ev.combinations(specimens(spark, d))


@query(f"{SPEC} SELECT specimen, combo, specimen || '(' || combo || ')' AS alt_specimen FROM norm JOIN com ON (norm.nuc = com.nuc OR norm.nuc = 'Mock') AND (norm.trt = com.trt OR norm.trt = 'Mock')")
def mock_fanout(spark, d):
    s = specimens(spark, d)
    return ev.fan_out(s, ev.combinations(s))


@query(f"{SPEC} SELECT specimen, nuc || ' - ' || trt AS annotation, min(ord) OVER (PARTITION BY nuc || ' - ' || trt) AS annot_ord FROM norm")
def condition_annotation(spark, d):
    return ev.annotate_conditions(specimens(spark, d), ["nuclease", "treatment"]).select("specimen", "annotation", "annot_ord")


@query(f"{SPEC}, each_ AS (SELECT DISTINCT 'r1' AS run_set, nuc, unnest(string_split(trt, ';')) AS target FROM norm) SELECT run_set, nuc AS nuclease, target, CASE target WHEN 'T1' THEN 'ACGT' WHEN 'T2' THEN 'GGCC' END AS sequence, CASE nuc WHEN 'Cas9' THEN 'NGG' END AS \"PAM\" FROM each_")
def target_pam_table(spark, d):
    seqs = spark.createDataFrame([("r1", "T1", "ACGT"), ("r1", "T2", "GGCC")], "run_set string, target string, sequence string")
    pams = spark.createDataFrame([("r1", "Cas9", "NGG")], "run_set string, nuclease string, PAM string")
    return ev.target_table(specimens(spark, d).withColumn("run_set", F.lit("r1")), seqs, pams).select("run_set", "nuclease", "target", "sequence", "PAM")


ALG = f"""{CLUSTER}, alg AS (SELECT specimen AS alt_specimen, samplename, seqnames, strand, s, e, clus_ori, l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN 'pair' || (l_partkey % 50) END AS paired_algn, CASE l_partkey % 4 WHEN 0 THEN 'T1:(sense)' WHEN 1 THEN 'T2:(antisense)' ELSE 'No_valid_match' END AS target_match,
  l_partkey % 7 AS mm, 'ACGT' || (l_partkey % 3) AS aligned_sequence, seqnames || ':' || strand || ':' || (l_partkey % 40) AS edit_site, CAST(1 + l_linenumber % 3 AS BIGINT) AS abund, CAST(2 + l_linenumber % 5 AS BIGINT) AS count, CAST(l_partkey % 3 AS BIGINT) AS umitag, CAST(CASE WHEN l_partkey % 4 = 0 THEN 0.5 ELSE 1 END AS DOUBLE) AS contrib FROM clus),
  piles AS (SELECT DISTINCT clus_ori FROM (SELECT alt_specimen, clus_ori FROM alg GROUP BY ALL HAVING count(*) >= 3)),
  onp AS (SELECT 'chr1:+:' || unnest(range(5, 9)) AS p UNION ALL SELECT unnest(['chr2:+:7', 'chr2:-:7'])),
  cri AS (SELECT alg.*, clus_ori IN (SELECT clus_ori FROM piles) AS is_pileup, paired_algn IS NOT NULL AS is_paired, target_match <> 'No_valid_match' AS is_matched, CASE WHEN edit_site IN (SELECT p FROM onp) THEN 'On-target' ELSE 'Off-target' END AS on_off FROM alg)"""


def algnmts(spark, d):
    own = intervals.pileup_clusters(frag(spark, d), ["specimen"])
    return own.select(F.col("specimen").alias("alt_specimen"), "specimen", "sampleName", "seqnames", "strand", "start", "end", "clus_ori", "l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 5 == 0, F.concat(F.lit("pair"), F.col("l_partkey") % 50)).alias("paired_algn"), F.when(F.col("l_partkey") % 4 == 0, "T1:(sense)").when(F.col("l_partkey") % 4 == 1, "T2:(antisense)").otherwise("No_valid_match").alias("target_match"), (F.col("l_partkey") % 7).alias("target_mismatch"), F.concat(F.lit("ACGT"), F.col("l_partkey") % 3).alias("aligned_sequence"), F.concat_ws(":", "seqnames", "strand", F.col("l_partkey") % 40).alias("edit_site"), (1 + F.col("l_linenumber") % 3).cast("long").alias("abund"), (2 + F.col("l_linenumber") % 5).cast("long").alias("count"), (F.col("l_partkey") % 3).alias("umitag"), F.when(F.col("l_partkey") % 4 == 0, 0.5).otherwise(1.0).alias("contrib"))


def flagged(spark, d):
    on = st.expand_positions(spark.createDataFrame([("chr1:+:5-8",), ("chr2:*:7",)], "p string"), "p")
    return ev.on_target_flag(ev.criteria(algnmts(spark, d)), on)


@query(f"{ALG} SELECT l_orderkey, l_linenumber, is_pileup, is_paired, is_matched, is_pileup OR is_paired OR is_matched AS probable FROM cri")
def criteria_union(spark, d):
    return ev.criteria(algnmts(spark, d)).select("l_orderkey", "l_linenumber", "is_pileup", "is_paired", "is_matched", "probable")


@query(f"{ALG} SELECT l_orderkey, l_linenumber, on_off AS on_off_target FROM cri")
def on_off_target(spark, d):
    return flagged(spark, d).select("l_orderkey", "l_linenumber", "on_off_target")


@query(f"{ALG} SELECT alt_specimen, clus_ori, string_agg(DISTINCT on_off, ';' ORDER BY on_off) AS on_off_target, coalesce(string_agg(DISTINCT paired_algn, ';' ORDER BY paired_algn), '') AS paired_algn, CAST(sum(count) AS BIGINT) AS count, CAST(sum(umitag) AS BIGINT) AS umitag, sum(contrib) AS algns, CAST(sum(abund) AS BIGINT) AS abund FROM cri WHERE is_pileup GROUP BY ALL")
def pileup_summary(spark, d):
    return ev.pileup_summary(flagged(spark, d).where("is_pileup"))


@query(f"{ALG} SELECT alt_specimen, edit_site, aligned_sequence, regexp_replace(target_match, ':\\((sense|antisense)\\)$', '') AS target_match, mm AS target_mismatch, string_agg(DISTINCT on_off, ';' ORDER BY on_off) AS on_off_target, coalesce(string_agg(DISTINCT paired_algn, ';' ORDER BY paired_algn), '') AS paired_algn, CAST(sum(count) AS BIGINT) AS count, CAST(sum(umitag) AS BIGINT) AS umitag, sum(contrib) AS algns, CAST(sum(abund) AS BIGINT) AS abund, string_agg(DISTINCT strand, ';' ORDER BY strand) AS orient FROM cri WHERE is_matched GROUP BY ALL")
def matched_summary(spark, d):
    return ev.matched_summary(flagged(spark, d).where("is_matched"))


@query(f"""{ALG}, side AS (SELECT alt_specimen, paired_algn, seqnames, strand, CASE WHEN strand = '+' THEN min(s) ELSE max(e) END AS p FROM cri WHERE is_paired GROUP BY alt_specimen, paired_algn, seqnames, strand), reg AS (SELECT alt_specimen, paired_algn, seqnames, min(p) AS a, max(p) AS z FROM side GROUP BY ALL),
  ont(x, c, p) AS (VALUES ('A', 'chr1', 3000), ('N', 'chr2', 50000), ('R', 'chr3', 20000))
  SELECT alt_specimen, paired_algn, seqnames, CASE WHEN EXISTS (SELECT 1 FROM ont WHERE x = alt_specimen AND c = seqnames AND a <= p + 30 AND z >= p - 30) THEN 'On-target' ELSE 'Off-target' END AS on_off_target FROM reg""")
def paired_on_target(spark, d):
    on = spark.createDataFrame([("A", "chr1", 3000), ("N", "chr2", 50000), ("R", "chr3", 20000)], "alt_specimen string, seqnames string, pos long")
    return ev.paired_on_target(ev.paired_regions(algnmts(spark, d).where("paired_algn IS NOT NULL")), on).select("alt_specimen", "paired_algn", "seqnames", "on_off_target")


@query(f"{ALG}, pr AS (SELECT * FROM cri WHERE is_pileup OR is_paired OR is_matched) SELECT alt_specimen, round(100.0 * sum(CASE WHEN on_off = 'On-target' THEN abund ELSE 0 END) / sum(abund), 6) AS pct FROM pr GROUP BY ALL")
def ontarget_pct(spark, d):
    return ev.on_target_percent(flagged(spark, d).where("probable"), ["alt_specimen"]).withColumn("pct", F.round("pct", 6))


@query(f"{ALG}, site AS (SELECT DISTINCT alt_specimen, edit_site, aligned_sequence, regexp_replace(target_match, ':.*', '') AS t, mm, on_off FROM cri WHERE is_matched), n AS (SELECT alt_specimen, count(*) AS n FROM site WHERE on_off = 'Off-target' GROUP BY ALL) SELECT alt_specimen, CAST(count(DISTINCT clus_ori) AS BIGINT) AS n_pile, n AS n_match FROM cri LEFT JOIN n USING (alt_specimen) WHERE is_pileup AND on_off = 'Off-target' GROUP BY ALL")
def offtarget_counts(spark, d):
    f = flagged(spark, d)
    matched = ev.matched_summary(f.where("is_matched"))
    return ev.off_target_counts(f.where("is_pileup"), ["alt_specimen"], "n_pile").join(ev.off_target_rows(matched, ["alt_specimen"], "n_match"), "alt_specimen", "left")


_EFF = f"""{ALG}, eff AS (SELECT alt_specimen, regexp_replace(target_match, ':.*', '') AS t, 100.0 * CAST(sum(CASE WHEN on_off = 'On-target' THEN abund ELSE 0 END) AS DOUBLE) / sum(abund) AS p FROM cri WHERE is_matched GROUP BY ALL),
  wide AS (SELECT alt_specimen, max(p) FILTER (t = 'T1') AS a, max(p) FILTER (t = 'T2') AS b FROM eff GROUP BY ALL)"""


@query(f'{_EFF} SELECT alt_specimen, round(a, 6) AS "T1", round(b, 6) AS "T2", CAST(NULL AS DOUBLE) AS "T9" FROM wide')
def efficiency_pivot(spark, d):
    """On-target share of each target's own abundance; T9 has none."""
    out = ev.efficiency_pivot(ev.matched_summary(flagged(spark, d).where("is_matched")), ["T1", "T2", "T9"])
    return out.select("alt_specimen", *(F.round(t, 6).alias(t) for t in ("T1", "T2", "T9")))


@query(f"{ALG}, w AS (SELECT samplename, sum(abund) AS a, sum(CASE WHEN is_pileup THEN abund ELSE 0 END) AS b, sum(CASE WHEN is_paired THEN abund ELSE 0 END) AS c, sum(CASE WHEN is_matched THEN abund ELSE 0 END) AS m, sum(CASE WHEN is_pileup OR is_paired OR is_matched THEN abund ELSE 0 END) AS p FROM cri GROUP BY ALL) SELECT samplename AS sample, unnest(['all', 'is_pileup', 'is_paired', 'is_matched', 'probable']) AS metric, CAST(unnest([a, b, c, m, p]) AS BIGINT) AS count FROM w")
def eval_stats(spark, d):
    return ev.criteria_stats(flagged(spark, d)).withColumnRenamed("sampleName", "sample")


@query(f"{FRAG}, st AS (SELECT samplename, 'm' || (l_partkey % 3) AS metric, count(*) AS n FROM frag GROUP BY ALL), g AS (SELECT DISTINCT samplename, unnest(['m0', 'm1', 'm2', 'm3']) AS metric FROM frag) SELECT g.samplename AS sample, g.metric, CAST(coalesce(n, 0) AS BIGINT) AS count FROM g LEFT JOIN st USING (samplename, metric)")
def eval_stats_complete(spark, d):
    f = frag(spark, d)
    return completed(f, f)


def completed(f: DataFrame, counted: DataFrame) -> DataFrame:
    stats = counted.groupBy("sampleName", F.concat(F.lit("m"), F.col("l_partkey") % 3).alias("metric")).agg(F.count("*").alias("count"))
    return ev.complete_stats(stats, f, ["m0", "m1", "m2", "m3"]).withColumnRenamed("sampleName", "sample")


@query(f"{FRAG}, st AS (SELECT samplename, 'm' || (l_partkey % 3) AS metric, count(*) AS n FROM frag GROUP BY ALL) SELECT samplename AS sample, CAST(coalesce(sum(n) FILTER (metric = 'm0'), 0) AS BIGINT) AS m0, CAST(coalesce(sum(n) FILTER (metric = 'm1'), 0) AS BIGINT) AS m1, CAST(coalesce(sum(n) FILTER (metric = 'm2'), 0) AS BIGINT) AS m2 FROM st GROUP BY ALL")
def stat_matrix(spark, d):
    stats = frag(spark, d).groupBy("sampleName", F.concat(F.lit("m"), F.col("l_partkey") % 3).alias("metric"), (F.col("l_orderkey") % 5).alias("bin")).agg(F.count("*").alias("count"))
    return ev.stat_matrix(stats, ["m0", "m1", "m2"]).withColumnRenamed("sampleName", "sample")


@query("SELECT regexp_extract(samplename, '^\\w+', 0) AS specimen, CAST(count(*) AS BIGINT) AS replicates, min(r_name) AS condition FROM (SELECT DISTINCT l_returnflag || '-' || l_linenumber AS samplename FROM lineitem) LEFT JOIN region ON substr(r_name, 1, 1) = regexp_extract(samplename, '^\\w+', 0) AND r_name <> 'AMERICA' AND r_name <> 'ASIA' GROUP BY ALL")
def sample_list(spark, d):
    support = t(spark, d, "region").where("r_name NOT IN ('AMERICA', 'ASIA')").select(F.substring("r_name", 1, 1).alias("specimen"), F.col("r_name").alias("condition"))
    return ev.sample_list(frag(spark, d).select("sampleName").distinct(), support=support)


@query(f"{ALG}, first AS (SELECT specimen, min(alt) AS alt FROM (SELECT alt_specimen AS specimen, alt_specimen || CASE WHEN l_orderkey % 2 = 0 THEN '(A)' ELSE '(B)' END AS alt FROM alg) GROUP BY ALL) SELECT alt_specimen AS specimen, CAST(sum(count) AS BIGINT) AS reads, CAST(sum(umitag) AS BIGINT) AS umitags, sum(contrib) AS algns FROM alg JOIN first ON specimen = alt_specimen AND alt = alt_specimen || CASE WHEN l_orderkey % 2 = 0 THEN '(A)' ELSE '(B)' END GROUP BY ALL")
def specimen_totals(spark, d):
    own = algnmts(spark, d).withColumn("alt_specimen", F.concat("specimen", F.when(F.col("l_orderkey") % 2 == 0, "(A)").otherwise("(B)")))
    return ev.specimen_totals(own).select("specimen", "reads", "umitags", "algns")


DIST = f"{FRAG}, ds AS (SELECT specimen AS annotation, 'T' || (l_partkey % 3) AS target, strand, CASE WHEN strand = '+' THEN s - (s + l_partkey % 61 - 30) ELSE e - (e + l_partkey % 61 - 30) END AS dist, seqnames AS edit_site, CAST(1 + l_linenumber % 3 AS BIGINT) AS abund FROM frag)"


def distances(spark, d):
    """Alignments with cuts -30 to 30 from their own 5' points."""
    cut = F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end")) + F.col("l_partkey") % 61 - 30
    return frag(spark, d).select(F.col("specimen").alias("annotation"), F.concat(F.lit("T"), F.col("l_partkey") % 3).alias("target"), "strand", ev.edit_distance(F.col("start"), F.col("end"), cut, F.col("strand")).alias("dist"), F.col("seqnames").alias("edit_site"), (1 + F.col("l_linenumber") % 3).cast("long").alias("abund"))


@query(f"{DIST} SELECT annotation, target, strand, dist, CAST(sum(abund) AS BIGINT) AS count, round(log10(sum(abund)) * CASE WHEN strand = '-' THEN -1 ELSE 1 END, 6) AS log_count FROM ds GROUP BY annotation, target, strand, dist")
def distance_hist(spark, d):
    return ev.distance_histogram(distances(spark, d), ["annotation", "target"]).withColumn("log_count", F.round("log_count", 6))


KDE = f"{DIST}, cnt AS (SELECT annotation, abs(dist) AS v, count(*) AS n FROM ds GROUP BY ALL), tot AS (SELECT annotation, sum(n) AS total FROM cnt GROUP BY ALL HAVING sum(n) >= 10), grid AS (SELECT CAST(unnest(range(0, 512)) AS INTEGER) AS idx), kde AS (SELECT annotation, idx, idx * 100.0 / 511 AS x, sum(n * exp(-power(idx * CAST(100 AS DOUBLE) / 511 - v, 2) / 2)) / total / sqrt(2 * pi()) AS y FROM cnt JOIN tot USING (annotation), grid GROUP BY annotation, idx, total)"


@query(f"{KDE} SELECT annotation, idx, round(y, 6) AS y FROM kde")
def kde_grid(spark, d):
    return ev.density_grid(distances(spark, d), ["annotation"]).select("annotation", "idx", F.round("y", 6).alias("y"))


_TAILS = f"{KDE}, mass AS (SELECT annotation, idx, CAST(round_even(idx * CAST(100 AS DOUBLE) / 511, 0) AS BIGINT) AS z, sum(y) OVER (PARTITION BY annotation ORDER BY idx ROWS UNBOUNDED PRECEDING) * (CAST(100 AS DOUBLE) / 511) AS m FROM kde), tab AS (SELECT annotation, z, arg_min(m, idx) AS m FROM mass GROUP BY ALL)"


@query(f"{_TAILS}, zs AS (SELECT DISTINCT annotation, dist AS z FROM ds) SELECT zs.annotation, zs.z, round(1 - m, 6) AS es_prob FROM zs LEFT JOIN tab ON zs.annotation = tab.annotation AND zs.z = tab.z")
def es_probability(spark, d):
    own = distances(spark, d)
    zs = own.select("annotation", F.col("dist").alias("z")).distinct()
    return ev.tail_probability(zs, ev.density_grid(own, ["annotation"]), ["annotation"]).select("annotation", "z", F.round("es_prob", 6).alias("es_prob"))


@query(f"{_TAILS} SELECT ds.annotation, edit_site, round(100 * greatest(0.0, max(coalesce(1 - m, 0.0))), 5) AS \"MESL\" FROM ds LEFT JOIN tab ON ds.annotation = tab.annotation AND abs(dist) = tab.z GROUP BY ALL")
def max_edit_likelihood(spark, d):
    own = distances(spark, d)
    return ev.max_likelihood(own, ev.density_grid(own, ["annotation"]), ["annotation"], ["edit_site"]).withColumn("MESL", F.round("MESL", 5))


@query(f"{DIST} SELECT annotation, target, round(100.0 * sum(CASE WHEN abs(dist) <= 20 THEN abund ELSE 0 END) / sum(abund), 6) AS pct_incl FROM ds GROUP BY ALL")
def inclusion(spark, d):
    return ev.inclusion(distances(spark, d), ["annotation", "target"], 20).withColumn("pct_incl", F.round("pct_incl", 6))


@query(f"{DIST}, w AS (SELECT annotation, dist, sum(abund) AS w FROM ds GROUP BY ALL), c AS (SELECT annotation, dist, sum(w) OVER (PARTITION BY annotation ORDER BY dist ROWS UNBOUNDED PRECEDING) / sum(w) OVER (PARTITION BY annotation) AS c FROM w) SELECT annotation, min(dist) FILTER (c >= 0.25) AS q25, min(dist) FILTER (c >= 0.5) AS q50, min(dist) FILTER (c >= 0.95) AS q95 FROM c GROUP BY ALL")
def weighted_quantiles(spark, d):
    return ev.weighted_quantiles(distances(spark, d), ["annotation"], "dist", "abund", [0.25, 0.5, 0.95])


@query(f"{ALG}, g AS (SELECT alt_specimen, clus_ori, sum(abund) AS abund FROM cri WHERE is_pileup GROUP BY ALL) SELECT alt_specimen, clus_ori, CAST(abund AS BIGINT) AS abund, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY alt_specimen ORDER BY abund DESC, clus_ori) AS INTEGER) AS rank FROM g) WHERE rank <= 10")
def top_offtargets(spark, d):
    own = ev.pileup_summary(flagged(spark, d).where("is_pileup"))
    return ev.top_per_condition(own, ["alt_specimen"], [F.desc("abund"), "clus_ori"]).select("alt_specimen", "clus_ori", "abund", "rank")


@query(f"{ALG} SELECT alt_specimen AS annotation, regexp_replace(target_match, ':.*', '') AS target_seq, edit_site, aligned_sequence, mm AS mismatch, substr(on_off, 1, CAST(strpos(on_off, '-') - 1 AS BIGINT)) AS target, 'g' AS gene_id, CAST(sum(abund) AS BIGINT) AS abund, length(edit_site) * CAST(1.5 AS DOUBLE) AS \"MESL\" FROM cri WHERE is_matched GROUP BY ALL")
def offtarget_sequences(spark, d):
    own = ev.matched_summary(flagged(spark, d).where("is_matched")).withColumn("annotation", F.col("alt_specimen")).withColumn("gene_id", F.lit("g"))
    mesl = own.select("annotation", "edit_site", "gene_id").distinct().withColumn("MESL", F.length("edit_site") * F.lit(1.5))
    return ev.off_target_sequences(own, mesl)


@query("own AS (SELECT DISTINCT p_size % 6 AS grp, p_brand AS symbol FROM part), o AS (SELECT DISTINCT p_brand AS symbol FROM part WHERE p_type LIKE 'S%' AND p_size < 10), s AS (SELECT DISTINCT p_brand AS symbol FROM part WHERE p_partkey % 50 = 0) SELECT grp, CAST(count(*) AS BIGINT) AS total, CAST(count(o.symbol) AS BIGINT) AS onco, CAST(count(s.symbol) AS BIGINT) AS special FROM own LEFT JOIN o USING (symbol) LEFT JOIN s USING (symbol) GROUP BY grp")
def enrichment_counts(spark, d):
    p = t(spark, d, "part")
    return ev.enrichment_counts(p.select((F.col("p_size") % 6).alias("grp"), F.col("p_brand").alias("symbol")), p.where("p_type LIKE 'S%' AND p_size < 10").select(F.col("p_brand").alias("symbol")), p.where("p_partkey % 50 = 0").select(F.col("p_brand").alias("symbol")), ["grp"])


@query("""own AS (SELECT DISTINCT p_size % 6 AS grp, p_brand AS symbol FROM part), o AS (SELECT DISTINCT p_brand AS symbol FROM part WHERE p_type LIKE 'S%' AND p_size < 10),
  n AS (SELECT grp, count(*) AS total, count(o.symbol) AS onco FROM own LEFT JOIN o USING (symbol) GROUP BY grp), base AS (SELECT onco AS c, total - onco AS d FROM n ORDER BY grp LIMIT 1),
  tab AS (SELECT grp, total, onco, total AS r, onco + c AS k, total + c + d AS t, onco AS a FROM n, base), x AS (SELECT *, unnest(range(greatest(0, r + k - t), least(r, k) + 1)) AS i FROM tab),
  lp AS (SELECT *, lgamma(k + 1) - lgamma(i + 1) - lgamma(k - i + 1) + lgamma(t - k + 1) - lgamma(r - i + 1) - lgamma(t - k - r + i + 1) - lgamma(t + 1) + lgamma(r + 1) + lgamma(t - r + 1) AS l FROM x),
  p AS (SELECT grp, total, onco, least(1.0, sum(exp(l)) FILTER (l <= mine + 1e-7)) AS p FROM (SELECT *, max(CASE WHEN i = a THEN l END) OVER (PARTITION BY grp) AS mine FROM lp) GROUP BY ALL),
  rk AS (SELECT *, row_number() OVER (ORDER BY p, grp) AS rank, count(*) OVER () AS m FROM p)
  SELECT CAST(grp AS INTEGER) AS grp, CAST(total AS BIGINT) AS total, CAST(onco AS BIGINT) AS onco, round(CAST(p AS DOUBLE), 9) AS onco_p, round(CAST(least(1.0, min(p * m / rank) OVER (ORDER BY rank DESC)) AS DOUBLE), 9) AS onco_adj_p FROM rk""")
def enrichment_tests(spark, d):
    rows = [r.asDict() for r in enrichment_counts(spark, d).orderBy("grp").collect()]
    return spark.createDataFrame([(r["grp"], r["total"], r["onco"], round(r["onco_p"], 9), round(r["onco_adj_p"], 9)) for r in ev.enrichment_tests(rows)], "grp int, total long, onco long, onco_p double, onco_adj_p double")


@query("a AS (SELECT l_returnflag AS specimen, count(*) AS reads FROM lineitem GROUP BY ALL), b AS (SELECT l_returnflag AS specimen, CAST(sum(l_linenumber) AS BIGINT) AS sites FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL), c AS (SELECT l_linestatus AS specimen, count(*) AS chimeras FROM lineitem GROUP BY ALL) SELECT specimen, CAST(coalesce(reads, 0) AS BIGINT) AS reads, coalesce(sites, 0) AS sites, CAST(coalesce(chimeras, 0) AS BIGINT) AS chimeras FROM a FULL JOIN b USING (specimen) FULL JOIN c USING (specimen)")
def run_stat_table(spark, d):
    li = t(spark, d, "lineitem")
    a = li.groupBy(F.col("l_returnflag").alias("specimen")).agg(F.count("*").alias("reads"))
    b = li.where("l_returnflag <> 'N'").groupBy(F.col("l_returnflag").alias("specimen")).agg(F.sum("l_linenumber").alias("sites"))
    c = li.groupBy(F.col("l_linestatus").alias("specimen")).agg(F.count("*").alias("chimeras"))
    return ev.joined_summaries(a, b, c, how="full").fillna(0)


METRICS = ["demulti.reads", "R1.trim.reads", "R2.primer.trim.reads", "R2.trim.reads", "umitags.reads", "filt.reads", "R1.consol.reads", "R2.consol.reads", "align.chimera.reads", "align.multihit.reads", "align.multihit.lengths", "align.multihit.clusters", "align.unique.reads"]
_RUN = f"""{ALG}, core AS (SELECT CASE WHEN l_suppkey % 40 = 0 THEN 'unassigned' ELSE samplename END AS x, [{", ".join(f"'{m}'" for m in METRICS)}][CAST(l_partkey % 13 AS BIGINT) + 1] AS metric, count(*) AS n FROM (SELECT *, l_returnflag || '-' || l_linenumber AS samplename FROM lineitem) GROUP BY ALL),
  names AS (SELECT DISTINCT x FROM core),
  uniq AS (SELECT samplename AS x, count(DISTINCT l_orderkey) AS reads, count(DISTINCT (seqnames, s, e, strand)) AS algns, count(DISTINCT (seqnames, strand, CASE WHEN strand = '+' THEN s ELSE e END)) AS loci FROM frag WHERE l_partkey % 6 > 0 GROUP BY ALL)"""
_OF = lambda m: f"CAST(coalesce((SELECT sum(n) FROM core WHERE core.x = names.x AND metric = '{m}'), 0) AS BIGINT)"
_UNIQ = lambda c: f"CAST(coalesce((SELECT {c} FROM uniq WHERE uniq.x = names.x), 0) AS BIGINT)"


def run_table(spark, d, name):
    metric = F.element_at(F.array(*map(F.lit, METRICS)), (F.col("l_partkey") % 13 + 1).cast("int"))
    sample = F.concat_ws("-", "l_returnflag", "l_linenumber")
    core = t(spark, d, "lineitem").groupBy(F.when(F.col("l_suppkey") % 40 == 0, "unassigned").otherwise(sample).alias("sampleName"), metric.alias("metric")).agg(F.count("*").alias("count"))
    own = frag(spark, d).select("sampleName", F.col("l_orderkey").alias("ID"), "seqnames", "start", "end", "strand", F.when(F.col("l_partkey") % 6 > 0, "uniq").otherwise("multi").alias("type"))
    return run_stats.run_stats(core, lambda: run_stats.incorporation_stats(flagged(spark, d)), own, names=frag(spark, d).select("sampleName").distinct(), tables=[name])[name]


@query(f"""{_RUN} SELECT x AS sample, {_OF('demulti.reads')} AS demulti, {_OF('R1.trim.reads')} AS "R1_trim", {_OF('R2.primer.trim.reads')} AS "R2_primer_trim", {_OF('R2.trim.reads')} AS "R2_trim", {_OF('umitags.reads')} AS umitags, {_OF('filt.reads')} AS filt,
  {_OF('R1.consol.reads')} AS "R1_consol", {_OF('R2.consol.reads')} AS "R2_consol", {_UNIQ('reads')} AS align_unique, {_OF('align.chimera.reads')} AS align_chimera, {_OF('align.multihit.reads')} AS align_multihit FROM names""")
def run_attrition(spark, d):
    return run_table(spark, d, "attrition").withColumnRenamed("sampleName", "sample")


@query(f"""{_RUN} SELECT x AS sample, {_UNIQ('reads')} AS unique_reads, {_UNIQ('algns')} AS unique_algns, {_UNIQ('loci')} AS unique_loci, {_OF('align.multihit.reads')} AS multihit_reads, {_OF('align.multihit.lengths')} AS multihit_lengths,
  {_OF('align.multihit.clusters')} AS multihit_clusters, {_OF('align.chimera.reads')} AS chimera_reads FROM names WHERE x <> 'unassigned'""")
def run_outcomes(spark, d):
    return run_table(spark, d, "outcomes").withColumnRenamed("sampleName", "sample")


@query(f"""{_RUN}, one AS (SELECT samplename, seqnames, s, e, strand, abund, bool_or(is_pileup) AS a, bool_or(is_paired) AS b, bool_or(is_pileup OR is_paired OR is_matched) AS p FROM cri GROUP BY ALL),
  ab AS (SELECT samplename AS x, sum(abund) AS total, coalesce(sum(abund) FILTER (p), 0) AS combined, coalesce(sum(abund) FILTER (a), 0) AS pileup, coalesce(sum(abund) FILTER (b), 0) AS paired FROM one GROUP BY ALL),
  hit AS (SELECT DISTINCT samplename, seqnames, s, e, strand, abund, edit_site, target_match, on_off FROM cri WHERE is_matched),
  mt AS (SELECT samplename AS x, sum(abund) AS matched, coalesce(sum(abund) FILTER (on_off = 'On-target'), 0) AS ontarget, coalesce(sum(abund) FILTER (on_off = 'Off-target'), 0) AS offtarget FROM hit GROUP BY ALL)
  SELECT x AS sample, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("total", "combined", "pileup", "paired", "matched", "ontarget", "offtarget"))} FROM names LEFT JOIN ab USING (x) LEFT JOIN mt USING (x) WHERE x <> 'unassigned'""")
def run_incorporation(spark, d):
    return run_table(spark, d, "incorporation").withColumnRenamed("sampleName", "sample")


@query("SELECT l_orderkey, l_linenumber, 'r' || (l_orderkey % 2) AS run_set FROM lineitem")
def run_union(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return ev.run_union({"r0": li.where("l_orderkey % 2 = 0"), "r1": li.where("l_orderkey % 2 = 1")}, {"r0": "1", "r1": "1"})


@query("w AS (SELECT l_returnflag AS specimen, l_linenumber, avg(l_discount) * 1000 AS p FROM lineitem GROUP BY ALL), m AS (SELECT specimen, min(p) AS lo, max(p) AS hi FROM w GROUP BY ALL) SELECT specimen, CASE WHEN round_even(lo, 1) = round_even(hi, 1) THEN printf('%.1f%%', hi) ELSE printf('%.1f - %.1f%%', lo, hi) END AS efficiency FROM m")
def efficiency_range(spark, d):
    w = t(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("specimen"), "l_linenumber").agg((F.avg("l_discount") * 1000).alias("p"))
    m = w.groupBy("specimen").agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
    return m.select("specimen", ev.efficiency_range(F.col("lo"), F.col("hi")).alias("efficiency"))


# ---- strings -------------------------------------------------------------------------------------


@query("src AS (SELECT c_custkey, 'chr' || (c_custkey % 5) AS c, CASE c_custkey % 3 WHEN 0 THEN '*' WHEN 1 THEN '+' ELSE '-' END AS st, c_custkey AS a, CASE WHEN c_custkey % 2 = 0 THEN c_custkey + 3 ELSE c_custkey END AS b FROM customer), e AS (SELECT *, unnest(CASE WHEN st = '*' THEN ['+', '-'] ELSE [st] END) AS sd FROM src) SELECT c_custkey, c || ':' || sd || ':' || unnest(range(a, b + 1)) AS position FROM e")
def expand_pos(spark, d):
    own = t(spark, d, "customer").selectExpr("c_custkey", "concat('chr', c_custkey % 5, ':', CASE c_custkey % 3 WHEN 0 THEN '*' WHEN 1 THEN '+' ELSE '-' END, ':', c_custkey, if(c_custkey % 2 = 0, concat('-', c_custkey + 3), '')) AS p")
    return st.expand_positions(own, "p").select("c_custkey", "position")


@query("SELECT c_custkey, c_mktsegment || '-' || CASE WHEN c_custkey % 4 = 0 THEN 'NA' ELSE CAST(c_nationkey AS VARCHAR) END || '-' || c_custkey AS joined FROM customer")
def vcollapse(spark, d):
    own = t(spark, d, "customer").withColumn("n", F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey")))
    return own.select("c_custkey", st.collapse(["c_mktsegment", "n", "c_custkey"], "-").alias("joined"))


_REF = "ACGTACGTAC"


@query(f"{READ}, p AS (SELECT id, rpad(substr(seq, 1, 6 + CAST(id % 5 AS INTEGER)), 10, 'N') AS x FROM reads) SELECT id AS read_id, " + " || ".join(f"CASE WHEN substr(x, {i + 1}, 1) = '{c}' THEN '.' ELSE substr(x, {i + 1}, 1) END" for i, c in enumerate(_REF)) + " AS diverged FROM p")
def div_seq(spark, d):
    own = reads(spark, d).withColumn("x", F.substring("seq", F.lit(1), (6 + F.col("read_id") % 5).cast("int")))
    return own.select("read_id", sq.divergence(F.col("x"), _REF).alias("diverged"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey * 1234 < 1000 THEN CAST(o_orderkey * 1234 AS VARCHAR) ELSE format('{:,}', o_orderkey * 1234) END AS shown FROM orders")
def thousands(spark, d):
    return t(spark, d, "orders").select("o_orderkey", st.thousands(F.col("o_orderkey") * 1234).alias("shown"))


# ---- figures -------------------------------------------------------------------------------------


@query(f"{CONTIG}, off AS (SELECT seqnames, CAST(coalesce(sum(CAST(ceil(len / 1000.0) AS BIGINT) * 1000) OVER (ORDER BY seqnames ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS o FROM contig), ti AS (SELECT specimen, seqnames, unnest(range((s - 1) // 1000, (e - 1) // 1000 + 1)) * 1000 + 1 AS t FROM frag), c AS (SELECT specimen, seqnames, t, count(*) AS n FROM ti GROUP BY ALL), m AS (SELECT *, max(log10(n + 1)) OVER (PARTITION BY specimen) AS top FROM c) SELECT specimen, seqnames, CAST(t AS BIGINT) AS tile_start, CAST(n AS BIGINT) AS n, round(log10(n + 1), 6) AS log_n, round(log10(n + 1) / top, 6) AS norm, CAST(o + t AS BIGINT) AS adj_start, CAST(o + t + 999 AS BIGINT) AS adj_end FROM m JOIN off USING (seqnames) WHERE n >= 2")
def density_track(spark, d):
    out = figures.density_track(frag(spark, d), contigs(spark, d), 1000, ["specimen"])
    return out.select("specimen", "seqnames", F.col("start").alias("tile_start"), F.col("count").alias("n"), F.round("log_count", 6).alias("log_n"), F.round("norm_log_count", 6).alias("norm"), "adj_start", "adj_end")


@query(f"{READ}, p AS (SELECT id, lpad(substr(seq, 1, 6 + CAST(id % 5 AS INTEGER)), 10, 'N') AS x FROM reads), g AS (SELECT id, x, CAST(unnest(range(1, 11)) AS INTEGER) AS place FROM p) SELECT id AS read_id, place, CASE WHEN substr(x, place, 1) = substr('{_REF}', place, 1) THEN '.' ELSE substr(x, place, 1) END AS letter FROM g")
def divergence_grid(spark, d):
    own = reads(spark, d).select("read_id", F.substring("seq", F.lit(1), (6 + F.col("read_id") % 5).cast("int")).alias("x"))
    return figures.divergence_grid(own, "x", _REF, "read_id")
