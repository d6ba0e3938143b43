"""Sequencing reads: keys, demultiplexing, trimming, filtering, consolidation.

Reads are rows (read_id, seq, qual).  Work that depends on a sequence alone is
done once per distinct sequence where sequences repeat much (index reads).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sequences import IUPAC, match_offsets, pattern_places, scanner, scoring_matrix
from .staging import ranked

NAME_PATTERN = r"[\w\:\-\+]+"


def with_key(reads: DataFrame, pattern: str = NAME_PATTERN, id_column: str = "read_id") -> DataFrame:
    """reads with `key`, the part of the name that mates share; null where the pattern doesn't match."""
    return reads.withColumn("key", F.nullif(F.regexp_extract(id_column, pattern, 0), F.lit("")))


def duplicate_keys(reads: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once; a manifest or a set of reads must have none."""
    return reads.groupBy(*columns).count().where("count > 1")


def require_unique(reads: DataFrame, *columns: str) -> DataFrame:
    if duplicate_keys(reads, *columns).limit(1).count():
        raise ValueError(f"{', '.join(columns)} must be unique")
    return reads


def classify_barcodes(index_reads: DataFrame, barcodes: list[str], length: int | None = None, max_mismatch: int = 0, max_n: int = 1) -> DataFrame:
    """index_reads (read_id, seq) with `barcode`: one of the barcodes, ambiguous, unassigned or degenerate.

    Distinct index sequences are few against reads: they are classified alone and joined back.  A barcode counts if
    it fits at just one place.  Too many Ns outweigh ambiguity, which outweighs no match.
    """
    cut = F.substring("seq", 1, length or max(map(len, barcodes)))
    distinct = index_reads.select(cut.alias("__s")).distinct()
    distinct = distinct.withColumn("__m", F.transform(pattern_places(F.col("__s"), barcodes, max_mismatch), lambda m: m["pattern"]))
    once = F.filter(F.array_distinct("__m"), lambda k: F.size(F.filter("__m", lambda x: x == k)) == 1)
    hits = F.transform(once, lambda k: F.get(F.array(*map(F.lit, barcodes)), k))
    n = F.length("__s") - F.length(F.replace("__s", F.lit("N"), F.lit("")))
    label = F.when(n > max_n, "degenerate").when(F.size(hits) > 1, "ambiguous").when(F.size(hits) == 0, "unassigned").otherwise(F.get(hits, F.lit(0)))
    return index_reads.withColumn("__s", cut).join(distinct.select("__s", label.alias("barcode")), "__s").drop("__s")


def assign_samples(first: DataFrame, second: DataFrame | None, manifest: DataFrame) -> DataFrame:
    """(key, sampleName) from one or two classified index reads and the manifest (sampleName, barcode1, barcode2).

    Reads without a sample are degenerate, ambiguous or unassigned, in this order of precedence.
    """
    require_unique(manifest, *[c for c in ("barcode1", "barcode2") if second is not None or c == "barcode1"])
    one = first.select("key", F.col("barcode").alias("barcode1"))
    if second is None:
        sheet = manifest.select("barcode1", "sampleName")
        both = one.join(F.broadcast(sheet), "barcode1", "left")
        classes = F.array("barcode1")
    else:
        both = one.join(second.select("key", F.col("barcode").alias("barcode2")), "key", "full")
        both = both.join(F.broadcast(manifest.select("barcode1", "barcode2", "sampleName")), ["barcode1", "barcode2"], "left")
        classes = F.array("barcode1", "barcode2")
    rest = F.when(F.array_contains(classes, "degenerate"), "degenerate").when(F.array_contains(classes, "ambiguous"), "ambiguous").otherwise("unassigned")
    return both.select("key", F.coalesce("sampleName", rest).alias("sampleName"))


def pool_replicates(sample: Column) -> Column:
    return F.regexp_replace(sample, r"-\d+$", "")


def bins(reads: DataFrame, n_bins: int, level: int, order: str = "read_id") -> DataFrame:
    """reads with `bin`: filled in order up to `level` while that fits, else n_bins even ones."""
    total = reads.count()
    size = F.lit(float(level) if total <= n_bins * level else total / n_bins)
    return ranked(reads, [order], "__rank").withColumn("bin", F.ceil(F.col("__rank") / size).cast("int")).drop("__rank")


def quality_trim(reads: DataFrame, k: int = 5, window: int = 10, threshold: str = "?") -> DataFrame:
    """Cuts the tail from the first base on around which k or more of 2 * round(window / 2) + 1 qualities are at or below the threshold."""
    half, limit = round(window / 2), ord(threshold)

    @F.arrow_udf("int")
    def first_bad(column):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        out = np.zeros(len(column), np.int32)  # 0: none
        size = np.array(pc.fill_null(pc.binary_length(column), 0))
        data = b"".join(x.encode("latin-1", "replace") for x in pc.fill_null(column, "").to_pylist())
        off = np.append(0, np.cumsum(size))
        low = np.append(0, np.cumsum(np.frombuffer(data, np.uint8) <= limit))
        if len(data):
            row = np.repeat(np.arange(len(size)), size)
            at = np.arange(len(data))
            bad = low[np.minimum(at + half + 1, off[row + 1])] - low[np.maximum(at - half, off[row])] >= k
            rows, first = np.unique(row[bad], return_index=True)
            out[rows] = at[bad][first] - off[rows] + 1
        return pa.array(out)

    marked = reads.withColumn("__at", first_bad("qual"))
    keep = marked.withColumn("__keep", F.when(F.col("__at") > 0, F.col("__at") - 1).otherwise(F.length("seq")).cast("int"))
    return keep.withColumn("seq", F.substring("seq", F.lit(1), F.col("__keep"))).withColumn("qual", F.substring("qual", F.lit(1), F.col("__keep"))).drop("__at", "__keep")


def lead_trim(reads: DataFrame, lead: str, phasing: int = 0, max_mismatch: int = 0, collect: str | None = None) -> DataFrame:
    """Reads that begin with `lead` just once within one base, cut after it; `collect` names a column for the spans under ambiguous codes."""
    cut = reads.withColumn("seq", F.substring("seq", F.lit(phasing + 1), F.length("seq")))
    if "qual" in cut.columns:
        cut = cut.withColumn("qual", F.substring("qual", F.lit(phasing + 1), F.length("qual")))
    head = F.substring("seq", 1, len(lead) + 1)
    spans = [(m.start(), m[0]) for m in re.finditer("[^ACGT]+", lead)] if collect else []
    pattern = re.sub("[^ACGT]", ".", lead) if collect else lead
    # A read must be longer than the lead; where codes are collected, than what lies from its first fixed base to its last.
    fixed = [m.span() for m in re.finditer("[ACGT]+", lead)] if spans else []
    least = fixed[-1][1] - fixed[0][0] if fixed else len(lead)
    found = cut.where(F.length("seq") > least).withColumn("__m", pattern_places(head, [pattern], max_mismatch)).where(F.size("__m") == 1)
    found = found.withColumn("__o", F.get("__m", F.lit(0))["offset"]).drop("__m")
    if collect:
        umi = F.concat(*[F.substring("seq", F.col("__o") + at, F.lit(len(text))) for at, text in spans]) if spans else F.lit("")
        allowed = "".join(f"[{IUPAC[c]}{c}]" for _, text in spans for c in text)
        found = found.withColumn(collect, umi).where(F.col(collect).rlike(f"^{allowed}$"))
    for c in ("seq", "qual"):
        if c in found.columns:
            found = found.withColumn(c, F.substring(c, F.col("__o") + len(lead), F.length(c)))
    return found.drop("__o")


def overread_trim(reads: DataFrame, tail: str, percent_id: float = 0.95, max_length: int = 20, min_length: int = 3) -> DataFrame:
    """Cuts a read before the first place where the tail's leading bases begin: all of them anywhere, or as many as fit before the read's end (min_length at least)."""
    pattern = tail[:max_length]
    allowed = [int(round(n * (1 - percent_id))) for n in range(len(pattern) + 1)]  # half to even
    whole = scanner([pattern], allowed[-1])
    codes = [scanner([pattern[:n]], allowed[n]) for n in range(min_length, len(pattern))]

    @F.arrow_udf("int")
    def first_place(column):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        never = np.iinfo(np.int32).max
        out = np.full(len(column), never, np.int64)
        row, _, place, _ = whole(column)
        np.minimum.at(out, row, place)
        size = np.array(pc.fill_null(pc.binary_length(column), 0))
        for n, scan in enumerate(codes, min_length):
            # The read's last n bases against the tail's first n.
            row = scan(pc.utf8_slice_codeunits(column, -n) if n else column)[0]
            row = row[size[row] >= n]
            out[row] = np.minimum(out[row], size[row] - n + 1)
        return pa.array(np.where(out == never, 0, out), pa.int32())

    out = reads.withColumn("__at", first_place("seq")).withColumn("__keep", F.when(F.col("__at") > 0, F.col("__at") - 1).otherwise(F.length("seq")).cast("int")).withColumn("seq", F.substring("seq", F.lit(1), F.col("__keep")))
    if "qual" in reads.columns:
        out = out.withColumn("qual", F.substring("qual", F.lit(1), F.col("__keep")))
    return out.drop("__at", "__keep")


def min_length(reads: DataFrame, n: int, lead: str = "", phasing: int = 0) -> DataFrame:
    return reads.where(F.length("seq") >= n + len(lead) + phasing)


def untrimmed_union(reads: DataFrame, trimmed: DataFrame) -> DataFrame:
    """All reads, with the trimmed sequence where there is one."""
    return reads.join(trimmed.select("read_id", F.col("seq").alias("__t")), "read_id", "left").withColumn("seq", F.coalesce("__t", "seq")).drop("__t")


def shared_keys(files: list[DataFrame], mode: str = "all") -> DataFrame:
    """(key): keys in all inputs, in `any` (more than one) or in just one (`negative`)."""
    every = None
    for i, f in enumerate(files):
        own = f.select("key").distinct().withColumn("__f", F.lit(i))
        every = own if every is None else every.unionByName(own)
    n = every.groupBy("key").agg(F.count("*").alias("__n"))
    test = {"all": F.col("__n") == len(files), "any": F.col("__n") > 1, "negative": F.col("__n") == 1}[mode]
    return n.where(test).select("key")


def keep_keys(reads: DataFrame, keys: DataFrame, negative: bool = False) -> DataFrame:
    return reads.join(keys, "key", "left_anti" if negative else "left_semi")


def contains_patterns(seq: Column, patterns: list[str], max_mismatch: list[int] | int = 0, every: bool = True, negative: bool = False) -> Column:
    """Whether seq holds the patterns (U read as T): all or any of them; negative: lacks all or any."""
    limits = [max_mismatch] * len(patterns) if isinstance(max_mismatch, int) else max_mismatch
    tests = [F.size(match_offsets(seq, p.upper().replace("U", "T"), m)) > 0 for p, m in zip(patterns, limits)]
    tests = [~t for t in tests] if negative else tests
    out = tests[0]
    for t in tests[1:]:
        out = out & t if every else out | t
    return out


def combine_criteria(criteria: list[Column], every: bool = True) -> Column:
    out = criteria[0]
    for c in criteria[1:]:
        out = out & c if every else out | c
    return out


def substitute(seq: Column, changes: list[str]) -> Column:
    """Character rewrites given as three letters: flag, from, to (iAR: A becomes R; rCB the same for the reference)."""
    return F.translate(seq, "".join(c[1] for c in changes), "".join(c[2] for c in changes))


def consolidate(reads: DataFrame, prefix: str = "seq", by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(distinct sequences with seq_id, read_id to seq_id): ids are prefix and the sequence's lexicographic rank."""
    keys = [by] if by else []
    named = ranked(reads.select(*keys, "seq").distinct(), ["seq"], "__rank", keys).select(*keys, "seq", F.concat(F.lit(prefix), F.col("__rank").cast("string")).alias("seq_id"))
    return named, reads.join(named, [*keys, "seq"]).select(*keys, "read_id", "seq_id")


def sequence_stats(reads: DataFrame, by: list[str] = ()) -> DataFrame:
    return reads.groupBy(*by).agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"), F.round(F.avg(F.length("seq")), 1).alias("mean_length"))


def alignment_filter(reads: DataFrame, refs: list[str], percent: float = 95.0, kind: str = "local", identity: str = "local", min_align: int = 20, gap_open: float = 10, gap_extend: float = 4, negative: bool = False) -> DataFrame:
    """Reads that align to a reference with `percent` identity, by an Arrow batch function over distinct sequences.

    Identity is the score over the read's length (global) or over its aligned width, of min_align bases at least (local).
    A read is aligned only with references that share a word with it where `shared_word` says that others can't reach percent.
    """
    score = identity_scorer(refs, kind, identity, min_align, gap_open, gap_extend, least=percent)

    @F.arrow_udf("double")
    def best(column):
        import pyarrow as pa

        return pa.array(score(column.to_pylist()))

    good = reads.select("seq").distinct().withColumn("__id", best("seq")).where(F.col("__id") < percent if negative else F.col("__id") >= percent).select("seq")
    return reads.join(good, "seq", "left_semi")


def align_identity(read: str, ref: str, kind: str = "local", identity: str = "local", min_align: int = 20, gap_open: float = 10, gap_extend: float = 4) -> float:
    """Percent identity of one read with one reference."""
    return float(identity_scorer([ref], kind, identity, min_align, gap_open, gap_extend)([read])[0])


def shared_word(width: int, percent: float, shortest: int = 6, longest: int = 16) -> int:
    """The longest word that an alignment of `width` bases or more with `percent` identity must hold unchanged; 0 if none of a useful length is certain.

    Without such a word every stretch of its length has a base that isn't equal, so w bases have floor(w / word) at
    least, which is the smallest share of w just before the next multiple.  A gap costs more than the stretch that it splits.
    """
    for word in range(longest, shortest - 1, -1):
        times = width // word
        if times and times / (word * (times + 1) - 1) > 1 - percent / 100 + 1e-9:
            return word
    return 0


def word_sharers(refs: list[str], word: int):
    """A function of a matrix of reads (codes in alphabetic order of `IUPAC`, one length): which references (columns) share a word with which read (rows); a read or reference with other bases than A, C, G and T shares with all."""
    letters = sorted(IUPAC)
    digit = {letters.index(c): k for k, c in enumerate("ACGT")}
    odd = [k for k, r in enumerate(refs) if set(r) - set("ACGT")]
    owners: dict[int, list[int]] = {}
    for k, ref in enumerate(refs):
        if k not in set(odd):
            for text in {ref[i : i + word] for i in range(len(ref) - word + 1)}:
                owners.setdefault(sum("ACGT".index(c) << 2 * (word - 1 - j) for j, c in enumerate(text)), []).append(k)
    values = sorted(owners)

    def sharers(raw):
        import numpy as np

        n, size = raw.shape
        table = np.full(len(letters) + 1, -1, np.int64)
        table[list(digit)] = list(digit.values())
        codes = table[raw]
        out = np.zeros((n, len(refs)), bool)
        out[:, odd] = True
        out[(codes < 0).any(1)] = True
        own = np.zeros((n, max(0, size - word + 1)), np.int64)
        for j in range(word if own.size else 0):
            own = own * 4 + np.maximum(codes[:, j : j + own.shape[1]], 0)
        if own.size and values:
            known = np.array(values, np.int64)
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            row, place = np.nonzero(known[at] == own)
            for r, v in set(zip(row.tolist(), at[row, place].tolist())):
                out[r, owners[values[v]]] = True
        return out

    return sharers


def identity_scorer(refs: list[str], kind: str = "local", identity: str = "local", min_align: int = 20, gap_open: float = 10, gap_extend: float = 4, least: float = 0):
    """A function of a list of reads: the percent identity of each with its best reference, by affine-gap alignment; 0 for empty ones.

    Identities below `least` may be told as 0: reads are then aligned only with the references that may reach it.

    kind: global, local, overlap (free ends on both), global-local (the whole read in a part of the reference) or
    local-global.  Reads of one length go through the dynamic programme together, a row of it at a time; the state along
    the reference's gaps is a running maximum.  A state is one number: the score in hundredths times SPAN, plus the
    aligned width so far (less the read's place), so that the greater width wins among equal scores.
    """
    free_read, free_ref = kind in ("local", "overlap", "local-global"), kind in ("local", "overlap", "global-local")
    table = scoring_matrix("asymmetric")
    span, never = 1 << 20, -(1 << 58)
    first, more = round(100 * (gap_open + gap_extend)) * span, round(100 * gap_extend) * span
    letters = sorted(IUPAC)
    # Exact where a gap costs a base's score at least.
    sure = gap_extend >= 0 and gap_open + gap_extend >= 1 and least > 0
    seeds = {}

    def may_reach(raw):
        word = shared_word(raw.shape[1] if identity == "global" else max(min_align, 1), least) if sure else 0
        if not word:
            return None
        if word not in seeds:
            seeds[word] = word_sharers(refs, word)
        return seeds[word](raw)

    def block(raw, ref):
        """Best state of each read (a row of raw, as places in `letters`) with a reference."""
        import numpy as np

        n, size = raw.shape
        along = np.arange(len(ref) + 1)[:, None] * more
        fit = np.array([[round(100 * table.get((a, b), 0.0)) * span for b in ref] for a in letters] + [[0] * len(ref)], np.int64)
        m = np.full((len(ref) + 1, n), 0 if free_ref else never, np.int64)
        m[0] = 0
        x = np.full_like(m, never)
        y = np.full_like(m, never)
        if not free_ref:
            y[1:] = -(first - more) - along[1:]
        best = np.full(n, never, np.int64)
        for i in range(1, size + 1):
            top = np.maximum(m, np.maximum(x, y))
            m2, x2, y2 = np.empty_like(m), np.maximum(np.maximum(m, y) - first, x - more), np.full_like(m, never)
            m2[0], x2[0] = (-i if free_read else never), (never if free_read else -(first - more) - i * more)
            m2[1:] = top[:-1] + fit[raw[:, i - 1]].T
            if kind == "local":
                m2[1:] = np.maximum(m2[1:], 1 - i)
            opened = np.maximum.accumulate(np.maximum(m2, x2) + along, axis=0)
            y2[1:] = opened[:-1] - along[1:] - (first - more)
            m, x, y = m2, x2, y2
            if kind == "local" or i == size or free_read:
                ends = np.maximum(m, np.maximum(x, y))[1:]
                if not (kind == "local" or (i == size and free_ref)):
                    ends = ends[-1:]
                best = np.maximum(best, ends.max(0) + i)
        return best

    def score(reads):
        import numpy as np

        place = np.full(256, len(letters))
        for k, c in enumerate(letters):
            place[ord(c)] = k
        out = np.zeros(len(reads))
        by_size = {}
        for i, read in enumerate(reads):
            if read:
                by_size.setdefault(len(read), []).append(i)
        for size, rows in by_size.items():
            for k in range(0, len(rows), 1024):
                own = rows[k : k + 1024]
                raw = place[np.frombuffer("".join(reads[i] for i in own).encode("latin-1", "replace"), np.uint8)].reshape(len(own), size)
                own, near = np.array(own), may_reach(raw)
                for k_ref, ref in enumerate(refs):
                    some = slice(None) if near is None else np.flatnonzero(near[:, k_ref])
                    if not ref or not len(own[some]):
                        continue
                    state = block(raw[some], ref)
                    points, width = state // span / 100, state % span
                    if identity == "global":
                        got = 100 * np.maximum(points, 0) / size
                    else:
                        got = np.where(width >= max(min_align, 1), 100 * points / np.maximum(width, 1), 0.0)
                    out[own[some]] = np.maximum(out[own[some]], got)
        return out

    return score
