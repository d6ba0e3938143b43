"""Nucleotide strings as Spark columns: IUPAC matching, complements, divergence, CIGAR arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

#: IUPAC nucleotide codes and the bases each stands for.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "M": "AC", "R": "AG", "W": "AT", "S": "CG", "Y": "CT", "K": "GT", "V": "ACG", "H": "ACT", "D": "AGT", "B": "CGT", "N": "ACGT"}
COMPLEMENT = ("ACGTMRWSYKVHDBN", "TGCAKYWSRMBDHVN")


def reverse_complement(seq):
    return F.reverse(F.translate(seq, *COMPLEMENT))


def overlapping_codes(code: str) -> str:
    """Every code that shares a base with `code`."""
    return "".join(c for c, bases in IUPAC.items() if set(bases) & set(IUPAC[code]))


def mismatches_at(seq, pattern: str, offset):
    """Mismatches of a literal pattern against seq from 1-based offset, codes read both ways; bases past either end mismatch.

    One substring and one membership test a position: stays in generated code, with no lambda.
    """
    total = F.lit(0)
    for i, code in enumerate(pattern.upper()):
        place = offset + F.lit(i)
        base = F.when(place >= 1, F.substring(seq, place, F.lit(1))).otherwise(F.lit(""))
        total = total + F.when((base != "") & F.contains(F.lit(overlapping_codes(code)), base), 0).otherwise(1)
    return total


def seeded_scan(coded: list[list], max_mismatch: int, beyond: int):
    """A function of (bases as sets of four bits, one sequence after another; offsets): places as scanner's, for any number of patterns at about the price of a few.

    By the pigeonhole principle one half of a pattern that fits has at most half of the mismatches.  All words of up to
    ten bases that lie so near to the first bases of a half are entered in a table; every word of a sequence is
    looked up there once, and what it meets is verified over the whole pattern.  Ambiguous bases of a sequence have no
    word: windows that hold one are compared with every pattern.
    """
    k = min(10, min(map(len, coded)) // 2)
    longest = max(map(len, coded))
    held = []

    def table():
        import numpy as np

        seeds = [(p, d, most, code[d : d + k]) for p, code in enumerate(coded) for d, most in ((0, max_mismatch // 2), (len(code) // 2, (max_mismatch - 1) // 2)) if most >= 0]
        pattern, shift, most = (np.array([s[i] for s in seeds], np.int64) for i in range(3))
        codes = np.array([s[3] for s in seeds], np.uint8)
        seed, word, cost = np.arange(len(seeds), dtype=np.int32), np.zeros(len(seeds), np.int32), np.zeros(len(seeds), np.int8)
        for i in range(k):
            each = []
            for letter in range(4):
                c = cost + (codes[seed, i] >> letter & 1 == 0)
                ok = c <= most[seed]
                each.append((seed[ok], word[ok] * 4 + letter, c[ok]))
            seed, word, cost = (np.concatenate(x) for x in zip(*each))
        first = np.append(0, np.cumsum(np.bincount(word, minlength=4**k)))
        whole = np.zeros((len(coded), longest), np.uint8)
        for p, code in enumerate(coded):
            whole[p, : len(code)] = code
        return pattern, shift, first, seed[np.argsort(word, kind="stable")], whole, np.array([len(c) for c in coded])

    def scan(raw, off):
        import numpy as np

        if not held:
            held.append(table())
        pattern, shift, first, entries, whole, length = held[0]
        letter = np.zeros(16, np.int32)
        letter[[1, 2, 4, 8]] = 0, 1, 2, 3
        single = np.zeros(16, bool)
        single[[0, 1, 2, 4, 8]] = True
        steps = np.arange(longest)
        size = np.diff(off)
        found = [[np.zeros(0, np.int64)] * 4]
        i = 0
        while i < len(size):
            j = max(i + 1, int(np.searchsorted(off + 2 * beyond * np.arange(len(off)), off[i] + 2 * beyond * i + (1 << 18), "right")) - 1)
            n = size[i:j]
            m = n + 2 * beyond
            begin = np.cumsum(m) - m
            total = int(m.sum())
            flat = np.zeros(total + longest, np.uint8)
            flat[np.arange(off[j] - off[i]) + np.repeat(begin + beyond - (off[i:j] - off[i]), n)] = raw[off[i] : off[j]]
            row = np.repeat(np.arange(j - i), m)

            def verify(start, of, which):
                """Keeps the windows from `start` within row `of` that the pattern fits."""
                ok = (start >= begin[of]) & (start + length[which] <= begin[of] + m[of])
                start, of, which = start[ok], of[ok], which[ok]
                wrong = np.zeros(len(start), np.int64)
                for x in range(0, len(start), 1 << 17):
                    y = slice(x, x + (1 << 17))
                    wrong[y] = ((flat[start[y, None] + steps] & whole[which[y]]) == 0).sum(1) - (longest - length[which[y]])
                fits = wrong <= max_mismatch
                found.append([of[fits] + i, which[fits], (start - begin[of])[fits] + 1 - beyond, wrong[fits]])

            words = max(0, total - k + 1)
            word = np.zeros(words, np.int32)
            for x in range(k):
                word = word * 4 + letter[flat[x : x + words]]
            many = first[word + 1] - first[word]
            ends = np.cumsum(many)
            x = 0
            while x < words:
                y = max(x + 1, int(np.searchsorted(ends, ends[x] - many[x] + (1 << 20))))
                own = many[x:y]
                place = np.repeat(np.arange(x, y), own)
                at = np.arange(len(place)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(first[word[x:y]], own)
                verify(place - shift[entries[at]], row[place], pattern[entries[at]])
                x = y
            odd = np.flatnonzero(~single[flat[:total]])
            if len(odd):
                near = np.zeros(total + 1, np.int64)
                np.add.at(near, np.maximum(odd - longest + 1, 0), 1)
                np.add.at(near, odd + 1, -1)
                start = np.flatnonzero(np.cumsum(near[:-1]))
                for x in range(0, len(start), max(1, (1 << 20) // len(coded))):
                    some = start[x : x + max(1, (1 << 20) // len(coded))]
                    verify(np.repeat(some, len(coded)), np.repeat(row[some], len(coded)), np.tile(np.arange(len(coded)), len(some)))
            i = j
        row, which, place, wrong = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((place, which, row))
        row, which, place, wrong = row[order], which[order], place[order], wrong[order]
        new = np.ones(len(row), bool)  # both halves may have found it
        new[1:] = (row[1:] != row[:-1]) | (which[1:] != which[:-1]) | (place[1:] != place[:-1])
        return row[new], which[new], place[new], wrong[new]

    return scan


def scanner(patterns: list[str], max_mismatch: int, beyond: int = 0, seeds_from: int = 12):
    """A function of an Arrow string array: (rows, patterns, 1-based offsets, mismatches) of the places where a pattern fits.

    Bases become sets of four bits, and a pattern place is one AND over all sequences and offsets; patterns may
    reach `beyond` bases past either end, which mismatch; a dot in a pattern fits anything.  `seeds_from` patterns or
    more of 16 bases or more, of which few are ambiguous, are found by seeds.  It holds all it needs, so that workers
    need no package.
    """
    bit = {"A": 1, "C": 2, "G": 4, "T": 8}
    table = bytes(sum(bit[x] for x in IUPAC.get(chr(c), "")) for c in range(256))
    coded = [[None if c == "." else table[ord(c)] for c in p.upper()] for p in patterns]
    plain = [k for k, c in enumerate(coded) if len(c) >= 16 and sum(x not in (1, 2, 4, 8) for x in c) <= 2]
    plain = plain if len(plain) >= seeds_from else []
    seeded = seeded_scan([coded[k] for k in plain], max_mismatch, beyond) if plain else None
    dense = [(k, c) for k, c in enumerate(coded) if k not in set(plain)]
    longest = max((len(c) for _, c in dense), default=0)

    def scan(column):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        none = np.zeros(0, np.int64)
        if not len(column):
            return none, none, none, none
        _, offsets, data = column.buffers()
        off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(table, np.uint8)[np.frombuffer(data, np.uint8)[off[0] : off[-1]]] if data is not None else np.zeros(0, np.uint8)
        off = off - off[0]
        size = np.diff(off)
        found = [[none] * 4]
        if seeded:
            row, which, place, wrong = seeded(raw, off)
            found.append([row, np.array(plain)[which], place, wrong])
        i = 0 if dense else len(size)
        while i < len(size):
            j, width = i + 1, int(size[i])
            while j < len(size) and (j + 1 - i) * (max(width, int(size[j])) + longest) <= 1 << 21:
                width = max(width, int(size[j]))
                j += 1
            n = size[i:j]
            grid = np.zeros((j - i, width + 2 * beyond + longest), np.uint8)
            inside = np.arange(width)[None, :] < n[:, None]
            grid[:, beyond : beyond + width][inside] = raw[off[i] : off[j]]
            for k, pattern in dense:
                offsets_ = width + 2 * beyond - len(pattern) + 1
                if offsets_ <= 0:
                    continue
                wrong = np.zeros((j - i, offsets_), np.int16)
                for at, code in ((i, c) for i, c in enumerate(pattern) if c is not None):
                    wrong += (grid[:, at : at + offsets_] & code) == 0
                fits = (wrong <= max_mismatch) & (np.arange(offsets_)[None, :] <= (n + 2 * beyond - len(pattern))[:, None])
                row, place = np.nonzero(fits)
                found.append([row + i, np.full(len(row), k), place + 1 - beyond, wrong[row, place].astype(np.int64)])
            i = j
        row, which, place, wrong = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((place, which, row))
        return row[order], which[order], place[order], wrong[order]

    return scan


def pattern_places(seq, patterns: list[str], max_mismatch: int, beyond: int = 0):
    """Array of (pattern, offset, mismatch): where the patterns, by their place in the list, fit seq; by pattern, then offset."""
    scan = scanner(patterns, max_mismatch, beyond)

    @F.arrow_udf("array<struct<pattern:int,offset:int,mismatch:int>>")
    def places(column):
        import numpy as np
        import pyarrow as pa

        row, which, place, wrong = scan(column)
        ends = np.searchsorted(row, np.arange(len(column) + 1)).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (which, place, wrong)], names=["pattern", "offset", "mismatch"])
        return pa.ListArray.from_arrays(pa.array(ends), values)

    return places(seq)


def match_offsets(seq, pattern: str, max_mismatch: int):
    """Array of (offset, mismatch) where the pattern fits seq with at most max_mismatch mismatches; null for null."""
    found = F.transform(pattern_places(seq, [pattern], max_mismatch), lambda m: F.struct(m["offset"].alias("offset"), m["mismatch"].alias("mismatch")))
    return F.when(seq.isNotNull(), found)


def divergence(seq, ref: str, match: str = ".", fill: str = "right"):
    """seq padded with N to ref's length, matching characters shown as `match`."""
    padded = F.rpad(seq, len(ref), "N") if fill == "right" else F.lpad(seq, len(ref), "N")
    return F.concat(*[F.when(F.substring(padded, i + 1, 1) == c, match).otherwise(F.substring(padded, i + 1, 1)) for i, c in enumerate(ref)])


def cigar_sum(cigar, ops: str):
    """Total length of a CIGAR string's runs with one of the operations."""
    runs = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{ops}]"), F.lit(1))
    return F.aggregate(runs, F.lit(0).cast("long"), lambda n, x: n + x.cast("long"))


def percent_identity(cigar, md):
    """Matched share of the read's aligned and clipped length, one decimal, half to even; letters of MD count as mismatches, also within deletions."""
    wrong = F.regexp_count(md, F.lit("[ACGT]"))
    return F.bround(100 * (cigar_sum(cigar, "M") - wrong) / cigar_sum(cigar, "HSMIDX="), 1)


def clipped(cigar, end: str = "start"):
    """Length of the hard or soft clip at one end."""
    text = F.regexp_extract(cigar, r"^(\d+)[HS]" if end == "start" else r"(\d+)[HS]$", 1)
    return F.when(text == "", F.lit(0)).otherwise(text.try_cast("int"))


def five_prime(start, end, strand):
    return F.when(strand == "-", end).otherwise(start)


def scoring_matrix(kind: str = "symmetric") -> dict[tuple[str, str], float]:
    """Scores of IUPAC code pairs.

    Codes without a common base score 0; a single base or N against a code that shares a base scores 1, and so do equal
    codes.  Other pairs score 0 (binary), shared bases over the larger code's (symmetric) or over the first code's
    (asymmetric), to two decimals.
    """
    out = {}
    for a, x in IUPAC.items():
        for b, y in IUPAC.items():
            shared = len(set(x) & set(y))
            if not shared:
                score = 0.0
            elif a == b or {len(x), len(y)} & {1, 4}:
                score = 1.0
            elif kind == "binary":
                score = 0.0
            else:
                score = round(shared / (max(len(x), len(y)) if kind == "symmetric" else len(x)), 2)
            out[a, b] = score
    return out
