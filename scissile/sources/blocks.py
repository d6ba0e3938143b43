"""Block-compressed files, read by many tasks each: the data sources `bam` and `bgzf_fastq`.

Such a file is a row of gzip members of at most 64 kB that say how long they are.
A task is given a range of bytes; it takes the blocks that begin there, finds the
first record that begins in one of them, and reads records until one begins
beyond its range, so every record is read once, however the file is cut.  A
record's start is told by its own fields and by those of the records that follow
it; a chain of records that breaks later is an error, never a loss.  Compressed
files without block lengths are read by the task that has their first byte.

Filters on flag, mapq, pos, rname and mapped_pair are taken by the BAM source: what
they rule out is dropped by the fixed fields, before names, CIGARs and tags are
read.  This module is sent to workers whole (see `register`), so that they need
no package.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

#: Fixed values of the formats: operations of a CIGAR, sizes of fixed tag types, the marks of a block.
CIGAR_OPS = "MIDNSHP=X"
TAG_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
BLOCK = re.compile(rb"\x1f\x8b\x08\x04.{6}\x06\x00BC\x02\x00", re.DOTALL)
#: The same sizes by a type's byte; -1 is no type of fixed size.
_SIZES = np.full(256, -1, np.int64)
_SIZES[[ord(k) for k in TAG_SIZES]] = list(TAG_SIZES.values())
END_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")

BAM_COLUMNS = "qname string, flag int, rname string, pos long, mapq int, cigar string, qwidth int, span int, MD string, mapped_pair boolean"
#: Bytes of a file that a task is given, and inflated bytes that it works on at a time.
SPLIT_BYTES, PIECE = 32 << 20, 4 << 20
#: Small ranges widen, up to the usual ones, where there would be more tasks than this: what a task costs of itself stays small.
MOST_TASKS = 1 << 10
#: Bytes that are read at a time behind a range, where only its last record goes on.
AHEAD = 1 << 16
#: A longer record is not believed where a task looks for its first one.
LONGEST_RECORD = 1 << 28
#: Records that must follow each other before a start is believed, unless the data end.
CHAIN = 16


def _open(uri: str):
    from pyarrow.fs import FileSystem

    fs, path = FileSystem.from_uri(uri)
    return fs.open_input_file(path)


class Inflated:
    """The inflated bytes of a file from a block on, in pieces; knows where in the file each stretch comes from."""

    def __init__(self, file, start: int, stop: int):
        self.file, self.at, self.stop, self.size, self.raw = file, start, stop, file.size(), b""

    def find_block(self) -> bool:
        """Goes on to the first block at or after the present place; whether there is one."""
        while self._need(18):
            if got := BLOCK.search(self.raw):
                self._skip(got.start())
                if self._need(18) and self._need(n := self._length()) and (self.at + n == self.size or self._need(n + 16) and BLOCK.match(self.raw, n)):
                    return True
                self._skip(1)
            else:
                self._skip(max(1, len(self.raw) - 15))
        return False

    def _length(self) -> int:
        return struct.unpack_from("<H", self.raw, 16)[0] + 1

    def _need(self, n: int) -> bool:
        if len(self.raw) < n:
            at = self.at + len(self.raw)
            self.raw += self.file.read_at(min(max(n, min(1 << 20, max(0, self.stop - at) + AHEAD)), self.size - at), at)
        return len(self.raw) >= n

    def _skip(self, n: int) -> None:
        self.raw, self.at = self.raw[n:], self.at + n

    def pieces(self, limit: int):
        """(bytes, whether their blocks begin before limit) of stretches of blocks, to the file's end."""
        held, total, inside, beyond = [], 0, True, 1  # behind the limit a block at first, as a record seldom needs more
        while self._need(18):
            if not BLOCK.match(self.raw) or not self._need(n := self._length()):
                raise ValueError(f"a block is damaged or cut short at byte {self.at}")
            if held and (total >= (PIECE if inside else beyond) or (self.at < limit) != inside):
                yield b"".join(held), inside
                beyond = beyond if inside else min(PIECE, 2 * total)
                held, total = [], 0
            inside = self.at < limit
            data = zlib.decompress(memoryview(self.raw)[18 : n - 8], -15, 1 << 16)
            crc, size = struct.unpack_from("<II", self.raw, n - 8)
            if zlib.crc32(data) != crc or len(data) != size:
                raise ValueError(f"a block at byte {self.at} doesn't fit its checksum")
            held.append(data)
            total += size
            self._skip(n)
        if self.raw or self.at < self.size:
            raise ValueError(f"a block is cut short at byte {self.at}")
        if held:
            yield b"".join(held), inside


def inflate_all(file):
    """(bytes, True) of any gzip file from its start, in pieces of bounded size; a file that is cut short is an error."""
    file.seek(0)
    pack, rest, ended = zlib.decompressobj(31), b"", True
    while data := rest or file.read(1 << 20):
        out = pack.decompress(data, PIECE)
        rest, ended = pack.unconsumed_tail or pack.unused_data, pack.eof
        if out:
            yield out, True
        if pack.eof:
            pack = zlib.decompressobj(31)
        elif not rest:  # inflated bytes may wait for a larger piece
            while more := pack.decompress(b"", PIECE):
                yield more, True
    if not ended:
        raise ValueError("a gzip file is cut short")


def ranges(files: list, step: int, usual: int) -> list[InputPartition]:
    """(uri, start, stop) of ranges of the files (uri, size): of `step` bytes, or wider, up to the usual ones, where those would be more than MOST_TASKS."""
    step = max(step, min(usual, -(-sum(size for _, size in files) // MOST_TASKS)))
    return [InputPartition((uri, a, min(size, a + step))) for uri, size in files for a in range(0, max(1, size), step)]


def _splits(options) -> list[InputPartition]:
    """Ranges of the files: as listed by the caller, or of the path's own filesystem."""
    if "files" in options:
        files = json.loads(options["files"])
    else:
        from pyarrow.fs import FileSelector, FileSystem, FileType

        fs, path = FileSystem.from_uri(options["path"])
        info = fs.get_file_info(path)
        infos = [info] if info.type == FileType.File else fs.get_file_info(FileSelector(path, recursive=True))
        files = [(f"{options['path'].rstrip('/')}{x.path.removeprefix(path.rstrip('/'))}", x.size) for x in infos if x.type == FileType.File]
    return ranges(files, int(options.get("splitbytes", SPLIT_BYTES)), SPLIT_BYTES)


class _Scan:
    """What a task reads of a file: `data`, growing as needed, and whether a place in it belongs to the task."""

    def __init__(self, file, start: int, stop: int):
        head = file.read_at(18, 0) if file.size() else b""
        self.blocked = bool(BLOCK.match(head))
        self.empty = not head or (start > 0 and not self.blocked)
        self.data, self.own, self.ended = b"", 0, self.empty
        if self.empty:
            return
        if self.blocked:
            if file.size() < len(END_BLOCK) or file.read_at(len(END_BLOCK), file.size() - len(END_BLOCK)) != END_BLOCK:
                raise ValueError("no end block: the file is cut short")
            blocks = Inflated(file, start, stop)
            self.empty = not blocks.find_block() or blocks.at >= stop
            self._pieces = iter(()) if self.empty else blocks.pieces(stop)
        else:
            self._pieces = inflate_all(file)

    def more(self) -> bool:
        piece, own = next(self._pieces, (None, False))
        if piece is None:
            self.ended = True
            return False
        if own:
            self.own = len(self.data) + len(piece)
        self.data += piece
        return True

    def need(self, n: int) -> bool:
        while len(self.data) < n and not self.ended:
            self.more()
        return len(self.data) >= n

    def drop(self, n: int) -> None:
        self.data, self.own = self.data[n:], self.own - n


# ---- BAM -------------------------------------------------------------------------------------------


def _header(file) -> tuple[list[str], np.ndarray, int]:
    """(names of contigs, their lengths, bytes of the header) of a BAM file."""
    scan = _Scan(file, 0, 1)

    def take(at: int, n: int) -> bytes:
        if not scan.need(at + n):
            raise ValueError("a BAM header is cut short")
        return scan.data[at : at + n]

    if not scan.need(4) or scan.data[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack("<i", take(4, 4))[0]
    many = struct.unpack("<i", take(at, 4))[0]
    at, names, sizes = at + 4, [], []
    for _ in range(many):
        n = struct.unpack("<i", take(at, 4))[0]
        names.append(take(at + 4, n)[:-1].decode())
        sizes.append(struct.unpack("<i", take(at + 4 + n, 4))[0])
        at += 8 + n
    return names, np.array(sizes, np.int64), at


def _plausible(data: bytes, at: int, sizes: np.ndarray) -> int:
    """The end of the record at a place, if its fields can be those of a record; else 0."""
    block, ref, pos, n_name, _, _, n_ops, flag, n_seq, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    fits = lambda r, p: -1 <= r < len(sizes) and -1 <= p and (r < 0 or p <= sizes[r])
    if not (fits(ref, pos) and fits(mate, mate_pos) and n_name > 1 and n_seq >= 0 and LONGEST_RECORD >= block >= 32 + n_name + 4 * n_ops + (n_seq + 1) // 2 + n_seq):
        return 0
    name = data[at + 36 : at + 36 + n_name]
    if len(name) < n_name or name[-1] or min(name[:-1]) < 33 or max(name[:-1]) > 126:
        return 0
    return at + 4 + block


def _chained(scan: _Scan, at: int, sizes: np.ndarray) -> bool:
    """Whether records follow each other from a place on: CHAIN of them, or up to the file's end."""
    for seen in range(CHAIN):
        if not scan.need(at + 36):
            return seen > 0 and at == len(scan.data)
        scan.need(at + 36 + 256)
        at = _plausible(scan.data, at, sizes)
        if not at or not scan.need(at):
            return False
    return True


def _first_record(scan: _Scan, sizes: np.ndarray) -> int:
    """The first place in the task's own blocks at which a record begins, or -1."""
    at = 0
    while at < scan.own or scan.more() and at < scan.own:
        if _chained(scan, at, sizes):
            return at
        at += 1
    return -1


@functools.lru_cache(maxsize=1 << 16)
def _cigar(raw: bytes) -> tuple[str, int, int]:
    """(text, bases of the read, bases of the reference) of a packed CIGAR."""
    runs = [(x >> 4, CIGAR_OPS[x & 15]) for x in struct.unpack(f"<{len(raw) // 4}I", raw)]
    size = lambda which: sum(n for n, o in runs if o in which)
    return "".join(f"{n}{o}" for n, o in runs) or "*", size("MIS=X"), size("MDN=X")


def _md(raw: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of the text of each record's MD tag, size -1 where there is none: all records go on by a tag at a time."""
    at, start, size, zeros = at.copy(), np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64), np.flatnonzero(raw == 0)
    live = np.flatnonzero(at + 3 <= ends)
    while len(live):
        a, kind = at[live] + 3, raw[at[live] + 2]
        text, many = np.isin(kind, (ord("Z"), ord("H"))), kind == ord("B")
        on = _SIZES[kind]
        if many.any():
            b = a[many]
            if (b + 5 > ends[live[many]]).any():
                raise ValueError("a tag is cut short")
            count = raw[b[:, None] + 1 + np.arange(4)].copy().view("<i4").ravel().astype(np.int64)
            unit = _SIZES[raw[b]]
            on[many] = np.where((count < 0) | (unit < 0), -1, 5 + unit * count)
        if text.any():
            b = a[text]
            found = np.append(zeros, len(raw))[np.searchsorted(zeros, b)]
            if (found >= ends[live[text]]).any():
                raise ValueError("a tag is cut short")
            on[text] = found - b + 1
        if (on < 0).any():
            raise ValueError("a tag of an unknown type")
        is_md = text & (raw[a - 3] == ord("M")) & (raw[a - 2] == ord("D"))
        start[live[is_md]], size[live[is_md]] = a[is_md], on[is_md] - 1
        at[live] = a + on
        live = live[~is_md & (at[live] + 3 <= ends[live])]
    return start, size


def _strings(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Stretches of the bytes as text; null where a size is below zero."""
    own = np.maximum(sizes, 0)
    offsets = np.concatenate([[0], np.cumsum(own)])
    data = raw[np.repeat(starts - offsets[:-1], own) + np.arange(offsets[-1])]
    valid = pa.py_buffer(np.packbits(sizes >= 0, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(sizes), [valid, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]).cast(pa.string())


def _batch(data: bytes, starts: np.ndarray, names: list[str], tests: list) -> pa.RecordBatch:
    raw = np.frombuffer(data, np.uint8)

    def field(offset: int, kind: str):
        width = np.dtype(kind).itemsize
        return raw[(starts[:, None] + (4 + offset + np.arange(width)))].copy().view(kind).ravel()

    ref, pos, flag = field(0, "<i4"), field(4, "<i4").astype(np.int64) + 1, field(14, "<u2").astype(np.int32)
    columns = {"flag": flag, "mapq": field(9, "u1").astype(np.int32), "pos": pos, "rname": ref, "mapped_pair": (flag & 1 > 0) & (flag & 0xC == 0)}
    keep = np.ones(len(starts), bool)
    for column, test in tests:
        keep &= test(columns[column], names) if column == "rname" else test(columns[column])
    at = np.flatnonzero(keep)
    n_name, n_ops, n_seq = field(8, "u1")[at].astype(np.int64), field(12, "<u2")[at].astype(np.int64), field(16, "<i4")[at].astype(np.int64)
    own = starts[at]
    ends = own + 4 + field(-4, "<i4")[at]
    ops = own + 36 + n_name
    packed = [data[a:z] for a, z in zip(ops.tolist(), (ops + 4 * n_ops).tolist())]
    place = {x: i for i, x in enumerate(dict.fromkeys(packed))}
    text, width, span = zip(*map(_cigar, place)) if place else ((), (), ())
    kind = pa.array(np.fromiter(map(place.__getitem__, packed), np.int64, len(packed)))
    cigar = [pa.array(x, t).take(kind) for x, t in ((text, pa.string()), (width, pa.int32()), (span, pa.int32()))]
    refs = pa.array([*names, "*"], pa.string()).take(pa.array(np.where(ref[at] < 0, len(names), ref[at]), pa.int64()))
    md = _strings(raw, *_md(raw, ops + 4 * n_ops + (n_seq + 1) // 2 + n_seq, ends))
    arrays = [_strings(raw, own + 36, n_name - 1), pa.array(flag[at]), refs, pa.array(pos[at]), pa.array(columns["mapq"][at]), *cigar, md, pa.array(columns["mapped_pair"][at])]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in BAM_COLUMNS.split(", ")])


def bam_records(uri: str, start: int, stop: int, tests: list):
    """Record batches of the records that begin in the blocks from start to stop."""
    with _open(uri) as file:
        try:
            if not file.size():
                raise ValueError("not a BAM file: empty")
            scan = _Scan(file, start, stop)
            if scan.empty:
                return
            names, sizes, skip = _header(file)
            if start == 0:
                scan.need(skip)
                at = skip  # beyond the task's own blocks, if the header is: later tasks then find the records
            else:
                at = _after_header(file, scan, start, skip, sizes)
                if at < 0:
                    return
            scan.drop(at)
            if not scan.own:
                scan.more()
            while scan.own > 0:
                starts, at = [], 0
                while at < scan.own and len(starts) < 50_000:
                    if len(scan.data) < at + 4 and (starts or not scan.need(at + 4)):
                        break
                    size = struct.unpack_from("<i", scan.data, at)[0]
                    if size < 32:
                        raise ValueError(f"a record of {size} bytes")
                    if len(scan.data) < at + 4 + size and (starts or not scan.need(at + 4 + size)):
                        break
                    starts.append(at)
                    at += 4 + size
                if not starts:
                    if scan.more():
                        continue
                    raise ValueError("the file ends inside a record")
                yield _batch(scan.data, np.array(starts, np.int64), names, tests)
                scan.drop(at)
                if not scan.own:  # the next blocks may be the task's as well
                    scan.more()
        except (ValueError, zlib.error) as e:
            raise ValueError(f"{uri}: {e}") from e


def _after_header(file, scan: _Scan, start: int, skip: int, sizes: np.ndarray) -> int:
    """Where a task that doesn't begin with the file begins to read: behind the header, if that reaches so far."""
    blocks, passed = Inflated(file, 0, 1), 0
    while passed < skip and blocks.at < start and blocks._need(18):  # a header of many blocks only
        n = blocks._length()
        blocks._need(n)
        passed += struct.unpack_from("<I", blocks.raw, n - 4)[0]
        blocks._skip(n)
    if passed < skip:
        scan.need(skip - passed)
        return skip - passed
    scan.more()
    return _first_record(scan, sizes)


def _test(f):
    """(column, predicate over its array) of a filter that the source can apply; else None."""
    column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if column == "rname" and isinstance(f, (EqualTo, In)):
        wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
        return column, lambda x, names: np.append([n in wanted for n in names], "*" in wanted)[x]  # -1, no contig, is the last
    if column not in ("flag", "mapq", "pos", "mapped_pair"):
        return None
    if isinstance(f, IsNotNull):
        return column, lambda x: np.ones(len(x), bool)
    if isinstance(f, In):
        values = [v for v in f.value if v is not None]
        return column, lambda x: np.isin(x, values)
    for kind, op in ((EqualTo, np.equal), (EqualNullSafe, np.equal), (GreaterThan, np.greater), (GreaterThanOrEqual, np.greater_equal), (LessThan, np.less), (LessThanOrEqual, np.less_equal)):
        if type(f) is kind and f.value is not None:
            return column, lambda x, op=op, v=f.value: op(x, v)
    return None


class BamReader(DataSourceReader):
    def __init__(self, options):
        self.options, self.filters = dict(options), []

    def pushFilters(self, filters):
        for f in filters:
            if _test(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        return _splits(self.options)

    def read(self, partition):
        uri, start, stop = partition.value
        yield from bam_records(uri, start, stop, [_test(f) for f in self.filters])


class BamSource(DataSource):
    """spark.read.format("bam"): path of a file or folder, splitBytes; files, a JSON list of (uri, size), instead of path."""

    @classmethod
    def name(cls):
        return "bam"

    def schema(self):
        return BAM_COLUMNS

    def reader(self, schema):
        return BamReader(self.options)


# ---- FASTQ -----------------------------------------------------------------------------------------

FASTQ_COLUMNS = "name string, seq string, qual string"


def _begins(lines: list[bytes], i: int) -> bool:
    return lines[i][:1] == b"@" and lines[i + 2][:1] == b"+" and len(lines[i + 1]) == len(lines[i + 3])


def fastq_records(uri: str, start: int, stop: int):
    """Record batches of the four-line records that begin in the blocks from start to stop: behind their first byte, up to the byte after them."""
    with _open(uri) as file:
        scan = _Scan(file, start, stop)
        if scan.empty:
            return
        if start:  # to the first line that begins a record; the line at the edge may be the end of another
            at, lines, places = 0, [], []
            while True:
                cut = scan.data.find(b"\n", at)
                if cut < 0:
                    if scan.more():
                        continue
                    if at >= len(scan.data):
                        return
                    cut = len(scan.data)  # the last line has no end
                if at:
                    places.append(at)
                    lines.append(scan.data[at:cut].removesuffix(b"\r"))
                at = cut + 1
                if len(lines) >= 4 and _begins(lines, len(lines) - 4):
                    at = places[-4]
                    break
                if len(lines) > 8:
                    raise ValueError(f"{uri}: no record of four lines found at byte {start}")
            # What begins with the first byte of a range belongs to the range before, which alone can tell a line's start.
            if at > scan.own:
                return
            scan.drop(at)
        else:
            scan.more()
        while scan.own >= 0:
            lines = scan.data.split(b"\n")
            last = lines.pop()  # without its end as yet
            whole = len(lines) // 4 * 4
            if scan.ended and last:
                lines.append(last)
                whole = len(lines) // 4 * 4
                if whole < len(lines):
                    raise ValueError(f"{uri} ends inside a record")
            sizes = np.cumsum([0] + [len(x) + 1 for x in lines[:whole]])
            own = int(np.searchsorted(sizes[:-1:4], scan.own, "right"))
            rows = [x.removesuffix(b"\r") for x in lines[: 4 * own]]
            for i in range(0, len(rows), 4):
                if not _begins(rows, i):
                    raise ValueError(f"{uri}: not a record: {rows[i : i + 4]}")
            if rows:
                yield pa.RecordBatch.from_pydict({"name": pa.array([x[1:] for x in rows[::4]], pa.binary()).cast(pa.string()), "seq": pa.array(rows[1::4], pa.binary()).cast(pa.string()), "qual": pa.array(rows[3::4], pa.binary()).cast(pa.string())})
            scan.drop(min(int(sizes[4 * own]), len(scan.data)))
            if not own and scan.ended:
                if scan.data.strip():
                    raise ValueError(f"{uri} ends inside a record")
                break
            if not scan.ended:
                scan.more()


class FastqReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        return _splits(self.options)

    def read(self, partition):
        yield from fastq_records(*partition.value)


class FastqSource(DataSource):
    """spark.read.format("bgzf_fastq"): gzip FASTQ, by many tasks a file where it is block-compressed."""

    @classmethod
    def name(cls):
        return "bgzf_fastq"

    def schema(self):
        return FASTQ_COLUMNS

    def reader(self, schema):
        return FastqReader(self.options)


# ---- writing ---------------------------------------------------------------------------------------


def to_blocks(data: bytes, size: int = 0xFF00) -> bytes:
    """data as blocks of at most `size` inflated bytes, without the end block."""
    out = []
    for i in range(0, len(data), size):
        part = data[i : i + size]
        pack = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = pack.compress(part) + pack.flush()
        out.append(END_BLOCK[:16] + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part)))
    return b"".join(out)


def write_part(folder: str, name: str, chunks) -> tuple[str, int]:
    """A file of blocks of the chunks' bytes, under a name of its own until it is whole; where it stands and its size."""
    import uuid

    from pyarrow.fs import FileSystem

    fs, path = FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    part, size = f"{path}/.{uuid.uuid4().hex}.tmp", 0
    with fs.open_output_stream(part, compression=None) as out:
        held = bytearray()
        for chunk in chunks:
            held += chunk
            if len(held) >= PIECE:
                size += out.write(to_blocks(bytes(held)))
                held.clear()
        size += out.write(to_blocks(bytes(held)) + END_BLOCK)
    fs.move(part, f"{path}/{name}")
    return f"{folder}/{name}", size


def bam_record(qname: str, flag: int, ref: int, pos: int, mapq: int, cigar: list[tuple[int, str]], seq_length: int, tags: bytes = b"") -> bytes:
    """A record's bytes: pos counts from 1; sequence and qualities are blank."""
    name = qname.encode() + b"\0"
    ops = b"".join(struct.pack("<I", n << 4 | CIGAR_OPS.index(o)) for n, o in cigar)
    body = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name), mapq, 0, len(cigar), flag, seq_length, -1, -1, 0) + name + ops + bytes((seq_length + 1) // 2) + b"\xff" * seq_length + tags
    return struct.pack("<i", len(body)) + body


HEAD = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("n_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_ops", "<u2"), ("flag", "<u2"), ("n_seq", "<i4"), ("mate", "<i4"), ("mate_pos", "<i4"), ("template", "<i4")])


def _column(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, sizes) of a text column; a null has no bytes."""
    held = pa.array([], pa.binary()) if not len(column) else column.cast(pa.binary())
    offsets = np.frombuffer(held.buffers()[1] or bytes(4), np.int32)[held.offset : held.offset + len(held) + 1].astype(np.int64)
    data = np.frombuffer(held.buffers()[2] or b"", np.uint8)
    return data, offsets[:-1], np.where(np.asarray(held.is_null()), 0, np.diff(offsets))


def _put(out: np.ndarray, at: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
    """Copies stretches of data to places of out."""
    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(at, sizes) + step] = data[np.repeat(starts, sizes) + step]


def bam_bytes(batch: pa.RecordBatch, places: dict[str, int]):
    """What bam_record gives for the rows (qname, flag, rname, pos, mapq, cigar, MD), one after another, some megabytes at a time; places: contigs' numbers."""
    if not batch.num_rows:
        return
    if any(c.null_count for c in batch.columns[:6]):
        raise ValueError("only MD may be null")
    cigar = batch.column(5).dictionary_encode()
    runs = [[(int(n), CIGAR_OPS.index(o)) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", c)] for c in cigar.dictionary.to_pylist()]
    packed = [b"".join(struct.pack("<I", n << 4 | o) for n, o in x) for x in runs]
    kind = cigar.indices.to_numpy(zero_copy_only=False)
    width = np.array([len(x) for x in packed], np.int64)
    reads = np.array([sum(n for n, o in x if CIGAR_OPS[o] in "MIS=X") for x in runs], np.int64)
    all_ops = np.frombuffer(b"".join(packed), np.uint8)
    rname = batch.column(2).dictionary_encode()
    ref = np.array([places[n] for n in rname.dictionary.to_pylist()], np.int64)[rname.indices.to_numpy(zero_copy_only=False)]
    flag, pos, mapq = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 3, 4))
    names, name_at, n_name = _column(batch.column(0))
    mds, md_at, n_md = _column(batch.column(6))
    tags = np.where(np.asarray(batch.column(6).is_null()), 0, 4 + n_md)
    n_ops, n_seq = width[kind], reads[kind]
    limits = ((flag, 0, 0xFFFF), (pos, -(1 << 31) + 1, 1 << 31), (mapq, 0, 0xFF), (n_name, 0, 0xFE), (n_ops // 4, 0, 0xFFFF), (n_seq, 0, (1 << 31) - 1))
    if any((x < low).any() or (x > high).any() for x, low, high in limits):
        raise ValueError("a value that a BAM record can't hold")
    before = HEAD.itemsize + n_name + 1 + n_ops + (n_seq + 1) // 2
    size = before + n_seq + tags
    upto, a = np.cumsum(size), 0
    while a < len(size):
        z = max(a + 1, int(np.searchsorted(upto, upto[a] - size[a] + PIECE, "right")))
        own = slice(a, z)
        out = np.repeat(np.tile(np.array([0, 0xFF, 0], np.uint8), z - a), np.stack([before[own], n_seq[own], tags[own]], 1).ravel())
        at = upto[own] - size[own] - (upto[a] - size[a])
        head = np.zeros(z - a, HEAD)
        for name, value in (("size", size[own] - 4), ("ref", ref[own]), ("pos", pos[own] - 1), ("n_name", n_name[own] + 1), ("mapq", mapq[own]), ("n_ops", n_ops[own] // 4), ("flag", flag[own]), ("n_seq", n_seq[own]), ("mate", -1), ("mate_pos", -1)):
            head[name] = value
        out[at[:, None] + np.arange(HEAD.itemsize)] = head.view(np.uint8).reshape(z - a, HEAD.itemsize)
        _put(out, at + HEAD.itemsize, names, name_at[own], n_name[own])
        _put(out, at + HEAD.itemsize + n_name[own] + 1, all_ops, (np.cumsum(width) - width)[kind[own]], n_ops[own])
        told = np.flatnonzero(tags[own])
        md = (at + before[own] + n_seq[own])[told]
        out[md[:, None] + np.arange(3)] = np.frombuffer(b"MDZ", np.uint8)
        _put(out, md + 3, mds, md_at[own][told], n_md[own][told])
        yield out.tobytes()
        a = z


def bam_header(refs: list[tuple[str, int]], text: str = "@HD\tVN:1.6\n") -> bytes:
    names = b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in refs)
    return b"BAM\1" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(refs)) + names


def register(spark) -> None:
    """Makes both formats known to the session; the module goes to workers by value."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamSource)
    spark.dataSource.register(FastqSource)
