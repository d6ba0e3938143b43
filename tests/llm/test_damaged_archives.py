"""Archives that are cut short, and members that inflate to far more than they hold."""

import gzip
import zlib

import pytest

from scissile.llm import warc


def put(tmp_path, data):
    (tmp_path / "a.warc.gz").write_bytes(data)
    return f"file://{tmp_path}/a.warc.gz"


def test_a_stream_cut_at_a_record_s_end_is_told(tmp_path):
    records = [warc._record(i, "u", b"p" * 3000, "0" * 40, None) for i in range(3)]
    pack = zlib.compressobj(1, wbits=31)
    cut = pack.compress(records[0]) + pack.flush(zlib.Z_SYNC_FLUSH)
    rest = pack.compress(b"".join(records[1:])) + pack.flush()
    assert len(list(warc.split_records(warc.inflate(put(tmp_path, cut + rest))))) == 3
    for end in (len(cut), len(cut) + len(rest) - 1, len(cut) + len(rest) - 8):
        with pytest.raises(ValueError):
            list(warc.split_records(warc.inflate(put(tmp_path, (cut + rest)[:end]))))


@pytest.mark.parametrize("step", [7, 1 << 20])
def test_pieces_are_bounded(tmp_path, step):
    data = b"\0" * (50 << 20)
    uri = put(tmp_path, gzip.compress(data) + gzip.compress(b"") + gzip.compress(b"tail"))
    sizes = [len(x) for x in warc.inflate(uri, 1 << 20 if step > 7 else 701)]
    assert max(sizes) <= warc.PIECE and sum(sizes) == len(data) + 4


def test_empty_file(tmp_path):
    assert list(warc.inflate(put(tmp_path, b""))) == []
