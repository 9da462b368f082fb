import base64
import gzip
import hashlib
import io
import os
import zlib

import pytest

from quarry.llm import warc

ROWS = [(1, "http://a/x y", "same"), (2, "http://b", "same"), (3, None, "other"), (4, "http://c", None), (5, "http://d", ""), (0, "http://e", "same"),
        (6, "http://f", "long é " * 300_000), (7, "http://g", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"), (None, "http://h", "same"), (8, "u", "solo"),
        (9, "u", "tie"), (9, "u", "tie"), (None, "v", "nobody"), (None, "v", "nobody")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")


def expected(rows, least=0):
    out = []
    for i, _, html in rows:
        b = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        refers = min(ids) if len(b) >= least and ids and i != min(ids) else None
        out.append((i is None, i or 0, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if refers is not None else "response",
                    -1 if refers is None else refers))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = warc.archive(pages(spark), least).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to)
                  for r in got) == expected(ROWS, least)
    given = {(i, h or "") for i, _, h in ROWS}
    assert all((r.page_id, r.payload.decode()) in given for r in got if r.record_type == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def test_members_stand_alone_and_sidecars_list_them(spark, tmp_path):
    whole = warc.write_archives(pages(spark).repartition(3), str(tmp_path / "whole"))
    index = warc.normalise(whole, str(tmp_path / "records"))
    listed = {(r.path, r.offset, r.length) for r in index.collect()}
    seen = set()
    for name in os.listdir(tmp_path / "records"):
        path = str(tmp_path / "records" / name)
        if not path.endswith(".idx"):
            data = open(path, "rb").read()
            at = 0
            for line in open(path + ".idx"):
                offset, length, kind, _ = line.rstrip("\n").split("\t")
                assert int(offset) == at
                one = zlib.decompressobj(31)
                rec = one.decompress(data[at:at + int(length)])
                assert one.eof and not one.unused_data and rec.startswith(b"WARC/1.1\r\n") and f"WARC-Type: {kind}\r\n".encode() in rec
                seen.add((path, at, int(length)))
                at += int(length)
            assert at == len(data)
    assert seen == listed and len(listed) == len(ROWS)
    for r in whole.collect():   # one gzip stream over the whole file
        data = open(r.path, "rb").read()
        one = zlib.decompressobj(31)
        assert one.decompress(data).count(b"WARC-Record-ID") == r.records and one.eof and not one.unused_data


def test_normaliser_takes_any_gzip_layout(monkeypatch):
    recs = [warc.record(i, f"http://x/{i}", b"p" * n, hashlib.sha1(b"p" * n).hexdigest(), n, None) for i, n in enumerate((0, 10, 5000, 70_000))]
    layouts = [gzip.compress(b"".join(recs)), b"".join(map(gzip.compress, recs)), gzip.compress(recs[0] + recs[1][:50]) + gzip.compress(recs[1][50:] + recs[2] + recs[3])]
    for chunk in (1 << 20, 64):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        for data in layouts:
            out = io.BytesIO()
            rows = list(warc.normalise_stream(io.BytesIO(data), out))
            parts = [zlib.decompress(out.getvalue()[o:o + n], 31) for o, n, _, _ in rows]
            assert parts == recs and [r[3] for r in rows] == [0, 1, 2, 3]
    with pytest.raises(EOFError):
        list(warc.normalise_stream(io.BytesIO(layouts[0][:-40]), io.BytesIO()))


def test_empty_table(spark):
    assert warc.archive(pages(spark, [])).collect() == []
