import gzip
import hashlib
import base64
import io

import pytest

from strata.llm import warc
from strata.llm.queries import op2_warc_normaliser
from strata.session import new_scratch, ship_package

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id bigint, url string, html string, payload_digest string, sha string"


def pages(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def expected(rows):
    best = {}
    for p, _, h in rows:
        key = h or ""
        best[key] = max(best.get(key, -1), -1 if p is None else p)
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        top = best[h or ""]
        response = p == top or top == -1
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if response else "revisit", None if response else top))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_round_trip_with_edges(spark):
    rows = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://ü/ \r\nEvil: 1", "x"), (4, "u", None), (5, "u", ""), (6, "u", "é" * 300_000),
            (7, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"), (8, "u", "y"), (8, "u", "y"), (None, "u", "x"), (None, "u", "z")]
    df = warc.warc_round_trip(pages(spark, rows)).cache()
    assert result(df) == expected(rows)
    payloads = {r.page_id: r.payload for r in df.collect()}
    assert bytes(payloads[6]).decode() == rows[5][2] and bytes(payloads[7]).decode() == rows[6][2] and payloads[1] is None
    assert {r.page_id: r.url for r in df.collect()}[3] == rows[2][1]


def test_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert result(op2_warc_normaliser(spark, SF)) == expected(rows)


def test_empty_table(spark):
    assert warc.warc_round_trip(pages(spark, [])).count() == 0


def test_members_and_sidecar(spark):
    rows = [(i, f"http://h/{i}", f"body {i % 7}" * i) for i in range(50)]
    manifest = warc.write_archives(warc.plan_records(pages(spark, rows)))
    index = warc.normalise_archives(manifest, new_scratch(spark, "t"))
    got = index.collect()
    assert len(got) == 50
    for path in {r.archive for r in got}:
        raw, lines = open(path, "rb").read(), open(path + ".idx").read().splitlines()
        own = sorted((r.offset, r.length) for r in got if r.archive == path)
        assert [tuple(map(int, x.split("\t")[:2])) for x in lines] == own
        assert own[0][0] == 0 and sum(n for _, n in own) == len(raw)
        records = [gzip.decompress(raw[a:a + n]) for a, n in own]
        assert all(r.startswith(b"WARC/1.1\r\n") for r in records) and gzip.decompress(raw) == b"".join(records)
    for r in manifest.collect():  # one member: nothing is left behind its end
        import zlib
        z = zlib.decompressobj(31)
        z.decompress(open(r.archive, "rb").read())
        assert z.eof and not z.unused_data


def test_damaged_streams():
    whole = gzip.compress(b"a" * 1000)
    assert b"".join(warc.inflate(io.BytesIO(whole + gzip.compress(b"b")))) == b"a" * 1000 + b"b"
    with pytest.raises(ValueError):
        list(warc.inflate(io.BytesIO(whole[:-9])))
    with pytest.raises(ValueError):
        list(warc.split_records(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])))
    record = warc.render(1, "u", b"p" * 10, "S", None, False)
    assert list(warc.split_records(record[i:i + 1] for i in range(len(record)))) == [record]
