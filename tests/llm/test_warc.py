import base64
import gzip
import hashlib

import pytest

from faresight.llm import warc
from faresight.llm.registry import op9_warc
from faresight.session import scratch_path
from tests.conftest import SF_SMALL

DDL = "page_id long, url string, html string, chunk int"
SMALL = warc.WarcPlan(chunk_bytes=1000)


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, least=0):
    first = {}
    for r in rows:
        body = (r["html"] or "").encode()
        if r["page_id"] is not None and len(body) >= least:
            first[body] = min(first.get(body, r["page_id"]), r["page_id"])
    out = []
    for r in rows:
        body = (r["html"] or "").encode()
        lead = first.get(body, r["page_id"]) if r["page_id"] is not None and len(body) >= least else r["page_id"]
        again = lead != r["page_id"]
        out.append((r["page_id"], len(body), b32(body), "revisit" if again else "response", lead if again else None))
    return sorted(out, key=str)


def test_query(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert sorted(map(tuple, op9_warc(spark, SF_SMALL).collect()), key=str) == expected(pages)


@pytest.mark.parametrize("least", [0, 5])
def test_cases(spark, least):
    rows = [(1, "http://a/", None, 0), (2, None, "", 0), (3, "http://b/é\n", "same", 0), (4, "u", "same", 0), (4, "u", "same", 0),
            (4, "u", "different", 0), (None, "u", "same", 0), (9, "u", "WARC/1.1\r\n\r\n" * 400, 0),
            (8, "u", "ü" * 50_000, 0), (10, "u", "ü" * 50_000, 0), (11, "u", "x" * 1000, 0), (12, "u", "x" * 2000, 0)]
    pages = spark.createDataFrame(rows, DDL)
    plan = warc.WarcPlan(chunk_bytes=1000, min_bytes=least)
    got = warc.archive_round_trip(spark, pages, plan).collect()
    assert sorted(map(tuple, got), key=str) == expected(pages.collect(), least)
    assert warc.archive_round_trip(spark, pages.limit(0)).collect() == []


def test_chunks_carry_running_digests_and_make_the_payload(spark):
    body = "".join(chr(97 + i % 26) for i in range(5500))
    pages = spark.createDataFrame([(1, "u", body, 0), (2, "u", body, 0), (3, "u", "", 0)], DDL)
    folder = scratch_path(spark, "warc-test")
    index = warc.write_archives(spark, pages, folder, SMALL)
    rows = sorted(warc.read_archives(index, folder, SMALL).collect(), key=lambda r: (r["page_id"], r["chunk"]))
    own = [r for r in rows if r["page_id"] == 1]
    assert [r["chunk"] for r in own] == list(range(6)) and [r["last"] for r in own] == [False] * 5 + [True]
    data = b""
    for r in own:
        data += bytes(r["data"])
        assert len(r["data"]) <= 1000 and r["payload_bytes"] == len(data) and r["payload_digest"] == b32(data)
    assert data.decode() == body
    assert [(r["record_type"], r["refers_to"], r["data"]) for r in rows if r["page_id"] == 2] == [("revisit", 1, None)]
    assert [bytes(r["data"]) for r in rows if r["page_id"] == 3] == [b""]


def test_files_are_plain_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>é</p>", 0)], DDL).coalesce(1)
    folder = scratch_path(spark, "warc-test")
    [row] = warc.write_archives(spark, pages, folder).collect()
    store, path = warc.open_store(folder)
    raw = gzip.decompress(store.open_input_file(f"{path}/{row['file']}").read())
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    assert head.startswith(b"WARC/1.1\r\n") and fields["WARC-Type"] == "response"
    assert rest.endswith(b"\r\n\r\n") and len(rest) == int(fields["Content-Length"]) + 4
    assert rest[:-4].endswith("<p>é</p>".encode())


def test_a_damaged_payload_is_an_error(spark):
    pages = spark.createDataFrame([(1, "u", "payload", 0)], DDL).coalesce(1)
    folder = scratch_path(spark, "warc-test")
    [row] = warc.write_archives(spark, pages, folder).collect()
    store, path = warc.open_store(folder)
    raw = gzip.decompress(store.open_input_file(f"{path}/{row['file']}").read()).replace(b"payload\r\n", b"pAyload\r\n")
    with store.open_output_stream(f"{path}/bad.gz", compression=None) as f:
        f.write(gzip.compress(raw))
    file = store.open_input_file(f"{path}/bad.gz")
    with pytest.raises(ValueError, match="differs from its digest"):
        list(warc.read_record(file, 0, file.size(), 1000, True))
