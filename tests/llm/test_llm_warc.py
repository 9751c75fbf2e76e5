"""Archives: round trips and transactions."""

from __future__ import annotations

import gzip
from pathlib import Path

from pyspark.sql import functions as F

from vitrine.llm import warc

PAGES = [(5, "http://a/b c?d#e", "x\r\n\r\ny"), (3, None, "x\r\n\r\ny"), (7, "http://[q", None), (9, "u", ""), (None, "u", ""),
         (3, None, "x\r\n\r\ny"), (11, "é\r\nEvil: 1", "é" * 50_000), (12, "", "WARC/1.1\r\n\r\n")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id long, url string, html string, row int, digest string"
                                 ).repartition(3)


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write_pages(pages(spark), path)
    found = warc.page_ids(warc.captures(warc.read_records(spark, path)))
    got = sorted(((r["page_id"] or 0, r["answer"]["type"], r["refers_to_page"], r["answer"]["payload_bytes"])
                  for r in found.collect()))
    assert got == [(0, "revisit", 7, 0), (3, "response", None, 6), (3, "response", None, 6), (5, "revisit", 3, 6),
                   (7, "response", None, 0), (9, "revisit", 7, 0), (11, "response", None, 100_000), (12, "response", None, 12)]
    whole = {r["page_id"]: r for r in found.collect()}
    assert whole[12]["answer"]["payload"] == b"WARC/1.1\r\n\r\n" and whole[11]["answer"]["payload"].decode() == "é" * 50_000
    assert whole[11]["target_uri"] == "%C3%A9%0D%0AEvil%3A%201".replace("%3A", ":")
    assert all(len(r["requests"]) == 1 and len(r["metadata"]) == 1 for r in whole.values())


def test_small_payloads_are_never_revisits(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write_pages(pages(spark), path, least_revisit=1)
    found = warc.page_ids(warc.captures(warc.read_records(spark, path, payloads=False)))
    assert {r["page_id"] for r in found.where(F.col("answer.type") == "revisit").collect()} == {5}


def test_archives_are_plain_warc(spark, tmp_path):
    path = tmp_path / "out"
    warc.write_pages(pages(spark), str(path))
    records = [r for f in Path(path).glob("*.gz") for r in warc.parse(gzip.decompress(f.read_bytes()))]
    assert len(records) == 3 * len(PAGES)
    assert len({h["warc-record-id"] for h, _ in records}) == len(records)


def test_a_response_may_name_its_request(spark):
    record = "record_id string, type string, concurrent_to string, target_uri string, date string, refers_to string, " \
             "content_type string, payload_digest string, payload_bytes long, block binary, payload binary"
    row = (None,) * 7
    records = spark.createDataFrame([("a", "response", "b", "u", *row), ("b", "request", None, "u", *row),
                                     ("c", "metadata", "a", "u", *row), ("d", "request", "lost", "u", *row)], record)
    (found,) = warc.captures(records).collect()
    assert [r["record_id"] for r in found["requests"]] == ["b"] and [r["record_id"] for r in found["metadata"]] == ["c"]


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write_pages(pages(spark).limit(0), path)
    assert warc.captures(warc.read_records(spark, path)).collect() == []


def plain_archive(n=40):
    return [warc.record([("WARC-Type", "resource"), ("WARC-Record-ID", f"<r{i}>")], bytes([97 + i % 26]) * (i * 997 % 7000)) for i in range(n)]


def read(spark, folder, **files):
    for name, data in files.items():
        (folder / f"{name}.warc.gz").write_bytes(data)
    return sorted(((r["type"], r["record_id"], r["payload_bytes"]) for r in warc.read_records(spark, str(folder)).collect()), key=str)


def test_one_gzip_member_a_record(spark, tmp_path, monkeypatch):
    records = plain_archive()
    whole = sorted((("resource", f"<r{i}>", i * 997 % 7000) for i in range(40)), key=str)
    end = b"\r\n\r\n"
    members = b"".join(gzip.compress(r + end) for r in records)
    single = gzip.compress(b"".join(r + end for r in records))
    for i, data in enumerate((members, single, b"".join(r + end for r in records), gzip.compress(b"") + members)):
        folder = tmp_path / str(i)
        folder.mkdir()
        assert read(spark, folder, a=data) == whole
    monkeypatch.setattr(warc, "FED_BYTES", 7)
    assert [h["warc-record-id"] for h, _ in warc.parse(warc.unpacked(members))] == [f"<r{i}>" for i in range(40)]


def test_broken_archives_keep_what_is_before(spark, tmp_path):
    end = b"\r\n\r\n"
    members = b"".join(gzip.compress(r + end) for r in plain_archive(6))
    wrong = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<w>"), ("Content-Type", "application/http"),
                         ("WARC-Payload-Digest", "sha1:AAAA")], b"HTTP/1.1 200 OK" + end + b"x")
    found = read(spark, tmp_path, cut=members[:-20], foreign=b"GIF89a....", empty=b"", short=b"WARC/1.1\r\nWARC-Type: a\r\nContent-Length: 9\r\n\r\nx",
                 bad=gzip.compress(wrong + end + plain_archive(1)[0] + end))
    assert [f for f in found if f[0] == "broken"] == [("broken", "<w>", None)] + [("broken", None, None)] * 3
    assert sum(f[0] == "resource" for f in found) == 5 + 1
    assert warc.captures(warc.read_records(spark, str(tmp_path))).count() == 6
