"""Archives: round trip, shared payloads, odd rows."""

import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.shipping import ship
from tidemark.scratch import Scratch


def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def run(spark, rows, least=0):
    pages = ship(spark).createDataFrame(rows, "page_id long, url string, html string, size int")
    folder = f"{Scratch(spark).root}/archives"
    warc.write_archives(pages, folder, least)
    return folder, warc.read_archives(spark, folder)


ROWS = [
    (5, "http://a/", "same", 1), (3, "http://b/\r\nX-Evil: 1", "same", 1), (9, None, "same", 1), (1, "http://c/", "", 1),
    (2, "http://c/", None, 1), (4, "u", "trick\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n", 1),
    (6, "u", "é東🎉" * 5000, 1), (6, "u", "é東🎉" * 5000, 1), (None, "u", "same", 1), (None, "u", "alone", 1),
]


def test_round_trip(spark):
    folder, records = run(spark, ROWS)
    found = records.collect()
    assert len(found) == len(ROWS)
    by_page = {}
    for r in found:
        by_page.setdefault(r.page_id, []).append(r)
    assert [by_page[i][0].record_type for i in (3, 5, 9, 1, 2, 4)] == [
        "response", "revisit", "revisit", "response", "revisit", "response"]
    assert by_page[5][0].refers_to == by_page[9][0].refers_to == 3 and by_page[2][0].refers_to == 1
    assert [r.record_type for r in by_page[6]] == ["response"] * 2
    assert {(r.record_type, r.refers_to) for r in by_page[None]} == {("revisit", 3), ("response", None)}
    for page, _, html, _ in ROWS:
        for r in by_page[page]:
            if r.record_type == "response" and page is not None:
                assert bytes(r.payload).decode() == (html or "") and r.payload_digest == sha(html or "")
    assert by_page[3][0].target_uri == "http://b/%0D%0AX-Evil: 1" and by_page[9][0].target_uri is None


def test_small_payloads_are_not_shared(spark):
    _, records = run(spark, ROWS, least=4)
    assert {r.record_type for r in records.collect() if r.page_id in (1, 2)} == {"response"}


def test_resolved_revisits_have_the_length_of_their_original(spark):
    heads = spark.createDataFrame(
        [(3, "response", "D", 4), (5, "revisit", "D", None), (1, "response", "E", 0)],
        "page_id long, record_type string, payload_digest string, payload_bytes long")
    assert {tuple(r) for r in warc.resolved(heads).collect()} == {
        (3, 4, "D", "response", None), (5, 4, "D", "revisit", 3), (1, 0, "E", "response", None)}


def test_empty_table_and_many_members(spark):
    _, records = run(spark, [])
    assert records.count() == 0
    block = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    many = gzip.compress(block) + gzip.compress(block * 2)
    assert [b for _, b in warc._records(many)] == [b"ab"] * 3


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    import gzip

    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 16)
    sizes = [10] * 100 + [5_000] * 40 + [30_000] * 8 + [200_000]
    pages = [(i, f"http://a/{i}", str(i).ljust(n, "x")) for i, n in enumerate(sizes)] + [(900, "http://a/r", str(110).ljust(5_000, "x"))]
    folder = str(tmp_path / "archives")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(1), folder)
    files = [len(gzip.decompress(f.read_bytes())) for f in (tmp_path / "archives").glob("*.gz")]
    assert sorted(files)[-2] < 2 << 16 and max(files) < 200_000 + (1 << 16) and 10 < len(files) < 60
    found = {r.page_id: r.payload for r in warc.read_archives(spark, folder).select("page_id", "payload").collect()}
    assert len(found) == len(pages) and found.pop(900) is None
    assert {k: bytes(v) if not isinstance(v, str) else v.encode() for k, v in found.items()} == {i: h.encode() for i, _, h in pages[:-1]}


def test_digests_hash_a_payload_once(spark):
    texts = ["", "a", "é東🎉", "x" * 5000] + [f"text {i}" for i in range(500)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", warc.base32_sha1(F.col("t")).alias("d"))
    assert {r.t: r.d for r in df.collect()} == {t: sha(t) for t in texts} | {None: None}
    assert str(df._jdf.queryExecution().optimizedPlan()).count("sha1(") == 1
