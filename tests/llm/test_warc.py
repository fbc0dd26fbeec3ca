"""Round trip of archives; revisits; coalesced ranges."""

from __future__ import annotations

import hashlib

from cadastra.llm import warc

BIG = "<p>" + "é" * 700 + "</p>"
ROWS = [(1, "http://a/x y\r\nZ: 1", BIG), (2, "http://b", BIG), (3, None, BIG), (4, "http://c", "small"), (5, "http://d", "small"), (6, "http://e", None), (7, "http://f", ""), (8, "http://g", "z" * 300_000), (8, "http://g", "z" * 300_000), (None, "http://h", "q" * 2000), (None, "http://i", BIG)]


def test_write_and_read_back(spark, shared):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, digest string").repartition(3)
    index = warc.write(pages, shared)
    found = warc.read(index, shared, payloads=True).collect()
    assert index.count() == len(found) == len(ROWS)
    assert sorted((r.key or 0, r.payload_bytes, r.payload_digest) for r in found) == sorted((k or 0, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for k, _, h in ROWS)
    kinds = {(r.key, r.payload_bytes): (r.record_type, r.refers_to) for r in found}
    big = len(BIG.encode())
    assert kinds[1, big] == kinds[2, big] == kinds[None, big] == ("revisit", 3)
    assert all(kind == ("response", None) for k, kind in kinds.items() if k[1] != big or k[0] == 3)
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    assert {bytes(r.payload).decode() for r in found if r.key == 8} == {"z" * 300_000}


def test_selected_records_only(spark, shared):
    pages = spark.createDataFrame([(i, f"http://{i}", f"page {i}") for i in range(50)], "page_id long, url string, html string").coalesce(1)
    index = warc.write(pages, shared)
    some = warc.read(index.where("key % 7 = 3"), shared).collect()
    assert sorted(r.key for r in some) == [3, 10, 17, 24, 31, 38, 45]


def test_empty_table(spark, shared):
    index = warc.write(spark.createDataFrame([], "page_id long, url string, html string"), shared)
    assert warc.read(index, shared).count() == 0


def test_ranges_join_neighbours_only():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 1000, 5), ("b", 0, 5)]
    assert list(warc.ranges(rows, gap=8, most=100)) == [("a", 0, 30, [0, 1, 2]), ("a", 1000, 1005, [3]), ("b", 0, 5, [4])]
    assert [r[3] for r in warc.ranges(rows, gap=8, most=20)] == [[0, 1], [2], [3], [4]]


def test_urls_come_back_and_revisits_name_their_response(spark, shared):
    urls = ["http://a/b%20c", "http://a/b c", "http://a/é?q=%C3%A9&x=1", "http://a/\t\r\nX: 1%", "", None, "http://a/100%"]
    pages = spark.createDataFrame([(i, u, BIG) for i, u in enumerate(urls)], "page_id long, url string, html string").coalesce(2)
    index = warc.write(pages, shared)
    assert {r.key: r.url for r in warc.read(index, shared).collect()} == {i: u or "" for i, u in enumerate(urls)}
    first = warc.record_bytes(6, "http://x", b"p", "response", None, 1, "d")
    later = warc.record_bytes(2, "http://y", b"", "revisit", 6, 1, "d")
    said = warc.parse(first)[0]["WARC-Record-ID"]
    assert warc.parse(later)[0]["WARC-Refers-To"] == said != warc.parse(later)[0]["WARC-Record-ID"]


def test_a_tie_on_the_largest_key(spark, shared):
    """Rows with the largest key and other URLs are all responses; others refer to that key."""
    pages = spark.createDataFrame([(5, "http://a", BIG), (5, "http://b", BIG), (4, "http://c", BIG)], "page_id long, url string, html string")
    found = warc.read(warc.write(pages, shared), shared).collect()
    assert sorted((r.key, r.record_type, r.refers_to) for r in found) == [(4, "revisit", 5), (5, "response", None), (5, "response", None)]


def test_op2_gives_memory_back(spark, sf_dir):
    """What earlier jobs left free in the heap is the machine's again before the query's first job, and before archives are read back."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    whole = lambda: sum(b.getCollectionCount() for b in beans if "Young" not in b.getName() and "Concurrent" not in b.getName())
    before = whole()
    warc.op2(spark, sf_dir)
    assert whole() - before >= 2
