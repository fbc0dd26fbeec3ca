"""Order of jobs, reruns and skips; versions, digests and manifests; versions of address text."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cadastra.functions import addresses as ad
from cadastra.operators import delivery as dl
from cadastra.plans import lineage as li


def test_jobs_in_order():
    g = li.Graph()
    a, b, c, d = (li.Job(s, r, "US") for s, r in (("ingest", "p"), ("harmonize", "p"), ("curate", "p"), ("harmonize", "q")))
    g.add(c, [b, d])
    g.add(b, [a])
    assert g.order() == [a, d, b, c]
    assert g.after([a]) == {a, b, c} and g.before(c) == {a, b, d}
    g.add(a, [c])
    with pytest.raises(ValueError, match="need each other"):
        g.order()


def test_reruns_and_skips():
    assert li.needs_rerun({"o": 1.0}, {"i": 2.0}) and li.needs_rerun({"o": None}, {}) and not li.needs_rerun({"o": 3.0}, {"i": 2.0})
    with pytest.raises(FileNotFoundError):
        li.needs_rerun({"o": 1.0}, {"i": None})
    job = li.Job("curate", "p", "US")
    old = li.record(job, "code", {"t": {"a": "1"}})
    assert li.can_skip(old, li.record(job, "code", {"t": {"a": "1", "b": "9"}}))
    assert not li.can_skip(old, li.record(job, "code", {"t": {"a": "2"}})) and not li.can_skip(old, li.record(job, "other", {"t": {"a": "1"}})) and not li.can_skip(None, old)


def test_names_and_paths():
    assert li.attribute_of("land_value_source") == "land_value" and li.attribute_of("lat") == "lat"
    recipes = [{"id": "a1", "entity": "parcel", "stage": "ingest", "scope": "US"}, {"id": "a2", "entity": "parcel", "stage": "ingest", "scope": "US-PA"}, {"id": "a3", "entity": "parcel", "stage": "ingest", "scope": "US-PA"}]
    assert li.best_recipe(recipes, "parcel", "US-PA-X", "ingest") == "a3" and li.best_recipe(recipes, "parcel", "US-NC", "ingest") == "a1" and li.best_recipe(recipes, "parcel", "DE", "ingest") is None
    assert li.output_path("/data/", recipes[0], "US-PA", layer="units") == "/data/US/PA/parcel/ingest/a1/units"


def test_versions_and_manifest(spark):
    day = date(2026, 1, 2)
    assert dl.next_version(day, []) == "20260102" and dl.next_version(day, ["20260102", "20260102a"]) == "20260102b"
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    m = dl.manifest("v", datetime(2026, 1, 2), {"t": df, "none": df.limit(0)}, region="US")
    assert m["tables"]["t"]["rows"] == 2 and m["region"] == "US" and m["tables"]["none"]["rows"] == 0
    moved = spark.createDataFrame([(2, "a"), (1, None)], "i int, s string")
    assert dl.same_columns(dl.digests(df), dl.digests(moved)) and not dl.same_columns(dl.digests(df, ["i"]), dl.digests(moved, ["i"]))
    with pytest.raises(ValueError, match="older"):
        dl.refuse_stale(spark.createDataFrame([("o", "i", 1)], "output string, input string, built int"), spark.createDataFrame([("i", 2)], "input string, built int"))


def test_address_edges(spark):
    rows = spark.createDataFrame([(0, None), (1, ""), (2, "12 Oak St, Springfield"), (3, "Oak St"), (4, "12-14a Oak St #5, Springfield, il 62704-1234"), (5, "1 A St; 2 B St + 3 C St"), (6, "5 Main  St   APT.5"), (7, "704 706; 716B")], "i int, t string")
    t = F.col("t")
    out = {r.i: r for r in rows.select("i", ad.parse_line(t).alias("p"), ad.split_list(t).alias("s"), ad.without_unit(t).alias("w"), ad.number_list(t).alias("n"), ad.clean(t).alias("c")).collect()}
    assert out[0].s is None and out[0].w is None and out[0].n is None and out[0].c == ""
    assert out[1].s == [""] and out[2].p.city == "Springfield" and out[2].p.state is None and out[3].p.address_number is None and out[3].p.address_street == "Oak St"
    assert (out[4].p.address_number, out[4].p.unit_number, out[4].p.city, out[4].p.state, out[4].p.postal_code) == ("12-14A", "#5", "Springfield", "IL", "62704-1234")
    assert out[5].s == ["1 A St", "2 B St", "3 C St"] and out[6].w == "5 Main  St" and out[7].n == "704-716"


def test_similarity_against_plain_subsequences(spark):
    def plain(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return 200.0 * table[-1][-1] / (len(a) + len(b)) if a or b else 100.0

    pairs = [("", ""), ("a", ""), ("main street", "maine st"), ("été 12", "ete 12"), ("abcabba", "cbabac"), ("x" * 90, "y" * 5 + "x" * 70), (None, "a")]
    got = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(ad.similarity(F.col("a"), F.col("b"))).collect()]
    assert got[-1] is None and got[:-1] == pytest.approx([plain(a, b) for a, b in pairs[:-1]])
