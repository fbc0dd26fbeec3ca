"""Overlaps with substitutions are found along a diagonal; others aren't."""

from __future__ import annotations

from cadastra.llm import decontaminate as dc

ITEM = "the council measured every northern parcel twice before the spring flood and wrote down each corner stone by hand"
WORDS = ITEM.split()


def changed(*at: int) -> str:
    return " ".join("other" if i in at else w for i, w in enumerate(WORDS))


def found(spark, shared, texts, items):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, item int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {r.k: (r["items"], r.matched) for r in dc.flagged(dc.overlaps(docs, bench, shared)).collect()}


def test_overlaps(spark, shared):
    texts = [ITEM, "before it " + changed(4, 11) + " after", ITEM.upper().replace(" ", ", "), "x " * 50 + " ".join(WORDS[3:16]) + " y" * 50, changed(2, 4, 6, 8, 10, 12, 14, 16), " ".join(WORDS[:6]), "nothing of it at all", None, "", " ".join(reversed(WORDS)), (ITEM + " ") * 40]
    got = found(spark, shared, texts, [(7, ITEM), (8, ITEM), (9, "too short"), (10, None)])
    assert set(got) == {0, 1, 2, 3, 10}
    assert got[0] == ("7,8", len(WORDS)) and got[1] == ("7,8", len(WORDS) - 2) and got[3] == ("7,8", 13)


def test_empty_tables(spark, shared):
    assert found(spark, f"{shared}/a", [], [(1, ITEM)]) == {}
    assert found(spark, f"{shared}/b", [ITEM], []) == {}


def test_all_that_counts_has_a_hit(spark, shared):
    """Every way to replace 1 of 10, 1 of 11 and 2 of 12 tokens of a lone passage; any longer overlap has one of these in it."""
    from itertools import combinations

    cases = [(n, bad) for n, most in ((10, 1), (11, 1), (12, 2)) for bad in combinations(range(n), most)]
    items = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in (10, 11, 12)]
    texts = [" ".join("other" if i in bad else f"w{n}x{i}" for i in range(n)) for n, bad in cases]
    got = found(spark, shared, texts, items)
    assert {k: v[0] for k, v in got.items()} == {k: str(n) for k, (n, _) in enumerate(cases)}


def test_short_items_are_looked_up_whole(spark, shared):
    texts = ["so we ask: What is the CAPITAL of France? yes", "what is the capital of spain", "what is the capital of", "word", "a sword"]
    assert found(spark, shared, texts, [(1, "What is the capital of France"), (2, "word")]) == {0: ("1", 6), 3: ("2", 1)}
