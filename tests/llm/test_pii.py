"""Base spans against plain regular expressions; discovery on a small corpus."""

from __future__ import annotations

import hashlib
import re

import pytest

from cadastra.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text: str) -> str:
    found = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if good(kind, m[0]))
    return ",".join(f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in found)


HARD = [
    None,
    "",
    "a@b.c_d@e.f x@y z@-.- a@b..c @a.b .@a.b",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3 1.2.3.0000000000000000000256 99999999999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 411111111111 4111  1111 5 4",
    "+1 (523) 555-1055 +1 +12 +1() 5 +123456789 call +1 523 555 1055. +++1 523 555 1055",
    "naïve 😀 a.b@c.de 😀😀 10.0.0.1 +49 30 1234567",
    "x" * 900 + "@" + "1" * 700 + " " + "a.b" * 300 + "@c.d" + ".e" * 300,
    "1 " * 400 + "+1" + " 2" * 200,
]
LONG = ["x" * 200_000 + "@" + "1" * 50_000 + " a@b.cd " + "a.b" * 30_000 + "@c.d" + ".e" * 30_000, "1 " * 40_000 + "+1" + " 2" * 20_000 + " 10.0.0.1", "w " * 300_000 + "a@b.cd"]


@pytest.mark.parametrize("tail", ["", " z"])
def test_base_spans_equal_plain_expressions(spark, shared, tail):
    texts = [t if t is None else t + tail for t in HARD]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    rows = pii.personal_data(docs, shared).select("k", pii.joined(pii.F.col("base")).alias("base")).collect()
    assert {r.k: r.base for r in rows} == {i: plain(t or "") for i, t in enumerate(texts)}


def test_very_long_texts_are_linear(spark, shared):
    docs = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string")
    found = {r.k: r.base for r in pii.personal_data(docs, shared).select("k", pii.joined(pii.F.col("base")).alias("base")).collect()}
    assert found[0] == f"email:250002:250008,email:250009:{len(LONG[0])}"
    assert found[1] == f"ip:{len(LONG[1]) - 8}:{len(LONG[1])}"
    assert found[2] == f"email:600000:600006"


def test_discovery_follows_contexts_and_leaves_others(spark, shared):
    rows = [f"dear all write to client mail u{i}@site{i}.example now" for i in range(8)]
    rows += ["dear all write to client mail u9(at)site9 now", "we met in room b1234 and then in room c5678 again", "version 2.0.17 of it"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.k: r.spans for r in pii.personal_data(docs, shared).select("k", pii.joined(pii.F.col("spans")).alias("spans")).collect()}
    start = rows[8].index("u9")
    assert found[8] == f"email:{start}:{start + len('u9(at)site9')}"
    assert found[9] == found[10] == ""
    assert all(found[i].startswith("email:") and "," not in found[i] for i in range(8))


def test_empty_table_and_repeated_rows(spark, shared):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.personal_data(none, f"{shared}/a").count() == 0
    same = spark.createDataFrame([(None, "mail a@b.cd"), (None, "mail a@b.cd"), (1, None)], "doc_id long, text string")
    out = pii.personal_data(same, f"{shared}/b").select("k", pii.joined(pii.F.col("spans")).alias("spans")).collect()
    assert sorted((r.k is None, r.spans) for r in out) == [(False, ""), (True, "email:5:11"), (True, "email:5:11")]


def test_redaction(spark, shared):
    docs = spark.createDataFrame([(1, "😀 a@b.cd and 10.0.0.1."), (2, "clean")], "doc_id long, text string")
    found = pii.personal_data(docs, shared)
    out = docs.join(found, docs.doc_id == found.k).select("doc_id", pii.redacted(pii.F.col("text"), pii.F.col("spans")).alias("t")).collect()
    assert {r.doc_id: r.t for r in out} == {1: "😀 [EMAIL] and [IP].", 2: "clean"}


def test_hash_of_no_spans():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


@pytest.mark.parametrize("steps", [1, 5])
def test_discovered_instances_support_new_patterns(spark, shared, steps):
    """A chain: seeds, a pattern, instances, the next pattern, and so on; what only the last pattern precedes is found."""
    names = ["alpha", "beta", "gamma", "delta", "kappa", "sigma"][: steps + 1]
    rows = [f"note alpha code u{i}@site{i}.example end" for i in range(12)]
    for j, (a, b) in enumerate(zip(names, names[1:], strict=False)):
        for i in range(4):
            rows += [f"note {a} code k{j}{i}zz end"] + [f"note {b} code k{j}{i}zz end"] * 3
    rows += [f"note {names[-1]} code last77 end", "note omega code other88 end"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.k: r.spans for r in pii.personal_data(docs, shared).select("k", pii.joined(pii.F.col("spans")).alias("spans")).collect()}
    start = rows[-2].index("last77")
    assert found[len(rows) - 2] == f"email:{start}:{start + 6}" and found[len(rows) - 1] == ""
    assert all(v for k, v in found.items() if k < len(rows) - 1)


def test_contexts_equal_plain_python(spark):
    """Adjacent mentions, words longer than what is looked at first, white space of all kinds, and too few words."""
    texts = ["ref code 12345 67890 A1B2C3 x", "w" * 900 + " " + "v" * 300 + " 12345", "12345 one 67890", "a\n\tb  12345,67890;a1@b2.cd,9.9.9.9", "a b " + "y" * 500 + "12345@x.yz 1.2.3.4", "x@y.zz" * 60 + " 12345 " + "x@y.zz," * 60, " 😀 é 12345", "nix"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    rows = pii.with_base(docs, "text", "base", "candidates").collect()
    seen = 0
    for r in rows:
        for m in [*r.base, *r.candidates]:
            words = re.findall(r"\S+", texts[r.i][: m.start] if "before" in m else "")
            # of the candidate with quotes or brackets around it, what precedes these counts
            want = " ".join(words[-2:]) if len(words) > 1 else ""
            assert " ".join(m.before.split()) == want, (r.i, m)
            seen += 1
    assert seen > 100
