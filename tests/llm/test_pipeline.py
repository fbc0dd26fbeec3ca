"""The pipeline, stage by stage, against plain versions."""

from __future__ import annotations

import hashlib
import re
import struct

import pytest
from test_bpe import library
from test_forest import brute
from test_pii import plain

import corpus_pipeline as cp
from cadastra.llm import quality
from cadastra.llm.common import remainder, shared_dir, stored


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('pipeline')}"
    docs = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for k, (_, f) in enumerate(cp.STAGES):
        docs.append(stored(f(spark, docs[-1], sf_dir), f"{path}/{k}"))
    return docs


def texts(df) -> dict:
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "near-duplicates", "decontamination", "personal data", "token ids"]
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_quality_keeps_what_scores_well(spark, sf_dir, stages):
    model = quality.fit(stages[0], spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder("doc_id", 5) != 0))
    assert texts(stages[1]) == {k: t for k, t in texts(stages[0]).items() if model.score(t or "") >= quality.THRESHOLD}


def test_one_document_of_each_group_stays(stages):
    before = texts(stages[1])
    assert texts(stages[2]) == {k: before[k] for k, (_, name) in brute(before, 5).items() if k == name}


def test_benchmark_passages_go(spark, sf_dir, stages):
    tokens = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    items = [tokens(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = texts(stages[2]), texts(stages[3])
    whole = {k for k, t in before.items() if any(f" {i} " in f" {tokens(t)} " for i in items)}
    assert not whole & set(after) and len(before) - len(after) <= len(whole) + 1


def test_personal_data_is_masked(stages):
    before = texts(stages[3])
    for k, t in texts(stages[4]).items():
        spans = [(int(a), int(b), kind) for kind, a, b in (s.split(":") for s in plain(before[k] or "").split(",") if s)]
        out, at = "", 0
        for a, b, kind in spans:
            if a >= at:
                out += before[k][at:a] + f"[{kind.upper()}]"
            at = max(at, b)
        assert t == (None if before[k] is None else out + before[k][at:])


def test_token_ids(stages):
    theirs, before = library(), texts(stages[4])
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(before)
    for r in rows:
        ids = theirs.encode(before[r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.token_ids) == ids and r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_one_row_stays_without_or_with_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(None, a), (None, a + " more"), (None, b), (None, b), (7, c), (7, c), (7, c + " more"), (3, d), (None, d), (None, None), (None, None), (7, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    out = cp.drop_near_duplicates(spark, docs, "").collect()
    left = [(r.doc_id, (r.text or " ")[0]) for r in out]
    assert sorted(left, key=str) == sorted([(None, "a"), (None, "b"), (7, "c"), (3, "d"), (None, " "), (None, " "), (7, " ")], key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k string, th int, spans string, score double, `group` string, item int"


@pytest.fixture
def edges(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, and columns named as the stages' own."""
    long = " ".join(f"word{i % 997} and x{i}" for i in range(60_000))
    text = " ".join(f"the quiet river number {i} runs to the sea" for i in range(30))
    rows = [(1, text), (1, text), (2, text + " again"), (None, text), (None, None), (3, None), (4, ""), (5, " \n\t "), (6, long), (7, "mail a@b.cd or 10.0.0.1 " * 3)]
    every = [(i, t, "en", "s", len(t or ""), "k", 1, "s", 0.5, "g", 2) for i, t in rows] + [(None,) * 11, (8, "plain text of a few words", *[None] * 9)]
    return spark.createDataFrame(every, SCHEMA)


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_edges_and_empty_tables(spark, sf_dir, edges, stage):
    name, f = cp.STAGES[stage]
    none = f(spark, edges.where("false"), sf_dir)
    assert none.count() == 0
    out = f(spark, edges, sf_dir)
    rows, before = out.collect(), edges.collect()
    if stage < 4:
        assert out.columns == list(cp.COLUMNS) and none.columns == list(cp.COLUMNS)
    if name == "near-duplicates":
        # the texts of one river are one group, of which the least id stays, once; texts without words are in no group
        assert sorted((r.doc_id or 0) for r in rows if (r.text or "").startswith("the quiet")) == [1]
        assert sum(not (r.text or "").strip() for r in rows) == sum(not (r.text or "").strip() for r in before)
        assert {6, 7, 8} <= {r.doc_id for r in rows}
    elif name in ("decontamination", "personal data"):
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in before)
        masked = [r.text for r in rows if r.doc_id == 7]
        assert masked == (["mail [EMAIL] or [IP] " * 3] if name == "personal data" else ["mail a@b.cd or 10.0.0.1 " * 3])
    elif name == "token ids":
        assert len(rows) == len(before) and {len(r.token_ids) for r in rows if r.doc_id in (3, 4)} == {0}
        assert next(r for r in rows if r.doc_id == 6).n_tokens > 100_000
    else:
        assert len(rows) <= len(before) and all(r.doc_id is None or r.doc_id < 9 for r in rows)


def test_stages_give_memory_back(spark, sf_dir):
    """Each stage begins with a heap that gave back what is free in it."""
    docs = stored(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20), f"{shared_dir(spark)}/few")
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    whole = lambda: sum(b.getCollectionCount() for b in beans if "Young" not in b.getName() and "Concurrent" not in b.getName())
    for name, f in cp.STAGES:
        before = whole()
        f(spark, docs, sf_dir)
        assert whole() > before, name


def test_workers_give_memory_back():
    """What another operator had kept isn't just free for the worker, but the machine's again, even if something newer lies behind it."""
    import subprocess
    import sys

    code = """
import psutil
from cadastra.llm.held import held
size = lambda: psutil.Process().memory_info().rss >> 20
before = size()
held(("large",), lambda: [bytes(2000) for _ in range(100_000)])
behind = [bytes(2000) for _ in range(100)]
between = size()
held(("small",), dict)
print(between - before, size() - before)
"""
    # in a process of its own, where no other test has left anything free
    grown, left = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert grown > 150 and left < 50
