"""Near duplicates against brute force, also with regions and groups so small that every branch is taken."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from cadastra.llm import forest
from cadastra.llm import shingles as sh


def brute(docs: dict, width: int) -> dict:
    sets = {}
    for k, t in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    name = {k: k for k in docs}
    for _ in docs:
        changed = False
        for a in docs:
            for b in docs:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]) and name[a] != name[b]:
                    name[a] = name[b] = min(name[a], name[b])
                    changed = True
        if not changed:
            break
    return {k: (len(sets[k]), name[k]) for k in docs}


def corpus() -> dict:
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    base = [[word() for _ in range(rng.randint(30, 120))] for _ in range(12)]
    texts = [" ".join(b) for b in base]
    for b in base[:6]:
        for _ in range(8):
            copy = list(b)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper(), None, "", " \t\n ", "one", "One", "one two", "one two three four", "é é é é é", "É é é é é", "w " * 5000]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize(("region", "group", "members", "queries"), [(4096, 256, 512, 256), (2, 1, 3, 2)])
def test_components_equal_brute_force(spark, shared, monkeypatch, region, group, members, queries):
    docs = corpus()
    edges = forest.forest_edges
    monkeypatch.setattr(forest, "forest_edges", lambda units: edges(units, region))
    monkeypatch.setattr(forest, "GROUP", group)
    monkeypatch.setattr(forest, "MEMBERS", members)
    monkeypatch.setattr(forest, "QUERIES", queries)
    rows = spark.createDataFrame([(k, t, 1) for k, t in docs.items()], "doc_id long, text string, node int").repartition(3)
    found = {r.k: (r.n_shingles, r.component) for r in forest.near_duplicates(rows, shared, width=4).collect()}
    assert found == brute(docs, 4)


def test_null_keys_repeats_and_empty(spark, shared):
    text = "a b c d e f g h"
    rows = spark.createDataFrame([(None, text), (5, text), (5, text), (None, "x y z q r"), (7, None)], "doc_id long, text string")
    found = sorted((r.k, r.component) for r in forest.near_duplicates(rows, f"{shared}/a").collect())
    none = forest.NO_KEY
    assert found == [(5, 5), (5, 5), (7, 7), (none, 5), (none, none)]
    assert forest.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), f"{shared}/b").count() == 0


@pytest.mark.parametrize(("depth", "least"), [(3, 0.997), (5, 0.99), (8, 0.9)])
def test_recall_at_the_threshold(depth, least):
    """Share of pairs at a similarity of just 0.8 that some tree brings together at a depth, and the sketch lets through."""
    rng = np.random.default_rng(7)
    found, n = 0, 600
    for _ in range(n):
        x = rng.integers(0, 1 << 63, 100, dtype=np.int64).astype(np.uint64)
        pair = np.stack([sh.signature(np.sort(x[:90])), sh.signature(np.sort(np.concatenate([x[:80], x[90:]])))])
        values = (pair & np.uint32(0xFFFF)).reshape(2, sh.TREES, sh.DEPTH)
        prefix = np.cumprod(values[0] == values[1], axis=1).sum(axis=1).max()
        sketch = sh.sketches(pair)
        found += prefix >= depth and sh.apart(sketch[0], sketch[1]) <= sh.MOST_APART
    assert found / n >= least


def test_op3_gives_memory_back(spark, sf_dir):
    """What earlier jobs left free in the heap is the machine's again before the query's first job, and before links are confirmed."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    whole = lambda: sum(b.getCollectionCount() for b in beans if "Young" not in b.getName() and "Concurrent" not in b.getName())
    before = whole()
    forest.op3(spark, sf_dir)
    assert whole() - before >= 2
