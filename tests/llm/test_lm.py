"""Counts and base against plain Python; the mixture is a code: shorter for likely texts, for no text a negative length."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from cadastra.llm import lm, mixing


def test_counts_and_base(spark, shared, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_CHARS", 400)
    texts = ["The cat sat.", "the CAT sat on the mat.", None, "", "  \n ", "a" * 5000 + " \t" * 40 + "b", "É the", "the cat sat on the mat again and again", "zebra quark"] * 3
    docs = spark.createDataFrame([(i, t, i % 4 != 1, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, train boolean, score double")
    rows = {r.doc_id: r for r in lm.scored(docs, shared, F.col("train"), ["doc_id"]).collect()}
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for i, t in enumerate(texts)}
    counts = Counter(w for i, ws in words.items() if i % 4 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for i, ws in words.items():
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0


def test_parts_make_up_the_word():
    for word in (b"", b"a", b"x" * 48, b"x" * 1000):
        cut = lm.parts(word)
        assert b"".join(p[1:] for p in cut) == word + b"\0" and max(map(len, cut)) <= lm.WORD_BYTES + 2
        assert [p[:1] for p in cut] == [lm.STARTS] + [lm.GOES_ON] * (len(cut) - 1)


def test_no_training_rows_and_no_rows(spark, shared):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = lm.scored(docs, f"{shared}/a", F.lit(False), ["doc_id"]).first()
    assert (r.n_known, r.train_tokens, r.n_tokens) == (0, 0, 3) and r.score < 0
    assert lm.scored(docs.where("false"), f"{shared}/b", F.lit(True), ["doc_id"]).count() == 0


def test_probabilities_of_a_byte_add_up():
    import numpy as np

    counts = np.zeros((2, mixing.INPUTS, mixing.SLOTS), np.float32)
    mixing.count([b"\x01abc\0", b"\x01abd\0"], np.array([5.0, 2.0]), counts)
    table, trust = mixing.odds(counts)
    cost = mixing.cost([b"\x01a" + bytes([b]) for b in range(256)], table, trust, mixing.first_weights(), mixing.refining(np.zeros((2, 256 * mixing.STEPS))))
    first = mixing.cost([b"\x01a"], table, trust, mixing.first_weights(), mixing.refining(np.zeros((2, 256 * mixing.STEPS))))
    assert math.isclose(sum(10 ** (cost - first)), 1.0, rel_tol=1e-3)


def test_whole_text_is_coded(spark, shared):
    """Case, white space and the order of words all cost bits, and every byte of a text has its share."""
    texts = ["The cat sat on the mat. ", "the dog ran to the old barn.\n"] * 40
    asked = ["the cat sat on the mat.", "THE CAT SAT ON THE MAT.", "the  cat\nsat on the\tmat.", "mat. the on sat cat the", "the cat sat on the mat.", "", "é" * 70_000 + " \0x"]
    docs = spark.createDataFrame([(i, t, i < len(texts)) for i, t in enumerate(texts + asked)], "doc_id long, text string, train boolean")
    rows = {r.doc_id - len(texts): r for r in lm.scored(docs, shared, F.col("train"), ["doc_id"]).collect()}
    assert len({rows[i].score for i in range(4)}) == 4 and rows[0].score == rows[4].score
    assert rows[0].score > max(rows[i].score for i in (1, 2, 3))
    assert rows[5].bits_per_byte is None
    for i in (0, 1, 2, 3, 6):
        assert math.isclose(rows[i].bits_per_byte, -rows[i].score * math.log2(10) / len(asked[i].encode()))


def test_windows_do_not_change_contexts():
    """A piece has the same contexts wherever windows are cut and whatever lies before it."""
    import numpy as np

    pieces = [b"\xffab cd  ef\xff", b"\xff" + b"word" * 50 + b" and on\xff", b"\xff\xff", b"\xff  x y\xff"]

    def contexts(pieces, size):
        parts = list(mixing.windows(pieces, size))
        return np.concatenate([np.stack([w.piece.astype(np.uint64), w.byte.astype(np.uint64), w.place.astype(np.uint64), *w.hashes]) for w in parts], axis=1)

    whole = contexts(pieces, 1 << 16)
    assert whole.shape[1] == sum(len(p) - 1 for p in pieces)
    for size in (1, 7, 64):
        assert (contexts(pieces, size) == whole).all()
    for i, p in enumerate(pieces):
        assert (contexts([p], 64)[1:] == whole[1:, whole[0] == i]).all()


def test_small_corpora_are_learnt_from_once():
    """What is learnt from two full steps is what is learnt from one, then the other, however few they are."""
    import numpy as np

    # with what is laid between pieces, just one step
    piece = (b"\xff" + b"ab c" * mixing.STEP)[: mixing.STEP - max(mixing.ORDERS) + 1]
    counts = np.zeros((2, mixing.INPUTS, mixing.SLOTS), np.float32)
    mixing.count([piece] * 2, np.ones(2), counts)

    def learnt(*parts):
        weights, seen = mixing.first_weights(), np.zeros((2, 256 * mixing.STEPS))
        for p in parts:
            mixing.learn(p, np.ones(len(p)), counts, weights, seen)
        return weights, seen

    (a, sa), (b, sb) = learnt([piece] * 2), learnt([piece], [piece])
    assert (a == b).all() and (sa == sb).all() and sa[0].sum() == 2 * 8 * (len(piece) - 1)


def test_equal_places_are_dealt_with_once():
    """Copies add no distinct places; their counts, costs and what is learnt are those of all places one by one."""
    import numpy as np

    rng = np.random.default_rng(3)
    texts = [b"\xff" + b" ".join(rng.choice([b"alpha", b"Beta", b"ga", b"d\xc3\xa9lta"], 60)) + b"\xff" for _ in range(20)]
    pieces = texts * 5
    (once, _, _), (found, piece, number) = next(mixing.distinct(texts)), next(mixing.distinct(pieces, each=True))
    assert len(found.byte) == len(once.byte) < number.sum() / 5
    assert number.sum() == len(piece) == sum(len(p) - 1 for p in pieces) and (found.times == number).all()
    assert (np.bincount(piece) == [len(p) - 1 for p in pieces]).all()
    one_by_one = {tuple(map(int, x)) for w in mixing.windows(pieces) for x in zip(w.byte, w.place, w.last, w.word, strict=True)}
    assert one_by_one == {tuple(map(int, x)) for x in zip(found.byte, found.place, found.last, found.word, strict=True)}

    counts, plain = np.zeros((2, 2, mixing.INPUTS, mixing.SLOTS), np.float32)
    mixing.count(pieces, np.ones(len(pieces)), counts)
    for w in mixing.windows(pieces):
        _, y, slots = w.walk()
        for k in range(mixing.INPUTS):
            for v in (0, 1):
                plain[v, k] += np.bincount(slots[k][y == v], minlength=mixing.SLOTS)
    assert (counts == plain).all()
    twice = np.zeros_like(counts)
    mixing.count(texts, np.full(len(texts), 5.0), twice)
    assert (counts == twice).all()

    weights, seen = mixing.first_weights(), np.zeros((2, 256 * mixing.STEPS))
    mixing.learn(pieces, np.ones(len(pieces)), counts, weights, seen)
    assert seen[0].sum() == 8 * number.sum()
    table, trust = mixing.odds(counts)
    cost = mixing.cost(pieces, table, trust, weights, mixing.refining(seen))
    alone = [mixing.cost([p], table, trust, weights, mixing.refining(seen))[0] for p in texts]
    assert (cost == alone * 5).all()


def test_words_of_a_block_are_numbers():
    """A block's words take an array's place each, not Python objects; what texts look up is what they hold."""
    import tracemalloc

    import numpy as np

    n = 200_000
    keys, base, known = np.arange(n) * 7 - n, np.arange(n) / 8, np.arange(n) % 3 > 0
    tracemalloc.start()
    entries = lm._entries([[keys[i::4], base[i::4], known[i::4]] for i in range(4)])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 20 * n
    assert (entries[0] == keys).all() and (entries[1] == base).all() and (entries[2] == known).all()

    words = sorted({b"a", b"bc", "é".encode(), b"x" * 300}, key=lm.key_of)
    own = lm._entries([[np.array([lm.key_of(w) for w in words]), np.arange(4) + 0.5, np.array([True, False, True, True])]])
    number, known, base = lm._base([b"", words[0] + b" \n" + words[1].upper() + b" " + words[0], b"  ", words[3]], *own)
    assert (number.tolist(), known.tolist(), base.tolist()) == ([0, 3, 0, 1], [0, 2, 0, 1], [0, 2.5, 0, 3.5])


def test_texts_are_cut_and_ordered_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lm, "NEAR", 20)
    monkeypatch.setattr(lm, "TOGETHER", 12)
    texts = ["the cat the", None, "x" * 50, "", "der hund der", "the dog the", "é" * 9]
    found = list(lm.near(pa.array(["left out", *texts]).slice(1)))
    assert [t for _, part in found for t in part] == [(t or "").encode() for t in texts]
    assert all(sum(map(len, part)) <= 20 or len(part) == 1 for _, part in found)
    assert [b for b, _ in found] == [sum(len(p) for _, p in found[:i]) for i in range(len(found))]
    raw = [(t or "").encode() for t in texts]
    order = lm.alike(raw)
    assert sorted(order) == list(range(len(raw))) and abs(order.index(0) - order.index(5)) == 1
    assert [i for some in lm.together(raw, order) for i in some] == order


def test_heap_is_given_back_before_learning_and_scoring(spark, shared):
    """Heaps that earlier steps let grow give back what is free in them, twice, before workers hold tables."""
    docs = spark.createDataFrame([(i, f"word{i % 7} and more {i}") for i in range(40)], "doc_id long, text string")
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    whole = lambda: sum(b.getCollectionCount() for b in beans if "Young" not in b.getName() and "Concurrent" not in b.getName())
    before = whole()
    assert lm.scored(docs, shared, F.col("doc_id") % 2 == 0, [F.col("doc_id")]).count() == 40
    assert whole() >= before + 2


def test_words_are_what_python_splits():
    texts = [b"", b"  a  B b ", b"\t\r\n", "É é\x0b\x0cx\x1cy z\xa0q".encode(), b"b\xff \xc3 A", b" a"]
    keys, text, which = lm._words(texts)
    assert len(set(keys.tolist())) == len(keys)
    found = Counter((int(t), int(keys[w])) for t, w in zip(text, which, strict=True))
    assert found == Counter((i, lm.key_of(w)) for i, t in enumerate(texts) for w in t.lower().split())


def test_sent_tables_teach_and_score_the_same():
    import pickle

    import numpy as np

    pieces = [lm.EDGE + b"one two three two one" * 20 + lm.EDGE]
    counts = np.zeros((2, mixing.INPUTS, mixing.SLOTS), np.float32)
    mixing.count(pieces, np.ones(1), counts)
    own = mixing.without_own(counts)
    learnt = []
    for tables in (own, pickle.loads(pickle.dumps(own))):
        weights, seen = mixing.first_weights(), np.zeros((2, 256 * mixing.STEPS))
        mixing.learn(pieces, np.ones(1), None, weights, seen, tables)
        learnt.append((weights, seen))
    assert (learnt[0][0] == learnt[1][0]).all() and (learnt[0][1] == learnt[1][1]).all()
    model = lm.MixtureModel(counts, learnt[0][0], mixing.refining(learnt[0][1]))
    sent = pickle.loads(pickle.dumps(model))
    assert sent.table.base is None and (sent.cost([b"one two"]) == model.cost([b"one two"])).all()
