"""Against the tokenizers library on hard texts; exact round trip."""

from __future__ import annotations

import hashlib
import random
import struct

from cadastra.llm import bpe

HARD = [None, "", " ", "a", "\n\n  \t x", "it's we'll I'D naïve café 😀😀 日本語   x", "<|endoftext|> a<|endoftext|>", "x" * 3000, " ".join(["the quick brown"] * 3000), "1234567 89,000.5 $$$ ###!!!", "\x00\x01 \x7f ﻿"]


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def test_words_encode_as_the_library_does():
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoin shrdlué'09-_!😀") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    ours, theirs = bpe.load(bpe.vocabulary()), library()
    for text, packed in zip(words, ours.encode_batch(words), strict=True):
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == theirs.encode(text, add_special_tokens=False).ids


def test_documents(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(HARD)] + [(0, None, "again")], "doc_id long, text string, n_tokens string")
    theirs = library()
    rows = bpe.encode(docs, bpe.vocabulary(), ids=True, texts=True).collect()
    assert len(rows) == len(HARD) + 1
    for r in rows:
        ids = theirs.encode(HARD[r.doc_id] or "", add_special_tokens=False).ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        assert list(r.token_ids) == ids and r.n_tokens == len(ids) and r.decoded == decoded
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), bpe.vocabulary()).count() == 0


def test_memory_is_that_of_a_slice():
    """A batch of many texts takes Python objects for some of them at a time, and none for each token; rows stay in order."""
    import tracemalloc

    import pyarrow as pa

    texts = [None, "", *(f"{i} " + "the quick brown fox, " * 5000 for i in range(60)), None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    ours = bpe.load(bpe.vocabulary())
    want = [list(struct.unpack(f"<{len(p) // 4}I", p)) for t in texts for p in ours.encode_batch([t or ""])]
    tracemalloc.start()
    n = 0
    for out in bpe.encoded(iter([batch]), bpe.vocabulary(), ("doc_id",), ids=True, texts=False):
        for r in range(out.num_rows):
            assert out.column("doc_id")[r].as_py() == n
            assert out.column("n_tokens")[r].as_py() == len(want[n])
            assert out.column("token_ids").slice(r, 1).flatten().equals(pa.array(want[n], pa.int32()))
            n += 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts)
    assert peak < 16_000_000


def test_states_are_found_once(monkeypatch):
    """Words are walked by states that are worked out once, as many as tokens have beginnings at most; forgetting steps changes nothing."""
    rng = random.Random(7)
    words = ["".join(rng.choice("etaoinshrdluxé'9") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    ours, theirs = bpe.TrieBpe(bpe.vocabulary()), library()
    want = [struct.pack(f"<{len(ids)}I", *ids) for ids in (theirs.encode(w, add_special_tokens=False).ids for w in words)]
    assert ours.encode_batch(words) == want
    assert 1 < len(ours.states) == len(ours.tails) <= len(ours.beginnings) + 1
    known = len(ours.states)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 0)
    assert ours.encode_batch(words) == want and len(ours.states) == known


def test_steps_and_judgements_lie_with_what_they_belong_to(monkeypatch):
    """Steps are found by byte in their state, judgements by token in the later one; as many as are counted, and bounded."""
    rng = random.Random(8)
    words = ["", *("".join(rng.choice("etaoinshrdluxé'9") for _ in range(rng.randint(1, 30))) for _ in range(500))]
    ours, theirs = bpe.TrieBpe(bpe.vocabulary()), library()
    want = [struct.pack(f"<{len(ids)}I", *ids) for ids in (theirs.encode(w, add_special_tokens=False).ids for w in words)]
    kept = lambda: (sum(len(after) - 1 for after, _ in ours.states.values()), sum(len(beside) - 1 for beside in ours.apart.values()))
    assert ours.encode_batch(words) == want
    assert kept() == (ours.steps, ours.judged) and min(kept()) > 500
    monkeypatch.setattr(bpe, "CACHE_WORDS", 100)
    ours.encode_batch(["a"])
    assert kept() == (ours.steps, ours.judged) and max(kept()) < 10
    ours.after_space.clear()
    assert ours.encode_batch(words) == want


def test_special_tokens_of_letters(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(bpe.vocabulary(), encoding="utf-8") as f:
        spec = json.load(f)
    top = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    spec["added_tokens"].append({**spec["added_tokens"][0], "content": "qux", "id": top + 1})
    path = tmp_path / "letters.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    theirs = Tokenizer.from_file(str(path))
    texts = ["aquxb", "qux", "a qux b", "quxqux aqu"]
    for text, packed in zip(texts, bpe.TrieBpe(str(path)).encode_batch(texts), strict=True):
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == theirs.encode(text, add_special_tokens=False).ids
