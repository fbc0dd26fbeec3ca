"""Byte-pair encoding and decoding by depth-first traversal of a trie of words.

The BPE encoding of any prefix of a word is fixed by the *last token* of each
of its prefixes: if t ends prefix i, what precedes it is the encoding of prefix
i - len(t).  The last token of prefix i is the longest vocabulary entry that
ends there and that greedy merging would leave beside the last token before
it.  The state so belongs to a trie node, not to a word: distinct words are put
into a trie, the traversal goes depth first, and a prefix that many words share
is worked out once.  Sorting the words makes that trie implicit: the stack of
states up to the longest common prefix with the word before is the path of the
node where the new branch leaves.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cadastra.llm.common import table
from cadastra.llm.held import held

#: How a byte-level tokenizer cuts text before merging.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
RUN = re.compile(r"\s\s")
#: Encoded words and their characters that a worker keeps between batches, and characters dealt with at a time.
CACHE_WORDS, CACHE_CHARS, SLICE_CHARS = 250_000, 16_000_000, 250_000
#: In place of the token before a word's first; in place of a byte, where the bytes of a state are.
START = TAIL = -1
#: States after one more byte; (id, length, whether it stays apart from a token before it) of tokens.
State = tuple[dict, tuple[tuple[int, int, dict[int, bool]], ...]]


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabulary files use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TrieBpe:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = _byte_letters()
        vocab = {bytes(letter[c] for c in t): i for t, i in spec["model"]["vocab"].items() if all(c in letter for c in t)}
        self.id_of = vocab
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters_are_whole = not any(t.replace(" ", "").isalpha() for t in self.special)
        top = max([*vocab.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * (top + 1)
        for t, i in vocab.items():
            self.bytes_of[i] = t
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        #: For each token: the merge that makes it (its rank, left part, right part); single bytes have none.
        self.made: dict[int, tuple[int, int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            left, right = (vocab[bytes(letter[c] for c in x)] for x in (a, b))
            self.rank[left, right] = r
            self.made.setdefault(vocab[self.bytes_of[left] + self.bytes_of[right]], (r, left, right))
        self.beginnings = {t[:i] for t in vocab for i in range(1, len(t) + 1)}
        self.length_of = [len(t) for t in self.bytes_of]
        self.packed = [struct.pack("<I", i) for i in range(top + 1)]
        #: By token: whether it stays apart from a token before it; from START it does.
        self.apart: dict[int, dict[int, bool]] = {}
        #: Beginnings of tokens that text was seen to end with: (states after one more byte, the tokens that end it, longest first).
        #: The tokens come as (id, length, what they stay apart from); under TAIL are the beginning's bytes.
        self.states: dict[bytes, State] = {b"": ({TAIL: b""}, ())}
        #: Entries of the dictionaries of states and of what stays apart.
        self.steps = self.judged = 0
        #: Packed ids by piece, and by what follows a single space.
        self.known: dict[str, bytes] = {}
        self.after_space: dict[str, bytes] = {}
        self.chars = 0

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether greedy merging of the two tokens' bytes ends in just these two.

        Merges inside a and inside b happen in order of rank.  Undo the later
        of the two last merges again and again; at each moment so recovered,
        the pair that faces each other across the border must not be one that
        merging would have taken before the merge just undone.
        """
        made, rank = self.made, self.rank
        never = 1 << 60
        before = never  # of the undone merge: (rank, side) as one number
        while True:
            r = rank.get((a, b))
            # equal ranks: the leftmost place merges first, so an undone merge on the right side comes after the border's
            if r is not None and 2 * r + 1 < before:
                return False
            ra, rb = made.get(a), made.get(b)
            if ra is None and rb is None:
                return True
            if rb is None or (ra is not None and ra[0] > rb[0]):
                before, a = 2 * ra[0], ra[2]
            else:
                before, b = 2 * rb[0] + 2, rb[1]

    @property
    def tails(self) -> list[bytes]:
        """The beginnings that there are states of."""
        return list(self.states)

    def step(self, after: dict, byte: int) -> State:
        """The state after one (of which `after` is the first part) and a byte: of the longest ending that could still grow into a token.

        With it comes every vocabulary entry that ends the text, longest first.
        """
        tail = after[TAIL] + bytes([byte])
        while tail not in self.beginnings:
            tail = tail[1:]
        state = self.states.get(tail)
        if state is None:
            found = [(self.id_of[tail[i:]], len(tail) - i) for i in range(len(tail)) if tail[i:] in self.id_of]
            state = self.states[tail] = ({TAIL: tail}, tuple((t, size, self.apart.setdefault(t, {START: True})) for t, size in found))
        after[byte] = state
        self.steps += 1
        return state

    def forget(self, most: int) -> None:
        """Of encoded words, steps and what stays apart, where they are more, nothing is kept; the states stay."""
        if len(self.known) > most:
            self.known.clear()
        if self.steps > most:
            for tail, (after, _) in self.states.items():
                after.clear()
                after[TAIL] = tail
            self.steps = 0
        if self.judged > most:
            for beside in self.apart.values():
                beside.clear()
                beside[START] = True
            self.judged = 0

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Packed ids of distinct words, by depth-first traversal of their trie."""
        length_of, packed = self.length_of, self.packed
        out: dict[str, bytes] = {}
        before = b""
        last: list[int] = [START]  # last[i]: the token that ends the prefix of i bytes
        states: list[dict] = [self.states[b""][0]]  # the state there
        for raw, word in sorted((w.encode(), w) for w in words):
            n, shared = len(raw), 0
            most = min(n, len(before))
            if raw[:most] == before[:most]:
                shared = most
            else:
                while raw[shared] == before[shared]:
                    shared += 1
            del last[shared + 1 :], states[shared + 1 :]
            after = states[-1]
            for byte in raw[shared:]:
                after, endings = after.get(byte) or self.step(after, byte)
                for t, size, apart in endings:
                    ok = apart.get(last[-size])
                    if ok is None:
                        ok = apart[last[-size]] = self.stay_apart(last[-size], t)
                        self.judged += 1
                    if ok:
                        break
                last.append(t)
                states.append(after)
            ids, i = [], n
            while i:
                t = last[i]
                ids.append(packed[t])
                i -= length_of[t]
            ids.reverse()
            out[word] = b"".join(ids)
            before = raw
        return out

    def pieces(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return PIECES.findall(text)
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            out += [part] if i % 2 else PIECES.findall(part)
        return out

    def encode_units(self, units: Iterable[str], plain: bool = False) -> dict[str, bytes]:
        """Packed ids of distinct texts; the pieces of all of them go through one trie.  plain: no special token is in them."""
        # ASCII letters are one piece, with a space before them or without, where no special token is in them
        whole, pieces = self.letters_are_whole, PIECES.findall if plain else self.pieces
        cut = {u: [u] if whole and u.isascii() and (u.isalpha() or (u[:1] == " " and u[1:].isalpha())) else pieces(u) for u in units}
        known = self.known
        known.update(self.encode_words(set().union(*cut.values()).difference(known)))
        return {u: known[p[0]] if len(p) == 1 else b"".join(map(known.__getitem__, p)) for u, p in cut.items()}

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers.

        A single space between two characters that aren't white space always
        starts a piece, so a text without two white-space characters in a row
        is dealt with as its parts between spaces; each part, with its space,
        is encoded once.  Other texts go whole.
        """
        self.forget(CACHE_WORDS)
        self.known.update({s: struct.pack("<I", i) for s, i in self.special.items()})
        parts = [None if RUN.search(t) or any(s in t for s in self.special) else t.split(" ") for t in texts]
        heads = self.encode_units({p[0] if p else t for t, p in zip(texts, parts, strict=True)})
        after = self.after_space
        words = set().union(*(p[1:] for p in parts if p))
        if len(after) > CACHE_WORDS or self.chars > CACHE_CHARS:
            # what the next texts use stays, frequent words among it
            after = self.after_space = {w: after[w] for w in words if w in after}
            self.chars = sum(map(len, after))
        new = words.difference(after)
        self.chars += sum(map(len, new))
        after.update((u[1:], ids) for u, ids in self.encode_units([f" {p}" for p in new], plain=True).items())
        get = after.__getitem__
        return [heads[p[0]] + b"".join(map(get, p[1:])) if p else heads[t] for t, p in zip(texts, parts, strict=True)]

    def decode(self, packed: bytes) -> bytes:
        """UTF-8 of the decoded text; bytes that aren't UTF-8 become U+FFFD, as the decoder of such files does."""
        raw = b"".join(map(self.bytes_of.__getitem__, memoryview(packed).cast("I").tolist()))
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
        return raw


def load(path: str) -> TrieBpe:
    """The encoder that this process keeps while it encodes."""
    return held(("bpe", path), lambda: TrieBpe(path))


def slices(column: pa.Array, most: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Consecutive texts (null: empty) of bounded total length; a longer text comes alone.  Only these are Python's at a time."""
    begin, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(column), 0).to_pylist()):
        if i > begin and size + n > most:
            yield [t or "" for t in column.slice(begin, i - begin).to_pylist()]
            begin, size = i, 0
        size += n
    if begin < len(column):
        yield [t or "" for t in column.slice(begin).to_pylist()]


def _id_lists(packed: list[bytes]) -> pa.Array:
    """Packed ids as lists, without a Python number for each."""
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
    ids = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(packed))])
    return pa.ListArray.from_arrays(pa.array(offsets), ids)


def encoded(batches: Iterator[pa.RecordBatch], path: str, keep: tuple[str, ...], ids: bool, texts: bool) -> Iterator[pa.RecordBatch]:
    """Batches of the columns `keep` and a text, as encode() has them; of a batch, however large, a slice of texts is dealt with at a time."""
    bpe = load(path)
    for batch in batches:
        done = 0
        for part in slices(batch.column(len(keep))):
            packed = bpe.encode_batch(part)
            decoded = [bpe.decode(p) for p in packed]
            columns = [batch.column(i).slice(done, len(part)) for i in range(len(keep))]
            columns += [
                pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
            ]
            names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(_id_lists(packed))
                names.append("token_ids")
            if texts:
                columns.append(pa.array([d.decode() for d in decoded], pa.string()))
                names.append("decoded")
            done += len(part)
            yield pa.RecordBatch.from_arrays(columns, names=names)
            del part, packed, decoded, columns
        # what Arrow took for the batch and its results goes back, not to a store of its own
        pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: bool = False, texts: bool = False) -> DataFrame:
    """Encode and decode every whole text.

    Returns the columns of `keep` with n_tokens, ids_sha256 and decoded_sha256;
    with `ids` also token_ids (array of int), with `texts` decoded (string).  A null text
    counts as empty (no tokens); rows are independent, so repeated rows give
    repeated results, and other columns of `docs` are left out.  No shuffle.
    """
    schema = docs.select(*keep).schema
    source = docs.select(*keep, docs[text].alias("__text"))
    for name, kind in (("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")):
        schema = schema.add(name, kind)
    if ids:
        schema = schema.add("token_ids", T.ArrayType(T.IntegerType()))
    if texts:
        schema = schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded(batches, path, keep, ids, texts)

    return source.mapInArrow(run, schema)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), vocabulary())
