"""Language-model scores of whole texts: a unigram base, and total bits by context mixing.

The base scores a text as its tokens: words, A-Z lower-cased, and one end.
The mixture codes every byte of the text as it stands, white space and case
too, and an end; its contexts reach across words, so it reads each occurrence
in its place.

1. Documents are dealt into blocks of about BLOCK_CHARS; each block gives its
   distinct words with their counts in training documents.
2. Their sums over all blocks are the vocabulary, from which words get their base.
3. Tasks turn training texts into counts of hashed contexts; then, with the
   sums of all tasks, learn mixing weights online and observe the refining
   map; the results, of fixed size, are summed.
4. Each block gets the base of its own words, and scores its documents by
   both.

Scoring walks texts that look alike together, whose places are more often equal;
weights are learnt in the order of the texts, so that no kind of text is the last;
words of a block are held as arrays, a number for each, and are Python's only
for the texts that are walked together.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import mixing as mx
from cadastra.llm.common import give_back, remainder, shared_dir, stored, table

#: Characters of a block; bytes of a word that are coded at a time.
BLOCK_CHARS, WORD_BYTES = 40_000_000, 48
#: The most tasks that fit the model; bytes of texts that are walked together.
MOST_TASKS, TOGETHER = 64, mx.STEP - (1 << 18)
#: Bytes of texts among which those that look alike are found; of a text's opening that are looked at; entries of words that wait to be summed.
NEAR, OPENING, WAITING = 1 << 25, 600, 1 << 20
#: Slots whose counts travel in a row.
CHUNK = 1 << 14
#: Bytes before a text, and its end: no UTF-8 text has that byte.
EDGE = b"\xff"
#: Bytes before parts: the start of a word, and what goes on with one.
STARTS, GOES_ON = b"\x01", b"\x02"


def parts(word: bytes) -> list[bytes]:
    """A word as the parts that are coded: of at most WORD_BYTES, the last one shorter and before an end mark."""
    cut = [word[i : i + WORD_BYTES] for i in range(0, len(word) + 1, WORD_BYTES)]
    cut[-1] += b"\0"
    return [(GOES_ON if i else STARTS) + c for i, c in enumerate(cut)]


def key_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys of the distinct words of the texts, A-Z lower-cased; for each occurrence its text and which of these it is)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string())))
    found = lists.values.dictionary_encode()
    each, which = found.dictionary.view(pa.binary()).to_pylist(), found.indices.to_numpy()
    text = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    if b"" in each:
        # what lies before white space at the beginning of a text, or after that at its end
        nothing = each.index(b"")
        del each[nothing]
        some = np.flatnonzero(which != nothing)
        text, which = text.take(some), which.take(some)
        which -= which > nothing
    keys = np.fromiter(map(xxhash.xxh3_64_intdigest, each), np.uint64, len(each))
    return (keys ^ np.uint64(1 << 63)).view(np.int64), text, which


def dealt(docs: DataFrame, text: str, train: Column, keep: list) -> DataFrame:
    """docs as (block, train, text, keep); about BLOCK_CHARS in a block."""
    body = F.coalesce(F.col(text), F.lit(""))
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    rows = docs.select(*keep, train.alias("__train"), body.alias("__text"))
    return rows.withColumn("__block", F.pmod(F.xxhash64("__text", *[c for c in rows.columns if c not in ("__train", "__text")]), F.lit(blocks)).cast("int"))


def near(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(where they begin, consecutive texts, null as empty) of at most NEAR bytes; a longer text comes alone."""
    column = column.cast(pa.binary())
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(ends):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + NEAR, side="right")))
        yield begin, [t or b"" for t in column.slice(begin, end - begin).to_pylist()]
        begin = end


def alike(texts: list[bytes]) -> list[int]:
    """An order of the texts in which those of one language, template or origin are neighbours: by the most frequent word of their opening, then by that."""

    def look(i: int) -> tuple[bytes, bytes]:
        opening = texts[i][:OPENING]
        words = Counter(opening.split())
        return max(words, key=words.get) if words else b"", opening

    return sorted(range(len(texts)), key=look)


def together(texts: list[bytes], order: list[int]) -> Iterator[list[int]]:
    """Numbers of texts, about TOGETHER bytes at a time."""
    held, size = [], 0
    for i in order:
        held.append(i)
        size += len(texts[i]) + 2
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def _runs(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """(begin, end) of rows that agree in the columns."""
    n = len(columns[0])
    change = np.zeros(max(0, n - 1), bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), n]
    return ((b, e) for b, e in zip(edges, edges[1:], strict=False) if e > b)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Keys, each once, with the sums of their numbers, as a single part."""
    keys, numbers = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(keys)
    keys = keys.take(order)
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return [(keys.take(begins), np.add.reduceat(numbers.take(order), begins))]


def gathered(rows: DataFrame) -> DataFrame:
    """(block, key, n): distinct words of each block with their counts in training documents."""

    def out(block: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for keys, numbers in _summed(parts) if parts else ():
            for i in range(0, len(keys), 20_000):
                own = keys[i : i + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block, np.int32)), pa.array(own), pa.array(numbers[i : i + 20_000])], names=["block", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, waiting = None, [], 0
        for batch in batches:
            blocks, train = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for begin, end in _runs(blocks):
                if blocks[begin] != at:
                    if at is not None:
                        yield from out(at, parts)
                    at, parts, waiting = int(blocks[begin]), [], 0
                for first, texts in near(batch.column(2).slice(begin, end - begin)):
                    for some in together(texts, range(len(texts))):
                        keys, text, which = _words([texts[i] for i in some])
                        learnt = train.take(np.array(some) + (begin + first))
                        if len(keys):
                            parts.append((keys, np.bincount(which[learnt.take(text)], minlength=len(keys))))
                            waiting += len(keys)
                        if waiting > WAITING:
                            parts = _summed(parts)
                            waiting = 0
        if at is not None:
            yield from out(at, parts)

    # ordered by block, so that a worker holds one block's words at a time
    ordered = rows.select("__block", "__train", "__text").repartition("__block").sortWithinPartitions("__block")
    return ordered.mapInArrow(run, "block int, key long, n long")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """Texts of the batches as the mixture's pieces, about TOGETHER bytes at a time."""
    for batch in batches:
        for _, texts in near(batch.column(0)):
            for some in together(texts, range(len(texts))):
                yield [EDGE + texts[i] + EDGE for i in some]


class MixtureModel:
    """Odds of every slot, weights and refining map: of fixed size, whatever the corpus."""

    def __init__(self, counts: np.ndarray, weights: np.ndarray, refine: np.ndarray):
        self.table, self.trust = mx.odds(counts)
        self.weights, self.refine = weights, refine

    def __setstate__(self, state: dict) -> None:
        """Unpickled tables are copied to where numpy lays large arrays, in large pages of memory."""
        self.__dict__.update(state)
        self.table, self.trust = self.table.astype(np.float32), self.trust.astype(np.uint8)

    def cost(self, texts: list[bytes]) -> np.ndarray:
        """log10 of the probability of each text with its end."""
        return mx.cost([EDGE + t + EDGE for t in texts], self.table, self.trust, self.weights, self.refine)


def fit(training: DataFrame) -> MixtureModel:
    """training: (text).  Without any, all bits are equally likely."""
    spark = training.sparkSession
    rows = training.coalesce(MOST_TASKS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, mx.INPUTS, mx.SLOTS), np.float32)
        for own in _texts(batches):
            mx.count(own, np.ones(len(own)), counts)
        flat = counts.reshape(-1, CHUNK)
        for i in range(0, len(flat), 16):
            at = [k for k in range(i, min(i + 16, len(flat))) if flat[k].any()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([flat[k].tobytes() for k in at], pa.binary())], names=["chunk", "counts"])

    def summed(part: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK)
        for raw in part.column("counts").to_pylist():
            total += np.frombuffer(raw, np.float32)
        return pa.table({"chunk": part.column("chunk")[:1], "counts": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    flat = np.zeros((2 * mx.INPUTS * mx.SLOTS // CHUNK, CHUNK), np.float32)
    for r in rows.mapInArrow(counted, "chunk int, counts binary").groupBy("chunk").applyInArrow(summed, "chunk int, counts binary").toLocalIterator():
        flat[r.chunk] = np.frombuffer(bytes(r.counts), np.float32)
    counts = flat.reshape(2, mx.INPUTS, mx.SLOTS)
    give_back(spark)
    shared = spark.sparkContext.broadcast(mx.without_own(counts))

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, weights, seen = 0, mx.first_weights(), np.zeros((2, 256 * mx.STEPS))
        for own in _texts(batches):
            mx.learn(own, np.ones(len(own)), None, weights, seen, shared.value)
            size += sum(map(len, own))
        if size:
            weights = weights.astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([float(size)]), pa.array([weights.tobytes()], pa.binary()), pa.array([seen.tobytes()], pa.binary())], names=["size", "weights", "seen"])

    size, weights, seen = 0.0, np.zeros((mx.GATES, mx.INPUTS)), np.zeros((2, 256 * mx.STEPS))
    for r in rows.mapInArrow(learned, "size double, weights binary, seen binary").collect():
        size += r["size"]
        weights += r["size"] * np.frombuffer(bytes(r.weights)).reshape(weights.shape)
        seen += np.frombuffer(bytes(r.seen)).reshape(seen.shape)
    # workers are used again: what they learnt from goes before the model comes
    shared.destroy()
    return MixtureModel(counts, weights / size if size else mx.first_weights(), mx.refining(seen))


def _entries(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Keys of a block's words, sorted, with the base of each and whether it is known."""
    if not parts:
        return [np.empty(0, np.int64), np.empty(0), np.empty(0, bool)]
    keys, base, known = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(keys)
    return [keys.take(order).astype(np.int64), base.take(order).astype(np.float64), known.take(order).astype(bool)]


def _base(texts: list[bytes], keys: np.ndarray, base: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, known ones, sum of their base) of each text."""
    own, text, which = _words(texts)
    order = np.argsort(own)
    at = np.empty(len(own), np.int64)
    at[order] = np.searchsorted(keys, own.take(order))
    if not (keys.take(at, mode="clip") == own).all():
        raise KeyError("a word of a block that isn't among its words")
    n = len(texts)
    return np.bincount(text, minlength=n), np.bincount(text, known.take(at).take(which), n).astype(np.int64), np.bincount(text, base.take(at).take(which), n)


def scored(docs: DataFrame, path: str, train: Column, keep: list, text: str = "text") -> DataFrame:
    """`keep`, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the whole text by the mixture) and bits_per_byte, for each row.

    train marks the rows that are learnt from.  A null text is empty: one
    token, its end, and has no bits_per_byte (others pay for their end too).  Repeated rows get equal results; other columns don't
    matter.  Without training rows every count is 0 and the mixture is as it
    starts.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = dealt(docs, text, train, keep)
    kept = [c for c in rows.columns if not c.startswith("__")]
    local = stored(gathered(rows), f"{path}/blocks")
    words = stored(local.groupBy("key").agg(F.sum("n").alias("n")), f"{path}/vocabulary")
    ends = docs.where(train).count()
    known, tokens = words.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    total, distinct = tokens + ends, known + (ends > 0)
    unit = math.log10(total + distinct + 1)
    model = fit(docs.where(train).select(F.coalesce(F.col(text), F.lit("")).alias("text")))
    shared = spark.sparkContext.broadcast(model)

    values = stored(words.select("key", (F.log10(F.col("n") + 1.0) - F.lit(unit)).alias("base"), (F.col("n") > 0).alias("known")), f"{path}/values")
    own = local.select("block", "key").join(values, "key")

    nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in kept]
    first = own.select(F.col("block").alias("__block"), F.lit(0).alias("__is"), "key", "base", "known", F.lit(None).cast("string").alias("__text"), *nothing)
    then = rows.select("__block", F.lit(1).alias("__is"), F.lit(None).cast("long").alias("key"), F.lit(None).cast("double").alias("base"), F.lit(None).cast("boolean").alias("known"), "__text", *kept)
    both = first.unionByName(then).repartition("__block").sortWithinPartitions("__block", "__is")
    give_back(spark)
    end_base, end_known = math.log10(ends + 1) - unit, int(ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, entries = None, [], None
        for batch in batches:
            blocks, is_text = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for begin, end in _runs(blocks, is_text):
                if blocks[begin] != at:
                    at, parts, entries = blocks[begin], [], None
                if not is_text[begin]:
                    parts.append([batch.column(i).slice(begin, end - begin).to_numpy(zero_copy_only=False) for i in (2, 3, 4)])
                    continue
                if entries is None:
                    entries, parts = _entries(parts), []
                for first, texts in near(batch.column(5).slice(begin, end - begin)):
                    n_tokens, n_known = np.empty((2, len(texts)), np.int64)
                    base, score, size = np.empty((3, len(texts)))
                    for some in together(texts, alike(texts)):
                        raw = [texts[i] for i in some]
                        n_tokens[some], n_known[some], base[some] = _base(raw, *entries)
                        score[some] = shared.value.cost(raw)
                        size[some] = [len(t) for t in raw]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        bits = -score * math.log2(10) / size
                    own = [batch.column(6 + j).slice(begin + first, len(texts)) for j in range(len(kept))]
                    columns = [pa.array(n_tokens + 1), pa.array(n_known + end_known), pa.array(np.full(len(texts), total, np.int64)), pa.array(base + end_base), pa.array(score), pa.array(bits, mask=size == 0)]
                    yield pa.RecordBatch.from_arrays([*own, *columns], names=[*kept, "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    schema = rows.select(*kept).schema
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"), ("score", "double"), ("bits_per_byte", "double")):
        schema = schema.add(name, kind)
    return both.mapInArrow(run, schema)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 7) == 2
    return scored(table(spark, sf_dir, "documents"), shared_dir(spark), ~held_out, [F.col("doc_id"), held_out.alias("held_out")])
