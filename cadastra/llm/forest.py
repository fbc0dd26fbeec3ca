"""Near-duplicate detection by an LSH forest of MinHash signatures, with exact confirmation.

1. Every document becomes a set of shingle hashes.  Equal sets are one class.
2. Forest: each class stands in TREES sorted orders, one for each part of its
   signature.  Classes that share the first LEAST_DEPTH values of an order are
   a region.  A region of more than REGION classes is divided by the next
   value, and again, as deep as it takes: the depth adapts to the region.  In
   a region all sketches are compared, nearest in the order first; across the
   border of two divided regions the two neighbours of the longest common
   prefix are.  What comes out is a forest of candidate pairs; its components
   hold all links, and nothing is confirmed outside of them.
3. Confirmation on the full sets.  A candidate component of up to GROUP
   classes is compared whole.  Of a larger one, the class nearest to what most
   signatures say is compared with all; the classes that it isn't linked with
   are then compared with all in blocks.  No pair is left out but those of
   which both are linked with that class already, so that no component changes.
4. Components of the links; the smallest document id of each names it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import shingles as sh
from cadastra.llm.common import give_back, shared_dir, stored, table
from cadastra.llm.components import components

LEAST_DEPTH, REGION = 3, 4096
#: Classes of a group that is compared whole; members and queries of a block of a larger one.
GROUP, MEMBERS, QUERIES = 256, 512, 256
#: Tasks among which the members of a large group are dealt where a fact of the group is joined to them.
SALTS = 64
#: Key of rows that have none: the largest, so that it names a component only where there is no other.
NO_KEY = (1 << 63) - 1
_NODE = pa.binary()


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


# 1. Sets ---------------------------------------------------------------------------------------------


def signed(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """k, th (a hash of the text; with k it names a row), n_shingles, node (fingerprint of the set), trees, s0 to s3 (sketch)."""
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("k"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sh.shingle_set(t.as_py(), width) for t in batch.column(2)]
            full = [s for s in sets if len(s)]
            sig = np.array([sh.signature(s) for s in full], np.uint32).reshape(len(full), sh.VALUES)
            tree, sketch = sh.trees(sig), sh.sketches(sig).view(np.int64)
            at, nodes, forest, parts = 0, [], [], []
            for s in sets:
                nodes.append(sh.fingerprint(s) if len(s) else None)
                forest.append(tree[at].tobytes() if len(s) else None)
                parts.append(sketch[at] if len(s) else (None,) * 4)
                at += bool(len(s))
            columns = [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, _NODE), pa.array(forest, _NODE)]
            columns += [pa.array([None if p[i] is None else int(p[i]) for p in parts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=["k", "th", "n_shingles", "node", "trees", "s0", "s1", "s2", "s3"])

    return rows.mapInArrow(run, "k long, th long, n_shingles long, node binary, trees binary, s0 long, s1 long, s2 long, s3 long")


def classes(rows: DataFrame) -> DataFrame:
    """One row for each distinct set: its fingerprint, least key, a row that has it, its tree values and sketch."""
    own = F.struct("k", "th", "trees", "s0", "s1", "s2", "s3")
    return rows.where("n_shingles > 0").groupBy("node").agg(F.min(own).alias("r")).select("node", "r.*")


# 2. Forest -------------------------------------------------------------------------------------------


def spanning(sketch: np.ndarray) -> list[tuple[int, int]]:
    """Edges (row, root) of the components of rows whose sketches are near, found breadth first."""
    edges: list[tuple[int, int]] = []
    left = np.arange(len(sketch))
    while len(left) > 1:
        root, queue = int(left[0]), [int(left[0])]
        left = left[1:]
        while queue and len(left):
            near = sh.apart(sketch[left], sketch[queue.pop()]) <= sh.MOST_APART
            if near.any():
                hit = left[near].tolist()
                edges += [(i, root) for i in hit]
                queue += hit
                left = left[~near]
    return edges


def region_edges(prefix: np.ndarray, sketch: np.ndarray, depth: int, most: int) -> list[tuple[int, int]]:
    """Candidate edges of sorted rows that share `depth` values."""
    n = len(prefix)
    if n < 2:
        return []
    if n <= most:
        return spanning(sketch)
    edges: list[tuple[int, int]] = []
    if depth < sh.DEPTH:
        cut = np.flatnonzero((prefix[1:, 2 * depth : 2 * depth + 2] != prefix[:-1, 2 * depth : 2 * depth + 2]).any(axis=1)) + 1
        starts = [0, *cut.tolist(), n]
    else:
        starts = [*range(0, n, most), n]
    for lo, hi in zip(starts[:-1], starts[1:], strict=True):
        edges += [(lo + a, lo + b) for a, b in region_edges(prefix[lo:hi], sketch[lo:hi], depth + 1, most)]
        if lo and sh.apart(sketch[lo], sketch[lo - 1]) <= sh.MOST_APART:
            edges.append((lo, lo - 1))
    return edges


def forest_edges(units: DataFrame, most: int = REGION) -> DataFrame:
    """Candidate edges (a, b) between classes, from all trees."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(sh.TREES - 1))).alias("tree")
    rows = units.select("node", "trees", "s0", "s1", "s2", "s3", tree)
    size = 2 * sh.DEPTH
    rows = rows.select("tree", F.expr(f"substring(trees, tree * {size} + 1, {size})").alias("prefix"), "node", "s0", "s1", "s2", "s3")
    order = ["tree", "prefix", "node"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    share = 1 + 2 * LEAST_DEPTH

    def ready(names: np.ndarray) -> int:
        """Rows from the start whose regions are complete, as more rows follow."""
        for depth in range(LEAST_DEPTH, sh.DEPTH + 1):
            differs = np.flatnonzero((names[:-1, : 1 + 2 * depth] != names[-1, : 1 + 2 * depth]).any(axis=1))
            start = int(differs[-1]) + 1 if len(differs) else 0
            if len(names) - start <= most:
                return start
        return len(names) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[np.ndarray, np.ndarray, list] | None = None
        for batch in _and_end(batches):
            if batch is not None:
                t = np.array(batch.column(0).to_numpy(zero_copy_only=False), np.uint8)
                names = np.hstack([t[:, None], _matrix(batch.column(1), np.uint8, size)])
                sketch = np.stack([batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(3, 7)], axis=1)
                nodes = batch.column(2).to_pylist()
                if kept is not None:
                    names, sketch, nodes = np.vstack([kept[0], names]), np.vstack([kept[1], sketch]), kept[2] + nodes
                end = ready(names) if len(names) else 0
            elif kept is None:
                return
            else:
                names, sketch, nodes = kept
                end = len(names)
            kept = (names[end:], sketch[end:], nodes[end:])
            a: list[bytes] = []
            b: list[bytes] = []
            # a region that goes on is joined to what is kept by its two neighbours
            if 0 < end < len(names) and (names[end, :share] == names[end - 1, :share]).all() and sh.apart(sketch[end], sketch[end - 1]) <= sh.MOST_APART:
                a.append(nodes[end])
                b.append(nodes[end - 1])
            head = names[:end, :share]
            starts = [0, *(np.flatnonzero((head[1:] != head[:-1]).any(axis=1)) + 1).tolist(), end] if end else [0]
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                if hi - lo > 1:
                    for x, y in region_edges(names[lo:hi, 1:], sketch[lo:hi], LEAST_DEPTH, most):
                        a.append(nodes[lo + x])
                        b.append(nodes[lo + y])
            yield pa.RecordBatch.from_arrays([pa.array(a, _NODE), pa.array(b, _NODE)], names=["a", "b"])

    return ordered.mapInArrow(run, "a binary, b binary")


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


# 3. Confirmation -------------------------------------------------------------------------------------


def confirmed(rows: DataFrame, group: list[str], percent: int) -> DataFrame:
    """Edges (a, b) that span the links of each group: of its queries with its members, or of all where it has no queries.

    rows: the columns of `group`, query (boolean), node, items (the set).  Groups must be of bounded size.
    """
    picked = rows.select(F.xxhash64(*group).alias("dealt"), *group, "query", "node", "items")
    ordered = picked.repartition("dealt").sortWithinPartitions("dealt", *group, F.col("query").desc(), "node")
    names = len(group)

    def edges(part: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        asked = [r for r in part if r[0]]
        others = [r for r in part if not r[0]]
        left = asked or others
        found = sh.links([np.frombuffer(r[2], np.uint64) for r in left], [np.frombuffer(r[2], np.uint64) for r in others], percent)
        # breadth first over queries and members; where there are only members, both sides are the same rows
        seen_l, seen_r = np.zeros(len(left), bool), np.zeros(len(others), bool)
        for i in range(len(left)):
            if seen_l[i]:
                continue
            seen_l[i] = True
            queue, root = [i], left[i][1]
            while queue:
                new = found[queue.pop()] & ~seen_r
                seen_r |= new
                for j in np.flatnonzero(new).tolist():
                    if others[j][1] != root:
                        yield others[j][1], root
                    if asked:
                        back = np.flatnonzero(found[:, j] & ~seen_l).tolist()
                    else:
                        back = [] if seen_l[j] else [j]
                    for q in back:
                        seen_l[q] = True
                        queue.append(q)
                        if asked and left[q][1] != root:
                            yield left[q][1], root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = None, []
        for batch in _and_end(batches):
            out: list[tuple[bytes, bytes]] = []
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch is not None else [(None,) * (names + 4)]
            for r in rows:
                g = r[1 : 1 + names]
                if g != at:
                    if len(part) > 1:
                        out += edges(part)
                    at, part = g, []
                part.append(r[1 + names :])
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], _NODE) for i in range(2)], names=["a", "b"])

    return ordered.mapInArrow(run, "a binary, b binary")


def with_items(docs: DataFrame, key: str, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """wanted (k, th, node and more), each with the full set of its row as `items`; of rows equal in k and th one serves."""
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("k"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("__text"))
    joined = rows.join(wanted, ["k", "th"]).dropDuplicates(["k", "th"])
    kept = [c for c in wanted.columns if c not in ("k", "th")]
    joined = joined.select(*kept, "__text")
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = pa.array([sh.shingle_set(t.as_py(), width).tobytes() for t in batch.column(n)], _NODE)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), items], names=[*kept, "items"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema if f.name != "__text")
    return joined.mapInArrow(run, f"{fields}, items binary")


def to_members(members: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """members (g, node and more) with `salt` and what facts (one row for each g) say of their group: no group meets in one task."""
    dealt = members.withColumn("salt", F.pmod(F.xxhash64(F.lit(2), F.col("node")), F.lit(SALTS)).cast("int"))
    return dealt.join(facts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["g", "salt"], how)


def middle(members: DataFrame) -> DataFrame:
    """(g, pivot): of each group, the class whose sketch is nearest to the commonest value at each place."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, np.ndarray] = {}
        shifts = np.arange(32, dtype=np.uint64) * np.uint64(2)
        for batch in batches:
            sketch = np.stack([batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(1, 5)], axis=1)
            value = ((sketch[:, :, None] >> shifts) & np.uint64(3)).reshape(len(sketch), sh.VALUES)
            group = np.array(batch.column(0).to_pylist(), object)
            for g in set(group.tolist()):
                v = value[group == g]
                total[g] = total.get(g, 0) + np.stack([(v == x).sum(axis=0) for x in range(4)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), _NODE), pa.array([t.tobytes() for t in total.values()], _NODE)], names=["g", "counts"])

    def commonest(part: pa.Table) -> pa.Table:
        counts = _matrix(part.column("counts"), np.int64, 4 * sh.VALUES).sum(axis=0).reshape(4, sh.VALUES)
        sketch = sh.sketches((counts.argmax(axis=0).astype(np.uint32) << np.uint32(16))[None, :]).view(np.int64)[0]
        return pa.table({"g": part.column("g")[:1], **{f"m{i}": pa.array([int(sketch[i])], pa.int64()) for i in range(4)}})

    partial = members.select("g", "s0", "s1", "s2", "s3").mapInArrow(counted, "g binary, counts binary")
    common = partial.groupBy("g").applyInArrow(commonest, "g binary, m0 long, m1 long, m2 long, m3 long")
    even = 0x5555555555555555
    apart = sum(F.bit_count((x := F.col(f"s{i}").bitwiseXOR(F.col(f"m{i}"))).bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(even))) for i in range(4))
    near = to_members(members, common).groupBy("g", "salt").agg(F.min(F.struct(apart.alias("apart"), "node")).alias("near"))
    return near.groupBy("g").agg(F.min("near")["node"].alias("pivot"))


def links(docs: DataFrame, units: DataFrame, loose: DataFrame, path: str, key: str, text: str, width: int, percent: int) -> DataFrame:
    """Edges that span all links, from candidate components (node, root)."""
    # only large groups have their size noted: the table of these is small, and the others are bounded
    sizes = stored(loose.groupBy(F.col("root").alias("g")).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > GROUP), f"{path}/sizes")
    sized = to_members(loose.withColumnRenamed("root", "g"), sizes, "left")
    members = sized.join(units, "node").select("node", "k", "th", "g", "size", "s0", "s1", "s2", "s3")
    sets = stored(with_items(docs, key, text, width, members), f"{path}/sets")
    small = sets.where("size is null").select("g", F.lit(False).alias("query"), "node", "items")
    large = sets.where("size is not null")
    found = stored(confirmed(small, ["g"], percent), f"{path}/small")
    if large.isEmpty():
        return found
    pivots = stored(middle(large), f"{path}/pivots")
    parts = F.ceil(F.col("size") / MEMBERS).cast("int")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    every = F.explode(F.sequence(F.lit(0), parts - 1))
    dealt = large.select("g", part.alias("part"), F.lit(False).alias("query"), "node", "items")
    asked = large.join(pivots.select(F.col("pivot").alias("node")), "node").select("g", every.alias("part"), F.lit(True).alias("query"), "node", "items")
    first = stored(confirmed(dealt.unionByName(asked), ["g", "part"], percent), f"{path}/first")
    linked = first.select(F.col("a").alias("node")).distinct()
    alone = large.select("g", "node").join(pivots.select(F.col("pivot").alias("node")), "node", "left_anti").join(linked, "node", "left_anti")
    alone = stored(alone, f"{path}/alone")
    found = found.unionByName(first)
    if alone.isEmpty():
        return found
    counts = stored(alone.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("blocks")), f"{path}/counts")
    with_blocks = to_members(large, counts)
    block = F.pmod(F.xxhash64(F.lit(1), F.col("node")), F.col("blocks")).cast("int")
    dealt = with_blocks.select("g", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("query"), "node", "items")
    asked = with_blocks.join(alone.select("node"), "node").select("g", every.alias("part"), block.alias("block"), F.lit(True).alias("query"), "node", "items")
    rest = stored(confirmed(dealt.unionByName(asked), ["g", "part", "block"], percent), f"{path}/rest")
    return found.unionByName(rest)


# 4. Components ---------------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs: k, th, n_shingles, component (the least key of all rows that links lead to) and group.

    group tells components apart whose least keys are equal; null without shingles.

    Null and blank texts have no shingles and no links; equal sets are always
    linked.  Rows without key count as having the largest; rows that repeat
    key and text are one document.  Extra columns don't matter.  An empty
    table gives no rows.
    """
    rows = stored(signed(docs, key, text, width), f"{path}/rows")
    units = stored(classes(rows), f"{path}/units")
    loose = components(stored(forest_edges(units), f"{path}/forest"), f"{path}/loose")
    give_back(docs.sparkSession)
    found = components(links(docs, units, loose, path, key, text, width, percent), f"{path}/found")
    member = units.select("node", "k").join(found, "node", "left")
    least = member.where("root is not null").groupBy("root").agg(F.min("k").alias("least"))
    named = stored(member.join(least, "root", "left").select("node", F.coalesce("least", "k").alias("component"), F.coalesce("root", "node").alias("group")), f"{path}/named")
    return rows.select("k", "th", "n_shingles", "node").join(named, "node", "left").select("k", "th", "n_shingles", F.coalesce("component", "k").alias("component"), "group")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    give_back(spark)
    found = near_duplicates(table(spark, sf_dir, "documents"), shared_dir(spark), width=4)
    known = F.nullif(F.col("k"), F.lit(NO_KEY))
    return found.select(known.alias("doc_id"), "n_shingles", F.nullif(F.col("component"), F.lit(NO_KEY)).alias("component_id"), (F.col("k") == F.col("component")).alias("kept"))
