"""Near duplicates by an LSH forest: sorted orders of signatures and their neighbours.

Texts with equal shingle sets form one node. Each node has ``TREES`` signatures of
``LABEL`` minhash values. For every tree the nodes are sorted by signature; a region is a
stretch whose first ``DEPTH`` values agree, and inside it the order goes on by the
values that follow, so next to a node stand those with which it shares the longest
prefix, however deep the region's density asks for. Neighbours in an order are
candidates. Two sets of similarity 0.8 share a region in no tree with a chance of
3 in a million, and all nodes of a region hang together through its neighbours: linked
texts are always in one cluster of candidates.

Inside each cluster full shingle sets are compared, through an inverted index in
numpy, and links are confirmed in whole numbers. A cluster of many shingles is dealt out
as pairs of blocks to several tasks, so none holds a large cluster whole, and a task
returns a spanning forest of its links, not the pairs. The forests' components are
the classes.

Defined cases: texts without words are linked with nothing; fewer words than a shingle
are one shingle, the whole sequence; equal texts are linked; a row without doc_id is
linked with nothing, its class is NULL and it is kept; rows that share a doc_id count as
one document; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlift.llm.common import fields, query, scratch, slices, table, words
from leadlift.llm.graph import components

TREES, DEPTH, LABEL = 32, 5, 6
#: Shingles that a task compares at once: up to 8 blocks of ``BLOCK``, then blocks of ``MOST``.
BLOCK, MOST = 200_000, 4_000_000


class Shingler:
    """Distinct shingles of a text as sorted 64-bit numbers."""

    FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)

    def __init__(self, size: int, most: int = 500_000):
        import xxhash

        self.size, self.most, self.known = size, most, {}
        self.number = xxhash.xxh3_64_intdigest
        self.factors = [np.uint64(f) for f in np.resize(self.FACTORS, size) + np.arange(size, dtype=np.uint64) * np.uint64(2)]

    def __call__(self, text: str | None) -> np.ndarray:
        parts = words(text)
        if len(parts) < self.size:
            return np.array([self.number(b" ".join(parts), len(parts))] if parts else [], dtype=np.uint64)
        if len(self.known) > self.most:
            self.known = {}
        known = self.known
        for part in set(parts).difference(known):
            known[part] = self.number(part)
        ids = np.array([known[p] for p in parts], dtype=np.uint64)
        n = len(ids) - self.size + 1
        mixed = np.zeros(n, dtype=np.uint64)
        for i, factor in enumerate(self.factors):
            mixed += ids[i : i + n] * factor
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


class Signer:
    def __init__(self):
        draw = np.random.default_rng(20240)
        self.a = draw.integers(0, 2**63, TREES * LABEL, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 2**63, TREES * LABEL, dtype=np.uint64)

    def __call__(self, shingles: np.ndarray) -> bytes:
        """For each tree the hash of its first ``DEPTH`` values, then the value after."""
        low = np.full(TREES * LABEL, np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(shingles), 2048):
            part = shingles[at : at + 2048]
            mixed = part[None, :] * self.a[:, None] + self.b[:, None]
            np.minimum(low, mixed.min(axis=1), out=low)
        values = (low >> np.uint64(20)).reshape(TREES, LABEL)
        prefix = np.zeros(TREES, dtype=np.uint64)
        for depth in range(DEPTH):
            prefix = (prefix ^ values[:, depth]) * np.uint64(0x9E3779B97F4A7C15)
            prefix ^= prefix >> np.uint64(31)
        return np.stack([prefix, values[:, DEPTH]], axis=1).tobytes()


def sketch(docs: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, digest, labels) a row; digest and labels are NULL without words."""
    out = fields(doc_id="long", n="long", digest="binary", labels="binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingle, sign = Shingler(size), Signer()
        for batch in slices(batches, 1 << 22):
            rows = []
            for value in batch.column(1).to_pylist():
                got = shingle(value)
                if len(got):
                    rows.append((len(got), xxhash.xxh3_128_digest(got.tobytes()), sign(got)))
                else:
                    rows.append((0, None, None))
            n, digest, labels = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(labels, pa.binary())], names=out.names
            )

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, out)


def orders(nodes: DataFrame) -> DataFrame:
    """(tree, region, deep, node): each node's place in every order."""
    out = fields(tree="int", region="long", deep="long", node="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                node = batch.column(0).to_numpy()
                labels = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64).reshape(len(node), TREES, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(node))),
                        pa.array(labels[:, :, 0].ravel()),
                        pa.array(labels[:, :, 1].ravel()),
                        pa.array(np.repeat(node, TREES)),
                    ],
                    names=out.names,
                )

    return nodes.select("node", "labels").mapInArrow(run, out)


def neighbours(nodes: DataFrame, partitions: int) -> DataFrame:
    """(a, b): nodes that stand side by side in a region of some order."""
    keys = ["tree", "region", "deep", "node"]
    placed = orders(nodes).repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    out = fields(a="long", b="long", tree="int", region="long", part="int", last="boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        before = None
        for batch in batches:
            tree, region, node = (batch.column(i).to_numpy() for i in (0, 1, 3))
            if not len(node):
                continue
            edge = lambda a, b, at, last, n: pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(tree[at]), pa.array(region[at]), pa.array(np.full(n, part, np.int32)), pa.array([last] * n, pa.bool_())],
                names=out.names,
            )
            if before is None:
                yield edge(node[:1], np.full(1, -1), slice(0, 1), False, 1)  # the partition's ends: rows with b = -1
            elif before[:2] == (tree[0], region[0]):
                yield edge(np.array([before[2]]), node[:1], slice(0, 1), None, 1)
            same = np.flatnonzero((tree[1:] == tree[:-1]) & (region[1:] == region[:-1]))
            if len(same):
                yield edge(node[same], node[same + 1], same, None, len(same))
            before = (tree[-1], region[-1], node[-1])
        if before:
            yield pa.RecordBatch.from_arrays(
                [pa.array([before[2]]), pa.array([-1]), pa.array([before[0]], pa.int32()), pa.array([before[1]]), pa.array([part], pa.int32()), pa.array([True])],
                names=out.names,
            )

    found = scratch(placed.mapInArrow(run, out), "neighbours")
    # Regions cut by a partition's end: joined by the next partition's first row. Two rows a partition.
    ends = found.filter(F.col("last").isNotNull())
    held = F.min("a").over(Window.partitionBy("tree", "region"))
    across = ends.select(F.col("a"), held.alias("b"))
    return found.filter(F.col("last").isNull()).select("a", "b").unionAll(across).filter("a != b").distinct()


def compare(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets`` between a left and a right one."""
    n = len(sets)
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    length = np.diff(np.append(starts, len(ordered)))
    term = np.empty(len(flat), dtype=np.int64)
    term[order] = np.repeat(np.arange(len(starts)), length)
    holders = owner[order]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    links: list[tuple[int, int]] = []
    for x in np.flatnonzero(left):
        mine = term[bounds[x] : bounds[x + 1]]
        mine = mine[length[mine] > 1]
        if not len(mine):
            continue
        # All holders of all its shingles, without a loop over them.
        reach = length[mine]
        at = np.repeat(starts[mine] - np.concatenate([[0], np.cumsum(reach)[:-1]]), reach) + np.arange(reach.sum())
        shared = np.bincount(holders[at], minlength=n)
        good = (100 * shared >= percent * (sizes + sizes[x] - shared)) & right
        good[x] = False
        for y in np.flatnonzero(good):
            a, b = find(x), find(int(y))
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(x), int(y)))
    return links


def confirmed(members: DataFrame, docs: DataFrame, size: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """(a, b): links of similarity ``percent`` per cent, a spanning forest in each task."""
    weights = scratch(members.groupBy("comp").agg(F.sum("n").alias("weight")), "weights")
    total = weights.agg(F.sum("weight")).first()[0] or 0
    tasks = int(total // BLOCK) + 1
    blocks = F.least(F.ceil(F.col("weight") / BLOCK), F.greatest(F.lit(8), F.ceil(F.col("weight") / MOST))).cast("int")
    sized = members.join(weights.select("comp", blocks.alias("blocks")), "comp")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    sized = scratch(sized.select("comp", "node", "digest", "blocks", own.alias("own")), "members")
    texts = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))
    # Never by broadcast: the members grow with the corpus.
    whole = texts.join(sized.hint("merge"), "node")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j")),
    )
    # Small clusters share a task; a pair of blocks of a large one is a task.
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(tasks))).otherwise(F.xxhash64("comp", "p.i", "p.j"))
    dealt = whole.withColumn("p", F.explode(pair)).select(
        "comp", "node", "digest", "own", "text", F.col("p.i").alias("i"), F.col("p.j").alias("j"), task.alias("task"),
        (F.col("blocks") > 1).alias("cut"),
    )

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        import xxhash

        shingle = Shingler(size)
        found = []
        frame = frame.sort_values(["comp", "i", "j", "node"], kind="stable")
        for (_, i, j), part in frame.groupby(["comp", "i", "j"], sort=False):
            sets, nodes, own_block = [], [], []
            for node, digest, block, value in zip(part["node"], part["digest"], part["own"], part["text"]):
                got = shingle(value)
                if xxhash.xxh3_128_digest(got.tobytes()) == bytes(digest):
                    sets.append(got)
                    nodes.append(node)
                    own_block.append(block)
            own_block = np.array(own_block)
            if len(sets) > 1:
                links = compare(sets, own_block == i, own_block == j, percent)
                found += [(nodes[x], nodes[y]) for x, y in links]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("task").applyInPandas(run, fields(a="long", b="long"))


def classes(
    docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    sketched = scratch(sketch(docs, size, doc_id, text), "sketches")
    placed = sketched.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    nodes = scratch(
        placed.groupBy("digest").agg(F.min("doc_id").alias("node"), F.max("n").alias("n"), F.max("labels").alias("labels")), "nodes"
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    clusters = components(neighbours(nodes, partitions))
    members = nodes.select("node", "digest", "n").join(clusters, "node")
    links = scratch(confirmed(scratch(members, "clustered"), docs, size, percent, doc_id, text), "links")
    final = components(links)
    named = nodes.select("digest", "node").join(final, "node", "left")
    named = scratch(named.select("digest", F.coalesce("comp", "node").alias("comp")), "classes")
    out = sketched.drop("labels").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` with one document of each class, the one of the least id."""
    gone = classes(docs, size, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


@query()
def op7_lsh_forest(spark, sf_dir):
    return classes(table(spark, sf_dir, "documents"), size=4)
