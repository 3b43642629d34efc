"""Near copies among embeddings by spherical-cap filters from structured random product codes.

A filter is a direction; a vector belongs to it if their inner product reaches a threshold,
that is, if the vector lies in the cap around it. The directions are products: after a random
rotation a vector is split in two halves, each half has a code of random unit vectors, and
every pair of code words is a direction. So all exceeding directions of a vector are decoded
from two short lists of inner products. ``ROTATIONS`` such codes are used. Their number of
directions grows with the corpus (``PER_FILTER`` vectors a direction), and the threshold
is set on random vectors so that a vector has ``CAPS`` filters a rotation on
average; after a random rotation that holds for any vector.

Vectors meet in their filters, where sign sketches of ``SKETCH`` bits tell which may be
near. The clusters that hang together by sketches are then verified: all cosines in double
precision, between blocks of vectors in numpy. A large cluster is dealt out as pairs
of blocks; a task returns counts of links and a spanning forest, never the pairs. Equal
vectors are one before all that, counted by their ids.

What can be missed: a pair with no filter in common. At cosine 0.95 in 64 dimensions that are
about 0.5 % of pairs, measured on random pairs, fewer in clusters. A sketch loses
a pair at that cosine with a chance under one in ten million. In a filter that holds more than
``CHUNK`` vectors, each is compared with its chunk and with a kept front of vectors, not with
all. What is found is exact. The worst case, all vectors hanging together by sketches
(angles below 45 degrees), stays quadratic in arithmetic, spread over the tasks.

Defined cases: a NULL, empty or zero vector, and one with NULL or non-finite components, links
with nothing; vectors of different lengths do not link; equal vectors link; rows
alike in id and vector are one vector; a NULL id links with nothing, has no component and
is kept; an empty table returns no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.llm.common import fields, query, scratch, table
from leadlift.llm.graph import components

ROTATIONS, CAPS = 8, 4
#: Vectors of the corpus for each direction of a code.
PER_FILTER = 2
#: Bits of a sign sketch, and how many may differ: 13 +- 3.4 do at cosine 0.95, 64 +- 5.7 at 0.
SKETCH, APART = 128, 32
#: Vectors of one filter that are compared at once.
CHUNK = 1024
#: Vectors a block of a cluster, beyond 8 blocks up to ``MOST``.
BLOCK, MOST = 256, 16_384


class Code:
    """One rotation's product code for vectors of ``size`` components."""

    def __init__(self, size: int, directions: int, seed: int):
        draw = np.random.default_rng([seed, size])
        self.rotation = np.linalg.qr(draw.standard_normal((size, size)))[0]
        self.cut = max(1, size // 2)
        self.words = max(1, int(np.ceil(np.sqrt(directions))))
        self.left = self.code(draw, self.cut)
        # A vector of one component has no second half: one empty word.
        self.right = self.code(draw, size - self.cut) if size > 1 else np.zeros((1, 0))
        probe = draw.standard_normal((256, size))
        probe /= np.linalg.norm(probe, axis=1)[:, None]
        self.level = -np.inf
        wanted = min(CAPS * len(probe), len(probe) * len(self.left) * len(self.right))
        best = np.zeros(0)
        for one in probe:
            sums = (self.left @ one[: self.cut])[:, None] + (self.right @ one[self.cut :])[None, :]
            best = np.concatenate([best, sums[sums >= self.level]])
            if len(best) > wanted:
                best = np.partition(best, len(best) - wanted)[-wanted:]
                self.level = best.min()
        self.level = best.min()

    def code(self, draw, size: int) -> np.ndarray:
        code = draw.standard_normal((self.words, size))
        return code / np.linalg.norm(code, axis=1)[:, None]

    def __call__(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, directions) of all caps that hold them, decoded from the halves' lists."""
        turned = unit @ self.rotation
        first, second = turned[:, : self.cut] @ self.left.T, turned[:, self.cut :] @ self.right.T
        a_row, a = np.nonzero(first >= self.level - second.max(axis=1)[:, None])
        b_row, b = np.nonzero(second >= self.level - first.max(axis=1)[:, None])
        starts = np.searchsorted(b_row, np.arange(len(unit) + 1))
        many = (starts[1:] - starts[:-1])[a_row]
        left = np.repeat(np.arange(len(a)), many)
        right = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + starts[a_row[left]]
        rows = a_row[left]
        good = first[rows, a[left]] + second[rows, b[right]] >= self.level
        return rows[good], a[left[good]] * len(self.right) + b[right[good]]


def sketches(unit: np.ndarray) -> np.ndarray:
    planes = np.random.default_rng([991, unit.shape[1]]).standard_normal((unit.shape[1], SKETCH))
    return np.packbits(unit @ planes > 0, axis=1).view(np.uint64)


def units(vectors: list[bytes]) -> np.ndarray:
    """Unit vectors; scaled first, so that no length overflows."""
    full = np.stack([np.frombuffer(v, np.float64) for v in vectors])
    full = full / np.abs(full).max(axis=1)[:, None]
    return full / np.linalg.norm(full, axis=1)[:, None]


def packed(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vec, digest): components as bytes of doubles; NULL where nothing can link."""
    out = fields(vec_id="long", vec="binary", digest="binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            vecs = []
            for value in batch.column(1).to_pylist():
                full = None
                if value and None not in value:
                    full = np.array(value, np.float64) + 0.0  # no negative zeros
                    full = full if np.isfinite(full).all() and full.any() else None
                vecs.append(None if full is None else full.tobytes())
            digests = [v and xxhash.xxh3_128_digest(v) for v in vecs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vecs, pa.binary()), pa.array(digests, pa.binary())], names=out.names)

    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector)).mapInArrow(run, out)


def decoded(nodes: DataFrame, directions: int) -> DataFrame:
    """(cap, turn, node, s0, s1): a row for each vector and filter that holds it."""
    out = fields(cap="long", turn="long", node="long", s0="long", s1="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, list[Code]] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                ids, vecs = batch.column(0).to_numpy(), batch.column(1).to_pylist()
                sizes = np.array([len(v) // 8 for v in vecs])
                for size in np.unique(sizes).tolist():
                    mine = np.flatnonzero(sizes == size)
                    unit = units([vecs[i] for i in mine])
                    signs = sketches(unit).view(np.int64)
                    if size not in codes:
                        codes[size] = [Code(size, directions, seed) for seed in range(ROTATIONS)]
                    for seed, code in enumerate(codes[size]):
                        rows, caps = code(unit)
                        cap = (caps.astype(np.int64) * ROTATIONS + seed) * 100_003 + size
                        node = ids[mine[rows]]
                        # Within a filter vectors stand in an order of its own.
                        turn = ((node.view(np.uint64) ^ cap.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cap, turn, node, signs[rows, 0], signs[rows, 1])], names=out.names)

    return nodes.select("node", "vec").mapInArrow(run, out)


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = np.bitwise_count(a[:, None, 0] ^ b[None, :, 0]).astype(np.int16) + np.bitwise_count(a[:, None, 1] ^ b[None, :, 1])
    return apart <= APART


def forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """The edges (left, right) among ``n`` that join what was apart before."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    tree = []
    for x, y in zip(left.tolist(), right.tolist()):
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            tree.append((x, y))
    return tree


class Filter:
    """Vectors of one filter as they come: edges of near ones, and the front that is kept."""

    def __init__(self):
        self.front, self.signs = np.zeros(0, np.int64), np.zeros((0, 2), np.uint64)

    def add(self, node: np.ndarray, signs: np.ndarray) -> list[tuple[int, int]]:
        edges = []
        for at in range(0, len(node), CHUNK):
            ids, own = node[at : at + CHUNK], signs[at : at + CHUNK]
            inner = np.nonzero(np.triu(close(own, own), 1))
            edges += [(int(ids[x]), int(ids[y])) for x, y in forest(len(ids), *inner)]
            alone = np.ones(len(ids), bool)
            if len(self.front):
                k = len(self.front)
                met, kept = np.nonzero(close(own, self.signs))
                edges += [(int(ids[x]), int(self.front[y - len(ids)])) for x, y in forest(len(ids) + k, met, kept + len(ids))]
                alone[met] = False
            # The first chunk is kept whole, of later ones what met nothing.
            self.front = np.concatenate([self.front, ids[alone]])
            self.signs = np.concatenate([self.signs, own[alone]])
        return edges


def small_filters(starts: np.ndarray, ends: np.ndarray, node: np.ndarray, signs: np.ndarray) -> list[tuple[int, int]]:
    """Edges inside whole filters of up to 64 rows, all filters at once."""
    size = ends - starts
    edges: list[tuple[int, int]] = []
    owner = np.repeat(np.arange(len(size)), size)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    row = starts[owner] + place
    lefts, rights = [], []
    for step in range(1, int(size.max(initial=1))):
        left = row[place + step < size[owner]]
        apart = np.bitwise_count(signs[left] ^ signs[left + step]).sum(axis=1)
        left = left[apart <= APART]
        lefts.append(left)
        rights.append(left + step)
    if lefts:
        left, right = np.concatenate(lefts), np.concatenate(rights)
        used, at = np.unique(np.concatenate([left, right]), return_inverse=True)
        tree = forest(len(used), at[: len(left)], at[len(left) :])
        edges += [(int(node[used[x]]), int(node[used[y]])) for x, y in tree]
    return edges


def met(rows: DataFrame) -> DataFrame:
    """(a, b, cap, s0, s1): near vectors of one filter; rows without b are a partition's ends."""
    out = fields(a="long", b="long", cap="long", s0="long", s1="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(edges: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = (np.array([e[i] for e in edges], np.int64) for i in (0, 1))
            none = pa.nulls(len(a), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, none, none], names=out.names)

        def end(cap: int, kept: Filter) -> pa.RecordBatch:
            n = len(kept.front)
            signs = kept.signs.view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(kept.front), pa.nulls(n, pa.int64()), pa.array(np.full(n, cap)), pa.array(signs[:, 0]), pa.array(signs[:, 1])], names=out.names
            )

        open_cap, state, first = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            cap, node = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            signs = np.stack([batch.column(3).to_numpy(), batch.column(4).to_numpy()], axis=1).view(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], cap[1:] != cap[:-1]]))
            ends = np.append(starts[1:], len(cap))
            # A filter at either end of a batch may go on in another one.
            inner = np.zeros(len(starts), bool)
            inner[1:-1] = (ends - starts)[1:-1] <= 64
            edges = small_filters(starts[inner], ends[inner], node, signs)
            for s, e in zip(starts[~inner].tolist(), ends[~inner].tolist()):
                if cap[s] != open_cap:
                    if first and state is not None:
                        first = False
                        yield end(open_cap, state)
                    open_cap, state = int(cap[s]), Filter()
                edges += state.add(node[s:e], signs[s:e])
            if edges:
                yield pack(edges)
        if state is not None:
            yield end(open_cap, state)

    return rows.mapInArrow(run, out)


def across(ends: DataFrame) -> DataFrame:
    """(a, b): near vectors of a filter that was cut by a partition's end. Few rows a partition."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        signs = frame[["s0", "s1"]].to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame(Filter().add(frame["a"].to_numpy(), signs), columns=["a", "b"], dtype="int64")

    return ends.select("cap", "a", "s0", "s1").groupBy("cap").applyInPandas(run, fields(a="long", b="long"))


def verified(members: DataFrame, least: float) -> DataFrame:
    """(a, b, n): for each vector ``a`` the ids that it links to in a task, or a tree edge to ``b``."""
    sizes = scratch(members.groupBy("comp").agg(F.count("*").alias("size")), "cap-sizes")
    blocks = F.least(F.ceil(F.col("size") / BLOCK), F.greatest(F.lit(8), F.ceil(F.col("size") / MOST))).cast("int")
    sized = members.join(sizes.filter("size > 1").select("comp", blocks.alias("blocks")), "comp")
    own = F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j"))
    )
    dealt = sized.withColumn("own", own).withColumn("p", F.explode(pair))
    dealt = dealt.select("comp", "node", "digest", "vec", "ids", "own", F.col("p.i").alias("i"), F.col("p.j").alias("j"))
    out = fields(a="binary", x="long", y="long", n="long")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(frame["i"].iat[0]), int(frame["j"].iat[0])
        frame = frame.sort_values("digest", kind="stable")
        sizes = frame["vec"].str.len()
        rows = []
        for _, part in frame.groupby(sizes):
            own, node, ids = part["own"].to_numpy(), part["node"].to_numpy(), part["ids"].to_numpy()
            unit, digests = units(part["vec"].tolist()), part["digest"].to_numpy()
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            found = np.zeros(len(part), np.int64)
            tree_left, tree_right = [], []
            for at in range(0, len(left), 512):
                mine = left[at : at + 512]
                links = (unit[mine] @ unit[right].T >= least) & (mine[:, None] != right[None, :])
                found[mine] += links @ ids[right]
                if i != j:
                    found[right] += links.T @ ids[mine]
                # One link to the left side's each right vector is enough, and each left one's first.
                tree = forest(len(part), *(side[k] for side, k in zip((mine, right), np.nonzero(links))))
                tree_left += [x for x, _ in tree]
                tree_right += [y for _, y in tree]
            rows += [(d, None, None, n) for d, n in zip(digests, found.tolist()) if n]
            for x, y in forest(len(part), np.array(tree_left, np.int64), np.array(tree_right, np.int64)):
                rows.append((None, node[x], node[y], None))
        frame = pd.DataFrame(rows, columns=["a", "x", "y", "n"])
        return frame.astype({"x": "Int64", "y": "Int64", "n": "Int64"})

    return dealt.groupBy("comp", "i", "j").applyInPandas(run, out)


def classes(vectors: DataFrame, least: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    rows = scratch(packed(vectors, vec_id, vector), "cap-vectors")
    able = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    nodes = able.groupBy("digest").agg(F.min("vec_id").alias("node"), F.first("vec").alias("vec"), F.count_distinct("vec_id").alias("ids"))
    nodes = scratch(nodes, "cap-nodes")
    directions = max(1, nodes.count() // PER_FILTER)
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["cap", "turn", "node"]
    caps = decoded(nodes, directions).repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    found = scratch(met(caps), "cap-met")
    edges = found.filter(F.col("b").isNotNull()).select("a", "b")
    clusters = components(edges.unionAll(across(found.filter(F.col("b").isNull()))).distinct())
    members = scratch(nodes.join(clusters, "node"), "cap-members")
    links = scratch(verified(members, least), "cap-links")
    counts = links.filter(F.col("a").isNotNull()).groupBy(F.col("a").alias("digest")).agg(F.sum("n").alias("others"))
    final = components(links.filter(F.col("x").isNotNull()).select(F.col("x").alias("a"), F.col("y").alias("b")))
    named = nodes.select("digest", "node", "ids").join(final, "node", "left").join(counts, "digest", "left")
    named = scratch(
        named.select("digest", F.coalesce("comp", "node").alias("comp"), (F.col("ids") - 1 + F.coalesce("others", F.lit(0))).alias("n")), "cap-classes"
    )
    out = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest")).join(named, "digest", "left")
    component = F.coalesce("comp", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


@query()
def op13_spherical_caps(spark, sf_dir):
    return classes(table(spark, sf_dir, "embeddings"))
