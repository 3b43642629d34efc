"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is its words, each closed by a blank, and one end sign. A byte is eight binary
decisions, each with a context tree of its own over the bytes before it, the nearest
first. The first two symbols of a word see the blank and the ``TAIL`` bytes before it, those
that follow see their own word, up to ``DEPTH`` bytes. A node's Krichevsky-Trofimov
estimate depends on its counts of zeros and ones alone, so the trees come from counts
that Spark sums: P_w = (P_e + product of the children's P_w) / 2, level by level from the
leaves, with one shuffle each. Down from the root the mixture over all depths then gives
each leaf its probability of a one.

Counts come from the learning rows only. Words and contexts of all rows are in the
tables, those not learnt from with no counts, so each has its probability, worked out
once. The tables grow with the corpus: what is broadcast is their head, the entries that
occur most, ``WORDS`` and ``KEYS`` at most; the others are joined by a shuffle.

Defined cases: NULL and empty texts are the end sign alone; repeated rows count and are
scored each; a NULL doc_id is learnt from; without learning rows every bit costs one bit;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.llm.common import fields, query, remainder_column, scratch, slices, table, words

DEPTH, TAIL = 5, 3
WORDS, KEYS = 250_000, 400_000
#: Bytes of rows that a task works on at once; its arrays take some hundred times that.
SLICE = 1 << 20
END, BLANK = b"\n", 0x20
HALF = float(np.log(0.5))


def count_words(docs: DataFrame, learn: Column, text: str, most: int = 200_000) -> DataFrame:
    """(word, key, c): occurrences in learning rows of each word, or else of each start.

    Words and starts of other rows only have 0.
    """
    out = fields(word="binary", key="long", c="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def words_so_far() -> pa.RecordBatch:
            n = len(counts)
            got = [pa.array(counts.keys(), pa.binary()), pa.nulls(n, pa.int64()), pa.array(counts.values(), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(got, names=out.names)

        def starts_so_far() -> pa.RecordBatch:
            distinct, c = summed(*map(np.concatenate, zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.nulls(len(distinct), pa.binary()), pa.array(distinct), pa.array(c)], names=out.names)

        for batch in slices(batches, SLICE):
            texts, learnt = [words(v) for v in batch.column(0).to_pylist()], batch.column(1).to_pylist()
            for parts, known in zip(texts, learnt):
                if known:
                    counts.update(parts)
                    counts[END] += 1
                else:
                    for part in (*parts, END):
                        if part not in counts:
                            counts[part] = 0
            if len(counts) > most:
                yield words_so_far()
            keys, owner = starts(texts)
            held.append(summed(keys, np.array(learnt, dtype=bool)[owner]))
            if sum(len(k) for k, _ in held) > most:
                yield starts_so_far()
        yield words_so_far()
        if held:
            yield starts_so_far()

    parts = docs.select(F.col(text), learn.alias("learn")).mapInArrow(run, out)
    return parts.groupBy("word", "key").agg(F.sum("c").alias("c"))


def summed(keys: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and of each the sum of its counts."""
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, weights=c, minlength=len(distinct)).astype(np.int64)


def starts(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(context << 8 | symbol) of the first two symbols of all words and of the end signs.

    With them the number of the text; before a text's first word lie zeros.
    """
    lead = b"\0" * TAIL + b" "
    streams = [lead + b" ".join([*parts, END]) for parts in texts]
    flat = np.frombuffer(b"".join(streams) + b" ", dtype=np.uint8).astype(np.int64)
    ends = np.cumsum([len(x) for x in streams])
    first = np.flatnonzero(flat[:-1] == BLANK) + 1
    first = first[first < len(flat) - 1]
    second = first[flat[first] != END[0]] + 1
    before = np.zeros(len(first), dtype=np.int64)
    for back in range(TAIL):
        before |= flat[first - 2 - back] << (8 * back)
    key0 = (before << 8 | BLANK) << 8 | flat[first]
    inside = flat[first] != END[0]
    key1 = ((before[inside] << 8 | BLANK) << 8 | flat[first[inside]]) << 8 | flat[second]
    key1 &= (1 << 8 * (DEPTH + 1)) - 1
    owner = np.searchsorted(ends, first, side="right")
    return np.concatenate([key0, key1]), np.concatenate([owner, owner[inside]])


def positions(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The same of the symbols that follow in the words, with the number of the word."""
    closed = [b"" if p == END else p + b" " for p in parts]
    size = np.array([len(p) for p in closed], dtype=np.int64)
    flat = np.frombuffer(b"".join(closed), dtype=np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(closed)), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    later = np.flatnonzero(place >= 2)
    place, owner = place[later], owner[later]
    context = np.zeros(len(later), dtype=np.int64)
    for back in range(1, DEPTH + 1):
        byte = flat[np.maximum(later - back, 0)]
        byte = np.where(place == back - 1, BLANK, np.where(place < back, 0, byte))
        context |= byte << (8 * (back - 1))
    return context << 8 | flat[later], owner


def count_contexts(vocabulary: DataFrame, most: int = 500_000) -> DataFrame:
    """(key, c, uses): deepest context and symbol inside words, its count, and in how many words."""
    out = fields(key="long", c="long", uses="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, counts, held
            key, at, uses = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            c = np.zeros(len(key), dtype=np.int64)
            np.add.at(c, at, np.concatenate(counts))
            keys, counts, held = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(c), pa.array(uses)], names=out.names)

        for batch in slices(batches, SLICE):
            key, owner = positions(batch.column(0).to_pylist())
            keys.append(key)
            counts.append(batch.column(1).to_numpy()[owner])
            held += len(key)
            if held > most:
                yield flush()
        if held:
            yield flush()

    return vocabulary.select("word", "c").mapInArrow(run, out).groupBy("key").agg(F.sum("c").alias("c"), F.sum("uses").alias("uses"))


def lgamma(x, log=F.log):
    """log Gamma for x >= 0.5, by Stirling's series at x + 7; of columns or, with np.log, of arrays."""
    low = log(x * (x + 1) * (x + 2)) + log((x + 3) * (x + 4) * (x + 5) * (x + 6))
    z = x + 7
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * log(z) - z + float(0.5 * np.log(2 * np.pi)) + series - low


def estimate(a, b, log=F.log):
    """log of the Krichevsky-Trofimov probability of a zeros and b ones, as floating numbers."""
    return lgamma(a + 0.5, log) + lgamma(b + 0.5, log) - lgamma(a + b + 1, log) - float(np.log(np.pi))


def at_depth(key: Column, depth: int) -> Column:
    """The node (context << 8 | decision) with its context cut to ``depth`` bytes."""
    return key.bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1).cast("long"))


def decisions(owner: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner << 8 | decision) and the bit, for the eight decisions of each symbol, symbol by symbol."""
    k = np.arange(8)
    node = (symbol[:, None] | 256) >> (8 - k)
    bit = symbol[:, None] >> (7 - k) & 1
    return (owner[:, None] << 8 | node).ravel(), bit.ravel()


def leaf_counts(node: np.ndarray, bit: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct nodes, zeros and ones of each, and each decision's place among them."""
    distinct, at = np.unique(node, return_inverse=True)
    weight = np.repeat(c, 8).astype(float)
    zeros = np.bincount(at, weights=weight * (1 - bit), minlength=len(distinct))
    return distinct, zeros, np.bincount(at, weights=weight * bit, minlength=len(distinct)), at


def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column's entries, and the row of each."""
    flat = column.flatten()
    return flat, np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))


def leaf_sums(leaves: DataFrame) -> DataFrame:
    """(node, a, b, below): of each node one byte above the leaves, the sums over its leaves."""
    out = fields(node="long", a="double", b="double", below="double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            entries, row = lists(batch.column(1))
            context = batch.column(0).to_numpy()
            node, bit = decisions(row, entries.field("symbol").to_numpy())
            distinct, a, b, _ = leaf_counts(node, bit, entries.field("c").to_numpy())
            up = (context[distinct >> 8] & ((1 << 8 * (DEPTH - 1)) - 1)) << 8 | (distinct & 255)
            parents, at = np.unique(up, return_inverse=True)
            sums = [np.bincount(at, weights=x, minlength=len(parents)) for x in (a, b, estimate(a, b, np.log))]
            yield pa.RecordBatch.from_arrays([pa.array(parents), *map(pa.array, sums)], names=out.names)

    parts = leaves.select("context", "entries").mapInArrow(run, out)
    return parts.groupBy("node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("below").alias("below"))


def mixtures(leaves: DataFrame) -> DataFrame:
    """(node, p, rest): down to the nodes above the leaves, the mixture of the estimates so
    far and the weight that is left for the leaf."""
    own, one = estimate(F.col("a"), F.col("b")), (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1)
    most = F.greatest("own", "below")
    weighted = most + HALF + F.log1p(F.exp(F.least("own", "below") - most))
    levels: list[DataFrame] = []
    above = leaf_sums(leaves)
    for depth in range(DEPTH - 1, -1, -1):
        level = above.withColumn("own", own).select("node", "a", "b", weighted.alias("lw"))
        levels.insert(0, scratch(level, f"ctw-{depth}"))
        above = levels[0].groupBy(at_depth(F.col("node"), depth - 1).alias("node")).agg(
            F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("lw").alias("below")
        )
    stay = F.exp(own + HALF - F.col("lw"))
    mixed = levels[0].select("node", (stay * one).alias("p"), (1 - stay).alias("rest"))
    for depth in range(1, DEPTH):
        parent = mixed.select(F.col("node").alias("up"), "p", "rest")
        here = levels[depth].withColumn("up", at_depth(F.col("node"), depth - 1)).join(parent, "up")
        mixed = here.select("node", (F.col("p") + F.col("rest") * stay * one).alias("p"), (F.col("rest") * (1 - stay)).alias("rest"))
    return mixed


def symbol_scores(contexts: DataFrame) -> DataFrame:
    """(key, c, uses, lp): log10 probability of each symbol in its deepest context.

    A context has 256 symbols and 255 decisions at most, so they fit in a row.
    """
    entry = F.struct(F.col("key").bitwiseAND(F.lit(255).cast("long")).alias("symbol"), "c", "uses")
    leaves = contexts.groupBy(F.shiftright("key", 8).alias("context")).agg(F.collect_list(entry).alias("entries"))
    leaves = scratch(leaves, "leaves")
    mixed = mixtures(leaves)
    node = F.struct(F.col("node").bitwiseAND(F.lit(255).cast("long")).alias("node"), "p", "rest")
    above = mixed.groupBy(F.shiftright("node", 8).alias("up")).agg(F.collect_list(node).alias("above"))
    up = F.col("context").bitwiseAND(F.lit((1 << 8 * (DEPTH - 1)) - 1).cast("long"))
    joined = leaves.withColumn("up", up).join(above, "up").select("context", "entries", "above")
    out = fields(key="long", c="long", uses="long", lp="double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            entries, row = lists(batch.column(1))
            symbol, c = entries.field("symbol").to_numpy(), entries.field("c").to_numpy()
            node, bit = decisions(row, symbol)
            distinct, a, b, at = leaf_counts(node, bit, c)
            higher, higher_row = lists(batch.column(2))
            known = higher_row << 8 | higher.field("node").to_numpy()
            order = np.argsort(known)
            found = order[np.searchsorted(known[order], distinct)]
            one = higher.field("p").to_numpy()[found] + higher.field("rest").to_numpy()[found] * (b + 0.5) / (a + b + 1)
            chosen = np.where(bit == 1, one[at], 1 - one[at])
            lp = np.log10(chosen).reshape(-1, 8).sum(axis=1)
            key = batch.column(0).to_numpy()[row] << 8 | symbol
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(c), entries.field("uses"), pa.array(lp)], names=out.names)

    return joined.mapInArrow(run, out)


def head_of(rows: DataFrame, weight: str, most: int) -> pa.Table:
    """The rows of greatest weight, ``most`` at most and none of weight 0.

    The bound is found among steps of a twelfth of a power of two, so few rows are counted.
    """
    step = F.floor(F.log2(F.col(weight).cast("double")) * 12).alias("step")
    sizes = sorted(((r[0], r[1]) for r in rows.filter(F.col(weight) > 0).groupBy(step).count().collect()), reverse=True)
    least, held = None, 0
    for at, n in sizes:
        if held + n > most:
            break
        least, held = at, held + n
    chosen = rows.filter(F.lit(False)) if least is None else rows.filter((F.col(weight) > 0) & (step >= least))
    return chosen.toArrow().combine_chunks()


def key_head(rows: DataFrame, weight: str):
    head = head_of(rows.select("key", "lp", weight), weight, KEYS).sort_by("key")
    return rows.sparkSession.sparkContext.broadcast((head["key"].to_numpy(), head["lp"].to_numpy()))


def look_up(known: np.ndarray, lp: np.ndarray, key: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``lp`` by owner, and which keys are not known."""
    if not len(known):
        return np.zeros(n), np.ones(len(key), dtype=bool)
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    found = known[at] == key
    return np.bincount(owner[found], weights=lp[at[found]], minlength=n).astype(float), ~found


def word_scores(vocabulary: DataFrame, scored: DataFrame) -> DataFrame:
    """(word, c, lp): of every word the log10 probability from its third symbol on."""
    shared = key_head(scored, "uses")
    out = fields(id="long", word="binary", c="long", lp="double", parted="boolean", key="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per word with the sum over the head; a row per symbol outside it."""
        from pyspark import TaskContext

        next_id = TaskContext.get().partitionId() << 36
        for batch in slices(batches, SLICE):
            n = batch.num_rows
            key, owner = positions(batch.column(0).to_pylist())
            part, far = look_up(*shared.value, key, owner, n)
            ids = np.arange(next_id, next_id + n)
            next_id += n
            parted = np.bincount(owner[far], minlength=n) > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), batch.column(0), batch.column(1), pa.array(part), pa.array(parted), pa.nulls(n, pa.int64())], names=out.names
            )
            m = int(far.sum())
            if m:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[owner[far]]), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()),
                     pa.nulls(m, pa.bool_()), pa.array(key[far])],
                    names=out.names,
                )

    split = scratch(vocabulary.select("word", "c").mapInArrow(run, out), "word-parts")
    rest = split.filter(F.col("key").isNotNull()).select("id", "key").join(scored.select("key", F.col("lp").alias("more")), "key")
    rest = rest.groupBy("id").agg(F.sum("more").alias("more"))
    whole = split.filter(F.col("key").isNull())
    unfinished = whole.filter("parted").select("id", "word", "c", "lp").join(rest, "id")
    unfinished = unfinished.select("word", "c", (F.col("lp") + F.col("more")).alias("lp"))
    return whole.filter("not parted").select("word", "c", "lp").unionByName(unfinished)


def score(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: tokens, known tokens, and both log10 probabilities.

    ``bits_per_byte`` is the model's code length over the text's bytes as words.
    """
    counted = scratch(count_words(docs, learn, text), "counted")
    vocabulary = counted.filter(F.col("word").isNotNull()).select("word", "c")
    first = counted.filter(F.col("key").isNotNull()).select("key", "c", F.lit(0).cast("long").alias("uses"))
    totals = vocabulary.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    n, v = totals[0] or 0, totals[1]
    contexts = scratch(first.unionByName(count_contexts(vocabulary)), "contexts")
    symbols = scratch(symbol_scores(contexts), "symbols")
    base = F.log10((F.col("c") + 1) / F.lit(float(n + v + 1)))
    scored = word_scores(vocabulary, symbols)
    head = head_of(scored.withColumn("base", base), "c", WORDS)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((head["word"], head["lp"].to_numpy(), head["base"].to_numpy()))
    shared_keys = key_head(symbols.filter("uses = 0"), "c")
    out = fields(
        id="long", doc_id="long", learn="boolean", n_tokens="long", n_bytes="long", known="long", base="double", lp="double",
        word="binary", key="long",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per text with the sums over the heads; a row per word or start outside them."""
        from pyspark import TaskContext

        head_words, lp, base_of = shared.value
        at_of = {w: i for i, w in enumerate(head_words.to_pylist())}
        next_id = TaskContext.get().partitionId() << 36
        for batch in slices(batches, SLICE):
            texts = [words(v) for v in batch.column(2).to_pylist()]
            n = len(texts)
            key, owner = starts(texts)
            start_lp, far_key = look_up(*shared_keys.value, key, owner, n)
            sums, far_words, far_owner = [], [], []
            for i, parts in enumerate(texts):
                parts.append(END)
                at = np.fromiter(map(at_of.get, parts, repeat(-1)), dtype=np.int64, count=len(parts))
                inside = at[at >= 0]
                sums.append((len(parts), sum(map(len, parts)) + len(parts) - 1, len(inside), base_of[inside].sum(), lp[inside].sum() + start_lp[i]))
                if len(inside) < len(parts):
                    far = np.flatnonzero(at < 0).tolist()
                    far_words += [parts[j] for j in far]
                    far_owner += [i] * len(far)
            ids = np.arange(next_id, next_id + n)
            next_id += n
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(zip(*sums), kinds)),
                 pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], names=out.names)
            for of, far, words_far, keys_far in (
                (np.array(far_owner, dtype=np.int64), len(far_words), far_words, None),
                (owner[far_key], int(far_key.sum()), None, key[far_key]),
            ):
                if far:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[of]), pa.nulls(far, pa.int64()), pa.nulls(far, pa.bool_()), *(pa.nulls(far, k) for k in kinds),
                         pa.nulls(far, pa.binary()) if words_far is None else pa.array(words_far, pa.binary()),
                         pa.nulls(far, pa.int64()) if keys_far is None else pa.array(keys_far)], names=out.names)

    split = docs.select(F.col(doc_id).cast("long"), learn.alias("learn"), F.col(text)).mapInArrow(run, out)
    split = scratch(split, "text-parts")
    zero = F.lit(0.0)
    by_word = split.filter(F.col("word").isNotNull()).select("id", "word").join(scored, "word").select(
        "id", F.when(F.col("c") > 0, F.lit(1)).otherwise(0).alias("known1"), F.col("lp").alias("lp1"), base.alias("base1")
    )
    by_key = split.filter(F.col("key").isNotNull()).select("id", "key").join(symbols.select("key", F.col("lp").alias("lp1")), "key")
    by_key = by_key.select("id", F.lit(0).alias("known1"), "lp1", zero.alias("base1"))
    rest = by_word.unionByName(by_key).groupBy("id").agg(F.sum("known1").alias("known1"), F.sum("lp1").alias("lp1"), F.sum("base1").alias("base1"))
    whole = split.filter(F.col("n_tokens").isNotNull()).drop("word", "key").join(rest, "id", "left")
    model = F.col("lp") + F.coalesce("lp1", zero)
    return whole.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("known1", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base1", zero)).alias("base_score"),
        model.alias("score"),
        (-model * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


@query()
def op3_context_tree_weighting(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"), remainder_column("doc_id", 7) != 2)
