"""Phrase mining by best-first branch and bound over prefix counts.

Texts are cut into pieces and words; words become 64-bit numbers (a vocabulary with two
words under one number is numbered anew with another seed, so nothing is merged). A pass counts
words, the next pairs of words that are frequent themselves. Every frequent pair is a
candidate and, at the same time, the prefix of all longer phrases that begin with it:
such a phrase occurs at most as often as its prefix, and so scores at most
``scale * f(prefix) / f(first word)``, whatever follows. That bound is admissible for
every length.

The frontier is expanded best first, in rounds. A round takes, for each language, all
prefixes whose bound reaches its threshold and counts their continuations; it also
counts the phrases that end with a pair in contention, since a longer phrase may
drop it. Thereby every candidate at or above the threshold is counted and settled. A
language is done when ``top`` survivors reach the threshold, ties included; else its
threshold falls, so that twice as many pairs are in contention, down to 0, where all is
expanded. Pieces are not shuffled; counts are summed per batch, per task and by key.

Which words and prefixes take part is told to the tasks by bit arrays of a fixed size
(``BITS``); a false hit counts a phrase too many, in full, and changes no result.

Scores are whole numbers: products are decimals of 38 digits.

Defined cases: NULL and empty texts have no words; a NULL lang counts as ``und``; a text is
read whole, whatever its length, and phrases never cross texts; repeated rows count
again each time; ties are ordered by count, then by the phrase's bytes; a language
without candidates has no row; an empty table returns no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlift.llm.common import fields, query, scratch, slices, table

TOP, LEAST, SCALE = 2000, 10, 1_000_000
#: A longer phrase with so many per cent of a candidate's occurrences drops it.
COVER = 50
#: Size of the arrays that tell frequent words and open prefixes: 2 MB each.
BITS = 1 << 24
#: The sign between pieces: a byte that no text holds.
CUT = b"\xff"
TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", CUT * 10)


class Reader:
    """Numbers of a text's words; 0 stands between pieces and after the text."""

    def __init__(self, seed: int, most: int = 500_000):
        import xxhash

        self.number, self.seed, self.most, self.known = xxhash.xxh3_64_intdigest, seed, most, {CUT: 0}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
            known[CUT] = 0
        ids = []
        for text in texts:
            parts = words(text)
            for part in set(parts).difference(known):
                known[part] = self.number(part, self.seed) or 1
            ids += [known[p] for p in parts]
            ids.append(0)
        return np.array(ids, np.uint64)


def words(text: str | None) -> list[bytes]:
    """Words and ``CUT`` signs of a text."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").lower().translate(TABLE).replace(CUT, b" \xff ").split()


def mixed(*parts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        total = (total ^ part) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total


def salt(lang: str) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def tallied(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns and how often each occurs."""
    order = np.lexsort(columns[::-1])
    ordered = [c[order] for c in columns]
    if not len(order):
        return ordered, np.zeros(0, np.int64)
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in ordered:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in ordered], np.diff(np.append(at, len(order)))


def held(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    at = places & np.uint64(BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bit_array(keys: DataFrame, *columns: str) -> np.ndarray:
    """A bit for each (lang, numbers): at most ``BITS / 64`` longs reach the driver."""
    out = fields(cell="long", bits="long")
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(BITS // 64, np.uint64)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            salts = {lang: salt(lang) for lang in set(langs)}
            first = np.array([salts[lang] for lang in langs], np.uint64)
            at = mixed(first, *(batch.column(i + 1).to_numpy().view(np.uint64) for i in range(n))) & np.uint64(BITS - 1)
            np.bitwise_or.at(cells, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        found = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(cells[found].view(np.int64))], names=out.names)

    marked = keys.select("lang", *columns).mapInArrow(run, out).groupBy("cell").agg(F.bit_or("bits").alias("bits")).collect()
    cells = np.zeros(BITS // 64, np.uint64)
    for cell, bits in marked:
        cells[cell] = np.uint64(bits % (1 << 64))
    return cells.view(np.uint8)


def by_language(docs: DataFrame, seed: int, names: list[str], find) -> DataFrame:
    """Sums ``n`` by (lang, *names) of what ``find(lang, ids)`` tallies of each batch."""
    out = fields(lang="string", **{name: "long" for name in names}, n="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(seed)
        for batch in slices(batches, 1 << 23):
            texts: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, of in texts.items():
                columns, n = find(lang, reader(of))
                if len(n):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n)), *(pa.array(c.view(np.int64)) for c in columns), pa.array(n)], names=out.names
                    )

    return docs.mapInArrow(run, out).groupBy("lang", *names).agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, w, word, n): how often each word occurs."""
    out = fields(lang="string", word="binary", w="long", n="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        import xxhash

        for batch in slices(batches, 1 << 23):
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, Counter()).update(words(text))
            for lang, tally in found.items():
                tally.pop(CUT, None)
                numbers = np.array([xxhash.xxh3_64_intdigest(w, seed) or 1 for w in tally], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(tally), pa.string()), pa.array(list(tally), pa.binary()), pa.array(numbers.view(np.int64)),
                     pa.array(list(tally.values()), pa.int64())],
                    names=out.names,
                )

    return docs.mapInArrow(run, out).groupBy("lang", "word", "w").agg(F.sum("n").alias("n"))


def score(a: str, left: str, right: str) -> Column:
    wide = "decimal(38,0)"
    return F.expr(f"cast(({SCALE} * cast({a} as {wide}) * cast({a} as {wide})) div (cast({left} as {wide}) * cast({right} as {wide})) as bigint)")


class Miner:
    """Counts of one corpus: ``docs`` has lang and text."""

    def __init__(self, docs: DataFrame, least: int):
        self.spark: SparkSession = docs.sparkSession
        self.docs, self.least = docs, least
        for self.seed in range(100):
            self.vocabulary = scratch(vocabulary(docs, self.seed), "phrase-words")
            clash = self.vocabulary.groupBy("w").agg(F.min("word").alias("a"), F.max("word").alias("b")).filter("a < b")
            if clash.isEmpty():
                break
        self.sizes = {r[0]: r[1] for r in self.vocabulary.groupBy("lang").agg(F.sum("n")).collect()}
        frequent = self.vocabulary.filter(F.col("n") >= least)
        self.frequent = scratch(frequent.select("lang", "w", "n"), "phrase-frequent")

    def pairs(self) -> DataFrame:
        """(lang, w1, w2, a, l, r, score, bound) of all frequent pairs."""
        known = self.spark.sparkContext.broadcast(bit_array(self.frequent, "w"))

        def find(lang: str, ids: np.ndarray):
            good = (ids != 0) & held(known.value, mixed(np.full(len(ids), salt(lang)), ids))
            at = np.flatnonzero(good[:-1] & good[1:])
            return tallied(ids[at], ids[at + 1])

        counted = by_language(self.docs, self.seed, ["w1", "w2"], find).filter(F.col("n") >= self.least)
        counted = scratch(counted.withColumnRenamed("n", "a"), "phrase-pairs")
        left = self.frequent.select("lang", F.col("w").alias("w1"), F.col("n").alias("l"))
        right = self.frequent.select("lang", F.col("w").alias("w2"), F.col("n").alias("r"))
        whole = counted.join(left, ["lang", "w1"]).join(right, ["lang", "w2"])
        whole = whole.withColumn("score", score("a", "l", "r"))
        # A phrase beginning with the pair occurs a times at most, its rest as often at least.
        return whole.withColumn("bound", F.expr(f"cast(({SCALE} * cast(a as decimal(38,0))) div l as bigint)"))

    def grow(self, pairs: DataFrame, least: dict[str, int]) -> DataFrame:
        """(lang, w1, w2, w3, a): frequent phrases with an open prefix, or ending in a pair in contention."""
        level = F.create_map(*(F.lit(x) for item in least.items() for x in item))[F.col("lang")]
        share = self.spark.sparkContext.broadcast
        opened = share(bit_array(pairs.filter(F.col("bound") >= level), "w1", "w2"))
        contended = share(bit_array(pairs.filter(F.col("score") >= level), "w1", "w2"))
        known = share(bit_array(pairs, "w1", "w2"))

        def find(lang: str, ids: np.ndarray):
            if lang not in least:
                return [ids[:0]] * 3, np.zeros(0, np.int64)
            both = (ids[:-1] != 0) & (ids[1:] != 0)
            places = mixed(np.full(len(ids) - 1, salt(lang)), ids[:-1], ids[1:])
            frequent = both & held(known.value, places)
            prefix, suffix = frequent & held(opened.value, places), frequent & held(contended.value, places)
            at = np.flatnonzero((prefix[:-1] & frequent[1:]) | (frequent[:-1] & suffix[1:]))
            return tallied(ids[at], ids[at + 1], ids[at + 2])

        counted = by_language(self.docs, self.seed, ["w1", "w2", "w3"], find).filter(F.col("n") >= self.least)
        return scratch(counted.withColumnRenamed("n", "a"), "phrase-triples")

    def survivors(self, pairs: DataFrame, triples: DataFrame, least: dict[str, int]) -> DataFrame:
        """(lang, w1, w2, w3, a, l, r, score) at or above each language's threshold, all settled."""
        level = F.create_map(*(F.lit(x) for item in least.items() for x in item))[F.col("lang")]
        over = [
            triples.select("lang", F.col("w1").alias("w1"), F.col("w2").alias("w2"), "a"),
            triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"),
        ]
        covering = over[0].unionAll(over[1]).groupBy("lang", "w1", "w2").agg(F.max("a").alias("longest"))
        alive = pairs.filter(F.col("score") >= level).join(covering, ["lang", "w1", "w2"], "left")
        alive = alive.filter(F.col("longest").isNull() | (100 * F.col("longest") < COVER * F.col("a")))
        two = alive.select("lang", "w1", "w2", F.lit(0).cast("long").alias("w3"), "a", "l", "r", "score")
        named = lambda first, second, name: pairs.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name))
        single = lambda word, name: self.frequent.select("lang", F.col("w").alias(word), F.col("n").alias(name))
        three = (
            triples.join(named("w1", "w2", "l2"), ["lang", "w1", "w2"])
            .join(named("w2", "w3", "r1"), ["lang", "w2", "w3"])
            .join(single("w1", "l1"), ["lang", "w1"])
            .join(single("w3", "r2"), ["lang", "w3"])
            .withColumn("s1", score("a", "l1", "r1"))
            .withColumn("s2", score("a", "l2", "r2"))
        )
        first = F.col("s1") <= F.col("s2")
        three = three.select(
            "lang", "w1", "w2", "w3", "a",
            F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
            F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
            F.least("s1", "s2").alias("score"),
        )
        return two.unionAll(three.filter(F.col("score") >= level))


def first_places(df: DataFrame, most: int) -> dict[str, int]:
    """Each language's score from which on ``most`` rows follow, to a thousandth; 0 if it has fewer.

    Scores are counted by thousandths first, so a language's rows here are 1,001 at most.
    """
    width = SCALE // 1000
    bins = df.groupBy("lang", F.expr(f"score div {width}").alias("bin")).agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("bin")))
    reached = bins.withColumn("above", above).filter(F.col("above") >= most)
    return {r[0]: r[1] * width for r in reached.groupBy("lang").agg(F.max("bin")).collect()}


def ranked(df: DataFrame, order: list[Column], top: int, name: str) -> DataFrame:
    """The first ``top`` rows of each language; each task hands on no more than those."""
    placed = df.withColumn(name, F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return placed.filter(F.col(name) <= top).withColumn(name, F.col(name).cast("long"))


def mine(docs: DataFrame, top: int = TOP, least: int = LEAST, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    # Languages keep their rows where they lie: a text's counts are summed in its own task.
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    miner = Miner(rows, least)
    pairs = scratch(miner.pairs(), "phrase-scored")
    totals = {r[0]: r[1] for r in pairs.groupBy("lang").agg(F.count("*")).collect()}
    settled: list[DataFrame] = []
    contended, open_langs = 2 * top, dict.fromkeys(totals, 0)
    while open_langs:
        # The score from which ``contended`` pairs follow is the round's threshold; 0 once all take part.
        deep = [name for name in open_langs if totals[name] > contended]
        levels = dict.fromkeys(open_langs, 0)
        if deep:
            levels |= first_places(pairs.filter(F.col("lang").isin(deep)), contended)
        triples = miner.grow(pairs.filter(F.col("lang").isin(list(levels))), levels)
        found = scratch(miner.survivors(pairs.filter(F.col("lang").isin(list(levels))), triples, levels), "phrase-survivors")
        enough = {r[0]: r[1] for r in found.groupBy("lang").agg(F.count("*")).collect()}
        done = [name for name, level in levels.items() if enough.get(name, 0) >= top or level == 0]
        if done:
            settled.append(found.filter(F.col("lang").isin(done)))
        open_langs = {name: 0 for name in open_langs if name not in done}
        contended *= 2
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    if not settled:
        empty = fields(lang="string", rank="long", phrase="string", a="long", l="long", r="long", n="long", score="long")
        return docs.sparkSession.createDataFrame([], empty)
    found = settled[0]
    for more in settled[1:]:
        found = found.unionAll(more)
    # Ties at the end are kept whole until their words are known.
    from_score = first_places(found, top)
    if from_score:
        edge = F.create_map(*(F.lit(x) for item in from_score.items() for x in item))[F.col("lang")]
        found = found.filter(F.col("score") >= F.coalesce(edge, F.lit(0)))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    found = scratch(found.withColumn("place", F.rank().over(best)).filter(F.col("place") <= top).drop("place"), "phrase-first")
    spelled = miner.vocabulary.select("lang", "w", F.col("word").cast("string").alias("word"))
    for i in (1, 2, 3):
        found = found.join(spelled.select("lang", F.col("w").alias(f"w{i}"), F.col("word").alias(f"p{i}")), ["lang", f"w{i}"], "left" if i == 3 else "inner")
    size = F.create_map(*(F.lit(x) for item in miner.sizes.items() for x in item))[F.col("lang")]
    found = found.withColumn("phrase", F.concat_ws(" ", "p1", "p2", "p3")).withColumn("n", size.cast("long"))
    return ranked(found, [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "rank").select(*columns)


def oracle(top: int = TOP, least: int = LEAST) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH raw AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, {lower} AS t FROM documents),
cut AS (SELECT d, lang, regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]') AS ps FROM raw),
piece AS (SELECT d, lang, generate_subscripts(ps, 1) AS i, unnest(ps) AS piece FROM cut),
split AS (SELECT d, lang, i, regexp_split_to_array(piece, '[\\x20\\x09]+') AS ws FROM piece),
word AS (SELECT d, lang, i, generate_subscripts(ws, 1) AS j, unnest(ws) AS w FROM split),
seq AS (SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM word WHERE w <> ''
        WINDOW o AS (PARTITION BY d, i ORDER BY j)),
f1 AS (SELECT lang, w, count(*) AS n FROM seq GROUP BY ALL),
f2 AS (SELECT lang, w, w2, count(*) AS n FROM seq WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w, w2, w3, count(*) AS n FROM seq WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {least}),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f1 GROUP BY lang),
long AS (SELECT lang, w, w2, max(n) AS n FROM (SELECT lang, w, w2, n FROM f3 UNION ALL SELECT lang, w2, w3, n FROM f3) GROUP BY ALL),
two AS (SELECT c.lang, c.w || ' ' || c.w2 AS phrase, c.n AS a, x.n AS l, y.n AS r,
        CAST(({SCALE}::HUGEINT * c.n * c.n) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
        FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w = c.w JOIN f1 y ON y.lang = c.lang AND y.w = c.w2
        LEFT JOIN long g ON g.lang = c.lang AND g.w = c.w AND g.w2 = c.w2
        WHERE c.n >= {least} AND (g.n IS NULL OR 100 * g.n < {COVER} * c.n)),
both_cuts AS (SELECT c.lang, c.w || ' ' || c.w2 || ' ' || c.w3 AS phrase, c.n AS a, x1.n AS l1, y1.n AS r1, x2.n AS l2, y2.n AS r2,
        CAST(({SCALE}::HUGEINT * c.n * c.n) // (x1.n::HUGEINT * y1.n) AS BIGINT) AS s1,
        CAST(({SCALE}::HUGEINT * c.n * c.n) // (x2.n::HUGEINT * y2.n) AS BIGINT) AS s2
        FROM f3 c JOIN f1 x1 ON x1.lang = c.lang AND x1.w = c.w JOIN f2 y1 ON y1.lang = c.lang AND y1.w = c.w2 AND y1.w2 = c.w3
        JOIN f2 x2 ON x2.lang = c.lang AND x2.w = c.w AND x2.w2 = c.w2 JOIN f1 y2 ON y2.lang = c.lang AND y2.w = c.w3),
kept AS (SELECT * FROM two UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END,
        CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM both_cuts)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score
FROM kept k JOIN total t ON t.lang = k.lang
QUALIFY rank <= {top}"""


@query(oracle())
def op11_best_first_phrases(spark, sf_dir):
    return mine(table(spark, sf_dir, "documents"))
