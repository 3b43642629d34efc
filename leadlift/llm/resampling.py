"""Importance resampling towards a target, from hashed counts of one- and two-word runs.

A text is lowered (A-Z), its separators collapse to single spaces, and one pattern is run
over it with ``overlapped=True``: its look-behind lets a match start at a word only, its
look-ahead ends the word and spans the next one, so each match gives the spans of the
one-word run and of the two-word run that begin there. Both are counted by the crc32 of
their bytes, modulo ``buckets``. Each text is scanned once; its buckets, two bytes a run, are
written, and both the counts and the weights are taken from that table.

A bucket's gain is the log ratio of its smoothed shares in target and corpus; a text's
weight is the mean of its gains. With Gumbel noise drawn from the id's hash, the highest
scores are a draw without replacement. Places in the order are numbered over range
partitions, so no task holds the corpus.

What reaches the driver: one count a bucket of either side, ``buckets`` numbers.

Defined cases: a NULL, empty or wordless text has no runs and weight 0; texts are scanned
whole, whatever their length; rows that share an id share the noise, each counts as a
row, and ties go to the smaller id, then the smaller number of runs; a NULL id hashes as the
empty text and comes before others in a tie; an empty corpus returns no rows, an empty
target leaves its counts at 0; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.llm.common import fields, query, scratch, slices, table
from leadlift.operators.positions import positions

BUCKETS = 10_000
#: What stands between words once A-Z are lowered.
BETWEEN = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word and, where one follows, the next with the space between.
RUNS = rb"(?<![^ ])[^ ]+(?=( [^ ]+)?)"
#: Runs whose bucket a task remembers.
KNOWN = 400_000


class Scanner:
    """(number of words, buckets of all runs) of a text."""

    def __init__(self, buckets: int = BUCKETS):
        import regex

        if not 0 < buckets <= 1 << 16:
            raise ValueError("buckets are kept in two bytes")
        self.buckets, self.known = buckets, {}
        self.between = re.compile(BETWEEN).sub
        self.runs = regex.compile(RUNS).finditer

    def __call__(self, text: str | None) -> tuple[int, np.ndarray]:
        if not text:
            return 0, np.zeros(0, np.uint16)
        clean = self.between(b" ", text.encode("utf-8", "surrogatepass").lower()).strip(b" ")
        known, buckets = self.known, self.buckets
        if len(known) > KNOWN:
            known.clear()
        found, words = [], 0
        add, look = found.append, known.get
        for match in self.runs(clean, overlapped=True):
            words += 1
            word, after = match.group(0, 1)
            place = look(word)
            if place is None:
                place = known[word] = crc32(word) % buckets
            add(place)
            if after is not None:
                pair = word + after
                place = look(pair)
                if place is None:
                    place = known[pair] = crc32(pair) % buckets
                add(place)
        return words, np.array(found, np.uint16)


def scan(docs: DataFrame, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, places): ``places`` are the buckets, two bytes a run."""
    out = fields(doc_id="long", n_words="long", n_features="long", places="binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(buckets)
        for batch in slices(batches, 1 << 22):
            got = [scanner(value) for value in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _ in got], pa.int64()),
                    pa.array([len(p) for _, p in got], pa.int64()),
                    pa.array([p.tobytes() for _, p in got], pa.binary()),
                ],
                names=out.names,
            )

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, out)


def counts(scanned: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Runs in each bucket."""
    out = fields(bucket="long", n="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, 1 << 24):
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint16), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=out.names)

    tallied = scanned.select("places").mapInArrow(run, out).groupBy("bucket").agg(F.sum("n").alias("n"))
    found = [0] * buckets
    for bucket, n in tallied.collect():
        found[bucket] = n
    return found


def gains(corpus: list[int], target: list[int]) -> list[int]:
    size, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return [
        math.floor(1000 * math.log(float(t + 1) * float(t_size) / (float(s + 1) * float(s_size))))
        for s, t in zip(corpus, target)
        for t_size, s_size in ((s_all + size, t_all + size),)
    ]


def weigh(scanned: DataFrame, gain: list[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of a text's runs."""
    out = fields(doc_id="long", n_words="long", n_features="long", weight="long")
    held = np.array(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 24):
            sums = [int(held[np.frombuffer(p, np.uint16)].sum()) // max(1, len(p) // 2) for p in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=out.names)

    return scanned.select("doc_id", "n_words", "n_features", "places").mapInArrow(run, out)


def noise(doc_id: str, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the id's sha256."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(named, "UTF-8"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    buckets: int = BUCKETS,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_features, weight, score, rank (NULL if not drawn)."""
    scanned = scratch(scan(docs, buckets, doc_id, text), "resample-runs")
    like = scratch(scan(target.select(F.lit(0).alias("doc_id"), F.col(target_text).alias("text")), buckets), "resample-target")
    gain = gains(counts(scanned, buckets), counts(like, buckets))
    scored = weigh(scanned, gain).withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = scratch(scored, "resample-scores")
    placed = positions(scored.filter(F.col("n_words") >= least_words).withColumn("low", -F.col("score")), [], ["low", "doc_id", "n_features"])
    drawn = F.col("position") <= F.floor(F.lit(percent) * F.col("group_size") / 100)
    ranked = placed.withColumn("rank", F.when(drawn, F.col("position").cast("long")))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionAll(rest.select(*columns))


def oracle(percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS) -> str:
    split = (
        "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )
    runs = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH steps AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
         lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
         FROM (SELECT unnest(range(256)) AS i)),
dw AS (SELECT row_number() OVER () AS r, doc_id, {split} AS w FROM documents),
bw AS (SELECT {split} AS w FROM benchmark),
df AS (SELECT r, f, count(*) AS n FROM (SELECT r, unnest({runs}) AS f FROM dw) GROUP BY r, f),
bf AS (SELECT f, count(*) AS n FROM (SELECT unnest({runs}) AS f FROM bw) GROUP BY f),
names AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM bf)),
places AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT,
         list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
         lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % {buckets} AS bucket FROM names, steps),
s AS (SELECT bucket, sum(n)::BIGINT AS n FROM df JOIN places USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS n FROM bf JOIN places USING (f) GROUP BY bucket),
gain AS (SELECT b.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (sa + {buckets})::DOUBLE
         / ((coalesce(s.n, 0) + 1)::DOUBLE * (ta + {buckets})::DOUBLE))) AS BIGINT) AS g
         FROM (SELECT unnest(range({buckets})) AS bucket) b LEFT JOIN s ON s.bucket = b.bucket LEFT JOIN t ON t.bucket = b.bucket,
         (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS sa, (SELECT coalesce(sum(n), 0) FROM t) AS ta)),
w AS (SELECT r, sum(n)::BIGINT AS k, CAST(floor(sum(n * g) / sum(n)::DOUBLE) AS BIGINT) AS weight
      FROM df JOIN places USING (f) JOIN gain USING (bucket) GROUP BY r),
sc AS (SELECT d.r, d.doc_id, len(d.w) AS words, coalesce(w.k, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
       + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
       FROM dw d LEFT JOIN w ON w.r = d.r),
pos AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM sc WHERE words >= {least_words})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {percent} * n // 100 THEN rank END AS rank
FROM sc LEFT JOIN pos ON pos.r = sc.r"""


@query(oracle())
def op12_overlapped_run_resampling(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
