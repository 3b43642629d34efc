"""Removes repeated lines and the sentences in them, by digests of normalised units.

A unit is a line, or where a line holds several sentences, a sentence; sentences of more
than 16 words are cut into clauses at words of locally least hash, so a passage falls into
the same units wherever it was put. Normalised, case and white space do not count. Units of at least ``least_words`` words are grouped by a
128-bit digest over the whole corpus; the occurrence that ranks first, by (doc_id,
position), stays and the others go. Offsets are of the original text, in code points.

Digests alone are shuffled, with the earliest place combined before; the join back
has a written table on both sides, so that a unit with very many occurrences is split.

Defined cases: NULL text stays NULL, without units; shorter units are kept; a text that
loses all becomes empty; rows alike in id and text share a place and do not repeat each
other; a NULL doc_id ranks first; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlift.llm.common import fields, query, row_key, scratch, slices, table

#: A sentence and the white space behind it, up to the line's end.
UNIT = re.compile(r"[^\n]+?(?:[.!?]+(?=[ \t\f\v\r]|$)|$)", re.M)
LEAST_WORDS = 6


#: Sentences of more words are cut into clauses, and how far around a cut words decide.
LONG, AROUND = 16, 5
WORD = re.compile(r"\S+")


def cuts(words: list[str]) -> list[int]:
    """Where a long sentence is cut: behind words of less hash than the ``AROUND`` on each side.

    Words around decide alone, so a passage is cut alike wherever it stands, and
    clauses have ``AROUND`` + 1 words at least.
    """
    h = [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words]
    return [i + 1 for i in range(AROUND, len(h) - AROUND) if h[i] < min(h[i - AROUND : i]) and h[i] <= min(h[i + 1 : i + AROUND + 1])]


def units(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised) of each unit, without white space at its ends."""
    for found in UNIT.finditer(text):
        raw = found[0]
        body = raw.strip()
        if not body:
            continue
        start = found.start() + len(raw) - len(raw.lstrip())
        words = body.lower().split()
        if len(words) <= LONG:
            yield start, start + len(body), " ".join(words)
            continue
        edges = [0, *cuts(words), len(words)]
        spans = [m.span() for m in WORD.finditer(body)] if len(edges) > 2 else ()
        for i, j in zip(edges, edges[1:]):
            if len(spans) == len(words):
                yield start + spans[i][0], start + spans[j - 1][1], " ".join(words[i:j])
        if len(spans) != len(words):
            yield start, start + len(body), " ".join(words)


def places(docs: DataFrame, least_words: int, doc_id: str, text: str) -> DataFrame:
    """(d, h, at, g1, g2): where each unit stands, and its digest as two longs."""
    out = fields(d="long", h="long", at="long", g1="long", g2="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        for batch in slices(batches, 1 << 22):
            d, h, at, digests = [], [], [], []
            for key, mark, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for start, _, unit in units(value or ""):
                    if unit.count(" ") + 1 >= least_words:
                        d.append(key)
                        h.append(mark)
                        at.append(start)
                        digests.append(xxhash.xxh3_128_digest(unit.encode("utf-8", "surrogatepass")))
            pair = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in (d, h, at)), pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())], names=out.names
            )

    d, h = row_key(doc_id, text)
    return docs.select(d, h, F.col(text)).mapInArrow(run, out)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def dedup_units(docs: DataFrame, least_words: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, n_units, n_removed, removed spans, and the text left."""
    all_places = scratch(places(docs, least_words, doc_id, text), "unit-places")
    place = F.struct("d", "h", "at")
    first = all_places.groupBy("g1", "g2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = scratch(first.filter("first < last").select("g1", "g2", "first"), "unit-first")
    later = all_places.join(first, ["g1", "g2"]).filter(place > F.col("first"))
    gone = later.groupBy("d", "h").agg(F.collect_set("at").alias("gone"))
    d, h = row_key(doc_id, text)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), d, h).join(gone, ["d", "h"], "left")
    out = fields(doc_id="long", n_units="long", n_removed="long", text="string")
    out = T.StructType([*out.fields[:3], T.StructField("removed", SPANS), out.fields[3]])
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 22):
            n, m, spans, texts = [], [], [], []
            for value, starts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                all_units = list(units(value or ""))
                off = frozenset(starts or ())
                cut = [{"start": a, "end": b} for a, b, _ in all_units if a in off]
                if cut:
                    edges = [0, *(x for span in cut for x in (span["start"], span["end"])), len(value)]
                    kept = "".join(value[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    value = "\n".join(" ".join(line.split()) for line in kept.split("\n") if line.strip())
                n.append(len(all_units))
                m.append(len(cut))
                spans.append(cut)
                texts.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(spans, pairs), pa.array(texts, pa.string())],
                names=out.names,
            )

    return rows.select("doc_id", "text", "gone").mapInArrow(run, out)


@query()
def op6_unit_digests(spark, sf_dir):
    return dedup_units(table(spark, sf_dir, "documents"))
