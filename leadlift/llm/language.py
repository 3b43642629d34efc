"""Language of a text from a bit-sliced Bloom filter over byte n-grams.

Each of ``cells`` cells holds one bit per language. An n-gram's cells, AND-ed, name all
languages that hold it; bits that are set by chance are expected at a rate known from
each language's fill, and the counts per language are corrected by it. The
language with the highest corrected count is the answer.

Fitting takes a sample of the labelled rows, chosen by a hash of the text, of about
``sample_per_language`` a language; the filter's size is fixed by its parameters, so
it can be broadcast whatever the corpus. Prediction reads whole texts and nothing else.

Defined cases: NULL text or text without a letter is ``und`` with score 0; repeated rows
are predicted each; equal counts go to the language that sorts first; without any
labelled row all is ``und``; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.llm.common import fields, query, remainder_column, slices, table

LETTER = re.compile(r"[^\W\d_]")
#: Every byte that is not a letter of ASCII and not part of a longer character, as a blank.
BLANKS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
NGRAM = 4
UNKNOWN = "und"


def plain(text: str) -> bytes:
    """Lower-cased letters of the text, one blank between words and at the ends."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(BLANKS).split()) + b" "


def codes(buffer: bytes) -> np.ndarray:
    """All n-grams of the bytes as 32-bit numbers, by position."""
    a = np.frombuffer(buffer, dtype=np.uint8).astype(np.uint32)
    if len(a) < NGRAM:
        a = np.concatenate([a, np.full(NGRAM - len(a), 32, np.uint32)])
    return a[:-3] | a[1:-2] << np.uint32(8) | a[2:-1] << np.uint32(16) | a[3:] << np.uint32(24)


@dataclass
class Filter:
    """``cells``: languages' bits in 64-bit planes; ``chance``: false positives by language."""

    languages: list[str]
    cells: np.ndarray
    chance: np.ndarray

    MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)

    @classmethod
    def places(cls, grams: np.ndarray, cells: int, k: int) -> list[np.ndarray]:
        shift = np.uint32(32 - (cells - 1).bit_length())
        mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        mixed ^= mixed >> np.uint32(12)
        return [(mixed * np.uint32(m)) >> shift for m in cls.MULTIPLIERS[:k]]

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], cells: int, k: int) -> Filter:
        languages = sorted(grams)
        planes = np.zeros(((len(languages) + 63) // 64 or 1, cells), dtype=np.uint64)
        chance = np.zeros(len(languages))
        for at, language in enumerate(languages):
            bit = np.uint64(1 << (at % 64))
            for place in cls.places(grams[language], cells, k):
                planes[at // 64][place] |= bit
            chance[at] = np.mean(planes[at // 64] & bit != 0) ** k
        return cls(languages, planes, chance)

    def hits(self, buffer: bytes, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Per piece of the buffer: n-grams looked up, and hits by language."""
        grams = codes(buffer)
        keep = np.ones(len(grams), dtype=bool)
        for back in range(1, NGRAM):  # n-grams that reach into the next piece
            edge = starts[1:] - back
            keep[edge[(edge >= 0) & (edge < len(keep))]] = False
        at = np.minimum(starts, len(grams) - 1)
        places = self.places(grams, self.cells.shape[1], k)
        total = np.add.reduceat(keep.astype(np.int64), at)
        found = np.empty((len(starts), len(self.languages)))
        for plane, cells in enumerate(self.cells):
            mask = cells[places[0]]
            for place in places[1:]:
                mask &= cells[place]
            mask[~keep] = 0
            for language in range(64 * plane, min(len(self.languages), 64 * plane + 64)):
                bits = (mask >> np.uint64(language % 64)).astype(np.uint8) & 1
                found[:, language] = np.add.reduceat(bits.astype(np.int64), at)
        return total, found


def fit(
    docs: DataFrame,
    training: Column,
    text: str = "text",
    lang: str = "lang",
    sample_per_language: int = 2000,
    least_share: float = 0.02,
    against_best: float = 0.3,
    ngrams_per_language: int = 50_000,
    cells: int = 1 << 18,
    k: int = 2,
) -> Filter:
    """A filter from about ``sample_per_language`` texts of each language.

    A language holds an n-gram that stands in ``least_share`` of its texts, and in
    ``against_best`` times the share it has in the language where it is most frequent.
    """
    rows = docs.filter(training & F.col(text).isNotNull() & F.col(lang).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang)).count().collect()}
    if not sizes:
        return Filter([], np.zeros((1, cells), np.uint64), np.zeros(0))
    share = F.create_map(*[x for l, n in sizes.items() for x in (F.lit(l), F.lit(min(1.0, sample_per_language / n)))])
    luck = F.pmod(F.xxhash64(F.col(text)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.filter(luck < share[F.col(lang)]).select(F.col(lang), F.col(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 22):
            by: dict[str, list] = {}
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(language, []).append(np.unique(codes(plain(value))))
            for language, grams in by.items():
                gram, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(n)], names=["l", "g", "n"]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language]), pa.array([-1], pa.int64()), pa.array([len(grams)], pa.int64())], names=["l", "g", "n"]
                )

    counted = sample.mapInArrow(count, fields(l="string", g="long", n="long")).groupBy("l", "g").agg(F.sum("n").alias("n"))
    frame = counted.toPandas()  # bounded by the sample
    texts = frame[frame.g == -1].set_index("l").n
    frame = frame[frame.g >= 0]
    frame = frame.assign(share=frame.n / frame.l.map(texts))
    best = frame.groupby("g").share.transform("max")
    frame = frame[(frame.share >= least_share) & (frame.share >= against_best * best)]
    grams = {
        language: part.sort_values(["share", "g"], ascending=[False, True]).g.to_numpy()[:ngrams_per_language].astype(np.uint32)
        for language, part in frame.groupby("l")
    }
    return Filter.build({str(l): grams.get(l, np.zeros(0, np.uint32)) for l in texts.index}, cells, k)


def predict(
    docs: DataFrame, fitted: Filter, keep: list[str], text: str = "text", k: int = 2, block: int = 1 << 20
) -> DataFrame:
    """``docs``' columns ``keep`` with ``lang_pred`` and ``score``, for every row.

    The score is the corrected share of the text's n-grams that the language holds.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((fitted.languages, fitted.cells, fitted.chance))
    kept = [f for name in keep for f in docs.select(name).schema.fields]
    out = type(docs.schema)([*kept, *fields(lang_pred="string", score="double").fields])
    inside = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Filter(*model.value)
        for batch in slices(batches, 1 << 22):
            texts = batch.column(len(keep)).to_pylist()
            known = np.array([bool(x and LETTER.search(x)) for x in texts])
            total, found = np.zeros(len(texts)), np.zeros((len(texts), len(f.languages)))
            pieces, owners, held = [], [], 0

            def look() -> None:
                nonlocal pieces, owners, held
                if pieces and f.languages:
                    starts = np.cumsum([0, *map(len, pieces[:-1])])
                    n, hits = f.hits(b"".join(pieces), starts, k)
                    np.add.at(total, owners, n)
                    np.add.at(found, owners, hits)
                pieces, owners, held = [], [], 0

            for row, value in enumerate(texts):
                if known[row]:
                    whole = plain(value)
                    whole += b" " * max(0, NGRAM - len(whole))
                    for at in range(0, max(1, len(whole) - NGRAM + 1), block):  # parts share NGRAM - 1 bytes
                        pieces.append(whole[at : at + block + NGRAM - 1])
                        owners.append(row)
                        held += len(pieces[-1])
                    if held >= block:
                        look()
            look()
            if f.languages:
                n = np.maximum(total, 1)[:, None]
                right = np.clip((found / n - f.chance) / (1 - f.chance), 0, 1)
                best = right.argmax(axis=1)
                names = [f.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)]
                score = np.where(known, right[np.arange(len(best)), best], 0.0)
            else:
                names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(score)], names=out.names)

    return inside.mapInArrow(run, out)


def held_out(doc_id: str = "doc_id") -> Column:
    return remainder_column(doc_id, 3) == 1


@query()
def op5_language_bitmask_filters(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fitted = fit(docs, ~held_out())
    got = predict(docs, fitted, ["doc_id"])
    return got.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
