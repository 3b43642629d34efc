"""Benchmark decontamination with a set of hashed n-grams of the benchmark.

The benchmark's windows of ``window`` words, each with its items, are the set. A fixed
bit array, the hashes of all its ``STEP``-grams, goes to every task. Of a
document only every ``STEP``-th ``STEP``-gram is looked up: each window of
``2 * STEP`` words holds one of them whole, so no window escapes. Around each hit the
windows themselves are cut and joined with the set on their words, which is exact,
then counted. No text is shuffled, only windows that were hit. The set is broadcast
while it counts at most ``BROADCAST_WINDOWS``; beyond, the join shuffles.

Items of fewer words than a window have one window, their whole sequence, looked up
at every position in the same way.

Defined cases: NULL and empty texts have no words and no hit; an empty benchmark hits
nothing; repeated rows share their result; equal windows of several items count for each;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.llm.common import query, row_key, scratch, table

WINDOW = 10
STEP = 5
#: Longs in the bit array: 2 Mbit, whatever the benchmark's size.
CELLS = 1 << 15
BROADCAST_WINDOWS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words; letters of either case are part of words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN, -1), "")


def part(array: str, at: Column, size) -> Column:
    return F.concat_ws(" ", F.slice(array, at + 1, size))


def mark(array: str, at: Column, size) -> Column:
    """A hash that equal parts share, whatever the case of their letters."""
    return F.xxhash64(F.lower(part(array, at, size)))


def exact(joined: Column) -> Column:
    return F.translate(joined, UPPER, LOWER)


def places(m: Column) -> list[tuple[Column, Column]]:
    """(cell, bit) of a hash in the bit array, twice."""
    both = []
    for shift in (0, 27):
        moved = F.shiftrightunsigned(m, shift)
        cell = F.pmod(F.shiftrightunsigned(moved, 6), F.lit(CELLS).cast("long")).cast("int")
        both.append((cell, moved.bitwiseAND(F.lit(63).cast("long")).cast("int")))
    return both


def bits(marks: DataFrame) -> Column:
    """The bit array of the column ``m``: a constant of ``CELLS`` longs, whatever ``marks`` counts."""
    set_bits = [
        F.struct(cell.alias("c"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("b")) for cell, bit in places(F.col("m"))
    ]
    filled = marks.select(F.explode(F.array(*set_bits)).alias("x")).groupBy("x.c").agg(F.bit_or("x.b").alias("b"))
    cells = [0] * CELLS
    for cell, value in filled.collect():
        cells[cell] = value
    return F.split(F.lit(",".join(map(str, cells))), ",").cast("array<bigint>")


def within(array: Column, m: Column) -> Column:
    one = F.lit(1).cast("long")
    first, second = (
        F.call_function("shiftrightunsigned", F.get(array, cell), bit).bitwiseAND(one) == 1 for cell, bit in places(m)
    )
    return first & second


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """(words joined, their number, item ids): the benchmark's distinct windows."""
    size = F.least(F.size("w"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("w") - size)
    cut = items.filter(F.size("w") > 0).select(
        "item", size.alias("len"), F.explode(F.transform(starts, lambda s: exact(part("w", s, size)))).alias("win")
    )
    return cut.groupBy("win", "len").agg(F.collect_set("item").alias("items"))


def cut(s: Column, size: int) -> Column:
    return F.struct(s.alias("s"), F.lit(size).alias("len"), exact(part("w", s, size)).alias("win"))


def short_windows(items: DataFrame, size: int) -> Column:
    """Windows of ``size`` words that may be an item of as many."""
    array = bits(items.filter(F.size("w") == size).select(mark("w", F.lit(0), size).alias("m")))
    starts = F.sequence(F.lit(0), F.size("w") - size)
    return F.transform(F.filter(starts, lambda s: within(array, mark("w", s, size))), lambda s: cut(s, size))


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """A row per row of ``docs``: (doc_id, d, h, n_words, spans, items).

    ``spans`` are the (start, end) of hit windows in words, ``items`` the ids as text.
    """
    step = min(STEP, window // 2)
    # Small next to any corpus; written so that each use reads the same rows.
    items = scratch(benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(text).alias("w")), "items")
    known = scratch(windows_of(items, window), "windows")
    grams = items.filter(F.size("w") >= window).select(
        F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - step), lambda s: mark("w", s, step))).alias("m")
    )
    array = bits(grams)
    short = sorted(r[0] for r in known.filter(F.col("len") < window).select("len").distinct().collect())  # below ``window``
    d, h = row_key(doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), d, h, words(text).alias("w"))

    spots = F.filter(
        F.sequence(F.lit(0), F.size("w") - step, F.lit(step)), lambda s: within(array, mark("w", s, step))
    )
    # Windows that hold the gram at s whole.
    reach = F.flatten(
        F.transform(
            spots,
            lambda s: F.sequence(F.greatest(F.lit(0), s + step - window), F.least(s, F.size("w") - window)),
        )
    )
    nothing = F.array().cast("array<struct<s:int,len:int,win:string>>")
    found = F.when(F.size("w") >= window, F.transform(F.array_distinct(reach), lambda s: cut(s, window))).otherwise(nothing)
    for size in short:
        found = F.concat(found, F.when(F.size("w") >= size, short_windows(items, size)).otherwise(nothing))
    seen = scratch(rows.select("doc_id", "d", "h", F.size("w").cast("long").alias("n_words"), found.alias("found")), "seen")

    known_side = F.broadcast(known) if known.count() <= BROADCAST_WINDOWS else known
    hits = seen.filter(F.size("found") > 0).select("d", "h", F.explode("found").alias("x")).select("d", "h", "x.*")
    hits = hits.join(known_side, ["win", "len"])
    grouped = hits.groupBy("d", "h").agg(
        F.array_sort(F.collect_set(F.struct("s", (F.col("s") + F.col("len")).alias("e")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    joined = seen.drop("found").join(grouped, ["d", "h"], "left")
    return joined.select(
        "doc_id",
        "d",
        "h",
        "n_words",
        F.coalesce("spans", F.array().cast("array<struct<s:int,e:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def covered(spans: str) -> Column:
    """Words inside any of the sorted spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        spans,
        start,
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["e"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(acc["end"], x["s"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    seen = scan(docs, benchmark, window).withColumn("n_hit", covered("spans"))
    return seen.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` without a word inside a benchmark window, all columns."""
    d, h = row_key()
    hit = scan(docs, benchmark, window).filter(F.size("spans") > 0).select("d", "h")
    here = docs.withColumns({"_d": d, "_h": h})
    return here.join(hit, (here["_d"] == hit["d"]) & (here["_h"] == hit["h"]), "left_anti").select(*docs.columns)


def oracle(window: int = WINDOW) -> str:
    split = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{}', '{}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    split = split.format(UPPER, LOWER)
    return f"""
WITH dw AS (SELECT doc_id, {split} AS w FROM documents),
bw AS (SELECT CAST(item_id AS VARCHAR) AS item, {split} AS w FROM benchmark),
bwin AS (SELECT item, least(len(w), {window}) AS n, unnest(list_transform(range(1, len(w) - least(len(w), {window}) + 2),
         lambda s: array_to_string(w[s:s + least(len(w), {window}) - 1], ' '))) AS win FROM bw WHERE len(w) > 0),
items AS (SELECT DISTINCT item, n, win FROM bwin),
sizes AS (SELECT DISTINCT n FROM items),
dwin AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s,
         unnest(list_transform(range(1, len(w) - n + 2), lambda s: array_to_string(w[s:s + n - 1], ' '))) AS win
         FROM dw, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, s, d.n, item FROM dwin d JOIN items i ON i.n = d.n AND i.win = d.win),
pos AS (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hits)),
nh AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
ni AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS all_items
       FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(all_items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN nh ON nh.doc_id = dw.doc_id LEFT JOIN ni ON ni.doc_id = dw.doc_id"""


@query(oracle())
def op9_hashed_benchmark_windows(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
