"""Deletes later repeats of runs of lines, found by winnowing over line hashes.

The hashes of a text's non-blank lines, normalised, form a sequence. Of each ``window``
consecutive hashes the least, and of equal ones the last, is a fingerprint, so two
texts that share a run of ``window`` lines share its fingerprint for certain. Positions
of fingerprints that occur at least twice are joined with their repeats and
extended to both sides, over every window that chose them; a run of ``window`` lines that
stands earlier in the corpus, by (doc_id, line), is a repeat, overlapping repeats
merge into longer runs, and their lines are deleted. Everything is DataFrame code;
what is grouped are hashes, with the earliest place of each combined before a shuffle.

With ``alone`` a line of so many words is a run by itself, whatever its neighbours are, and of a
text of any number of lines; shorter lines still need a run of ``window``.

Defined cases: a NULL text stays NULL with no lines; without ``alone`` a text of fewer than
``window`` non-blank lines is left as it is; blank lines are kept and do not count; a text that loses
all its lines becomes empty; rows alike in id and text share a place and so do not
repeat each other; a NULL doc_id comes before all others; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.llm.common import query, row_key, scratch, table

WINDOW = 2


def normal(line: Column) -> Column:
    """Lower case, one blank for each stretch of white space, none at the ends."""
    return F.lower(F.trim(F.regexp_replace(line, r"[\t\x0B\f\r ]+", " ")))


def fingerprints(docs: DataFrame, window: int, text: str = "text") -> DataFrame:
    """(d, h, line numbers ``at``, hashes ``hs``, fingerprint positions ``ps``) a text."""
    d, h = row_key(text=text)
    hashed = F.filter(
        F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.struct(i.alias("at"), normal(x).alias("x"))),
        lambda s: s["x"] != "",
    )
    lines = docs.filter(F.col(text).isNotNull()).select(d, h, hashed.alias("l"))
    lines = lines.select("d", "h", F.col("l.at").alias("at"), F.transform("l.x", lambda x: F.xxhash64(x)).alias("hs"))
    lines = lines.filter(F.size("hs") >= window)
    cut = lambda s: F.slice("hs", s + 1, window)
    # The last place of the least: counted from the end of the window.
    chosen = lambda s: s + window - F.array_position(F.reverse(cut(s)), F.array_min(cut(s))).cast("int")
    starts = F.sequence(F.lit(0), F.size("hs") - window)
    return lines.withColumn("ps", F.array_distinct(F.transform(starts, chosen)))


def repeated_windows(prints: DataFrame, window: int) -> DataFrame:
    """(d, h, lines): line numbers of the windows that stand earlier in the corpus."""

    def around(p: Column) -> Column:
        begin = F.greatest(F.lit(0), p - window + 1)
        return F.struct(
            F.element_at("hs", p + 1).alias("print"),
            (p - begin).alias("p"),
            F.slice("hs", begin + 1, 2 * window - 1).alias("near"),
            F.slice("at", begin + 1, 2 * window - 1).alias("lines"),
        )

    places = prints.select("d", "h", F.explode(F.transform("ps", around)).alias("x")).select("d", "h", "x.*")
    # Written, so that the join below has a plain exchange on both sides and can split a hot key.
    twice = scratch(places.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1").select("print"), "line-twice")
    places = places.join(twice, "print", "left_semi")
    # Extend to both sides: every window of lines around the place, named by all its lines.
    reach = F.filter(
        F.sequence(F.lit(0), F.size("near") - window), lambda o: (o <= F.col("p")) & (o + window > F.col("p"))
    )
    spread = F.transform(
        reach,
        lambda o: F.struct(
            F.xxhash64(F.slice("near", o + 1, window)).alias("k1"),
            F.xxhash64(F.lit(1), F.slice("near", o + 1, window)).alias("k2"),
            F.slice("lines", o + 1, window).alias("lines"),
        ),
    )
    windows = places.select("d", "h", F.explode(spread).alias("w")).select("d", "h", "w.*")
    windows = scratch(windows.withColumn("place", F.struct("d", "h", F.element_at("lines", 1).alias("at"))), "line-windows")
    first = windows.groupBy("k1", "k2").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    first = scratch(first.filter("first < last").drop("last"), "line-first")
    return windows.join(first, ["k1", "k2"]).filter("place > first").select("d", "h", "lines")


def repeated_lines(docs: DataFrame, least: int, text: str = "text") -> DataFrame:
    """(d, h, lines): the lines of ``least`` words or more that stand earlier in the corpus."""
    d, h = row_key(text=text)
    split = F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.struct(i.alias("at"), normal(x).alias("x")))
    long = F.filter(split, lambda s: F.size(F.split(s["x"], " ", -1)) >= least)
    hashed = F.transform(
        long, lambda s: F.struct(F.xxhash64(s["x"]).alias("k1"), F.xxhash64(F.lit(1), s["x"]).alias("k2"), s["at"].alias("at"))
    )
    places = docs.filter(F.col(text).isNotNull()).select(d, h, F.explode(hashed).alias("x")).select("d", "h", "x.*")
    places = scratch(places.withColumn("place", F.struct("d", "h", "at")), "line-alone")
    first = places.groupBy("k1", "k2").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    first = scratch(first.filter("first < last").drop("last"), "line-alone-first")
    return places.join(first, ["k1", "k2"]).filter("place > first").select("d", "h", F.array("at").alias("lines"))


def dedup_lines(
    docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = (), alone: int | None = None
) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_lines (not blank), n_removed, and the text left.

    ``keep`` names columns to hand on.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *keep)
    prints = scratch(fingerprints(docs, window), "line-prints")
    later = repeated_windows(prints, window)
    if alone is not None:
        later = later.unionByName(repeated_lines(docs, alone))
    runs = later.groupBy("d", "h").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("lines")))).alias("gone"))
    d, h = row_key()
    joined = docs.select("doc_id", "text", *keep, d, h).join(runs, ["d", "h"], "left")
    lines = F.split("text", "\n", -1)
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    # Between two lines that go lies a slice that stays.
    edges = F.concat(F.array(F.lit(-1)), gone, F.array(F.size("lines")))
    kept = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size("edges") - 1),
            lambda i: F.slice(
                "lines", F.get("edges", i - 1) + 2, F.get("edges", i) - F.get("edges", i - 1) - 1
            ),
        )
    )
    n_lines = F.size(F.filter("lines", lambda x: normal(x) != ""))
    return joined.withColumn("lines", lines).withColumn("edges", edges).select(
        "doc_id",
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(n_lines).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        *keep,
    )


def oracle(window: int = WINDOW, source: str = "documents") -> str:
    ahead = ", ".join(f"lead(x, {i}) OVER o AS x{i}" for i in range(1, window))
    names = ", ".join(["x", *(f"x{i}" for i in range(1, window))])
    back = " OR ".join(["w.p = n.p", *(f"w.p = n.p - {i}" for i in range(1, window))])
    return f"""
WITH parts AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM {source}),
raw AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS ln FROM parts),
norm AS (SELECT *, lower(trim(regexp_replace(line, '[\\t\\x0B\\f\\r ]+', ' ', 'g'))) AS x FROM raw),
num AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS p FROM norm WHERE x <> ''),
win AS (SELECT * FROM (SELECT doc_id, p, x, {ahead} FROM num WINDOW o AS (PARTITION BY doc_id ORDER BY p))
        WHERE x{window - 1} IS NOT NULL),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY {names} ORDER BY doc_id, p) AS r
          FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT n.doc_id, n.ln FROM num n JOIN later w ON w.doc_id = n.doc_id AND ({back})),
per AS (SELECT r.doc_id, count(*) FILTER (r.x <> '') AS n_lines, count(g.ln) AS n_removed,
        coalesce(string_agg(r.line, chr(10) ORDER BY r.ln) FILTER (g.ln IS NULL), '') AS left_text
        FROM norm r LEFT JOIN gone g ON g.doc_id = r.doc_id AND g.ln = r.ln GROUP BY r.doc_id)
SELECT d.doc_id, coalesce(p.n_lines, 0) AS n_lines, coalesce(p.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE p.left_text END AS text
FROM {source} d LEFT JOIN per p ON p.doc_id = d.doc_id"""


@query(oracle())
def op1_winnowed_line_runs(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents"))
