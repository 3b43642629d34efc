"""Personal data, and terms that give it away, by an information-theoretic measure.

Four kinds are found by pattern: email, ip, card, phone. Their values are the protected
entities. All words of the texts that mention an entity co-occur with it; counts of
documents give log2(n(e,t) D / (n(e) n(t))), how many bits of the entity a term gives away,
against log2(D / n(e)), all there are. A term that gives away at least the share ``threshold``
of an entity's bits is a span of kind ``term`` wherever it stands in the texts that mention the
entity, to be generalised or removed; ``sanitise`` does both.

The share of bits alone would let ever more frequent terms pass as the corpus grows. A term
must therefore also lead to the entity: who looks it up may be log2(n(t) / n(e,t)) bits away
from it, at most ``left`` (1 - 1 / k) for an entity of k different texts. The one text of an
entity shows least, so only terms that no document without the entity has count there.

Texts share words by chance. The bits of an entity that stands in several texts are
corrected for small counts, by n(e,t) / (n(e,t) + 1) times m / (m + 1), m the lesser of n(e)
and n(t). They are not where the term stands within ``REACH`` words of the entity in
``support`` different texts, nor where one text alone has the entity.

A word is what lies between white space and emails; it is a term by its letters, three at
least and in one stretch.

Only DataFrame functions are used. Offsets come from the lengths of what lies between
matches, added up over a text's matches. The patterns never walk the same stretch twice:
repeats are possessive, and a match starts at the head of its stretch or where the last
match ended, which finds what the plain patterns find, leftmost first.

Defined cases: NULL counts as empty text, with no spans; very long texts and words are
read whole; a table without rows gives none; a term exactly at a bound is a span; repeated
rows share their result; equal texts count once in the co-occurrence; spans of different
kinds may overlap; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlift.llm.common import query, row_key, scratch, table

KINDS = ("email", "ip", "card", "phone")
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: A sign without which there is no match.
NEEDS = ("@", ".", None, "+")
#: Stands for a place of an email; no character of any text.
GAP = "\uFFFF"
REACH = 4
SPACE = r"[\x20\x09-\x0D]"
BETWEEN = rf"[\x20\x09-\x0D{GAP}]"
#: What adjoins a mention, and the words within ``REACH``.
NEXT = rf"^[^\x20\x09-\x0D]*+(?:{SPACE}[^\x20\x09-\x0D]*+){{0,{REACH}}}"


def digits(value: Column) -> Column:
    return F.translate(value, "() .-+", "")


def luhn(number: Column) -> Column:
    """Whether a number of 16 to 19 digits passes; false for others."""
    number = F.when(F.length(number).between(16, 19), number)
    n = F.length(number)
    places = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: (F.substring(number, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, F.lit(2)).otherwise(F.lit(1))),
    )
    total = F.aggregate(places, F.lit(0), lambda acc, x: acc + F.when(x > 9, x - 9).otherwise(x))
    return F.coalesce(total % 10 == 0, F.lit(False))


def valid(kind: Column, value: Column) -> Column:
    number = digits(value)
    small = F.forall(
        F.split(value, r"\.", -1),
        lambda x: (F.length(F.regexp_replace(x, "^0+", "")) <= 3)
        & (F.concat(F.lit("0"), F.substring(F.regexp_replace(x, "^0+", ""), 1, 3)).cast("int") <= 255),
    )
    return (
        F.when(kind == 1, small)
        .when(kind == 2, luhn(number))
        .when(kind == 3, F.length(number).between(8, 15))
        .otherwise(F.lit(True))
    )


def entity() -> Column:
    return F.concat(F.col("kind").cast("string"), F.lit(":"), F.lower("value"))


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, h, t, found): texts with a match that may hold, and the matches of each kind."""
    d, h = row_key(doc_id, text)
    rows = docs.select(d, h, F.coalesce(F.col(text), F.lit("")).alias("t")).filter(F.col("t") != "")
    none = F.array().cast("array<string>")
    found = []
    for kind, (pattern, need) in enumerate(zip(PATTERNS, NEEDS)):
        matches = F.regexp_extract_all("t", F.lit(pattern), F.lit(0))
        if need:
            matches = F.when(F.col("t").contains(need), matches).otherwise(none)
        if KINDS[kind] == "card":
            matches = F.when(F.exists(matches, lambda x: F.length(x) >= 16), matches).otherwise(none)
        found.append(F.struct(F.lit(kind).alias("kind"), matches.alias("m")))
    found = F.filter(F.array(*found), lambda x: F.size(x["m"]) > 0)
    return rows.select("d", "h", "t", found.alias("found")).filter(F.size("found") > 0)


def mentions(texts: DataFrame) -> DataFrame:
    """(d, h, kind, start, end, value, before, behind): base matches that hold.

    ``before`` and ``behind`` are the words next to the match, up to its neighbour.
    """
    each = texts.select("d", "h", "t", F.explode("found").alias("x"))
    pattern = F.element_at(F.array(*map(F.lit, PATTERNS)), F.col("x.kind") + 1)
    between = each.select("d", "h", "x.kind", "x.m", F.split("t", pattern, -1).alias("b"))
    listed = F.transform(
        F.sequence(F.lit(1), F.size("m")),
        lambda i: F.struct(
            i.alias("i"),
            F.element_at("m", i).alias("value"),
            F.length(F.element_at("b", i)).alias("gap"),
            F.reverse(F.regexp_extract(F.reverse(F.element_at("b", i)), NEXT, 0)).alias("before"),
            F.regexp_extract(F.element_at("b", i + 1), NEXT, 0).alias("behind"),
        ),
    )
    single = between.select("d", "h", "kind", F.explode(listed).alias("x")).select("d", "h", "kind", "x.*")
    single = single.dropDuplicates(["d", "h", "kind", "i"])  # repeated rows
    so_far = Window.partitionBy("d", "h", "kind").orderBy("i")
    placed = single.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far))
    placed = placed.withColumn("start", F.col("end") - F.length("value"))
    return placed.filter(valid(F.col("kind"), F.col("value"))).select(
        "d", "h", "kind", "start", "end", "value", "before", "behind"
    )


def nearby_terms(found: DataFrame) -> DataFrame:
    """(d, h, entity, term, start, end): words next to mentions, cut to their letters."""

    def listed(order: Column, edge: Column, sign: int) -> Column:
        """Words by distance from the mention; ``order`` has the nearest first."""
        return F.transform(
            F.sequence(F.lit(1), F.size(order)),
            lambda i: F.struct(
                F.element_at(order, i).alias("w"),
                (
                    edge
                    + sign
                    * F.aggregate(F.slice(order, 1, i - 1), F.lit(0).cast("long"), lambda acc, x: acc + F.length(x) + 1)
                    - (F.length(F.element_at(order, i)) if sign < 0 else F.lit(0))
                ).alias("at"),
            ),
        )

    before, behind = F.split("before", SPACE, -1), F.split("behind", SPACE, -1)
    near = F.concat(
        listed(F.reverse(before), F.col("start"), -1), listed(behind, F.col("end"), 1)
    )
    words = found.select("d", "h", entity().alias("entity"), F.explode(near).alias("x"))
    head = F.regexp_extract("x.w", r"^[^\p{L}]*", 0)
    core = F.regexp_extract("x.w", r"^[^\p{L}]*(\p{L}+)[^\p{L}]*$", 1)
    words = words.select(
        "d", "h", "entity", F.lower(core).alias("term"), (F.col("x.at") + F.length(head)).alias("start"), F.length(core).alias("n")
    )
    return words.filter("n >= 3").select("d", "h", "entity", "term", "start", (F.col("start") + F.col("n")).alias("end"))


def blanked(text: Column) -> Column:
    """The text with as many ``GAP`` in place of each email and of what runs on from it.

    Other matches have no letters.
    """
    pattern, need = PATTERNS[0], NEEDS[0]
    gone = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    blanks = F.concat(F.transform(gone, lambda x: F.repeat(F.lit(GAP), F.length(x))), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(F.split(text, pattern, -1), blanks, lambda x, y: F.concat(x, y)), "")
    return F.when(text.contains(need), F.regexp_replace(joined, rf"(?:\G(?!^)|(?<={GAP}))[\p{{L}}\p{{N}}]", GAP)).otherwise(text)


def terms_of(texts: DataFrame) -> DataFrame:
    """(h, term, start, end): where the terms of each text (h, t) stand."""
    # One step at a time, so that no expression holds copies of the one before.
    texts = texts.select("h", F.split(blanked(F.col("t")), BETWEEN, -1).alias("parts"))
    each = texts.select("h", F.posexplode("parts").alias("i", "w"))
    so_far = Window.partitionBy("h").orderBy("i")
    each = each.withColumn("at", F.sum(F.length("w").cast("long") + 1).over(so_far) - F.length("w") - 1)
    core = F.regexp_extract("w", r"^[^\p{L}]*+(\p{L}++)[^\p{L}]*+$", 1)
    each = each.withColumn("core", core).filter(F.length("core") >= 3)
    head = F.length(F.regexp_extract("w", r"^[^\p{L}]*+", 0))
    each = each.select("h", F.lower("core").alias("term"), (F.col("at") + head).alias("start"), F.length("core").alias("n"))
    return each.select("h", "term", "start", (F.col("start") + F.col("n")).alias("end"))


def telling(threshold: float, left: float, n_all: int, texts: Column, share: Column | float = 1.0) -> Column:
    """Whether a term gives away the threshold's share of an entity, its bits taken times ``share``,
    and leaves no more bits to it than its number of ``texts`` allows."""
    bits = F.log2(F.col("n_both") * n_all / (F.col("n_entity") * F.col("n_term")))
    lacks = F.log2(F.col("n_term") / F.col("n_both")) <= left * (1 - 1 / texts)
    return lacks & (bits * share >= threshold * F.log2(n_all / F.col("n_entity")))


def disclosing_near(near: DataFrame, n_term: DataFrame, n_all: int, support: int, threshold: float, left: float) -> DataFrame:
    """(entity, term): terms that by the mentions they stand next to give away an entity."""
    both = near.groupBy("entity", "term").agg(
        F.count_distinct("d", "h").alias("n_both"), F.count_distinct("h").alias("texts")
    )
    both = both.filter(F.col("texts") >= support)
    n_entity = near.groupBy("entity").agg(F.count_distinct("d", "h").alias("n_entity"))
    return both.join(n_entity, "entity").join(n_term, "term").filter(telling(threshold, left, n_all, F.col("texts"))).select("entity", "term")


def disclosing(entities: DataFrame, own: DataFrame, near: DataFrame, n_all: int, threshold: float, left: float) -> DataFrame:
    """(h, term): terms of a text that give away an entity mentioned there.

    ``entities`` has the entities of each text with its number of documents, (h, entity, n),
    ``own`` the terms, (h, term, n_term), ``near`` what ``disclosing_near`` found.
    """
    of_entity = entities.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("n_texts"), F.min("h").alias("h"))
    of_entity = scratch(of_entity, "pii-entities")
    some = F.col("n_entity") < n_all  # An entity of all documents has no bits.
    # All entities of one text alone co-occur alike with its terms.
    alone = of_entity.filter("n_texts = 1").select("h", "n_entity", F.col("n_entity").alias("n_both")).distinct()
    single = own.join(alone, "h").filter(some & telling(threshold, left, n_all, F.lit(1))).select("h", "term")
    several = of_entity.filter("n_texts > 1").select("entity", "n_entity", "n_texts")
    pairs = entities.join(several, "entity").join(own, "h")
    both = pairs.groupBy("entity", "term").agg(
        F.sum("n").alias("n_both"),
        *(F.first(c).alias(c) for c in ("n_entity", "n_texts", "n_term")),
    )
    less = F.least("n_entity", "n_term")
    small = F.col("n_both") / (F.col("n_both") + 1) * less / (less + 1)
    rated = both.filter(some & telling(threshold, left, n_all, F.col("n_texts"), small)).select("entity", "term").unionByName(near)
    shared = pairs.select("h", "entity", "term").join(rated, ["entity", "term"], "left_semi").select("h", "term")
    return single.unionByName(shared).distinct()


def find(
    docs: DataFrame, support: int = 2, threshold: float = 0.5, left: float = 2.0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: doc_id and ``spans``, sorted (kind, start, end).

    Kinds 0 to 3 are the base in the order of ``KINDS``, 4 is ``term``; offsets are code
    points, the end exclusive.
    """
    rows = scratch(candidates(docs, doc_id, text), "pii-texts")
    base = scratch(mentions(rows), "pii-mentions")
    # Texts alike are looked at once.
    texts = rows.join(base.select("d", "h").distinct(), ["d", "h"], "left_semi")
    texts = scratch(texts.groupBy("h").agg(F.first("t").alias("t"), F.count("*").alias("n")), "pii-distinct")
    terms = scratch(terms_of(texts), "pii-terms")
    near = scratch(nearby_terms(base), "pii-near")
    parted = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), r"[^\p{L}]+", -1), lambda x: F.lower(x))
    n_term = docs.select(F.explode(F.array_distinct(parted)).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    wanted = terms.select("term").unionByName(near.select("term")).distinct()
    n_term = scratch(n_term.join(wanted, "term", "left_semi"), "pii-counts")
    n_all = docs.count()
    telling_near = scratch(disclosing_near(near, n_term, n_all, support, threshold, left), "pii-telling")
    entities = base.select("h", entity().alias("entity")).distinct().join(texts.select("h", "n"), "h")
    own = scratch(terms.select("h", "term").distinct().join(n_term, "term"), "pii-own")
    marked = terms.join(disclosing(entities, own, telling_near, n_all, threshold, left), ["h", "term"], "left_semi")
    holders = base.select("d", "h").distinct()
    spans = (
        base.select("d", "h", "kind", "start", "end")
        .unionByName(holders.join(marked, "h").select("d", "h", F.lit(4).alias("kind"), "start", "end"))
        .unionByName(near.join(telling_near, ["entity", "term"], "left_semi").select("d", "h", F.lit(4).alias("kind"), "start", "end"))
    )
    each = spans.groupBy("d", "h").agg(F.array_sort(F.collect_set(F.struct("kind", "start", "end"))).alias("spans"))
    d, h = row_key(doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), d, h).join(each, ["d", "h"], "left")
    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return rows.select("doc_id", "d", "h", F.coalesce("spans", empty).alias("spans"))


def named(spans: Column) -> Column:
    names = F.array(*map(F.lit, [*KINDS, "term"]))
    one = lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    found = find(docs, **options)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    base = F.filter("spans", lambda x: x["kind"] < len(KINDS))
    return found.select(
        "doc_id",
        *(count(k) for k in range(len(KINDS))),
        F.sha2(named(base), 256).alias("base_sha256"),
        named(F.col("spans")).alias("spans"),
    )


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, text): base spans become [EMAIL] and the like, telling terms [TERM].

    Where spans overlap, the one that starts first is kept, of these the earlier kind.
    """
    found = find(docs, doc_id=doc_id, text=text, **options).select("d", "h", "spans").dropDuplicates(["d", "h"])
    d, h = row_key(doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"), d, h)
    rows = rows.join(found, ["d", "h"])
    ordered = F.array_sort(F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))
    kind = "struct<end:bigint,out:array<struct<start:bigint,kind:int,end:bigint>>>"
    apart = F.aggregate(
        ordered,
        F.struct(F.lit(0).cast("long").alias("end"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>").alias("out")).cast(kind),
        lambda acc, x: F.when(x["start"] < acc["end"], acc)
        .otherwise(F.struct(x["end"].alias("end"), F.concat(acc["out"], F.array(x)).alias("out")).cast(kind)),
        lambda acc: acc["out"],
    )
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in [*KINDS, "term"]))
    rows = rows.withColumn("s", apart)
    before = lambda i: F.coalesce(F.get("s", i - 1)["end"], F.lit(0).cast("long"))
    parts = F.transform(
        "s",
        lambda x, i: F.concat(
            F.substring("t", (before(i) + 1).cast("int"), (x["start"] - before(i)).cast("int")),
            F.element_at(names, x["kind"] + 1),
        ),
    )
    rest = F.substring("t", (before(F.size("s")) + 1).cast("int"), F.length("t"))
    return rows.select("doc_id", F.concat(F.array_join(parts, ""), rest).alias("text"))


@query()
def op10_disclosing_terms(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"))
