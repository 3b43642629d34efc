"""Near copies, components, tree weighting, page text and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlift.llm import graph, markup, near, treeweight


def shingles(text, size):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def brute_classes(rows, size, percent=80):
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        common = Counter(j for x in s for j in holders[x])
        for x in s:
            holders[x].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(words, groups=6, copies=12):
    """Groups of copies with a few words changed, and of copies of copies."""
    draw, rows = random.Random(1), []
    for g in range(groups):
        base = words(1000 + g, 60 + 40 * g).split()
        for c in range(copies):
            text = list(base)
            for _ in range(draw.randint(0, 5)):
                text[draw.randrange(len(text))] = f"new{draw.randint(0, 10**6)}"
            rows.append((100 * g + c, " ".join(text)))
            if c % 4 == 3:
                base = text
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_classes_equal_brute_force(documents, odd, words, size):
    rows = near_copies(words) + [(700 + i, words(i, 3 + i)) for i in range(40)]
    rows += [(900 + i, t) for i, (_, t) in enumerate(odd)] + [(950, "a b"), (951, "A\nB"), (952, "a b c")]
    got = near.classes(documents(rows), size=size).collect()
    want = brute_classes(rows, size)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.component_id == r.doc_id)


def test_large_clusters_in_pairs_of_blocks(documents, words, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 300)
    monkeypatch.setattr(near, "MOST", 600)
    rows = near_copies(words, 3, 30)
    got = near.classes(documents(rows), size=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(rows, 4)


def test_near_copies_of_odd_rows(documents, odd):
    got = near.classes(documents([*odd, (None, None)])).collect()
    assert len(got) == len(odd) + 1
    for r in got:
        assert r.kept or r.doc_id != r.component_id
        assert (r.component_id is None) == (r.doc_id is None)
    assert near.classes(documents([])).collect() == []


def test_one_of_each_class_stays(documents, words):
    rows = near_copies(words, 3, 5) + [(None, "x"), (5000, None)]
    docs = documents(rows)
    left = near.drop_near_copies(docs)
    assert left.columns == docs.columns
    want = {i for i, (_, c) in brute_classes([r for r in rows if r[0] is not None], 5).items() if i == c}
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(want)
    assert left.filter("doc_id is null").count() == 1


def test_neighbours_join_regions_across_partitions(spark, documents, words):
    sketched = near.sketch(documents([(i, words(1, 50) + f" tail{i}") for i in range(40)], 1), 4, "doc_id", "text")
    nodes = sketched.select(F.col("doc_id").alias("node"), "labels")
    for parts in (1, 7):
        edges = near.neighbours(nodes, parts)
        found = {r.node: r.comp for r in graph.components(edges).collect()}
        assert len(found) == 40 and set(found.values()) == {0}


def test_components_of_random_graphs(spark):
    draw = random.Random(2)
    edges = [(draw.randint(0, 150), draw.randint(0, 150)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)] + [(3, 3)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges if a == b}
    assert {k: v for k, v in got.items()} == {x: find(x) for x in parent if x in got}
    assert set(parent) - set(got) <= alone
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def symbols_of(text):
    """(deepest context, symbol) of the text's words and its end, by the definition."""
    out, before = [], b"\0" * treeweight.TAIL
    for word in [*(text or "").encode().lower().split(), None]:
        closed = b"\n" if word is None else word + b" "
        for i, symbol in enumerate(closed):
            if i < 2:
                context = before + b" " + closed[:i]
            else:
                context = b" " + closed[:i]
            out.append((context.rjust(treeweight.DEPTH, b"\0")[-treeweight.DEPTH :], symbol))
            if word is None:
                break
        if word is not None:
            before = (before + b" " + word)[-treeweight.TAIL :]
    return out


class BruteTree:
    """Context trees with explicit nodes, and the mixture by its recursion."""

    def __init__(self, texts):
        self.counts = defaultdict(lambda: [0, 0])
        for text in texts:
            self.add(text, 1)

    def bits(self, symbol):
        for k in range(8):
            yield (256 | symbol) >> (8 - k), symbol >> (7 - k) & 1

    def add(self, text, n):
        for context, symbol in symbols_of(text):
            for decision, bit in self.bits(symbol):
                for depth in range(treeweight.DEPTH + 1):
                    self.counts[context[treeweight.DEPTH - depth :], decision][bit] += n

    def build(self):
        self.children = defaultdict(set)
        for context, decision in self.counts:
            if context:
                self.children[context[1:], decision].add(context)
        self.weighted = {}
        for context, decision in sorted(self.counts, key=lambda x: -len(x[0])):
            a, b = self.counts[context, decision]
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            if len(context) == treeweight.DEPTH:
                self.weighted[context, decision] = own, own
            else:
                below = sum(self.weighted[c, decision][1] for c in self.children[context, decision])
                self.weighted[context, decision] = own, math.log(0.5) + np.logaddexp(own, below)

    def one(self, context, decision, depth=0):
        at = context[treeweight.DEPTH - depth :]
        a, b = self.counts[at, decision]
        here = (b + 0.5) / (a + b + 1)
        if depth == treeweight.DEPTH:
            return here
        own, mixed = self.weighted[at, decision]
        stay = math.exp(own + math.log(0.5) - mixed)
        return stay * here + (1 - stay) * self.one(context, decision, depth + 1)

    def score(self, text):
        total = 0.0
        for context, symbol in symbols_of(text):
            for decision, bit in self.bits(symbol):
                p = self.one(context, decision)
                total += math.log10(p if bit else 1 - p)
        return total


def brute_scores(rows):
    learnt = [t for i, t in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2]
    tree = BruteTree(learnt)
    for i, t in rows:
        tree.add(t, 0)  # nodes without counts
    tree.build()
    counts = Counter()
    for t in learnt:
        counts.update([*(t or "").encode().lower().split(), b"\n"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), b"\n"]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        out.append((i, zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2, len(w), sum(counts[x] > 0 for x in w), n, base, tree.score(t)))
    return out


@pytest.mark.parametrize("head", [10**6, 3])
def test_scores_equal_explicit_trees(documents, words, monkeypatch, head):
    """Also with heads so small that nearly all goes through the joins."""
    monkeypatch.setattr(treeweight, "WORDS", head)
    monkeypatch.setattr(treeweight, "KEYS", head)
    rows = [(i, words(i, 1 + 3 * i)) for i in range(25)] + [(30, None), (31, ""), (None, "th Éé X\x00y a"), (4, words(4, 13)), (4, words(4, 13))]
    got = treeweight.score(documents(rows), treeweight.remainder_column("doc_id", 7) != 2).collect()
    want = sorted(brute_scores(rows), key=repr)
    assert len(got) == len(want)
    for g, w in zip(sorted((tuple(r)[:7] for r in got), key=repr), want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-6)


def test_a_text_beginning_and_end_are_a_distribution():
    """Over all symbols the probabilities of a context sum to one."""
    tree = BruteTree(["a b ab", "b a"])
    context = b"\0" * (treeweight.DEPTH - 1) + b" "
    for symbol in range(256):
        for decision, _ in tree.bits(symbol):
            for depth in range(treeweight.DEPTH + 1):
                tree.counts[context[treeweight.DEPTH - depth :], decision]
    tree.build()
    total = 0.0
    for symbol in range(256):
        p = 1.0
        for decision, bit in tree.bits(symbol):
            one = tree.one(context, decision)
            p *= one if bit else 1 - one
        total += p
    assert total == pytest.approx(1.0)


def test_scores_of_odd_tables(documents, odd):
    learn = treeweight.remainder_column("doc_id", 7) != 2
    assert len(treeweight.score(documents(odd), learn).collect()) == len(odd)
    assert treeweight.score(documents([]), learn).collect() == []
    unlearnt = treeweight.score(documents([(1, "ab c")]), F.lit(False)).first()
    # Five symbols, blanks and the end among them, of eight bits each.
    assert unlearnt.score == pytest.approx(-(len("ab c ") + 1) * 8 * math.log10(2)) and unlearnt.base_score == 0.0


def test_learning_pays_on_held_out_texts(documents, words):
    rows = [(i, words(i, 200)) for i in range(120)]
    got = treeweight.score(documents(rows), treeweight.remainder_column("doc_id", 7) != 2).filter("held_out").collect()
    assert got and sum(r.bits_per_byte for r in got) / len(got) < 3


def page(body, nav="", tail=""):
    return f"<!DOCTYPE html><html><head><title>T</title><script>if (a<b) '</p>'</script></head><body>{nav}{body}{tail}</body></html>"


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""),
        ("", ""),
        ("plain  text", "plain text"),
        (page("<article><h1>A &amp; B</h1><p>one<br>two<p>th<b>r</b>ee</article>"), "A & B one two three"),
        (page("<article><p>a</p><aside>no</aside><div class='share-bar x'>no</div><section id=comments>no</section>b</article>"), "a b"),
        (page("<main><div><p>x&nbsp;&#233;&lt;y</p></div></main><footer>f</footer>", "<nav><ul><li>m</ul></nav>"), "x é<y"),
        (page("<div class='content'><p>a<div>b</div>c</div><form>f<button>g</button></form><div role=banner>h</div>"), "a b c"),
        (page("<header><h1>site</h1></header><article><header><h1>title</h1></header>text</article>"), "title text"),
        (page("<article>a<!-- c --><style>p{}</style><noscript>n</noscript><span hidden>h</span>b</article>"), "ab"),
        (page("<article><p>cut off <b>her"), "cut off her"),
        ("<p>a<p>b<", "a b<"),
        ("<article>a <div class=\"x", "a"),
        ("<main><article>one</article><article>two</article><p>more</p></main>", "one two"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<a <b <c " * 2000, ""),
        ("x" + "<" * 5000, "x" + "<" * 5000),
        (page("<article class='post comments-open'><header class='entry-header'><h1>t</h1></header><p>a</p><article class='comment'>no</article></article>"), "t a"),
        (page("<div class='page with-sidebar'><div class='sidebar'>s</div><article><p>a</p></article></div>"), "a"),
        (page("<div class='site-header'>s</div><div><p>a</p><div id='comments'><p>c</p></div></div><div class='cookie-notice'>n</div>"), "a"),
        ("<p title='a>b' data-x=\"<p>\">t</p>", "t"),
        ("<article><p title='a hidden gem'>one</p><p title='display: none'>two</p><p style='color:red; display : none'>no</p></article>", "one two"),
        ("<article><div class='social history'>a</div><div id='search-results'>b</div><div class='search-form'>no</div></article>", "a b"),
        ("<article><p aria-hidden=true>no</p><p aria-hidden='false'>a</p><p hidden='until-found'>b</p><p hidden>no</p></article>", "a b"),
        ("<article><p>a <button>never closed</p><p>b</p></article>", "a never closed b"),
        ("<article><svg><svg><text>no</text></svg><text>no</text></svg>a<object><object>no</object>no</object>b</article>", "ab"),
        ("<article><p>a</p><select><option>no<option>no</select><button><div>no</div></button><p>b</p></article>", "a b"),
        ("<article>" + "<div>" * 4000 + "<form>no</form><p>deep" + "</div>" * 4000 + "end</article>", "deep end"),
        ("<b>" * 20000 + "</i>" * 20000 + "x", "x"),
    ],
)
def test_main_text(html, want):
    got = markup.main_text(html)
    assert got == want if len(want) < 1000 else got.startswith("x")


def site(host, i, text, article=False):
    body = f"<div><p>{text}</p></div>"
    if article:
        body = f"<article>{body}</article>"
    return (i, f"https://{host}/p/{i}?q", f"<html><body><div><p>Menu of {host}</p><p>Home</p></div>{body}<div>Bottom line</div></body></html>")


PAGES = "page_id long, url string, html string"


def rows_of_sites():
    rows = [site("one.example", i, f"story {i}") for i in range(12)]
    rows += [site("two.example", 100 + i, "same story", article=True) for i in range(12)]
    rows += [site("few.example", 200 + i, f"story {i}") for i in range(3)]
    return rows + [(300, None, None), (301, "", ""), (302, "odd url", "<p>x"), (0, *site("one.example", 0, "story 0")[1:])]


@pytest.mark.parametrize("broadcast", [10**6, -1])
def test_templates_are_counted_per_host(spark, monkeypatch, broadcast):
    monkeypatch.setattr(markup, "BROADCAST", broadcast)
    table = spark.createDataFrame([(*r, "c", "e") for r in rows_of_sites()], PAGES + ", host string, digests string")
    got = sorted(map(tuple, markup.extract(table).collect()), key=repr)
    want = []
    for page_id, url, html in rows_of_sites():
        if page_id < 100:
            text = f"story {page_id}"
        elif page_id < 200:
            text = "same story"
        elif page_id < 300:
            text = f"Menu of few.example Home story {page_id - 200} Bottom line"
        else:
            text = "x" if page_id == 302 else ""
        want.append((page_id, url, text, len(text)))
    assert got == sorted(want, key=repr)
    assert markup.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_hosts():
    assert [markup.host_of(u) for u in ("http://A.b:80/x", "//u@c.d?q", "e.f/g", None, "")] == ["a.b", "c.d", "e.f", "", ""]


def test_templates_inside_articles_match_a_count_of_blocks(spark):
    """Random sites put together from blocks; expected texts from the blocks alone."""
    import random

    rng = random.Random(5)
    block = lambda name: f"<div class='b1'><p>{name} one</p><p>{name} <b>two</b></p></div>"
    words_of = lambda name: f"{name} one {name} two"
    sites = []
    for host in range(6):
        marked = host % 2 == 0
        for i in range(14):
            blocks = [f"story{host}x{rng.randrange(10)}"]
            for common, chance in (("share", 0.9), ("promise", 0.5), ("rare", 0.2)):
                if rng.random() < chance:
                    blocks.append(common)
            rng.shuffle(blocks)
            sites.append((len(sites), f"http://h{host}.example/{i}", marked, tuple(blocks)))
    rows = [
        (i, url, "<body><div>menu</div>" + ("<article>" if marked else "") + "".join(map(block, blocks)) + ("</article>" if marked else ""))
        for i, url, marked, blocks in sites
    ]
    want, changed = {}, 0
    for i, url, marked, blocks in sites:
        same = [s for s in sites if s[1].split("/")[2] == url.split("/")[2]]
        bodies = {s[3] for s in same} if marked else [s[3] for s in same]
        least = max(5, (0.5 if marked else 0.05) * len(bodies))
        often = lambda name: sum(name in b for b in bodies) >= least
        menu = [] if marked or len(same) >= 5 else ["menu"]
        want[i] = " ".join(menu + [words_of(b) for b in blocks if not often(b)])
        changed += marked and any(map(often, blocks))
    assert changed > 20
    got = {r.page_id: r.text for r in markup.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == want


@pytest.mark.parametrize("broadcast", [10**6, -1])
def test_an_unlisted_block_in_every_article_goes(spark, monkeypatch, broadcast):
    monkeypatch.setattr(markup, "BROADCAST", broadcast)
    bar = "<div class='xq'><span>Read our newsletter now</span></div>"
    rows = [(i, f"http://s.example/{i}", f"<article><h1>Title</h1><p>the <b>text</b> {i}</p>{bar}<ul><li>yes</li><li>n{i}</li></ul></article>") for i in range(9)]
    # Copies under many addresses are one article, which does not make its text template.
    rows += [(100 + i, f"http://c.example/{i}", "<article><p>one story</p></article>") for i in range(30)]
    # Exactly at the bound: five of ten articles.
    rows += [(200 + i, f"http://t.example/{i}", f"<article><p>s{i}</p>{bar if i < 5 else ''}</article>") for i in range(10)]
    # Below it: four of eight are fewer than five articles.
    rows += [(300 + i, f"http://u.example/{i}", f"<article><p>s{i}</p>{bar if i < 4 else ''}</article>") for i in range(8)]
    got = {r.page_id: r.text for r in markup.extract(spark.createDataFrame(rows, PAGES)).collect()}
    want = {i: f"Title the text {i} yes n{i}" for i in range(9)} | {100 + i: "one story" for i in range(30)}
    want |= {200 + i: f"s{i}" for i in range(10)}
    want |= {300 + i: f"s{i}" + (" Read our newsletter now" if i < 4 else "") for i in range(8)}
    assert got == want
