"""Phrases, resampling and spherical caps against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from leadlift.llm import caps, phrases, resampling


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_phrases(rows, top, least):
    count, total = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n-\r]", lowered(text)):
            ws = [w for w in re.split(r"[ \t]+", piece) if w]
            total[lang] += len(ws)
            for k in (1, 2, 3):
                for i in range(len(ws) - k + 1):
                    count.setdefault(lang, Counter())[tuple(ws[i : i + k])] += 1
    out = []
    for lang, f in count.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(len(q) == 3 and n >= least and 2 * n >= a and p in (q[:2], q[1:]) for q, n in f.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def zipf_texts(seed, n, vocabulary=60):
    draw = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    rows = []
    for i in range(n):
        ws = draw.choices(names, weights, k=draw.randint(5, 80))
        if i % 3 == 0:
            ws[2:2] = ["New", "york", "city"] if i % 2 else ["new", "York"]
        text = " ".join(w + draw.choice(["", "", "", "", ",", ".", "\n", "\t"]) for w in ws)
        rows.append((i, text, ["en", "de", None][i % 3]))
    return rows


@pytest.mark.parametrize("top", [3, 25, 2000])
def test_phrases_are_those_of_brute_force(documents, top):
    rows = zipf_texts(5, 90) + [(200, None, "en"), (201, "", "fr"), (202, "x y " * 3000, "fr"), (203, "\x00 Été " * 12, "en")]
    got = sorted(tuple(r) for r in phrases.mine(documents(rows), top, 4).collect())
    assert got == brute_phrases([(lang, text) for _, text, lang in rows], top, 4)


def test_phrases_take_several_rounds_when_pairs_are_dropped(documents):
    """The best pairs all lie inside triples, so the first threshold leaves too few."""
    rows = [(i, " . ".join(f"a{j} b{j} c{j}" for j in range(40)) + " . " + " . ".join(f"z z{i % 7} q" for _ in range(9)), "en") for i in range(12)]
    got = sorted(tuple(r) for r in phrases.mine(documents(rows), 45, 5).collect())
    want = brute_phrases([(lang, text) for _, text, lang in rows], 45, 5)
    assert got == want and len({r[7] for r in want}) > 1


def test_phrases_of_nothing(documents, spark):
    assert phrases.mine(documents([])).collect() == []
    assert phrases.mine(documents([(1, None), (2, " . ")])).collect() == []


def brute_weights(texts, target, buckets):
    def runs(text):
        ws = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text)) if w]
        return len(ws), ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]

    places = lambda fs: [zlib.crc32(f.encode()) % buckets for f in fs]
    all_runs = [runs(t) for t in texts]
    s = Counter(b for _, fs in all_runs for b in places(fs))
    t = Counter(b for text in target for b in places(runs(text)[1]))
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets)))) for b in range(buckets)]
    return [(n, len(fs), sum(gain[b] for b in places(fs)) // len(fs) if fs else 0) for n, fs in all_runs]


def test_resampling_is_that_of_brute_force(documents, spark, odd, words):
    rows = [(i + 10, words(i, 15 + i) + ", " + words(500 + i, 8).upper()) for i in range(40)] + odd
    target = [words(3, 40), None, "Foo-bar 42 é"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(documents(rows), bench, buckets=97).collect()
    weights = brute_weights([t for _, t in rows], target, 97)
    want, eligible = [], []
    for (doc, _), (n, k, weight) in zip(rows, weights):
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want.append((doc, k, weight, score))
        if n >= 20:
            eligible.append((-score, doc, k, weight, score))
    drawn = sorted(eligible)[: 25 * len(eligible) // 100]
    key = lambda r: tuple(map(repr, r))
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(want, key=key)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [(r.doc_id, r["rank"]) for r in ranked] == [(d[1], i + 1) for i, d in enumerate(drawn)]


def test_overlapped_runs_start_at_words_only():
    n, places = resampling.Scanner(1 << 16)("  Ab-ab ab,abé ")
    want = ["ab", "ab ab", "ab", "ab ab", "ab", "ab abé", "abé"]
    assert n == 4 and places.tolist() == [zlib.crc32(w.encode()) % (1 << 16) for w in want]


def test_resampling_of_nothing(documents, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(documents([]), bench).collect() == []
    got = resampling.resample(documents([(1, None), (2, "one word " * 20)]), bench).collect()
    assert {(r.doc_id, r.n_features, r["rank"]) for r in got} == {(1, 0, None), (2, 79, None)}


def brute_links(rows, least=0.95):
    able = {}
    for vec_id, v in rows:
        if vec_id is not None and v and None not in v and np.isfinite(v).all() and any(v):
            able[vec_id] = np.array(v, float) / np.linalg.norm(v)
    ids = sorted(able)
    links = {i: {j for j in ids if j != i and len(able[i]) == len(able[j]) and able[i] @ able[j] >= least} for i in ids}
    out = {}
    for vec_id, _ in rows:
        seen, todo = {vec_id}, [vec_id]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least_id = None if vec_id is None else min(seen)
        out[vec_id] = (len(links.get(vec_id, ())), least_id, vec_id == least_id)
    return out


VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), *(T.StructField(n, T.StringType()) for n in ("node", "cap", "n", "comp", "digest"))]
)


def table_of(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, *["x"] * 5) for i, v in rows], VECTORS).repartition(partitions)


def test_caps_find_the_links_of_brute_force(spark):
    draw = np.random.default_rng(3)
    near = lambda v, by: [float(np.float32(x)) for x in v + draw.standard_normal(len(v)) * by]
    rows, at = [], 0
    for size, copies in ((64, 1), (64, 2), (64, 30), (64, 400), (16, 5), (1, 3)):
        for _ in range(40 if copies < 3 else 2):
            v = draw.standard_normal(size)
            for _ in range(copies):
                rows.append((at, near(v, 0.08)))
                at += 7
    rows += [(at + 1, rows[3][1]), (at + 2, rows[3][1]), (at + 3, [2 * x for x in rows[3][1]]), (at + 3, [2 * x for x in rows[3][1]])]
    rows += [(at + 4, None), (at + 5, []), (at + 6, [0.0] * 64), (at + 7, [1.0, None]), (at + 8, [float("nan")] * 64), (None, rows[3][1])]
    got = {r.vec_id: tuple(r)[1:] for r in caps.classes(table_of(spark, rows)).collect()}
    want = brute_links(rows)
    want[None] = (0, None, True)
    assert set(got) == set(want)
    assert [k for k in want if got[k] != want[k]] == []
    assert caps.classes(table_of(spark, [])).collect() == []


def test_caps_recall_of_single_pairs_at_the_threshold(spark):
    """Pairs just above the threshold, none with a third vector to help."""
    draw = np.random.default_rng(11)
    rows = []
    for i in range(400):
        v, z = draw.standard_normal((2, 64))
        v /= np.linalg.norm(v)
        z -= (z @ v) * v
        z /= np.linalg.norm(z)
        rows += [(2 * i, v.tolist()), (2 * i + 1, (0.951 * v + math.sqrt(1 - 0.951**2) * z).tolist())]
    got = caps.classes(table_of(spark, rows)).collect()
    assert sum(r.n_links for r in got) >= 2 * 0.98 * 400


def test_a_filter_of_many_vectors_is_linked_in_chunks(monkeypatch):
    monkeypatch.setattr(caps, "CHUNK", 8)
    draw = np.random.default_rng(1)
    center = draw.standard_normal(64)
    unit = center + 0.1 * draw.standard_normal((50, 64))
    signs = caps.sketches(unit)
    edges = caps.Filter().add(np.arange(50), signs)
    assert len(caps.forest(50, *np.array(edges).T)) == 49


def test_directions_are_all_those_that_exceed():
    code = caps.Code(10, 400, 5)
    draw = np.random.default_rng(2).standard_normal((30, 10))
    unit = draw / np.linalg.norm(draw, axis=1)[:, None]
    turned = unit @ code.rotation
    sums = (turned[:, :5] @ code.left.T)[:, :, None] + (turned[:, 5:] @ code.right.T)[:, None, :]
    want = {(r, a * len(code.right) + b) for r, a, b in zip(*np.nonzero(sums >= code.level))}
    assert set(zip(*(x.tolist() for x in code(unit)))) == want and want
