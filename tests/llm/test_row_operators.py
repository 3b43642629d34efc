"""Packing, language filters and the rule cascade: each row by itself."""

import zlib

import numpy as np
import pytest

from leadlift.llm import language, packing, quality

TOKENIZER = "word_bpe_49k.json"


def tokens_of(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    if not hasattr(tokens_of, "tokenizer"):
        tokens_of.tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    return tokens_of.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def check_packing(got, docs, window):
    """Every id in exactly one piece, sequences gapless and not too long."""
    texts = {}
    for doc_id, text in docs:
        texts.setdefault(doc_id, []).append(tokens_of(text))
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == texts.keys()
    for doc_id, rows in pieces.items():
        ids, copies = texts[doc_id][0], len(texts[doc_id])
        assert sum(r.length for r in rows) == copies * len(ids)
        covered = np.zeros(len(ids), int)
        for r in rows:
            assert r.doc_tokens == len(ids) and r.length > 0
            part = np.array(ids[r.start : r.start + r.length], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
            covered[r.start : r.start + r.length] += 1
        assert (covered == copies).all()
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window and all(r.sequence_tokens == at for r in rows)
    return sequences


def test_packing_is_an_exact_round_trip(documents, odd, words):
    rows = odd + [(100 + i, words(i, 5 + 37 * i % 900)) for i in range(120)]
    got = packing.pack(documents(rows), window=256).collect()
    sequences = check_packing(got, rows, 256)
    short = [s for s in sequences.values() if sum(r.length for r in s) < 256]
    assert len(short) <= 2  # one a partition


def test_packing_closes_windows_within_its_memory(documents, words):
    rows = [(i, words(i, 60)) for i in range(80)]
    got = packing.pack(documents(rows, 1), window=256, max_open_tokens=1000).collect()
    check_packing(got, rows, 256)


def test_sum_of_squares_chooses_the_level_with_the_least_growth():
    p = packing.Packer(10, 0, 1 << 20)
    piece = lambda n: (0, 0, b"\0\0\0\0" * n, n)
    for n in (6, 6, 3):
        p.place(piece(n))
    # 3 beside 6 and 6: on a 6 it costs 1 - 4 + 1 = -2, alone +1.
    assert p.counts[6] == 1 and p.counts[9] == 1 and p.counts[3] == 0
    p.place(piece(4))  # closing the 6 costs 1 - 2 = -1, alone +1
    assert p.counts[6] == 0 and p.next_id == 1


def test_encoder_equals_the_tokenizer_on_whole_texts():
    import public_tokenizers

    encoder = packing.Encoder(public_tokenizers.path(TOKENIZER), most=5)
    for text in (
        "It's the re'd  'll x'sy\tA.B,c!! don't",
        "a\x1cb  ć ́x <|endoftext|>foo <|ENDOFTEXT|> ΑΣ Σ ὈΔΥΣΣΕΎΣ",
        "it's\x0b\x85we'll x\r\n12 ３ ⅷ ªº ßẞ ŉ İi",
        "é é 中文字 한국어 \U0001f600\U0001f600 Øre. naïve,, 12.5%",
    ):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokens_of(text)[:-1], text


def test_packing_of_an_empty_table(documents):
    assert packing.pack(documents([])).collect() == []


LANGUAGES = {
    "aa": ("th", "er", "on", "an", "re"),
    "bb": ("sch", "ung", "keit", "ein", "ich"),
    "cc": ("ción", "mente", "ado", "os", "rr"),
}


def labelled(words, n=60):
    return [(1000 + 10 * i + j, words(i, 60, names), name) for i in range(n) for j, (name, names) in enumerate(LANGUAGES.items())]


@pytest.fixture
def fitted(documents, words):
    import pyspark.sql.functions as F

    return language.fit(documents(labelled(words)), F.lit(True))


def test_language_of_held_out_texts(documents, words, fitted):
    rows = [(i, words(5000 + i, 40, names), name) for i in range(40) for name, names in LANGUAGES.items()]
    got = language.predict(documents(rows), fitted, ["doc_id", "lang"]).collect()
    assert len(got) == len(rows)
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_rows(documents, odd, fitted):
    got = language.predict(documents(odd), fitted, ["doc_id"]).collect()
    assert len(got) == len(odd)
    kinds = {r.doc_id: r.lang_pred for r in got}
    assert [kinds[i] for i in (1, 2, 3, 6)] == ["und"] * 4
    assert kinds[4] != "und"


def test_language_of_long_texts_is_looked_up_in_parts(documents, words, fitted):
    text = words(1, 3000, LANGUAGES["bb"])
    whole = language.predict(documents([(1, text)]), fitted, ["doc_id"]).first()
    parts = language.predict(documents([(1, text)]), fitted, ["doc_id"], block=100).first()
    assert whole == parts


def test_language_without_labels(documents, odd):
    import pyspark.sql.functions as F

    nothing = language.fit(documents([(1, "abc", None)]), F.lit(True))
    assert {r.lang_pred for r in language.predict(documents(odd), nothing, ["doc_id"]).collect()} == {"und"}
    assert language.predict(documents([]), nothing, ["doc_id"]).collect() == []


def test_filters_name_all_languages_and_know_their_chance():
    draw = np.random.default_rng(1)
    grams = {f"l{i:03d}": draw.integers(0, 2**32, 500, dtype=np.uint32) for i in range(70)}  # two planes
    f = language.Filter.build(grams, 1 << 14, 2)
    for at, name in enumerate(f.languages):
        found = f.cells[at // 64][language.Filter.places(grams[name], 1 << 14, 2)[0]]
        assert (found >> np.uint64(at % 64) & np.uint64(1)).all()
    other = draw.integers(0, 2**32, 50_000, dtype=np.uint32)
    a, b = language.Filter.places(other, 1 << 14, 2)
    hit = (f.cells[0][a] & f.cells[0][b] & np.uint64(1)).astype(bool).mean()
    assert abs(hit - f.chance[0]) < 0.003


def brute_base(text):
    import re

    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(hit)


def test_rule_base_equals_brute_force(documents, odd, words):
    rows = [r for r in odd if r[0] not in (7,)] + [
        (10, "a b c a b c\n\x0b\na b c a b c\n  \n#*$ <|> é"),
        (11, "a a a a a\na a a a a"),
        *((20 + i, words(i, 70, ("a", "b"))) for i in range(20)),
    ]
    got = quality.judge(documents(rows), list(quality.RULES)).collect()
    want = {i: brute_base(t) for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        n, chars, symbols, lines, repeats = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id], r
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (r.kept and r.base_failed)


def test_rule_verdict_does_not_depend_on_the_order(documents, words):
    rows = [(i, words(i, 80)) for i in range(30)] + [
        (100, words(1, 80).upper()),
        (101, " ".join(w + "###" for w in words(2, 80).split())),
        (102, "\n".join(["same line here"] * 3 + [words(i, 5) for i in range(5)] + ["same line here"] * 3) + words(3, 60)),
    ]
    docs = documents(rows)
    names = list(quality.RULES)
    one = {r.doc_id: r.kept for r in quality.judge(docs, names).collect()}
    two = {r.doc_id: r.kept for r in quality.judge(docs, names[::-1]).collect()}
    assert one == two
    assert all(one[i] for i in range(30))
    assert not any(one[i] for i in (100, 101, 102))


def test_rule_order_puts_cheap_rejections_first(documents, words):
    import time

    def slow(page):
        time.sleep(0.002)
        return True

    rules = {"never": lambda page: False, "slow": slow, "fast": lambda page: True}
    docs = documents([(i, words(i, 60)) for i in range(20)])
    assert quality.order_rules(docs, rules=rules) == ["fast", "slow", "never"]
    assert sorted(quality.order_rules(documents([]), rules=rules)) == ["fast", "never", "slow"]
    assert quality.judge(documents([]), []).collect() == []
