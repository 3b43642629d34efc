"""Quality rules as a short-circuit cascade, ordered by rejections per cost.

Each rule says whether it rejects a text. On a sample of the rows all rules are run and
timed; the order is by share rejected over mean time. In the full pass a text
goes through the rules in that order until one rejects it. A verdict is whether any
rule rejects, so the order changes the time only, never a result.

Words are what stands between the bytes 0x20 and 0x09-0x0D. Defined cases: a NULL or
empty text has no words, so it fails the base; repeated rows are judged each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.llm.common import fields, query, slices, table

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\v\f\r"


class Page:
    """A text and, once a rule asks for them, its parts."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.words = self.text.encode("utf-8", "surrogatepass").split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACE))

    @property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @property
    def n_dup_lines(self) -> int:
        lines = [x for x in self.text.split("\n") if x.strip(SPACE)]
        return len(lines) - len(set(lines))

    @property
    def n_repeat_words(self) -> int:
        """Words inside windows of three that the text holds twice or more."""
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        counts = Counter(windows)
        total, end = 0, 0
        for at, window in enumerate(windows):
            if counts[window] > 1:
                total += at + 3 - max(at, end)
                end = at + 3
        return total


def short_words(page: Page) -> bool:
    return not 2 <= page.word_chars / max(1, page.n_words) <= 15


def symbols(page: Page) -> bool:
    return page.n_symbols > 0.3 * page.n_words


def shouting(page: Page) -> bool:
    upper = sum(map(str.isupper, page.text))
    return upper > 0.5 * sum(map(str.isalpha, page.text))


def repeated_lines(page: Page) -> bool:
    """At least three lines, and more than three in ten, equal an earlier one."""
    lines = sum(1 for x in page.text.split("\n") if x.strip(SPACE))
    return page.n_dup_lines > max(2, 0.3 * lines)


def few_letters(page: Page) -> bool:
    return sum(map(str.isalpha, page.text)) < 0.6 * page.word_chars


def one_word(page: Page) -> bool:
    """One word makes up more than a third of the text."""
    return page.n_words > 0 and max(Counter(page.words).values()) > 0.34 * page.n_words


RULES: dict[str, Callable[[Page], bool]] = {
    f.__name__: f for f in (short_words, symbols, shouting, repeated_lines, few_letters, one_word)
}


def order_rules(docs: DataFrame, text: str = "text", sample: int = 2000, rules=RULES) -> list[str]:
    """The rules' names, by rejections per second on about ``sample`` rows.

    Rows are taken by a hash of the text; a table of fewer rows is timed whole.
    """
    rows = max(1, docs.count())
    luck = F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(1 << 20))
    some = docs.select(text) if rows <= sample else docs.filter(luck < F.lit(int(sample / rows * (1 << 20)) + 1)).select(text)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, hits = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0)
        for batch in slices(batches, 1 << 22):
            for page in map(Page, batch.column(0).to_pylist()):
                for name, rule in rules.items():
                    began = time.perf_counter()
                    hits[name] += rule(page)
                    spent[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(rules)), pa.array([spent[r] for r in rules]), pa.array([hits[r] for r in rules], pa.int64())],
            names=["rule", "seconds", "hits"],
        )

    got = some.mapInArrow(measure, fields(rule="string", seconds="double", hits="long"))
    total = {r[0]: (r[1], r[2]) for r in got.groupBy("rule").agg(F.sum("seconds"), F.sum("hits")).collect()}
    worth = {name: total.get(name, (0.0, 0))[1] / max(total.get(name, (0.0, 0))[0], 1e-9) for name in rules}
    return sorted(rules, key=lambda name: (-worth[name], name))


def judge(docs: DataFrame, order: list[str], doc_id: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """Base figures of every text, and whether it passes the base and all rules."""
    out = fields(
        doc_id="long", n_words="long", word_chars="long", n_symbols="long", n_dup_lines="long",
        n_repeat_words="long", base_failed="boolean", kept="boolean",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = [rules[name] for name in order]
        for batch in slices(batches, 1 << 22):
            rows = []
            for page in map(Page, batch.column(1).to_pylist()):
                n, repeats = page.n_words, page.n_repeat_words
                failed = n < 50 or 100 * repeats > 50 * n
                kept = not failed and not any(rule(page) for rule in cascade)
                rows.append((n, page.word_chars, page.n_symbols, page.n_dup_lines, repeats, failed, kept))
            arrays = [pa.array(c, f.dataType.simpleString() == "boolean" and pa.bool_() or pa.int64()) for c, f in zip(zip(*rows), out.fields[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=out.names)

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, out)


@query()
def op8_rule_cascade(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return judge(docs, order_rules(docs))
