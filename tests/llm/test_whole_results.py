"""What a shorter way of doing the job would leave out."""

import corpus_pipeline
from leadlift.llm import personal


def test_terms_of_a_single_text_count_wherever_they_stand(documents, words):
    """One text mentions the entity; a rare word far from it gives it away, common ones do not."""
    rows = [(i, f"the {words(i, 30)} the") for i in range(60)]
    text = "Pseudonym, " + "the " * 40 + "zorro@mail.org,nearby the " + "the " * 40 + "(pseudonym)"
    rows += [(100, text), (101, None), (102, "1@abc.2 the")]
    got = {r.doc_id: r.spans for r in personal.report(documents(rows)).collect()}
    at = text.index("zorro")
    near, last = text.index("nearby"), text.index("pseudonym")
    want = [f"email:{at}:{at + 14}", "term:0:9", f"term:{near}:{near + 6}", f"term:{last}:{last + 9}"]
    assert got[100].split(",") == want
    assert got[102] == "email:0:7" and not any(got[i] for i in range(60))


def test_the_pipeline_deletes_long_lines_put_singly(spark, documents, words):
    """The neighbours of the line differ in each text; short lines stay without a repeated neighbour."""
    notice = "All rights to this text are reserved"
    rows = [(i, f"{words(i, 20)}\n{notice}\n{words(50 + i, 20)}\nyes yes") for i in range(3)]
    rows += [(10, words(10, 60)), (11, f" {words(10, 60).upper()}"), (12, notice), (13, "yes yes"), (14, None)]
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, documents(rows), "").collect()}
    assert got[0] == rows[0][1] and set(got) == {0, 1, 2, 10, 13, 14}
    assert all(got[i] == rows[i][1].replace(notice + "\n", "") for i in (1, 2))
    assert got[13] == "yes yes" and got[10] == rows[3][1]
