from __future__ import annotations

import corpus_pipeline
from tests.llm.data import SMALL


def test_a_group_of_copies_keeps_its_text(spark):
    """A third of a source is one text; only the menu line, which unlike pages share, goes."""
    copied = "menu\n" + "\n".join(f"copied line {j} of a text that many pages hold" for j in range(6))
    rows = [(i, f"menu\nown line {i}\nmore of {i}", "s") for i in range(40)] + [(100 + i, copied, "s") for i in range(20)]
    rows += [(200 + i, "three copies\nin a small source", "t") for i in range(3)] + [(210 + i, f"other {i}", "t") for i in range(5)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars int")
    cut = corpus_pipeline.line_stage(spark, docs, SMALL)
    text = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert all(text[100 + i] == copied.removeprefix("menu\n") for i in range(20)) and text[3] == "own line 3\nmore of 3"
    assert all(text[200 + i] == "three copies\nin a small source" for i in range(3))
    left = [r["text"] for r in corpus_pipeline.near_duplicate_stage(spark, cut, SMALL).collect()]
    assert left.count(copied.removeprefix("menu\n")) == 1 and "" not in left
