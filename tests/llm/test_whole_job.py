"""Cases of the second review: rows without ids or with repeated ones, short lines, elements without end tags."""

import corpus_pipeline
from test_text_operators import BASE, changed


def test_near_dedup_decides_by_row(spark):
    other = " ".join(f"v{i}" for i in range(60))
    third = " ".join(f"t{i}" for i in range(60))
    lone = " ".join(f"u{i}" for i in range(60))
    rows = [
        (1, " ".join(BASE), "a"), (1, " ".join(BASE), "a"),       # equal rows
        (2, changed(5), "b"), (2, other, "c"),                    # one id: a copy of 1, and a text of its own
        (3, changed(5, by="y"), "d"), (3, other, "e"),            # both are copies
        (None, lone, "f"), (None, lone, "g"),                     # no id, no other copy
        (None, changed(40), "h"),                                 # no id, a copy of 1
        (-4, third, "i"), (-4, other + " more", "j"),             # the smallest id of two groups
        (None, "", "k"), (9, None, "l"), (9, "", "m"),            # without words: in no group
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    without = {r[2] for r in got if not r[1]}
    texts = sorted((str(r[0]), r[1]) for r in got if r[1])
    assert without == {"k", "l", "m"}
    assert texts == sorted([("1", " ".join(BASE)), ("None", lone), ("-4", third), ("-4", other + " more")])
    assert kept.count() == len(got) == 7
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").collect() == []
