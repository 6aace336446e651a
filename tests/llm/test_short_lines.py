"""Short lines that stand on many sites."""

import corpus_pipeline


def test_pipeline_removes_short_boilerplate(spark):
    body = "Log in\n\n  \u00a0\t\nown line {}\n\u00bb\n{}"
    rows = [(i, body.format(i, "Share this" if i < 9 else "Of."), f"s{i}", 0) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.dedup_lines(spark, docs, "").collect()}
    for i, text, *_ in rows:
        # 'Log in' and the mark stand on 12 sites, 'Share this' on 9; blank lines and the first place stay.
        want = text if i == 0 else text.replace("Log in\n", "").replace("\u00bb\n", "")
        assert got[i] == (want, len(want))
