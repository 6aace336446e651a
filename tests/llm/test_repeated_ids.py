"""Ids with several texts, each of which stands for its own group."""

from lodestrata.llm import near_dup


def changed(words, at):
    return " ".join("z" if i == at else w for i, w in enumerate(words))


def test_both_texts_of_an_id_link(spark):
    one, two = [f"a{i}" for i in range(80)], [f"b{i}" for i in range(80)]
    rows = [(1, " ".join(one)), (1, " ".join(two)), (1, " ".join(two)), (5, changed(one, 3)), (6, changed(two, 70)), (7, changed(two, 20)), (8, "else where")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()}
    assert got == {(1, 1, True), (5, 1, False), (6, 1, False), (7, 1, False), (8, 8, True)}
