"""Whole licence texts, their versions, and runs that only look alike."""

import pytest

from lodestrata.llm import license_scan

TEXTS = {**license_scan.PASSAGES, **license_scan.VERSIONS}
NOTICE = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
          "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")


@pytest.fixture(scope="module")
def scanned(spark):
    whole = next(t for t, label in license_scan.PASSAGES.items() if label == "mit" and len(t) > 500)
    words = whole.split()
    changed = " ".join(w for i, w in enumerate(words) if i % 40)
    shuffled = " ".join(sorted(words))
    rows = [(1, NOTICE.format(2)), (2, NOTICE.format(3)), (3, whole.upper()), (4, "x " * 50 + changed + " y" * 50), (5, shuffled),
            (6, " ".join(words[: len(words) // 8])), (7, "all rights reserved"), (8, "all rights are reserved"), (9, None), (10, "gnu")]
    rows += [(100 + i, f"before {text.replace(' ', ' - ')}. after") for i, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r for r in license_scan.license_scan(docs).collect()}


def test_every_text_is_found_whole(scanned):
    for i, label in enumerate(TEXTS.values()):
        assert label in scanned[100 + i]["labels"].split(",") and scanned[100 + i]["score"] == 1


def test_versions_are_told_apart(scanned):
    assert (scanned[1]["labels"], scanned[2]["labels"]) == ("gpl,gpl-2", "gpl,gpl-3")
    assert scanned[1]["base_labels"] == scanned[2]["base_labels"] == "gpl"


def test_changed_texts_and_loose_words(scanned):
    assert scanned[3]["labels"] == "mit" and scanned[3]["score"] == 1
    assert "mit" in scanned[4]["labels"].split(",")
    assert scanned[5]["labels"] == ""
    assert scanned[6]["labels"] == "mit" and scanned[6]["n_base"] == 0
    assert (scanned[7]["labels"], scanned[8]["labels"]) == ("all-rights-reserved", "")
    assert scanned[9]["n_words"] == 0 and scanned[10]["labels"] == ""


def test_spans_name_their_place(spark):
    rows = spark.createDataFrame([(1, 1, "one two MIT License three"), (2, 2, "a b c redistribution and use in source and binary forms with or "
                                  "without any modification are permitted provided that the following conditions are met")],
                                 "id long, rid long, text string")
    got = {(r["id"], r["label"]): r for r in license_scan.spans(rows).where("base or coverage >= need").collect()}
    assert (got[1, "mit"]["start"], got[1, "mit"]["words"]) == (2, 2)
    assert (got[2, "bsd"]["start"], got[2, "bsd"]["words"]) == (3, 22) and got[2, "bsd"]["coverage"] == 1
