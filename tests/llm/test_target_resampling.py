"""Target resampling against a plain version written straight from its definition."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from lodestrata.llm import target_resampling as R


def features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    grams = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, Counter(zlib.crc32(g.encode()) % 10000 for g in grams)


def plain(docs, target):
    raw, goal = Counter(), Counter()
    for _, text in docs:
        raw.update(features(text)[1])
    for text in target:
        goal.update(features(text)[1])
    S, T = raw.total(), goal.total()
    gain = [math.floor(1000 * math.log((goal[b] + 1) * (S + 10000) / ((raw[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        words, own = features(text)
        weight, score = sum(gain[b] * n for b, n in own.items()), None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(words), own.total(), weight, score, None])
    able = sorted((r for r in rows if r[4] is not None and r[1] >= 20), key=lambda r: (-r[4], r[0]))
    for place, row in enumerate(able[:5 * len(able) // 100], 1):
        row[5] = place
    return rows


def rows_of(df):
    return [(r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def corpus():
    base = [" ".join(f"w{(i * j) % 37}" for j in range(1, 20 + i % 9)) for i in range(200)]
    docs = list(enumerate(base))
    docs += [(500, None), (501, ""), (502, " .,\x00\x7f\n"), (503, "One-Word"), (504, "ÄÖ İK ünïcode 中文 _x_ a1B2"),
             (None, base[3]), (None, base[3]), (7, base[7]), (7, base[8]), (-9, base[9]), (505, "x" * 300_000),
             (506, " ".join(f"t{i % 977}" for i in range(120_000)))]
    return docs, ["W1 w2 w3 w4", "w5, w10; w15 w20", None, ""]


def test_equals_the_plain_version(spark):
    docs, target = corpus()
    docs_df = spark.createDataFrame([(*d, 1, "n") for d in docs], "doc_id long, text string, row int, weight string").repartition(5)
    got = R.resample(docs_df, spark.createDataFrame([(t,) for t in target], "text string"))
    expected = [tuple(r) for r in plain(docs, target)]
    assert sorted(rows_of(got), key=key) == sorted(expected, key=key)
    assert [r[5] for r in expected].count(None) < len(expected)


def test_repeated_rows_have_ranks_of_their_own(spark):
    text = " ".join(f"v{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text)] * 400 + [(2, text)] * 100, "doc_id long, text string").repartition(7)
    got = R.resample(docs, spark.createDataFrame([(text,)], "text string")).where("rank is not null").toPandas()
    assert sorted(got["rank"]) == list(range(1, 26))
    assert got["doc_id"].nunique() == 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert R.resample(none, none.select("text")).collect() == []
    got = R.resample(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), none.select("text")).collect()
    assert rows_of_plain(got) == [tuple(plain([(1, "a b")], [])[0])]


def rows_of_plain(rows):
    return [(r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows]


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_pieces_of_a_text_do_not_matter(monkeypatch, piece):
    text = "Aa b  c,d e\n" * 9 + "f" * 100 + " g"
    whole = Counter(x for _, found in R.runs(text.encode()) for x in found)
    monkeypatch.setattr(R, "PIECE", piece)
    assert Counter(x for _, found in R.runs(text.encode()) for x in found) == whole
    assert sum(n for n, _ in R.runs(text.encode())) == len(features(text)[0])
