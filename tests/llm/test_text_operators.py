"""Operators on documents against brute force, and their edge cases: nulls, empty and long texts, repeated rows, empty
tables, columns of clashing names."""

import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lodestrata.llm import license_scan, line_dedup, lm, near_dup, packing, pieces, quality, text as T

FILES = "/opt/tokenizers"
EXTRA = "u long, k1 string, n string, row string, text_u string"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


BASE = [f"w{i}" for i in range(60)]


def changed(*places, by="x"):
    return " ".join(f"{by}{i}" if i in places else w for i, w in enumerate(BASE))


ROWS = [
    (1, "Alpha beta\tgamma delta, Épsilon", "a"), (2, None, "b"), (3, "", None), (4, LONG, "c"), (5, LONG, "a"),
    (5, LONG, "a"), (6, "one two", "b"), (7, "ONE two", "b"), (None, "one two three four five", "c"), (8, "  \n ", "a"),
    (9, changed(), "a"), (10, changed(5), "b"), (11, changed(5, 40), "c"), (12, changed(5, 40, 59), "c"),
    (13, changed(*range(0, 60, 7), by="y"), "d"), (14, "licence CC-BY, see the MIT License. mit license", "d"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, i, "q", "n", "row", "t") for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {EXTRA}")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], f"doc_id long, text string, source string, {EXTRA}")


def test_word_hashes_agree_with_words():
    texts = ["Ab  cd\n", "", None, "é ab"]
    data, at = T.texts_of(pa.array(texts))
    doc, start, end = T.words(data, at)
    assert [(int(d), data[s:e].tobytes().decode()) for d, s, e in zip(doc, start, end)] \
        == [(0, "Ab"), (0, "cd"), (3, "é"), (3, "ab")]
    h = T.word_hashes(data, start, end)
    assert h[0] == h[3] and len(set(h.tolist())) == 3 and int(h[0].astype(np.int64)) == T.hash_of("ab")
    assert T.word_hashes(data, start, end, lower=False)[0] != h[3]


@pytest.mark.parametrize("n", [1, 3, 50, 400])
def test_superminhash_stops_early_with_the_full_result(n):
    rng = np.random.default_rng(n)
    hashes, slots = rng.integers(0, 1 << 63, n, dtype=np.uint64), 48
    got = near_dup.signatures(np.array([0, n]), hashes, slots)[0]
    want = [1 << 64] * slots
    for h in hashes.tolist():
        order = list(range(slots))
        for rank in range(slots):
            x = int(T.mixed(np.array([(h + rank * 0x9E3779B97F4A7C15 + 1) % (1 << 64)], np.uint64))[0])
            pick = rank + ((x & 0xFFFFFFFF) * (slots - rank) >> 32)
            order[rank], order[pick] = order[pick], order[rank]
            want[order[rank]] = min(want[order[rank]], (rank << 32) | (x >> 32))
    assert got.tolist() == want


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs, k):
    got = [tuple(r) for r in near_dup.near_duplicates(docs, shingle=k).collect()]

    def shingles(t):
        w = words(t)
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets = [(r[0], shingles(r[1])) for r in ROWS]
    root = {i: i for i, _ in sets if i is not None}
    for _ in root:
        for i, a in sets:
            for j, b in sets:
                if i is not None and j is not None and a and 100 * len(a & b) >= 80 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    want = [(i, len(s), None if i is None else root[i], i is not None and root[i] == i) for i, s in sets]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_near_duplicates_that_no_leader_joins(spark):
    # A chain: each text is near its neighbours only, so leaders alone cannot bring all of them together.
    base = [f"c{i}" for i in range(120)]
    rows = [(100 + i, " ".join("z%d" % j if j < 8 * i else w for j, w in enumerate(base))) for i in range(8)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).collect()
    assert {r["component_id"] for r in got} == {100}


def test_empty_tables(nothing, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert near_dup.near_duplicates(nothing).collect() == []
    assert line_dedup.line_dedup(nothing).collect() == []
    assert packing.pack(nothing, f"{FILES}/word_bpe_49k.json").collect() == []
    assert quality.resample(nothing, labels).collect() == []
    assert lm.lm_scores(nothing).collect() == []
    assert license_scan.license_scan(nothing).collect() == []
    assert pieces.round_trip(nothing, f"{FILES}/piece_bpe_32k.model").collect() == []


def test_line_dedup(spark):
    common, rare, short = "this line stands on many sites", "this line stands on two sites", "Of."
    rows = [(i, f"{common}\nown line number {i}\n{short}\n{rare if i % 10 < 2 else ''}\n{common}", f"s{i % 10}", i) for i in range(30)]
    rows += [(40, common, None, 0), (41, None, "s1", 0), (42, "", "s1", 0), (None, common, "s1", 0), (None, common, "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, first long")
    got = line_dedup.line_dedup(docs, min_sites=10)
    assert got.columns == docs.columns
    by = {r["doc_id"]: r["text"] for r in got.collect()}
    assert by[0] == f"own line number 0\n{short}\n{rare}"  # a null id sorts first and keeps the long line
    assert by[1] == f"own line number 1\n{rare}" and by[2] == "own line number 2\n"  # short lines go, blank ones stay
    assert by[40] == "" and by[41] is None and by[42] == "" and by[None] == common
    assert got.count() == len(rows)
    assert line_dedup.line_dedup(docs, min_sites=11).where(f"text like '%{common}%'").count() == 33


def test_packing(docs):
    path = f"{FILES}/word_bpe_49k.json"
    got = packing.pack(docs, path).toPandas()
    from tokenizers import Tokenizer

    tokenizer, want = Tokenizer.from_file(path), []
    for i, text, _ in ROWS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(-1 if i is None else i, n, s, len(p := ids[s:s + 4096]), zlib.crc32(struct.pack(f"<{len(p)}I", *p)))
                 for n, s in enumerate(range(0, len(ids), 4096))]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(want) == sorted(got[columns].fillna(-1).astype("int64").itertuples(index=False, name=None))
    for _, one in got.sort_values("offset").groupby("sequence_id"):
        assert one["offset"].tolist() == (one["length"].cumsum() - one["length"]).tolist() and one["length"].sum() <= 4096
    assert got["sequence_id"].nunique() == -(-int(got["length"].sum()) // 4096)


def test_words_are_tokenized_alike_alone_and_in_texts():
    from tokenizers import Tokenizer

    path = f"{FILES}/word_bpe_49k.json"
    tokenizer = Tokenizer.from_file(path)
    texts = ["Don't STOP, 12 a b", "x<|endoftext|>y <|ENDOFTEXT|>", "ΑΣ ΟΔΟΣ́ é K", "\x1ca\x1fb  ", "🙂🙂 ﬁ"]
    ids, bounds = packing.token_ids(pa.array(texts), path)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] \
        == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_bins_are_as_full_as_they_can_be():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 100, 500).tolist()
    bins = packing.fullest_bins(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(500))
    waiting = Counter(lengths)
    for b in bins:  # the largest waiting piece, with what fills its bin best
        first = max(waiting)
        waiting -= Counter([first])
        sums = {first}
        for n in waiting.elements():
            sums |= {s + n for s in sums if s + n <= 100}
        assert lengths[b[0]] == first and sum(lengths[i] for i in b) == max(sums)
        waiting -= Counter(lengths[i] for i in b[1:])


def test_quality(spark):
    good = [(i, " ".join(f"g{(i * 7 + j * j) % 50}" for j in range(40)), 1) for i in range(60)]
    bad = [(100 + i, " ".join(f"b{(i * 3 + j) % 50}###" for j in range(40)), 0) for i in range(20)]
    rows = [(i, t, "x", 0.0) for i, t, _ in good + bad] + [(300, None, "x", 0.0), (301, "", "x", 0.0), (0, good[0][1], "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, score double")
    labels = spark.createDataFrame([(i, q) for i, _, q in good[:30] + bad[:10]] + [(1, None), (None, 1), (999, 1)], "doc_id long, quality int")
    kept = quality.resample(docs, labels)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == sorted([0, *range(60), 300, 301])
    # Against a plain version of the ratios and of the k-th key.
    model = quality.fit(docs, labels)
    scored = [tuple(r) for r in quality.score(docs, model).collect()]
    target, raw = Counter(), Counter()
    for i, t, _, _ in rows:
        _, bucket = quality.ngrams(pa.array([t], pa.string()))
        raw.update(bucket.tolist())
        if i in dict((i, 1) for i, _, q in good[:30]):
            target.update(bucket.tolist())
    n, m, size = sum(target.values()), sum(raw.values()), quality.BUCKETS
    ratio = lambda b: math.log((target[b] + 1) / (n + size)) - math.log((raw[b] + 1) / (m + size))
    for i, t, _, _ in rows:
        _, bucket = quality.ngrams(pa.array([t], pa.string()))
        want = sum(ratio(b) for b in bucket.tolist()) / (len(bucket) + quality.NEUTRAL)
        assert any(s[0] == i and abs(s[1] - want) < 1e-9 for s in scored)
    table = quality.score(docs, model)
    keys = sorted((s[2] for s in scored), reverse=True)
    for k in (1, 10, 50):
        assert quality.cut_for(table, k) == keys[k - 1]
    # Without labels nothing is judged.
    assert quality.resample(docs, labels.limit(0)).count() == len(rows)


def test_lm(docs):
    got = sorted((tuple(r) for r in lm.lm_scores(docs).collect()), key=str)
    tokens = [(i, [*words(t), None]) for i, t, _ in ROWS]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in tokens]
    c = Counter(w for (_, ws), h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(((i, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
                   for (i, ws), h in zip(tokens, held)), key=str)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6 * max(1, abs(b[5]))) and a[6] < 0


def test_lm_chances_sum_to_one_and_learning_helps():
    words_ = lm.Vocabulary(np.arange(5, dtype=np.uint64), np.array([9, 7, 5, 3, 2]), np.arange(5), np.array([9, 7, 5, 3, 2, 4]), 30, 9, 3, 2)
    model = lm.Model(words_, hashed=64)
    item = np.array([0, 1, 2, 3, 4, 5] * 200)
    doc = np.zeros(len(item), int)
    before = model.log10(doc, item).sum()
    learner = lm.Learner(model)
    for _ in range(3):
        learner.learn(doc, item)
    model.by_class, model.by_item = learner.tables
    assert model.log10(doc, item).sum() > before / 2
    history = np.array([2, 4])
    total = sum(10 ** model.log10(np.zeros(3, int), np.append(history, i))[2] for i in range(6))
    assert total == pytest.approx(1, abs=1e-4)


def test_license_scan(docs):
    by = {}
    for r in license_scan.license_scan(docs).collect():
        by.setdefault(r["doc_id"], r)
    assert tuple(by[14])[1:] == (9, 3, 1, 7, "cc-by,mit", "cc-by,mit", 1.0)
    for i in (2, 3, 8):
        assert tuple(by[i])[1:] == (0, 0, None, None, "", "", 0.0)
    assert by[4]["n_words"] == 30_000


def test_license_passage_with_words_put_in(spark):
    text = ("Permission is hereby granted, free of charge, truly, to any person obtaining a copy of this software and its "
            "associated documentation files")
    rows = spark.createDataFrame([(1, text), (2, "MIT LİCENSE and mit KK license"), (3, "mit license mit license")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.license_scan(rows).collect()}
    assert got[1]["labels"] == "mit" and got[1]["base_labels"] == "" and 0.75 <= got[1]["score"] < 1
    assert got[2]["n_base"] == 0 and (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"]) == (2, 0, 2)


def library_model(model):
    """The same pieces and scores as a unigram model of the public library."""
    def number(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + number(n >> 7)

    def part(tag, body):
        return number(tag << 3 | 2) + number(len(body)) + body

    import sentencepiece

    kinds = {model.unknown: 2, 1: 3, 2: 3} | {int(i): 6 for i in model.byte_ids}
    proto = b"".join(part(1, part(1, p.encode()) + number(2 << 3 | 5) + struct.pack("<f", model.scores[i]) + number(3 << 3) + number(kinds.get(i, 1)))
                     for i, p in enumerate(model.pieces))
    proto += part(2, number(3 << 3) + b"\x01" + number(35 << 3) + b"\x01")
    proto += part(3, part(1, b"identity") + number(3 << 3) + b"\x01" + number(4 << 3) + b"\x00" + number(5 << 3) + b"\x01")
    out = sentencepiece.SentencePieceProcessor()
    out.load_from_serialized_proto(proto)
    return out


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel.load(f"{FILES}/piece_bpe_32k.model")


TEXTS = ["hello world", "a  b\nc  ", " x", "日本語 ſ Å̈ ﬁ 🙂 \U000e0041", "   ", "don't", "a" * 50, "\t\n", "▁ marks ▁▁", "\x00 zero"]


def test_pieces_agree_with_the_library(model):
    library = library_model(model)
    for text in TEXTS[:8]:
        mine, theirs = model.encode(text), library.encode(text)
        assert sum(model.scores[mine]) == pytest.approx(sum(model.scores[theirs]), rel=1e-6)
        assert len(mine) == len(theirs) and model.decode(mine) == text == library.decode(mine)


def test_trie_finds_every_word():
    found = [b"a", b"ab", b"abc", b"b", "é".encode(), b"\xff\x00"]
    trie = pieces.double_array(found)
    for n, word in enumerate(found):
        state = 0
        for b in word:
            nxt = trie.base[state] + b
            assert trie.check[nxt] == state
            state = nxt
        assert trie.piece[state] == n


def test_pieces_over_a_table(spark, docs, model):
    path = f"{FILES}/piece_bpe_32k.model"
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None, ""])], "doc_id long, text string")
    ids = pieces.encode(rows, path)
    assert {r["doc_id"]: r["ids"] for r in ids.collect()} == {i: model.encode(t) for i, t in enumerate([*TEXTS, None, ""])}
    back = {r["doc_id"]: r["text"] for r in pieces.decode(ids, path).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate([*TEXTS, None, ""])}
    got = pieces.round_trip(docs, path).toPandas()
    assert len(got) == len(ROWS) and got["round_trip"].all() and got.loc[got["doc_id"].isin([2, 3]), "n_pieces"].eq(0).all()
