"""The language model: rounds and learners, growth, layout, and its score by a plain version."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import lm, text as T


def plain_score(model, texts):
    """log10 of every text, token by token in plain Python."""
    w, out = model.words, []
    known = dict(zip(w.hashes.tolist(), zip(w.items.tolist(), w.counts.tolist(), strict=True), strict=True))
    for text in texts:
        hashes = [T.hash_of(x) % 2 ** 64 for x in text.lower().split()] + [int(lm.END)]
        codes = []
        for h in hashes:
            item = known.get(h, (-1, 0))[0]
            codes.append(item if item >= 0 else w.tail + 2 + (h >> 40) % lm.CODES)
        total = 0.0
        for i, code in enumerate(codes):
            rows = [r[:, i] for r in model.features(np.zeros(len(codes), int), np.array(codes))]
            item = min(code, w.tail)
            class_, place = divmod(item, w.width)
            for bias, table, own, target in ((model.class_bias, model.by_class, rows[0], class_),
                                             (model.item_bias[class_], model.by_item, rows[1], place)):
                scores = [float(b) + sum(float(table[r][j]) for r in own) for j, b in enumerate(bias)]
                total += scores[target] - math.log(sum(math.exp(s) for s in scores))
            if item == w.tail:
                total += math.log((max(0, known.get(hashes[i], (-1, 0))[1]) + 1) / w.tail_mass)
        out.append(total / math.log(10))
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(5)
    follow = {a: rng.permutation(3000)[:3] for a in range(3000)}

    def text():
        at, out = int(rng.zipf(1.3)) % 3000, []
        for _ in range(60):
            out.append(f"w{at}")
            at = int(rng.choice(follow[at])) if rng.random() < 0.7 else int(rng.zipf(1.3)) % 3000
        return " ".join(out)

    return spark.createDataFrame([(i, text()) for i in range(1500)], "doc_id long, text string")


def test_rounds_deal_every_part_once():
    for tokens in (1, 99, 1000, 123_456, 10_000_000):
        got = lm.rounds(tokens, share=1000)
        assert got[0][0] == 0 and got[-1][1] == lm.PARTS
        assert all(a[1] == b[0] for a, b in zip(got, got[1:]))
        assert sum(n for _, _, n in got) >= tokens / 1000
        assert all((end - first) / lm.PARTS * tokens <= n * 1000 + 1 for first, end, n in got)
    assert lm.rounds(0) == []


def test_score_is_the_models_own_chance(corpus, monkeypatch):
    monkeypatch.setattr(lm, "train", train := Kept(lm.train))
    got = {r["doc_id"]: r["score"] for r in lm.lm_scores(corpus).collect()}
    some = corpus.where("doc_id % 300 = 2").collect()
    for r, want in zip(some, plain_score(train.model, [r["text"] for r in some]), strict=True):
        assert got[r["doc_id"]] == pytest.approx(want, rel=1e-4)


class Kept:
    def __init__(self, run):
        self.run = run

    def __call__(self, *args):
        self.model = self.run(*args)
        return self.model


def test_files_do_not_decide_and_several_learners_learn(corpus, monkeypatch):
    run = lm.rounds
    monkeypatch.setattr(lm, "rounds", lambda tokens: run(tokens, share=10_000))

    def held(docs):
        return docs.where("held_out").agg((F.sum("score") / F.sum("n_tokens")).alias("s"), (F.sum("base_score") / F.sum("n_tokens")).alias("b")).first()

    one, many = (held(lm.lm_scores(corpus.repartition(n))) for n in (2, 32))
    assert one["s"] > one["b"] + 0.05 and many["s"] > many["b"] + 0.05
    assert one["s"] == pytest.approx(many["s"], abs=0.01)


def test_commonest_and_growing_items(spark):
    counts = pd.DataFrame({"h": np.arange(20_000), "c": 1 + (200_000 // (1 + np.arange(20_000)))})
    table = spark.createDataFrame(counts, "h long, c long").repartition(4)
    got = lm._commonest(table, 500, 20_000)
    assert 440 <= len(got) <= 560 and got["h"].tolist()[:400] == list(range(400))
    assert len(lm._commonest(table, 20_000, 20_000)) == 20_000
    assert lm.vocabulary(table).classes == lm.NARROW
    # All counts equal: a share by hash.
    assert 300 <= len(lm._commonest(table.select("h", F.lit(1).cast("long").alias("c")), 500, 20_000)) <= 700
    assert lm.vocabulary(spark.range(3_000_000).select(F.col("id").alias("h"), F.lit(2).cast("long").alias("c"))).classes > lm.NARROW
