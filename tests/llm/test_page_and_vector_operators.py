"""Pages, vectors, the pipeline and the registered queries."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import rows_of
from lodestrata.llm import ann, html_text, near_dup, packing, quality, vector_dedup
from lodestrata.llm.graph import components

DATA = "/root/testdata/sf0.001"


def test_components(spark):
    edges = [(1, 2), (2, 1), (3, 2), (9, 8), (7, 7), (None, 3), *[(20 + i, 21 + i) for i in range(30)], *[(100, 200 + i) for i in range(50)]]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} | {20 + i: 20 for i in range(31)} | {100: 100} | {200 + i: 100 for i in range(50)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>no</title><script>var t="</p>";</script></head><body><header>Site</header>
<div class="cookie-notice">We use cookies.</div><nav><ul><li><a href=x>home</a></li></ul></nav><main><div class="post">
<h1>A&nbsp;title &amp; more</h1><p>First   <b>para</b><br>of some length here.<p>Second &lt;last&gt;.</p><div class="ad">Buy now!</div>
<p>Hm.</p><style>p{}</style></div><section id="comments"><h3>Comments</h3><p>I agree with this article very much.</p></section></main>
<aside><p>Related reading that is long.</p></aside><form><p>Sign up</p></form><!-- x --><footer>&copy; me</footer></body></html>"""


def test_pages(spark):
    rows = [(1, "u", PAGE, "x"), (2, "u", None, "x"), (3, "u", "", "x"), (3, None, PAGE, "x"), (None, "u", "<p", "x"),
            (4, "u", "<article>" + "<p>Some longer words stand here.</p>" * 5000 + "</article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()}
    want = "A title & more\nFirst para of some length here.\nSecond <last>.\nHm."
    assert got[1, "u"] == got[3, None] == (want, len(want))
    assert got[2, "u"] == got[3, "u"] == ("", 0)
    assert got[4, "u"][0].count("\n") == 4999
    assert html_text.extract(pages.limit(0)).collect() == []


def test_field_sums_and_best_path_by_enumeration():
    field = html_text.Field_({}, [[0.3, -0.7], [0.1, 0.9]])
    scores = [0.5, -1.2, 0.4, 0.1]
    def value(y):
        return sum(s for s, x in zip(scores, y) if x) + sum(field.moves[a][b] for a, b in zip(y[:-1], y[1:]))

    paths = [tuple(n >> i & 1 for i in range(4)) for n in range(16)]
    weights = np.exp([value(p) for p in paths])
    chance, moved = field.marginals(scores)
    assert chance == pytest.approx([sum(w for w, p in zip(weights, paths) if p[i]) / weights.sum() for i in range(4)])
    assert moved[0][1] == pytest.approx(sum(w * sum(p[i:i + 2] == (0, 1) for i in range(3)) for w, p in zip(weights, paths)) / weights.sum())
    assert field.decode(scores) == [bool(x) for x in max(paths, key=value)]


def test_held_out_layouts():
    model = html_text.train(html_text.layouts(1))
    right = total = 0
    for page, truth in html_text.layouts(2):
        got = model.decode(model.scores(page))
        right += sum(a == b for a, b in zip(got, truth))
        total += len(truth)
    assert right / total > 0.97


def vectors(spark, seed, n=400, dims=12):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[n // 2:] = x[rng.integers(0, 40, n - n // 2)] + rng.normal(scale=0.12, size=(n - n // 2, dims))
    x[5] = x[6] = x[7]
    x[8] = 3 * x[7]
    rows = [(i, v.tolist(), "k") for i, v in enumerate(x)]
    bad = [(n, None), (n + 1, [0.0] * dims), (n + 2, [float("nan")] + [1.0] * (dims - 1)), (n + 3, [float("inf")] * dims),
           (n + 4, [None] + [1.0] * (dims - 1)), (n + 5, [1.0]), (n + 6, [])]
    rows += [(i, v, "k") for i, v in bad] + [(3, rows[3][1], "k")]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<double>, k1 string"), [i for i, _ in bad]


@pytest.mark.parametrize("block", [64, 4096])
def test_vector_dedup(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    x, table, bad = vectors(spark, 1)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    root = list(range(len(x)))
    for _ in range(30):
        root = [min(root[j] for j in np.flatnonzero(near[i])) for i in range(len(x))]
    got = vector_dedup.near_vectors(table).collect()
    assert len(got) == table.count()
    for r in got:
        i = r["vec_id"]
        # Vector 3 stands there twice: the copies link with each other and count twice for their partners.
        n = 0 if i in bad else int(near[i].sum()) - 1 + int(near[i, 3])
        assert (r["n_links"], r["component_id"], r["kept"]) == ((0, i, True) if i in bad else (n, root[i], root[i] == i)), i
    assert vector_dedup.near_vectors(table.limit(0)).collect() == []
    assert [tuple(r) for r in vector_dedup.near_vectors(table.where("vec_id = 400")).collect()] == [(400, 0, 400, True)]


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 150)
    x, table, bad = vectors(spark, 2)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = ann.nearest(table, table.where("vec_id % 10 = 0")).toPandas()
    assert not got["query_id"].isin(bad).any() and not got["vec_id"].isin(bad).any()
    hits = 0
    for q in range(0, len(x), 10):
        mine = got[got["query_id"] == q].sort_values("rank")
        score = u @ u[q]
        score[q] = -9
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5] and q not in mine["vec_id"].tolist()
        assert mine["score"].to_numpy() == pytest.approx(score[mine["vec_id"]])
        hits += len(set(mine["vec_id"]) & set(np.lexsort((np.arange(len(x)), -score))[:5].tolist()))
    assert hits / got["query_id"].nunique() / 5 >= 0.9
    few = table.where("vec_id in (5, 6, 10)")
    ranked = [tuple(r)[:3] for r in ann.nearest(few, few.where("vec_id = 6")).orderBy("rank").collect()]
    assert ranked == [(6, 1, 5), (6, 2, 10)]
    assert ann.nearest(table.limit(0), table.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
class TestTables:
    @pytest.mark.parametrize("name", sorted(entry.LLM_QUERIES))
    def test_query(self, spark, name):
        got = entry.queries()[name](spark, DATA)
        rows = [tuple(r) for r in got.collect()]
        assert rows
        if sql := entry.oracle_sql().get(name):
            con = duckdb.connect()
            for view in ("documents", "embeddings", "benchmark"):
                con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{DATA}/{view}.parquet'")
            result = con.execute(sql)
            names = [d[0] for d in result.description]
            assert rows_of(got.columns, rows) == rows_of(names, result.fetchall())

    def test_recall(self, spark):
        v = spark.read.parquet(f"{DATA}/embeddings.parquet")
        p = v.toPandas()
        x = np.stack(p["embedding"]).astype(float)
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        ids, hits, asked = p["vec_id"].to_numpy(), 0, 0
        got = ann.nearest(v, v.where("vec_id % 50 = 0")).toPandas()
        for i in np.flatnonzero(ids % 50 == 0):
            score = u @ u[i]
            score[i] = -9
            hits += len(set(ids[np.lexsort((ids, -score))[:5]]) & set(got[got["query_id"] == ids[i]]["vec_id"]))
            asked += 5
        assert hits / asked >= 0.9

    def test_pipeline(self, spark):
        """Each stage against what it must do to its own input, and run() against the stages."""
        docs = spark.read.parquet(f"{DATA}/documents.parquet")
        columns = docs.columns
        kept = corpus_pipeline.select_quality(spark, docs, DATA)
        good = {r[0] for r in spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1").select("doc_id").collect()}
        ids = {r[0] for r in kept.select("doc_id").collect()}
        assert kept.columns == columns and len(good & ids) >= 0.97 * len(good)
        lines = corpus_pipeline.dedup_lines(spark, kept, DATA)
        assert lines.columns == columns and lines.count() == kept.count() and not lines.where("n_chars <> length(text)").take(1)
        single = corpus_pipeline.drop_near_duplicates(spark, lines, DATA)
        heads = {r["component_id"] for r in near_dup.near_duplicates(lines).collect()}
        assert set(single.columns) == set(columns) and {r[0] for r in single.select("doc_id").collect()} == heads
        packed = corpus_pipeline.pack_sequences(spark, single, DATA).toPandas()
        assert set(packed["doc_id"]) == heads
        run = corpus_pipeline.run(spark, DATA).toPandas()
        same = ["doc_id", "piece", "start", "length", "ids_crc32"]
        assert sorted(run[same].itertuples(index=False, name=None)) == sorted(packed[same].itertuples(index=False, name=None))
        assert packing.CAPACITY == 4096 and quality.LABELLED == 20_000
