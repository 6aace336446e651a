import pytest

from lodestrata import storage
from lodestrata.operators.monitor import Monitor
from lodestrata.plans.store import Store
from lodestrata.sources import catalog, layout, lineage, readers, sinks
from lodestrata.storage import materialise, release_scratch, scratch_root


def test_hash_tells_nulls_and_separators_apart(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a|1:b", "", None), ("a", "1:b|0:", None), ("", None, None), (None, "", None)]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    hashes = [r[0] for r in df.select(lineage.record_hash(["x", "y", "z"])).collect()]
    assert len(set(hashes)) == len(rows) and all(len(h) == 64 for h in hashes)


def test_flatten_nested_json(spark, folder):
    path = f"{folder}/u.json"
    with open(path, "w") as f:
        f.write('[{"id": 1, "nome": "A", "microrregiao": {"nome": "m", "mesorregiao": {"nome": "M"}}},\n'
                ' {"id": 2, "nome": "B", "microrregiao": null}]')
    flat = readers.flatten(readers.read_json(spark, path, multi_line=True)).orderBy("id")
    assert sorted(flat.columns) == ["id", "microrregiao_mesorregiao_nome", "microrregiao_nome", "nome"]
    assert [r.microrregiao_mesorregiao_nome for r in flat.collect()] == ["M", None]


def test_fallback_order(spark, folder):
    spark.range(3).write.parquet(f"{folder}/short")
    spark.range(9).write.parquet(f"{folder}/long")
    told = []
    df, chosen = readers.read_first_available(
        spark, [readers.Source("gone", "json", f"{folder}/gone"), readers.Source("short", "parquet", f"{folder}/short"),
                readers.Source("long", "parquet", f"{folder}/long")], 5, lambda s, why: told.append((s.name, why)))
    assert (chosen.name, df.count()) == ("long", 9)
    assert told == [("gone", "PATH_NOT_FOUND"), ("short", "fewer than 5 rows")]


def test_presence(spark, folder):
    for name, content in (("a.csv", "x"), ("empty.csv", "")):
        with open(f"{folder}/{name}", "w") as f:
            f.write(content)
    files = readers.present_files(spark, folder)
    expected = spark.createDataFrame([("a.csv",), ("b.csv",), ("empty.csv",)], "name string")
    missing = readers.missing_entries(expected, files, r"([^/]+)$")
    with pytest.raises(FileNotFoundError, match="b.csv, empty.csv"):
        readers.require_present(missing)
    readers.require_present(missing.where("name = 'a.csv'"))


def test_layout_skips_and_keeps_rows(spark, folder):
    df = spark.range(2000).selectExpr("id", "if(id % 3 = 0, 7, cast(id % 50 as int)) as k")
    sinks.overwrite_path(sinks.clustered(df, ["k"], 4), f"{folder}/c")
    back = spark.read.parquet(f"{folder}/c")
    assert back.exceptAll(df).isEmpty() and back.count() == 2000
    sinks.overwrite_path(df, f"{folder}/p", ["k"])
    costs = {r.strategy: r for r in layout.scan_bytes(spark.read.parquet(f"{folder}/p"), {"all": None, "one": "k = 7", "none": "k = -1"}).collect()}
    assert costs["all"].bytes > costs["one"].bytes > 0 == costs["none"].bytes and costs["all"].files > costs["one"].files >= 1
    assert catalog.footprint(spark, {"x": f"{folder}/p"}).first().bytes == costs["all"].bytes


def test_views_skip_missing(spark, folder):
    spark.range(4).createOrReplaceTempView("t_here")
    bound, absent = catalog.bind_views(spark, {"v_here": "t_here", "v_gone": "t_gone"})
    assert (bound, absent) == ({"v_here"}, {"v_gone"}) and spark.table("v_here").count() == 4


def test_typed_table_and_inventory(spark, folder):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS t_inventory LOCATION '{folder}/s'")
    schema = spark.createDataFrame([], "id string, v double").schema
    catalog.recreate_table(spark, "t_inventory.typed", schema)
    assert spark.table("t_inventory.typed").schema == schema
    assert [tuple(r) for r in catalog.schema_inventory(spark, ["t_inventory"]).collect()] == [("t_inventory", "typed", 0)]
    spark.sql("DROP SCHEMA t_inventory CASCADE")


def test_store_and_scratch(spark, folder):
    store = Store(spark, folder)
    assert store.write("gold", "t", spark.range(3), ["id"]).count() == 3
    assert set(store.find("gold", ["t", "absent"])) == {"t"}
    assert materialise(spark.range(2), "x").count() == 2
    assert scratch_root(spark).endswith(spark.sparkContext.applicationId)
    assert callable(release_scratch) and Monitor(spark, folder, "p").run_id


def test_scratch_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(storage, "CHECKPOINT_KEY", "spark.lodestrata.unset")
    assert "lodestrata-" in scratch_root(spark) and scratch_root(spark) == scratch_root(spark)


def test_dictionary_and_share(spark):
    counts = spark.createDataFrame([("csv", 1), ("parquet", 3), ("csv", 0)], "format string, rows int")
    assert {r.format: r.pct for r in lineage.share_by(counts, "format", "rows").collect()} == {"csv": 25.0, "parquet": 75.0}


def test_unreadable_sources_are_passed_over(spark, folder):
    import os

    spark.range(9).write.parquet(f"{folder}/good")
    os.mkdir(f"{folder}/broken")
    for path, content in ((f"{folder}/broken/part.parquet", "not a table"), (f"{folder}/page.json", "<html>error</html>")):
        with open(path, "w") as f:
            f.write(content)
    told = []
    df, chosen = readers.read_first_available(
        spark, [readers.Source("broken", "parquet", f"{folder}/broken"), readers.Source("page", "json", f"{folder}/page.json"),
                readers.Source("good", "parquet", f"{folder}/good")], 1, lambda s, why: told.append(s.name))
    assert (chosen.name, df.count(), told) == ("good", 9, ["broken", "page"])
