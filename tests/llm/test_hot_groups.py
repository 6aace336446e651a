"""Many equal rows, and samples whose size does not go with the number of tasks."""

from pyspark.sql import functions as F

from lodestrata.llm import packing, sampling
from test_text_operators import FILES


def test_equal_pieces_are_dealt_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 500)
    sizes = spark.sparkContext.accumulator(0)  # groups of more than twice the bound
    packed = packing._pack

    def watched(capacity, round_):
        run = packed(capacity, round_)

        def counted(group):
            if len(group) > 1000:
                sizes.add(1)
            return run(group)

        return counted

    monkeypatch.setattr(packing, "_pack", watched)
    docs = spark.createDataFrame([(None, "")] * 6000, "doc_id long, text string").repartition(4)
    got = packing.pack(docs, f"{FILES}/word_bpe_49k.json")
    assert got.count() == 6000 and "row" not in got.columns
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("offset").alias("last")).where("n > 4096 or last <> n - 1").count() == 0
    assert got.select("sequence_id").distinct().count() <= 2 * -(-6000 // 4096) + 12
    assert sizes.value == 0


def test_samples(spark):
    rows = spark.range(20_000).repartition(50)
    taken = sampling.about(rows, 1000, "id")
    assert 850 < taken.count() < 1150
    assert "TakeOrdered" not in taken._jdf.queryExecution().executedPlan().toString()
    assert sampling.about(rows, 20_000, "id").count() == 20_000 and sampling.about(rows.limit(0), 5, "id").count() == 0
