from pyspark.sql import functions as F

from lodestrata.functions import labels, numeric, times
from lodestrata.functions.casts import conform_types, decimals_to_double
from lodestrata.plans.rules import EDUCATION


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def out(df, *columns):
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return [r[0] for r in rows] if len(columns) == 1 else rows


def test_half_up_on_decimal_value(spark):
    df = column(spark, [1.005, 2.675, -1.005, 0.1 + 0.2, None, float("nan")])
    assert out(df, numeric.half_up("x", 2)) == [1.01, 2.68, -1.01, 0.3, None, None]


def test_safe_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert out(df, numeric.safe_ratio("a", "b")) == [None, None, 1.5]


def test_half_up_cuts_only_what_a_double_does_not_hold(spark):
    df = spark.createDataFrame([(62.124999999,), (0.004999999999,), (62.125,), (1e31,), (58938.144999999997,)], "x double")
    assert out(df, numeric.half_up("x", 2)) == [62.12, 0.0, 62.13, 1e31, 58938.15]


def test_rate_when_nobody_passes_can_be_null(spark):
    df = spark.createDataFrame([(1, False, 2.0), (2, True, 1.0), (2, False, 1.0)], "g int, ok boolean, w double")
    got = dict(out(df.groupBy("g").agg(numeric.weighted_rate("ok", "w", nobody=None).alias("r")), "g", "r"))
    assert got == {1: None, 2: 50.0}


def test_weighted_rate_zero_null_and_no_weight(spark):
    schema = "g int, ok boolean, w double"
    rows = [(1, False, 2.0), (1, False, 1.0), (2, True, 1.0), (2, False, 3.0), (3, True, 0.0), (4, None, 1.0)]
    got = dict(out(spark.createDataFrame(rows, schema).groupBy("g").agg(
        numeric.weighted_rate("ok", "w").alias("r")).select("g", "r"), "g", "r"))
    assert got == {1: 0.0, 2: 25.0, 3: None, 4: 0.0}


def test_projection_and_pace(spark):
    schema = "a double, b double, t double, n int"
    rows = [(50.0, 60.0, 80.0, 1), (60.0, 50.0, 80.0, 1), (50.0, 90.0, 80.0, 1), (50.0, 50.0, 80.0, 0)]
    df = spark.createDataFrame(rows, schema)
    assert out(df, numeric.cycles_to_target("a", "b", "t", F.col("n"))) == [2.0, None, 0.0, None]
    pace = spark.createDataFrame([(12.0, 2024), (12.0, 2030)], "g double, c int")
    assert out(pace, numeric.required_pace("g", "c", 2030)) == [2.0, None]


def test_leading_code(spark):
    assert out(column(spark, [3550308, 1100015], "int"), numeric.leading_code("x", 100000)) == [35, 11]


def test_ladder_null_has_no_band(spark):
    bands = labels.ladder("x", EDUCATION.score_bands, EDUCATION.top_score_band)
    assert out(column(spark, [649.9, 650.0, 742.9, 743.0, 800.0, None]), bands) == [
        "Muito baixa", "Baixa", "Abaixo do corte", "Adequada", "Avancada", None]


def test_interval_label_closed_on_the_right(spark):
    band = labels.interval_label("x", EDUCATION.priority_edges, EDUCATION.priority_labels)
    assert out(column(spark, [0.0, 50.0, 50.1, 85.0, 100.0, 100.1, -0.1, None]), band) == [
        "Monitoramento", "Monitoramento", "Média", "Alta", "Crítica", None, None, None]


def test_crosswalk_accents_and_padding(spark):
    text = column(spark, [" Pública ", "MUNICIPAL", "outra", None], "string")
    code = labels.crosswalk("x", EDUCATION.segment_codes)
    assert out(text, code) == [5, 3, None, None]
    assert out(text.withColumn("c", code), labels.decode("c", EDUCATION.segment_labels)) == [
        "Publica", "Municipal", None, None]


def test_text_flag_falls_back(spark):
    df = spark.createDataFrame([("Sim", 1.0), ("?", 800.0), ("?", None), (None, 700.0)], "t string, s double")
    flag = labels.text_flag("t", {"sim": True, "não": False}, F.col("s") >= 743)
    assert out(df, flag) == [True, True, False, False]


def test_times(spark):
    df = column(spark, ["2024-05-01T10:00:00.250+00:00", "ontem de manha", None], "string")
    parsed = df.withColumn("t", times.lenient_timestamp("x"))
    assert [t is None for t in out(parsed, "t")] == [False, True, True]
    later = F.timestamp_millis(F.unix_millis("t") + 1500)
    assert out(parsed.where("t is not null"), times.latency_ms(later, "t")) == [1500.0]


def test_casts(spark):
    df = spark.createDataFrame([("7", "x"), ("7a", "y")], "a string, b string")
    assert out(conform_types(df, {"a": "int", "absent": "int"}), "a") == [7, None]
    assert dict(decimals_to_double(spark.sql("select 100.0 * 3 as v, 'a' as k")).dtypes) == {"v": "double", "k": "string"}


def test_equal_width_bin_last_is_closed(spark):
    df = column(spark, [0.0, 4.9, 5.0, 10.0])
    assert out(df, numeric.equal_width_bin("x", F.lit(0.0), F.lit(10.0), 2)) == [0, 0, 1, 1]
    assert out(column(spark, [3.0]), numeric.equal_width_bin("x", F.lit(3.0), F.lit(3.0), 5)) == [0]
