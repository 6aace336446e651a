"""Landing files in the published layout, through every layer."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.monitor import Monitor, run_summary
from lodestrata.operators.quality import QualityGateError
from lodestrata.plans.education import ENTITIES
from lodestrata.plans.medallion import Medallion
from lodestrata.plans.store import Store

SMALL = {"unit_indicator": 10, "parent_indicator": 4, "national_targets": 1, "parent_targets": 2, "unit_targets": 10,
         "parents": 3, "units": 12, "records": 100}
PARENTS = [(35, "sp", "São Paulo ", 3, "SE", "Sudeste"), (31, "mg", "Minas Gerais", 3, "SE", "Sudeste"),
           (29, "ba", "Bahia", 2, "NE", "Nordeste")]
UNITS = [p * 100_000 + k for p in (35, 31, 29) for k in range(1, 9)]


def scores(cycle, unit):
    """Ten assessed pupils: the weight of those that pass sets the rate."""
    passing = (unit * 7 + cycle) % 9 + 1
    return [(f"{cycle}-{unit}-{i}", 750.0 + i if i < passing else 650.0 + i) for i in range(10)]


def rate(cycle, unit):
    return sum(s >= 743 for _, s in scores(cycle, unit)) * 10.0


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landing"))

    def csv(name, header, rows):
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join([header, *[",".join("" if v is None else str(v) for v in r) for r in rows]]) + "\n")

    base = "br_inep_avaliacao_alfabetizacao"
    levels = ",".join(f"proporcao_aluno_nivel_{i}" for i in range(9))
    csv(f"{base}_municipio.csv", f"ano,id_municipio,serie,rede,taxa_alfabetizacao,media_portugues,{levels}",
        [(c, u, 2, 3, rate(c, u), round(sum(s for _, s in scores(c, u)) / 10, 2), *[None if c == 2023 else 11.1] * 9)
         for c in (2023, 2024) for u in UNITS])
    csv(f"{base}_uf.csv", f"ano,sigla_uf,serie,rede,taxa_alfabetizacao,media_portugues,{levels}",
        [(c, p[1].upper(), 2, 3, 55.5, 745.0, *[None] * 9) for c in (2023, 2024) for p in PARENTS])
    targets = ",".join(f"meta_alfabetizacao_{y}" for y in range(2024, 2031))
    csv(f"{base}_meta_alfabetizacao_brasil.csv", f"ano,rede,taxa_alfabetizacao,{targets},percentual_participacao",
        [(c, "Pública", 56.0, *range(60, 81, 3), 90) for c in (2023, 2024)])
    csv(f"{base}_meta_alfabetizacao_uf.csv", f"ano,sigla_uf,rede,taxa_alfabetizacao,{targets},percentual_participacao",
        [(c, p[1].upper(), "Municipal", 55.5, *range(60, 81, 3), 90) for c in (2023, 2024) for p in PARENTS])
    csv(f"{base}_meta_alfabetizacao_municipio.csv",
        f"ano,id_municipio,rede,taxa_alfabetizacao,{targets},percentual_participacao,nivel_alfabetizacao",
        [(c, u, " municipal", rate(c, u), *[None if u % 5 == 0 else 40 + 5 * k + (c - 2023) for k in range(7)], 88.5, 3)
         for c in (2023, 2024) for u in UNITS])
    csv("ibge_estados.csv", "id,sigla,nome,regiao_id,regiao_sigla,regiao_nome", PARENTS)
    csv("ibge_municipios.csv", "id,nome,microrregiao_nome,microrregiao_mesorregiao_nome", [(u, "x", "m", "M") for u in UNITS])
    with open(f"{folder}/ibge_municipios.json", "w") as f:
        json.dump([{"id": u, "nome": f" U{u}", "microrregiao": {"nome": "m", "mesorregiao": {"nome": "M"}}} for u in UNITS], f)
    rows = [(p, c, u, "e1", 3, 2, s, float(s >= 743), 1, 1.0 if i % 2 else None) for c in (2023, 2024) for u in UNITS
            for i, (p, s) in enumerate(scores(c, u))]
    rows += [(f"absent-{u}", 2024, u, "e1", 3, 2, None, None, 0, 2.0) for u in UNITS]
    spark.createDataFrame(rows, "id_aluno string, ano int, id_municipio int, id_escola string, rede int, serie int, "
                          "proficiencia double, alfabetizado double, presenca int, peso_aluno double"
                          ).write.parquet(f"{folder}/alunos.parquet")
    return folder


@pytest.fixture(scope="module")
def built(spark, landing, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lake"))
    entities = [replace(e, min_rows=1) for e in ENTITIES]
    pipeline = Medallion(Store(spark, folder), Monitor(spark, f"{folder}/monitoring", "batch", "run1"), minimum=SMALL,
                         entities=entities)
    pipeline.run_batch(landing)
    return pipeline


def test_layers(built):
    fact = built.store.read("silver", "fact")
    assert fact.count() == 2 * len(UNITS) and fact.where("parent_name is null or meso_region <> 'M'").count() == 0
    one = fact.where(f"cycle = 2024 and unit_id = {UNITS[1]}").first()
    assert (one.rate, one.target_cycle, one.target_final, one.parent_rate, one.national_rate) == (
        rate(2024, UNITS[1]), 41.0, 71.0, 55.5, 56.0)
    assert fact.where("target_is_default").select("target_final").distinct().first()[0] == 80.0
    assert built.store.read("silver", "levels").count() == 9 * len(UNITS)
    raw = built.store.read("bronze", "units")
    assert raw.select("_source_format").distinct().first()[0] == "json"
    assert built.store.read("bronze", "parents").first()["_source"] == "ibge_estados.csv"
    assert built.store.read("silver", "records").where("not assessed").count() == len(UNITS)


def test_marts_and_monitoring(built):
    names = ("unit_indicator", "target_vs_actual", "change_between_cycles", "parent_ranking", "level_profile",
             "record_profile", "model_features")
    assert set(built.store.find("gold", names)) == set(names)
    assert not built.store.find("gold", ["stream_profile"])      # no stream yet: skipped
    summary = run_summary(built.monitor.stored_steps()).first()
    assert summary.failed_steps == 0 and summary.steps == 19
    assert built.monitor.stored_alerts().where("severity = 'LOW'").count() == 1
    profile = built.store.read("gold", "record_profile").where(f"cycle = 2024 and unit_id = {UNITS[0]}").first()
    assert (profile.registered, profile.assessed_records, profile.rate) == (11, 10, rate(2024, UNITS[0]))


def test_stream_joins_batch(spark, built, tmp_path_factory):
    source, work = str(tmp_path_factory.mktemp("events")), str(tmp_path_factory.mktemp("ck"))
    with open(f"{source}/a.json", "w") as f:
        for i in range(44):
            f.write(json.dumps({
                "id_evento": f"E{i % 40}", "tipo_evento": "A", "ts_evento": "2024-06-01T08:00:00.000+00:00",
                "id_municipio": UNITS[0] if i % 8 else 9999999, "id_escola": "e", "rede": 3, "serie": 2, "id_aluno": f"a{i}",
                "proficiencia_portugues": 600.0, "peso_aluno": 1.0, "origem": "o", "_defeito_injetado": None}) + "\n")
    built.run_stream(source, work, processed_at=F.expr("event_time + interval 1 second"))
    events = built.store.read("silver", "stream")
    assert events.count() == events.select("event_id").distinct().count() == 35
    alert = built.store.read("silver", "stream_alerts").first()
    assert alert.severity == ("ALTA" if rate(2024, UNITS[0]) > 10 else "MEDIA")
    assert [a["severity"] for a in built.monitor.alerts] == ["HIGH"]      # 12.5% of the events are dead letters
    assert ("stream_profile", "built") in [(r.name, r.state) for r in built.build_gold("stream_profile")]


def test_analytics(built):
    table = built.prioritise(ks=(2, 3), seeds=(1, 2))
    assert table.count() == len(UNITS) and table.where("profile is null or priority_band is null").count() == 0
    comparison = built.predict(which=["ridge"])
    assert {r.model for r in comparison.collect()} == {"baseline", "ridge"}


def test_gate_stops_a_bad_source(spark, landing, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bad"))
    strict = Medallion(Store(spark, folder), Monitor(spark, f"{folder}/monitoring", "batch"), minimum=SMALL | {"units": 99})
    strict.ingest(landing)
    with pytest.raises(QualityGateError) as stop:
        strict.gate_bronze()
    assert ("units", "row_count") in {(r.table, r.check) for r in stop.value.failures}
    with pytest.raises(FileNotFoundError, match="alunos.parquet"):
        strict.ingest(str(tmp_path_factory.mktemp("empty")))
