"""The published assessment programme: its source layout in the common vocabulary."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lodestrata.operators.reshape import columns_with_prefix

# Fixed values of the published files: column names, file names, smallest plausible sizes.
LEVEL_PREFIX = "proporcao_aluno_nivel_"
TARGET_PREFIX = "meta_alfabetizacao_"
INDICATOR_COLUMNS = {"ano": "cycle", "id_municipio": "unit_id", "sigla_uf": "parent_code", "serie": "grade",
                     "rede": "segment", "taxa_alfabetizacao": "rate", "media_portugues": "mean_score"}
TARGET_COLUMNS = {"ano": "cycle", "id_municipio": "unit_id", "sigla_uf": "parent_code", "rede": "segment_text",
                  "taxa_alfabetizacao": "rate", "percentual_participacao": "participation",
                  "nivel_alfabetizacao": "aggregate_level"}
PARENT_COLUMNS = {"id": "parent_id", "sigla": "parent_code", "nome": "parent_name", "regiao_sigla": "region_code",
                  "regiao_nome": "region_name"}
UNIT_COLUMNS = {"id": "unit_id", "nome": "unit_name", "microrregiao_nome": "micro_region",
                "microrregiao_mesorregiao_nome": "meso_region"}
RECORD_COLUMNS = {"id_aluno": "person_id", "ano": "cycle", "id_municipio": "unit_id", "id_escola": "site_id",
                  "rede": "segment", "serie": "grade", "proficiencia": "score", "proficiencia_portugues": "score",
                  "alfabetizado": "passed", "presenca": "presence", "preenchimento_caderno": "booklet",
                  "peso_aluno": "weight"}
EVENT_COLUMNS = {"id_evento": "event_id", "tipo_evento": "event_type", "ts_evento": "ts_text",
                 "id_municipio": "unit_id", "id_escola": "site_id", "rede": "segment", "serie": "grade",
                 "id_aluno": "person_id", "proficiencia_portugues": "score", "peso_aluno": "weight",
                 "origem": "origin", "_defeito_injetado": "injected_defect"}
PARENT_DIVISOR = 100_000


@dataclass(frozen=True)
class Entity:
    """A raw table: its files in order of preference and its column names."""

    name: str
    files: tuple[tuple[str, str], ...]
    columns: Mapping[str, str]
    min_rows: int = 1


ENTITIES = (
    Entity("unit_indicator", (("br_inep_avaliacao_alfabetizacao_municipio.csv", "csv"),), INDICATOR_COLUMNS),
    Entity("parent_indicator", (("br_inep_avaliacao_alfabetizacao_uf.csv", "csv"),), INDICATOR_COLUMNS),
    Entity("national_targets", (("br_inep_avaliacao_alfabetizacao_meta_alfabetizacao_brasil.csv", "csv"),),
           TARGET_COLUMNS),
    Entity("parent_targets", (("br_inep_avaliacao_alfabetizacao_meta_alfabetizacao_uf.csv", "csv"),), TARGET_COLUMNS),
    Entity("unit_targets", (("br_inep_avaliacao_alfabetizacao_meta_alfabetizacao_municipio.csv", "csv"),),
           TARGET_COLUMNS),
    Entity("records", (("alunos.parquet", "parquet"),), RECORD_COLUMNS),
    Entity("parents", (("ibge_estados.json", "json"), ("ibge_estados.csv", "csv")), PARENT_COLUMNS, 27),
    Entity("units", (("ibge_municipios.json", "json"), ("ibge_municipios.csv", "csv")), UNIT_COLUMNS, 5_500),
)


def in_common_words(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rename what is present; level and target columns keep their numbers."""
    renames = {c: columns[c] for c in df.columns if c in columns}
    renames |= {c: "level_" + c.removeprefix(LEVEL_PREFIX) for c in columns_with_prefix(df, LEVEL_PREFIX)}
    renames |= {c: "target_" + c.removeprefix(TARGET_PREFIX) for c in columns_with_prefix(df, TARGET_PREFIX)}
    return df.withColumnsRenamed(renames)


def with_parent_id(df: DataFrame, parents: DataFrame) -> DataFrame:
    """Parent id for tables that carry the parent's letters."""
    code = F.upper(F.trim("parent_code"))
    known = parents.select(code.alias("parent_code"), "parent_id")
    return df.withColumn("parent_code", code).join(known, "parent_code", "left")
