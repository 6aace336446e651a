"""Thresholds, labels and codes a pipeline is configured with."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    """Everything that differs between two domains using the same plans."""

    segment_labels: Mapping[int, str]
    segment_codes: Mapping[str, int]
    cut: float
    score_range: tuple[float, float]
    unit_range: tuple[int, int]
    score_bands: Sequence[tuple[float, str]]
    top_score_band: str
    risk_bands: Sequence[tuple[float, str]]
    low_risk: str
    target_status: Mapping[str, str]
    trend_names: Mapping[str, str]
    trend_dead_band: float
    final_year: int
    default_final_target: float
    focus_segment: int
    expected_cycle: int
    series_break_points: float
    priority_weights: Mapping[str, float]
    priority_edges: Sequence[float]
    priority_labels: Sequence[str]
    cluster_names: Sequence[str]
    alert_min_records: int
    alert_drop_points: float
    alert_floor: float
    alert_names: Mapping[str, str]
    rejection_reasons: Mapping[str, str]
    dead_letter_limit: float
    reconstruction_limit: float
    crosswalk_tolerance: float
    crosswalk_limit: float

    @property
    def critical(self) -> str:
        return self.risk_bands[0][1]


# Fixed values of the published assessment programme.
EDUCATION = Rules(
    segment_labels={0: "Total", 1: "Federal", 2: "Estadual", 3: "Municipal", 4: "Privada", 5: "Publica"},
    segment_codes={"total": 0, "federal": 1, "estadual": 2, "municipal": 3, "privada": 4,
                   "publica": 5, "pública": 5},
    cut=743.0,
    score_range=(200.0, 1000.0),
    unit_range=(1_000_000, 9_999_999),
    score_bands=((650.0, "Muito baixa"), (700.0, "Baixa"), (743.0, "Abaixo do corte"), (800.0, "Adequada")),
    top_score_band="Avancada",
    risk_bands=((40.0, "Critico"), (55.0, "Alto"), (70.0, "Medio")),
    low_risk="Baixo",
    target_status={"none": "Sem meta definida", "hit": "Meta atingida", "below": "Abaixo da meta"},
    trend_names={"single": "Serie unica", "up": "Melhora", "down": "Piora", "flat": "Estavel"},
    trend_dead_band=1.0,
    final_year=2030,
    default_final_target=80.0,
    focus_segment=3,
    expected_cycle=2024,
    series_break_points=15.0,
    priority_weights={"gap": 0.50, "trajectory": 0.30, "relative": 0.20},
    priority_edges=(0.0, 50.0, 70.0, 85.0, 100.0),
    priority_labels=("Monitoramento", "Média", "Alta", "Crítica"),
    cluster_names=("Vulnerabilidade crítica", "Atenção prioritária", "Em rota de melhoria",
                   "Consolidado", "Referência", "Destaque"),
    alert_min_records=20,
    alert_drop_points=10.0,
    alert_floor=50.0,
    alert_names={"drop": "QUEDA_DE_DESEMPENHO", "below": "ABAIXO_DA_META", "high": "ALTA", "medium": "MEDIA"},
    rejection_reasons={"missing": "campos_obrigatorios_ausentes", "range": "proficiencia_fora_de_faixa",
                       "time": "timestamp_invalido", "unit": "municipio_inexistente"},
    dead_letter_limit=10.0,
    reconstruction_limit=0.5,
    crosswalk_tolerance=0.1,
    crosswalk_limit=1.0,
)
