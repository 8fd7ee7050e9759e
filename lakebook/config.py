"""Fixed values of the highway product, and the settings that group them."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# --- fixed values: results depend on these exact numbers and labels -----------------

# Radar positions on the road, in km.
SENSOR_KM = tuple(
    Decimal(km)
    for km in (
        "525.900", "527.200", "529.100", "530.300", "531.220",
        "531.800", "534.000", "534.250", "535.170", "535.900",
        "537.500", "538.200", "539.000", "540.500", "543.200",
    )
)

# The product covers one state.
STATE = "MG"

# Hourly volume classes: (first value of the class, label); each class ends where
# the next begins, the last one is open.
VOLUME_CLASSES = (
    (1, "FLUXO_BAIXO"),
    (109, "FLUXO_MEDIO"),
    (217, "FLUXO_ALTO"),
)

# Speed labels come cut to ten characters, so three end in a space.
SPEED_CLASSES = {
    "<= 20 KM/h": "VELOCIDADE_BAIXA",
    "21 - 50 KM": "VELOCIDADE_BAIXA",
    "51 - 80 KM": "VELOCIDADE_BAIXA",
    "81 - 100 K": "VELOCIDADE_MEDIA",
    "101 - 120 ": "VELOCIDADE_MEDIA",
    "121 - 140 ": "VELOCIDADE_ALTA",
    "141 - 160 ": "VELOCIDADE_ALTA",
    "> 160 KM/h": "VELOCIDADE_ALTA",
}

VEHICLE_CLASSES = {
    "Comercial": "VEICULO_COMERCIAL",
    "Passeio": "VEICULO_PASSEIO",
    "Moto": "VEICULO_MOTO",
    "Ônibus": "VEICULO_ONIBUS",
}

# Look-back windows of the book, in months.
LOOKBACK_MONTHS = (1, 3, 6, 9, 12)

# How many months before the run month the stage reaches back.
HISTORY_MONTHS = 12

# Subjects, and the audit names of their tables.
FLOW_SUBJECT = "fluxo"
ACCIDENTS_SUBJECT = "acidentes"
TB_RAW = {FLOW_SUBJECT: "tb_raw_fluxo", ACCIDENTS_SUBJECT: "tb_raw_acidentes"}
TB_TRUSTED_FLOW = "tb_trusted_fluxo"
TB_TRUSTED_ACCIDENTS = "tb_trusted_acidentes"
TB_STAGE = "tb_refined_stage"
TB_BOOK = "tb_refined_book"

# Folders of the lake, under its root: names of this package.
RAW_FOLDER = "raw"
TRUSTED_FOLDER = "trusted"
STAGE_FOLDER = "refined/stage"
BOOK_FOLDER = "refined/book"
CONTROL_FOLDER = "audit"

# --- settings ------------------------------------------------------------------------


@dataclass(frozen=True)
class ProductConfig:
    """Everything a stage and a book depend on besides their inputs."""

    sensors: tuple[Decimal, ...] = SENSOR_KM
    state: str = STATE
    volume_classes: tuple[tuple[int, str], ...] = VOLUME_CLASSES
    speed_classes: dict[str, str] = field(default_factory=lambda: dict(SPEED_CLASSES))
    vehicle_classes: dict[str, str] = field(default_factory=lambda: dict(VEHICLE_CLASSES))
    lookback_months: tuple[int, ...] = LOOKBACK_MONTHS
