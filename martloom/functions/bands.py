"""Bands: an ordered list of thresholds, each with a label.

The caller decides whether the banded value is rounded first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.columns import as_col

Bands = list[tuple[float, str]]

# Thresholds and labels of the marts.
ALIGNMENT_BANDS = [(80, "Alto"), (60, "Médio")]
ALIGNMENT_OTHERWISE = "Baixo"
COHESION_BANDS = [(80, "Muito Coesa"), (60, "Coesa")]
COHESION_OTHERWISE = "Fragmentada"
DIVERSITY_BANDS = [(0.15, "Alta diversidade"), (0.25, "Média diversidade")]
DIVERSITY_OTHERWISE = "Baixa diversidade"
OUTLIER_BANDS = [
    (1, "Comportamento esperado"),
    (2, "Leve desvio"),
    (3, "Atenção"),
    (4, "Possível anomalia"),
]
OUTLIER_OTHERWISE = "Muito atípico"
YES, NO = "Sim", "Não"


def _first_match(tests: list[tuple[Column, str]], otherwise: Column) -> Column:
    return F.coalesce(*[F.when(test, F.lit(label)) for test, label in tests], otherwise)


def band_at_least(c: str | Column, bands: Bands, otherwise: str) -> Column:
    """First band whose threshold the value reaches; NULL falls to ``otherwise``."""
    v = as_col(c)
    return _first_match([(v >= edge, label) for edge, label in bands], F.lit(otherwise))


def band_at_most(c: str | Column, bands: Bands, otherwise: str) -> Column:
    """First band whose threshold the value does not exceed; NULL falls to ``otherwise``."""
    v = as_col(c)
    return _first_match([(v <= edge, label) for edge, label in bands], F.lit(otherwise))


def band_below(c: str | Column, bands: Bands, otherwise: str) -> Column:
    """First band whose threshold the value stays below; NULL stays NULL."""
    v = as_col(c)
    last = F.when(v.isNotNull(), F.lit(otherwise))
    return _first_match([(v < edge, label) for edge, label in bands], last)


def yes_no(test: Column, yes: str = YES, no: str = NO) -> Column:
    """``yes`` when the test holds, ``no`` when it fails or is NULL."""
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))
