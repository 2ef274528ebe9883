"""Tunable weights and thresholds.

The defaults are fixed values: results match the expected ones only with these
numbers.  Every one of them can be overridden per call.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Term:
    """One weighted input of a composite score: ``column * scale * weight``, a published statistic or a rating.

    ``complement`` scores ``1 - column`` instead (used for shares allowed).
    """

    column: str
    weight: float
    scale: float = 1.0
    complement: bool = False


@dataclass(frozen=True)
class RatingConfig:
    offensive: tuple[Term, ...] = (
        Term("PTS", 0.4),
        Term("FG_PCT", 0.3, scale=100.0),
        Term("FG3_PCT", 0.15, scale=100.0),
        Term("AST", 0.15, scale=2.0),
    )
    defensive_base: float = 100.0
    defensive: tuple[Term, ...] = (
        Term("OPP_PTS", -0.4),
        Term("OPP_FG_PCT", 0.4, scale=100.0, complement=True),
        Term("OPP_TOV", 0.2, scale=3.0),
    )
    power: tuple[Term, ...] = (
        Term("W_PCT", 0.25, scale=100.0),
        Term("PLUS_MINUS", 0.2, scale=2.0),
        Term("offensive_rating", 0.3),
        Term("defensive_rating", 0.25),
    )


@dataclass(frozen=True)
class ValueConfig:
    home_advantage: float = 3.0
    power_per_point: float = 10.0
    logistic_scale: float = 10.0
    spread_threshold: float = 3.0
    total_threshold: float = 5.0
    win_probability_threshold: float = 0.55


@dataclass(frozen=True)
class ReportConfig:
    strong_spread: float = 10.0
    strong_total: float = 8.0
    stake: float = 100.0
    histogram_width: float = 2.0
    top_k: int = 10
    value: ValueConfig = field(default_factory=ValueConfig)
