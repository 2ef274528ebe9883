"""Odds and team-performance analytics expressed as Spark DataFrame operators."""

from courtline.config import RatingConfig, ReportConfig, ValueConfig
from courtline.session import build_session

__all__ = ["RatingConfig", "ReportConfig", "ValueConfig", "build_session"]
