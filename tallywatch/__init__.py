"""Windowed transaction-risk analytics on PySpark."""

from tallywatch.config import JobConfig, RiskConfig

__all__ = ["JobConfig", "RiskConfig"]
