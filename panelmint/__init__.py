"""Risk, selection and walk-forward analytics on price panels, built on Spark DataFrames."""

from panelmint.config import Schedule, Settings

__all__ = ["Schedule", "Settings"]
