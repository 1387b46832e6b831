"""Registered queries and their SQL twins; importing the package fills the registry."""

from panelmint.checks import basket_checks, model_checks, panel_checks, universe_checks, walk_checks
from panelmint.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "basket_checks", "model_checks", "panel_checks", "universe_checks", "walk_checks"]
