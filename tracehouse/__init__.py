"""Spark toolkit for a warehouse of instrument runs and their signal traces."""

from tracehouse.plans.pipeline import build_warehouse
from tracehouse.plans.serve import get_data

__all__ = ["build_warehouse", "get_data"]
