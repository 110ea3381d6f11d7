"""Registered queries over the driver's tables, each with its DuckDB oracle SQL."""

from .base import REGISTRY, load_all

__all__ = ["REGISTRY", "load_all"]
