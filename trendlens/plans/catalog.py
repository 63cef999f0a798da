"""Imports every query module so that the registry is complete."""

from trendlens.plans import queries_copies, queries_models, queries_reports, queries_series, queries_text  # noqa: F401
from trendlens.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
