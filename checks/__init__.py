"""Queries over the given tables with an independent SQL text for each."""

from checks.registry import CASES
from checks import cases_marts, cases_surge, cases_metrics  # noqa: F401
