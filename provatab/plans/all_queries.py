"""Loads every query module, so that the registry is complete."""

from provatab.plans import (  # noqa: F401
    q_columns,
    q_compare,
    q_contract,
    q_evidence,
    q_measure,
    q_publish,
    q_repair,
    q_resolve,
    q_selection,
    q_series,
    q_sources,
    q_tables,
)
from provatab.plans.registry import ORACLE, QUERIES  # noqa: F401
