"""Composed jobs and the named query catalogue."""

from __future__ import annotations


def _load() -> None:
    from . import q_checks, q_edge, q_eval, q_model, q_position, q_profile, q_registry, q_stream  # noqa: F401  (registration side effects)


def all_queries():
    _load()
    from .catalog import QUERIES
    return dict(QUERIES)


def all_oracle_sql():
    _load()
    from .catalog import ORACLE
    return dict(ORACLE)
