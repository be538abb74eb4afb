"""All queries of the core and their SQL."""

from __future__ import annotations

from tallyforge.plans import aggregates, audits, evidence, history, incremental, projection, publication, quality, relational, release, resolution, scans, temporal, textual, training, vocabulary

MODULES = [training, relational, aggregates, textual, quality, resolution, scans, incremental, release, vocabulary, audits, temporal, projection, publication, history, evidence]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.oracle_sql().items()}
