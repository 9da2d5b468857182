"""Queries over the driver tables, each with the SQL that states what it must return.

Inputs that the tables do not hold (HTML tables, JSON payloads, share texts) are derived from
whole tables by row-wise concatenation, so their volume grows with the tables.
"""

from __future__ import annotations

from dossierkit.catalog import documents, extraction, profiles, resolution, values

_PARTS = (resolution, values, extraction, documents, profiles)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
