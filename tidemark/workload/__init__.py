"""Registered queries and, where SQL can say the same, their oracles."""

from tidemark.workload.registry import ORACLES, QUERIES
from tidemark.workload import (  # noqa: F401  (importing a module registers its queries)
    contracts, damage, documents, finance, governance, ingest, itsm, security, serving,
)

__all__ = ["ORACLES", "QUERIES"]
