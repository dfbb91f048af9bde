"""Import every query module so it registers itself; re-export the catalogue."""

from tabflow.plans import (  # noqa: F401  (imported for registration)
    queries_features,
    queries_fitted,
    queries_model,
    queries_monitor,
    queries_scoring,
    queries_stream,
    queries_tables,
)
from tabflow.plans.catalog import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
