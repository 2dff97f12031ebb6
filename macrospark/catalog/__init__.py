"""Named queries over the given tables, each with the SQL that must give the same rows."""

from macrospark.catalog import (  # noqa: F401
    features,
    ingest,
    pipelines,
    quality,
    scalars,
    storage,
    streams,
    versions,
)
from macrospark.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
