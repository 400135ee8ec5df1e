"""All registered queries."""

from canteiro.queries import (  # noqa: F401  (imported to register)
    consolidation,
    enrichment,
    keys,
    parsing,
    reports,
    source_records,
    supplier_views,
)
from canteiro.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
