"""Queries of all operators by name, with their SQL."""

from terraflux.plans import aggregates, filters, joins, pipelines, sources, windows  # noqa: F401
from terraflux.plans.registry import QUERIES, SQL  # noqa: F401
