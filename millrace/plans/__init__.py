"""Registered queries: the operators applied to the given tables, each beside its SQL twin."""

from millrace.plans import governance, memory, relational, retrieval, streams, sync  # noqa: F401
from millrace.plans.registry import REGISTRY, Query  # noqa: F401
