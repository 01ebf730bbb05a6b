"""The query catalog: importing it registers every query.

Queries live in ``quarry.plans.queries``, one module per application domain;
this module exposes the registry and the few helpers tests use.
"""

from __future__ import annotations

from quarry.plans import queries  # noqa: F401 - registers the queries
from quarry.plans.queries.anomaly import _anomaly_model  # noqa: F401
from quarry.plans.queries.risk import _returns  # noqa: F401
from quarry.plans.queries.text import _svd  # noqa: F401
from quarry.plans.registry import REGISTRY, Query, query, r4  # noqa: F401
