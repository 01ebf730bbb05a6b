"""Registered queries, one module per application domain (importing a module registers its queries)."""

from quarry.plans.queries import (anomaly, classify, cooccurrence, general, graph,  # noqa: F401
                                  linkage, recommend, risk, scoring, text, trips)
