"""All registered queries: importing a module registers its queries."""

from plumbline.workload import (  # noqa: F401
    amendments,
    chamber,
    contracts,
    deputy_expenses,
    expressions,
    grants,
    landing,
    relational,
    senate,
    tenders,
)
from plumbline.workload.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
