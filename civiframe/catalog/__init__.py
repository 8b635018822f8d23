"""Every operator as a query over the provided tables, with its SQL equivalent."""

from civiframe.catalog import (  # noqa: F401  (importing registers the queries)
    cleaning,
    correction,
    dimensions,
    expressions,
    facts,
    places,
    sensors,
    storage,
)
from civiframe.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
