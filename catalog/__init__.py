"""Every operator as a named query over the given tables, beside its SQL twin."""

from catalog import (  # noqa: F401
    bars, books, flows, forecasts, indicators, ingest, jobs, monitoring, rankings, serving, upkeep,
)
from catalog import cuts  # noqa: F401
from catalog.base import QUERIES, SQL  # noqa: F401
