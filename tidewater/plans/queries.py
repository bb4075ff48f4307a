"""All registered queries of the event part."""

from __future__ import annotations

from tidewater.plans import catalog, increments

QUERIES = catalog.QUERIES | increments.QUERIES
