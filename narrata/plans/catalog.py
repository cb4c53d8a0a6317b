"""Every query of the library by name, with the SQL that gives the same rows."""

from __future__ import annotations

from narrata.plans import links, reports, services, streams, texts

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _module in (texts, links, reports, services, streams):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
