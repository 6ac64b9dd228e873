"""The queries by name, with the SQL that checks them."""

from __future__ import annotations

from . import contacts, dossiers, feeds, files, insights, listings, policies, profiles, records, runs, streams

MODULES = (contacts, dossiers, profiles, records, runs, streams, feeds, listings, insights, files, policies)
FLAGSHIP = "url_registered_domain"


def queries():
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql():
    return {k: s for m in MODULES for k, s in m.ORACLES.items()}
