"""Registry of the candidate-discovery queries and their SQL."""

from . import delivery, evidence, fingerprints, intake, monitor, providers, records, research, runs, tiers

MODULES = (monitor, intake, research, tiers, providers, records, evidence, delivery, fingerprints, runs)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
