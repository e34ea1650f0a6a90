"""All queries by name."""

from cairn.plans import acquisition, broker, cubes, derivations, drift, evaluation, evidence, gaps, indicators, lanes, ledger, publication, relate, schemas, search, shapes, snapshot, sources, standards, structures, variants
from cairn.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "broker", "cubes", "derivations", "drift", "evaluation", "evidence", "gaps", "indicators", "lanes", "ledger", "publication", "relate", "schemas", "search", "shapes", "snapshot", "sources", "standards", "structures", "variants"]
