"""One named query per operator, with the SQL that gives the same rows."""

from tallymark.queries import expressions, grades, samples
from tallymark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "expressions", "grades", "samples"]
