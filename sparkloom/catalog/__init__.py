"""Named queries over the tables, each with the SQL it must agree with where SQL can say it."""

from sparkloom.catalog.registry import ORACLES, QUERIES, load_all

__all__ = ["ORACLES", "QUERIES", "load_all"]
