"""Registered queries with their SQL twins, by theme."""

from odolake.queries import cost, fuel, inout, learning, pages, places, points, rows

MODULES = (points, rows, pages, fuel, cost, places, learning, inout)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
