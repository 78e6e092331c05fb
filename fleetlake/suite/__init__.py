"""Every operator as a query over the test tables, with an independent SQL oracle."""

from . import backlog, documents, events, grid, lake_io, signals_decode, streams, trips

MODULES = (trips, events, grid, lake_io, backlog, signals_decode, documents, streams)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
