"""gleaner: thread archives and product catalogues as Spark jobs.

Layout: ``sources`` (scans and derived input views), ``functions`` (column
expressions and skew-safe building blocks), ``operators`` (the inventory
(Structured Streaming jobs) and ``plans`` (composed jobs and the registered
queries with their DuckDB oracles).
"""
