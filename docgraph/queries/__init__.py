"""The registered queries: every operator on the test tables, with equivalent SQL where there is one."""

from docgraph.queries import graph, ingest, runs

ALL = {**ingest.QUERIES, **graph.QUERIES, **runs.QUERIES}
