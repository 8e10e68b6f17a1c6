"""Registered queries and their SQL."""

from massquarry.plans import analysis, evaluation, evidence, flows, preparation, search

_MODULES = (search, evidence, analysis, evaluation, flows, preparation)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE = {k: v for m in _MODULES for k, v in m.ORACLE.items()}
