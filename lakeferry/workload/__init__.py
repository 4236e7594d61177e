"""Registered queries: every operator over the given tables, with the SQL it must equal."""

from lakeferry.workload import config, incremental, lake, plan

MODULES = (lake, plan, config, incremental)


def all_queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles():
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
