"""Every operator as a query over the given tables, beside the SQL that states its result."""

from fareflow.checks import models, results, runs, trips

MODULES = (trips, runs, results, models)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
