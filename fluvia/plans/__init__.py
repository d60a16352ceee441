"""Registered queries and their SQL."""


def _modules():
    from fluvia.plans import land, maps, more, ranking, tables

    return [maps, tables, more, land, ranking]


def all_queries() -> dict:
    return {k: f for m in _modules() for k, f in m.QUERIES.items()}


def all_sql() -> dict:
    return {k: s for m in _modules() for k, s in m.SQL.items()}
