"""Catalogue of runnable reports over the test tables, each with its SQL twin where SQL can say it."""

from plumbline.catalogue import clustering, deeper, exact, learning, preparing, profiling, rules

_PARTS = (profiling, preparing, learning, clustering, rules, exact, deeper)


def all_reports() -> dict:
    return {name: fn for part in _PARTS for name, fn in part.REPORTS.items()}


def all_sql() -> dict:
    return {name: text for part in _PARTS for name, text in part.SQL.items()}
