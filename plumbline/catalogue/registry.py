"""Decorator that files a report, and its SQL twin if it has one, under the function's name."""


def make_registry():
    reports: dict = {}
    sql: dict = {}

    def report(text: str | None = None):
        def register(fn):
            reports[fn.__name__] = fn
            if text is not None:
                sql[fn.__name__] = text
            return fn
        return register

    return reports, sql, report
