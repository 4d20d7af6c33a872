"""Operators for preparing training text: one module per operator, plus
``queries`` (the registered thin queries) and ``oracle`` (their DuckDB twins).
Nothing outside this package imports it."""
