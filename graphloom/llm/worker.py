"""Tables that a Python worker keeps from task to task (units and their ids,
words and their hashes).  A worker outlives an operator, so the first task of
another operator empties what the one before it left."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

_TABLES: dict[str, Callable[[], None]] = {}


def only(name: str, clear: Callable[[], None]) -> None:
    """From now on this worker keeps the tables of ``name`` alone."""
    for other in [n for n in _TABLES if n != name]:
        _TABLES.pop(other)()
    _TABLES[name] = clear
    _hand_back()


def _hand_back() -> None:
    """Free memory goes back to the machine: workers share an executor's with its JVM."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def none() -> None:
    """At the start of a task that keeps no tables."""
    only("none", lambda: None)
