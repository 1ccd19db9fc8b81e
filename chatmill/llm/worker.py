"""What a Python worker keeps between tasks."""

from __future__ import annotations

import gc
from collections.abc import Callable

_held: dict = {}
_owner: list[str] = []


def kept(owner: str, key, make: Callable):
    """The value of `key`, made when first asked for.

    Spark uses a worker for one operator after another: when another `owner` asks, what the last one kept is dropped, so that
    a worker holds the tables of one operator only.
    """
    if _owner != [owner]:
        _held.clear()
        _owner[:] = [owner]
    if key not in _held:
        _held[key] = make()
        gc.freeze()  # large tables that stay: the garbage collector need not look through them again and again
    return _held[key]
