"""What a Python worker holds from one task to the next.

Spark gives a worker the tasks of many steps, one after the other. Caches of a step that is over, and freed memory that
the allocators keep for later, would otherwise stay beside what the next step needs.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import TypeVar

import pyarrow as pa

Item = TypeVar("Item")
_caches: list[dict] = []


def cache() -> dict:
    """A dict that lives as long as the worker, or until a step that has no use for it begins."""
    _caches.append({})
    return _caches[-1]


def trim() -> None:
    """Give freed memory back to the system, where the allocators can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def emptied(batches: Iterator[Item]) -> Iterator[Item]:
    """``batches`` of a task, in a worker that has let go of what other steps left there."""
    for held in _caches:
        held.clear()
    trim()
    yield from batches
    trim()
