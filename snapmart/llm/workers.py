"""Memory of Python workers, which Spark keeps from one task to the next.

A worker that has run one operator's tasks runs the next one's, so what the
first remembers, and what its allocators hold back for later use, would count
beside the second's own needs.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa

_memories: list[Callable[[], None]] = []


def remembered(forget: Callable[[], None]) -> None:
    """Name what empties a memory that outlives tasks."""
    if forget not in _memories:
        _memories.append(forget)


def give_back() -> None:
    """Freed memory goes from the allocators to the system, as far as they can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def _lean(batches: Iterator[pa.RecordBatch], work: Callable) -> Iterator[pa.RecordBatch]:
    for forget in _memories:
        forget()
    try:
        yield from work(batches)
    finally:
        give_back()


def lean(work: Callable) -> Callable:
    """``work`` for ``mapInArrow``, begun without what other operators remember
    in the worker and ended without memory held back."""
    return partial(_lean, work=work)
