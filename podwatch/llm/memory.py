"""Memory that a Python worker gives back at the end of a task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    """``malloc_trim`` of the C library, None where it has none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None


def release() -> None:
    """Gives freed memory that Arrow and the C library keep back to the system."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim is not None:
        trim(0)


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for mapInArrow, with a release at its end: workers outlive tasks, and wait or turn to other work with all that they keep."""

    @wraps(run)
    def whole(batches: Batches) -> Batches:
        yield from run(batches)
        release()

    return whole
