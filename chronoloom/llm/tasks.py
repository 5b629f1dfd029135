"""What functions over Arrow batches do at the end of a task."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, whose freed memory goes back to the system at the end of each task.

    Python workers live on for later stages; what the allocators keep would count against the executor all the while.
    """

    def tidied(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return tidied
