"""Freed memory of Python workers, which stay beside the executor's JVM after their stage, goes back to the system."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidy(func: Callable) -> Callable:
    """func, a generator over batches, with give_back at the end of each task."""

    def go(*args, **options):
        try:
            yield from func(*args, **options)
        finally:
            give_back()

    return go
