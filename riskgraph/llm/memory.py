"""Memory of Python workers between tasks."""

from __future__ import annotations

import ctypes
import functools
import gc

import pyarrow as pa


def give_back() -> None:
    """Return memory that is no longer used to the system; a worker lives on after its task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def as_task(func):
    """A function from batches to batches that gives its memory back when its task ends."""
    @functools.wraps(func)
    def run(batches):
        try:
            yield from func(batches)
        finally:
            give_back()

    return run
