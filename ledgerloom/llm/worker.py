"""What a Python worker keeps from task to task: one thing at a time.

Workers outlive an operator; without this, the tables of one would take up
memory while the next one works.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa

_kept: dict[Hashable, object] = {}


def keep(key: Hashable, make: Callable[[], object]) -> object:
    """The kept thing of this key, made anew if another was kept."""
    if key not in _kept:
        release()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Let go of what is kept, and give memory that is no longer used back to the system."""
    if _kept:
        _kept.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps it for later use
        pass


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task`` with a release before and after it, so that the memory it needed is there for the next operator."""

    @functools.wraps(task)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        try:
            yield from task(batches)
        finally:
            release()

    return tidied
