"""What Python workers hold between tasks.

Workers outlive their tasks, and some operators keep a memory in them on purpose. In a session that
runs several operators one after the other, these memories and what the allocators keep of freed
blocks would add up.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_forget: list[Callable[[], None]] = []
_last: str | None = None


def forgets(clear: Callable[[], None]) -> None:
    """Register how to empty a memory that outlives tasks."""
    _forget.append(clear)


def trim(collect: bool = True) -> None:
    """Give freed memory back to the system, that of circular garbage as well if asked."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def enter(operator: str) -> None:
    """First call of a task: after another operator's task, its memories are emptied."""
    global _last
    if _last not in (None, operator):
        for clear in _forget:
            clear()
        trim()
    _last = operator
