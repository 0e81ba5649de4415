"""What a Python worker keeps from task to task, and how it gives memory back.

Spark uses a worker again for other stages, which then run beside what the last one has left: its tables,
and memory that is free but still held by the process. Both count for the executor.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_HELD: dict[Hashable, Any] = {}


def give_back() -> None:
    """Free memory goes to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` returned for this key before. A worker holds one thing at a time: that of another key goes."""
    if key not in _HELD:
        drop_held()
        _HELD[key] = make()
    return _HELD[key]


def drop_held() -> None:
    """For tasks that need nothing of what the worker holds."""
    if _HELD:
        _HELD.clear()
        give_back()
