"""What a Python worker keeps from one task to the next: the things of one operator at a time.

Workers are used again by later tasks and stages.  An operator that asks for
what it keeps (a vocabulary, word hashes) makes the worker let go of what
another operator had left there, so that a chain of operators takes no more
memory than the largest of them.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa

_kept: dict[tuple, Any] = {}


def give_back() -> None:
    """Free memory goes back to the machine: Python's, Arrow's and, where the C library can do that, its own."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def held(owner: tuple, make: Callable[[], Any]) -> Any:
    """What `owner` keeps in this process; made where it isn't there.  Other owners' things are dropped."""
    if owner not in _kept:
        if _kept:
            _kept.clear()
            give_back()
        _kept[owner] = make()
    return _kept[owner]
