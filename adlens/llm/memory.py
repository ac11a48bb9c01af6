"""Give memory back between tasks.

Python workers live on from stage to stage, and what their allocators keep for later counts against the executor.
"""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """Return what is free in Arrow's pool and in the C library's heap to the system, where these can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
