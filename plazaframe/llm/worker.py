"""Memory of Python workers, which Spark reuses from stage to stage."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa

from plazaframe.llm.word_ids import word_encoder


def give_back() -> None:
    """Return what is free to the system; a worker would otherwise stay as large as its largest batch made it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    library = ctypes.CDLL(None)
    if hasattr(library, "malloc_trim"):  # not every C library has it
        library.malloc_trim(0)


def forget_words() -> None:
    """Drop the words that tasks of a tokenizing stage remembered in this worker."""
    word_encoder.cache_clear()
    give_back()
