"""What Python workers hold between tasks.

Spark hands a worker on from task to task and stage to stage, and keeps an idle one for a while. What an
operator leaves there adds to whatever the executor does next, even where that runs no Python at all.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa

#: Bytes of input after which a worker hands free memory back.
GIVE_BACK_BYTES = 4 << 20

Batches = Iterator[pa.RecordBatch]

#: The caches that the tasks of this worker may have filled.
_filled: set[Any] = set()


def begin(caches: tuple[Any, ...]) -> None:
    """Empty all caches of earlier tasks but ``caches``, those of the task that begins."""
    for other in _filled - set(caches):
        other.cache_clear()
    _filled.clear()
    _filled.update(caches)


def give_back() -> None:
    """Hand memory that is free to the system; allocators would keep it for this worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library has it
    if trim:
        trim(0)


def _watched(batches: Batches) -> Batches:
    size = 0
    for batch in batches:
        size += batch.nbytes
        yield batch
        if size >= GIVE_BACK_BYTES:
            give_back()
            size = 0


def frugal(run: Callable[[Batches], Batches], *caches: Any) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, with free memory handed back on the way and behind the last batch.

    ``caches`` are the functions with ``cache_clear`` whose results stay for later tasks of the same operator; a task
    of another one drops them.
    """
    def frugal_run(batches: Batches) -> Batches:
        begin(caches)
        try:
            yield from run(_watched(batches))
        finally:
            give_back()

    return frugal_run
