"""What a Python worker keeps between tasks."""

import gc
from collections.abc import Callable

import pyarrow as pa

_KEPT: dict = {}


def kept(name, make: Callable[[], object]):
    """The object of this name, made once in a Python worker.

    A worker serves one operator after another: asking for another name gives up what was kept before, so that caches of
    different operators are never held together.
    """
    if name not in _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _KEPT[name] = make()
    return _KEPT[name]
