"""Where tokenizer files are, asked in the process that opens them."""

from __future__ import annotations

import os
from collections.abc import Callable, Hashable
from typing import Any


def located(name: str) -> str:
    """``name`` if it is a path, else the place of the public tokenizer file of that name."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letters a byte-level vocabulary writes its bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def halved(store: dict) -> None:
    """Drop the older half of what a store holds."""
    for key in list(store)[: len(store) // 2]:
        del store[key]


_STORES: dict[Hashable, Any] = {}


def let_go(but: Hashable = None) -> None:
    """Free the stores that tasks of other kinds have left in this worker process."""
    for key in [k for k in _STORES if k != but]:
        del _STORES[key]


def worker_store(key: Hashable, make: Callable[[], Any]) -> Any:
    """What tasks of one kind keep for the next of their kind in the same worker process; only
    one kind's is kept at a time."""
    let_go(but=key)
    if key not in _STORES:
        _STORES[key] = make()
    return _STORES[key]
