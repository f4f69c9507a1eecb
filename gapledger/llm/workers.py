"""What a Python worker may keep between tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import pyarrow as pa


def worker_memo(key: Any, make: Callable[[], Any]) -> Any:
    """``make()``, kept for later tasks of the same worker process.

    The functions of this package reach a worker by value, so their own globals last
    for one task only; an entry among the loaded modules lasts as long as the process.
    """
    memo = sys.modules.setdefault("_gapledger_worker_memo", ModuleType("_gapledger_worker_memo"))
    kept = memo.__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


class BoundedMemo(dict):
    """Values by key, made on first use; ``turn`` forgets what was not asked for since the last but one.

    Subclasses give ``make``.
    """

    def __init__(self, limit: int) -> None:
        super().__init__()
        self.limit = limit
        self.before: dict = {}

    def turn(self) -> None:
        if len(self) > self.limit:
            self.before = dict(self)
            self.clear()

    def make(self, key: Any) -> Any:
        raise NotImplementedError

    def __missing__(self, key: Any) -> Any:
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def slices(texts: pa.Array, characters: int) -> Iterator[list[str]]:
    """The texts (null: empty) in runs of about so many characters, or one longer text."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text.as_py() or "")
        size += len(part[-1])
        if size > characters:
            yield part
            part, size = [], 0
    if part:
        yield part
