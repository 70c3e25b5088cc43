"""One large object per Python worker: workers outlive tasks, so what a task leaves behind adds up."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

T = TypeVar("T")
_held: dict[Hashable, object] = {}


def held(setup: Hashable, build: Callable[[Hashable], T]) -> T:
    """The object built from ``setup``, kept for later tasks until another one is asked for."""
    if setup not in _held:
        _held.clear()
        _held[setup] = build(setup)
    return _held[setup]


def release() -> None:
    """Forget what earlier tasks left behind. Called by tasks that hold much themselves and use no held object."""
    _held.clear()
