"""A memory of bounded size for what tasks compute again and again."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

# About what an entry takes beside the bytes of its key and value.
ENTRY_BYTES = 180


class Recent(dict):
    """Values made on demand, in two generations of about `room` bytes each.

    A full generation becomes the older one; what is asked for moves back from it,
    so only what was not asked for during a whole generation is forgotten.
    """

    def __init__(self, make: Callable[[Any], Any], room: int = 48 << 20) -> None:
        super().__init__()
        self._make = make
        self._room = room
        self._held = 0
        self._older: dict = {}

    def __missing__(self, key: Hashable) -> Any:
        value = self._older.pop(key, None)
        if value is None:
            value = self._make(key)
        if self._held >= self._room:
            self._older = dict(self)
            self.clear()
            self._held = 0
        self[key] = value
        self._held += ENTRY_BYTES + _size(key) + _size(value)
        return value


def _size(value: Any) -> int:
    return len(value) if isinstance(value, bytes | str) else 0
