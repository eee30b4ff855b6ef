"""A bounded store of values that are made on demand."""

from __future__ import annotations

from collections.abc import Callable


#: Characters of a key that is kept; longer ones are made anew, so that the keys' number bounds the bytes.
LONGEST = 64


class Recent(dict):
    """Values by key. Holds the keys used lately: at most twice ``limit`` and a few more.

    When more than ``limit`` have come in, ``turn`` sets them aside and starts anew; a key set aside
    comes back on its next use, and what has not come back by the next turn goes.
    """

    def __init__(self, limit: int, make: Callable | None = None):
        super().__init__()
        self.limit, self.make, self.aside = limit, make, {}

    def __missing__(self, key):
        value = self.aside.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > self.limit:
            self.aside = dict(self)
            self.clear()
