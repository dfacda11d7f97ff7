"""A bounded per-process memory of what a function gave for a word."""

from __future__ import annotations

from collections.abc import Callable, Iterable


class WordCache:
    """Words to byte strings.  ``fill`` gets the list of unknown words and gives their values in order.

    At most ``most`` words are held between calls; beyond that all but the
    words of the call are forgotten, which costs time only.
    """

    def __init__(self, fill: Callable[[list[str]], Iterable[bytes]], most: int = 600_000) -> None:
        self.fill, self.most, self.known = fill, most, {}

    def add(self, words: set[str]) -> dict[str, bytes]:
        """The memory, with all of ``words`` in it."""
        missing = list(words - self.known.keys())
        if missing:
            if len(self.known) + len(missing) > self.most:
                self.known = {w: self.known[w] for w in words if w in self.known}
            self.known.update(zip(missing, self.fill(missing)))
        return self.known
