"""Cutting texts where a tokenizer's own split is certain to cut, and remembering what the pieces give."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

#: A chunk is white space followed by what is not. A non-space character before white space always ends a
#: match of the GPT-2 style patterns (no alternative runs from a non-space into a space), so chunks can be
#: tokenised apart.
CHUNK = re.compile(r"\s*\S+|\s+")
_CUT = re.compile(r"(?<=\S)(?=\s)")
#: Characters that are taken at once; longer texts are cut at a chunk's end.
STRETCH = 1 << 20


def stretches(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > STRETCH:
        cut = _CUT.search(text, at + STRETCH)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Memo(dict):
    """chunk -> value; unknown chunks are worked out together by `many`. Holds a bounded number of chunks."""

    def __init__(self, many: Callable[[list[str]], list], most: int = 120_000, longest: int = 64):
        super().__init__()
        self.many, self.most, self.longest = many, most, longest

    def of(self, text: str) -> Iterator[list]:
        """The values of all chunks of `text`, a stretch at a time."""
        for part in stretches(text):
            chunks = CHUNK.findall(part)
            try:
                yield list(map(self.__getitem__, chunks))
                continue
            except KeyError:
                pass
            fresh = list({c for c in chunks if c not in self})
            known = dict(zip(fresh, self.many(fresh)))
            yield [known[c] if c in known else self[c] for c in chunks]
            if len(self) + len(known) > self.most:
                self.clear()
            self.update((c, v) for c, v in known.items() if len(c) <= self.longest)
