"""Texts of a slice as arrays of code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)


SEGMENT_CHARS = 1 << 20


def segments(texts: list[str | None], before: int, behind: int, limit: int = 0
             ) -> Iterator[tuple[np.ndarray, list[str]]]:
    """The lower-cased texts in groups of about ``limit`` characters, as (text numbers, segments).

    A long text is cut in several segments.  Each segment has the ``before`` characters in
    front of it and the ``behind`` characters after it, NUL where the text has none."""
    limit = limit or SEGMENT_CHARS
    numbers: list[int] = []
    found: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        text = "\0" * before + (text or "").lower() + "\0" * behind
        for at in range(0, max(1, len(text) - before - behind), limit):
            numbers.append(i)
            found.append(text[at:at + before + limit + behind])
            held += len(found[-1])
            if held >= limit:
                yield np.array(numbers), found
                numbers, found, held = [], [], 0
    if numbers:
        yield np.array(numbers), found


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts one after another, lengths)."""
    return (np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4"),
            np.array([len(t) for t in texts], np.int64))


def mixed(a: np.ndarray) -> np.ndarray:
    """A 64-bit mix of unsigned integers (Stafford's variant of the murmur finalizer)."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))
