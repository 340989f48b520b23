"""Strings that mark places in a text and can be found again without doubt."""

from __future__ import annotations

import re
from collections.abc import Sequence

#: Bytes that continue a UTF-8 character.
CONTINUING = bytes(range(0x80, 0xC0))


def code_points(data: bytes | bytearray) -> int:
    """Characters of UTF-8 ``data``."""
    return len(data.translate(None, CONTINUING))


def checked_marks(marks: Sequence[str]) -> tuple[bytes, ...]:
    """``marks`` as UTF-8, if none holds another and no end of one begins another.

    A text without such marks shows exactly the marks that are put into it, wherever they stand.
    """
    found = tuple(m.encode() for m in marks)
    for i, a in enumerate(found):
        for k, b in enumerate(found):
            overlap = any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)) + (i != k)))
            if not a or overlap or (i != k and b in a):
                raise ValueError(f"marks must not overlap: {marks}")
    return found


def any_of(marks: Sequence[bytes]) -> re.Pattern[bytes]:
    return re.compile(b"|".join(re.escape(m) for m in marks))
