"""Splitting of texts by a tokenizer's pattern, with a quick path for code points below 256."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

_CLASSES = (r"\p{L}", r"\p{N}", r"\s")


def below_256(pattern: str) -> re.Pattern[str]:
    """``pattern`` with its Unicode classes written out for code points below 256."""
    members = {
        name: "".join(
            re.escape(chr(c)) for c in range(256) if regex.match(f"[{name}]", chr(c))
        )
        for name in _CLASSES
    }
    out, in_class, i = [], False, 0
    while i < len(pattern):
        name = next((c for c in _CLASSES if pattern.startswith(c, i)), None)
        if name:
            out.append(members[name] if in_class else f"[{members[name]}]")
            i += len(name)
            continue
        char = pattern[i : i + 2] if pattern[i] == "\\" else pattern[i]
        if char == r"\S":
            char = rf"[^{members[r'\s']}]"
        in_class = (in_class or char == "[") and char != "]"
        out.append(char)
        i += 2 if pattern[i] == "\\" else 1
    return re.compile("".join(out))


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` in a text, in order."""
    wide, narrow = regex.compile(pattern).findall, below_256(pattern).findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return wide(text)
        return narrow(text)

    return split
