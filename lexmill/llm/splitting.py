"""Splitting of texts before merges: the matches of a pattern with Unicode classes, fast where a text allows it."""

from __future__ import annotations

import re

import regex


def latin_pattern(pattern: str) -> str | None:
    """``pattern`` with its classes (``\\p{..}``, ``\\s``, ``\\S``) written out for texts of the first 256 characters;
    None if it holds others."""
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern):
        if part[0] == "\\" and (part[1] in "psS"):
            positive = part.replace("S", "s") if part == r"\S" else part
            members = "".join(re.escape(c) for c in map(chr, range(256)) if regex.match(positive, c))
            if inside and part == r"\S":
                return None
            out.append(members if inside else f"[{'^' * (part == chr(92) + 'S')}{members}]")
            continue
        if part[0] == "\\" and part[1].isalnum():
            return None
        inside = (inside or part == "[") and part != "]"
        out.append(part)
    return "".join(out)


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Splitter:
    """All matches of the pattern in a text."""

    def __init__(self, pattern: str) -> None:
        self.general = regex.compile(pattern).findall
        latin = latin_pattern(pattern)
        self.latin = re.compile(latin).findall if latin else self.general

    def __call__(self, text: str) -> list[str]:
        return self.latin(text) if is_latin(text) else self.general(text)
