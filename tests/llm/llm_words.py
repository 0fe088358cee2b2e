"""Words by the plainest reading of the rule."""

from __future__ import annotations

SPACES = " \t\n\v\f\r"


def words(text: str | None) -> list[str]:
    out, word = [], ""
    for c in (text or "") + " ":
        if c not in SPACES:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out
