"""What a text must hold for a regular expression to be found in it."""

from __future__ import annotations

LEAST = 3
_CLASSES = set("dDwWsSbBAZztnrf")


class Unsure(Exception):
    """The expression has something that isn't looked into."""


def required(pattern: str) -> list[str] | None:
    """Stretches of letters, ASCII ones in lower case, one of which at least every match holds, each of LEAST letters or more; None if there are none for sure.

    Expressions are those of Java: characters, classes, groups, alternatives and quantifiers. With look-around,
    references, flags within, quoted stretches or codes nothing is sure.
    """
    try:
        found, at = _alternatives(pattern, 0)
    except (Unsure, IndexError):
        return None
    return sorted(found) if found and at == len(pattern) else None


def _alternatives(p: str, at: int) -> tuple[set[str] | None, int]:
    out: set[str] | None = set()
    while True:
        found, at = _sequence(p, at)
        out = None if out is None or found is None else out | found
        if at < len(p) and p[at] == "|":
            at += 1
        else:
            return out, at


def _sequence(p: str, at: int) -> tuple[set[str] | None, int]:
    best: set[str] | None = None
    run = ""

    def offer(found: set[str] | None) -> None:
        nonlocal best
        if found and min(map(len, found)) >= LEAST and (best is None or min(map(len, found)) > min(map(len, best))):
            best = found

    while at < len(p) and p[at] not in "|)":
        c, letter, group = p[at], "", None
        at += 1
        if c == "(":
            if p[at] == "?":
                if p[at + 1] != ":":
                    raise Unsure
                at += 2
            group, at = _alternatives(p, at)
            if p[at] != ")":
                raise Unsure
            at += 1
        elif c == "[":
            at += p[at] == "^"
            at += p[at] == "]"
            while p[at] != "]":
                if p[at] == "[" or p[at] == "&":
                    raise Unsure
                at += 2 if p[at] == "\\" else 1
            at += 1
        elif c == "\\":
            c = p[at]
            at += 1
            if not c.isalnum():
                letter = c
            elif c not in _CLASSES:
                raise Unsure
        elif c not in ".^$":
            letter = c
        needed, many, at = _quantifier(p, at)
        if letter and needed:
            run += letter.lower() if letter.isascii() else letter
        if not letter or not needed or many:
            offer({run} if run else None)
            run = ""
            offer(group if needed else None)
    offer({run} if run else None)
    return best, at


def _quantifier(p: str, at: int) -> tuple[bool, bool, int]:
    """Whether what stands before must be there, and whether it may be there more than once."""
    needed, many = True, False
    if at < len(p) and p[at] in "?*+":
        needed, many = p[at] == "+", p[at] != "?"
        at += 1
    elif at < len(p) and p[at] == "{":
        end = p.index("}", at) if "}" in p[at:] else len(p)
        needed, many = p[at + 1 : end].split(",")[0].strip("0") != "", True
        at = end + 1
    else:
        return needed, many, at
    if at < len(p) and p[at] in "?+":  # reluctant or possessive
        at += 1
    return needed, many, at
