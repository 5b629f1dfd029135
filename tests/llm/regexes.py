"""Texts that a pattern without unbounded repeats matches."""

from __future__ import annotations

import itertools
from re import _parser


def _node(op, argument, most: int) -> list[str]:
    name = str(op)
    if name == "LITERAL":
        return [chr(argument)]
    if name == "IN":
        return [chr(low) for kind, low in argument if str(kind) == "LITERAL"][:3]
    if name == "ANY":
        return ["z"]
    if name == "SUBPATTERN":
        return _all(argument[3], most)
    if name == "BRANCH":
        return [text for part in argument[1] for text in _all(part, most)]
    if name in ("MAX_REPEAT", "MIN_REPEAT"):
        low, _, part = argument
        once = _all(part, most)
        return ["" if not low else "".join(c) for c in itertools.islice(itertools.product(once, repeat=max(low, 0)), most)] + ([] if low else once)
    raise ValueError(f"no texts for {name}")


def _all(parsed, most: int) -> list[str]:
    out = [""]
    for op, argument in parsed:
        out = [a + b for a, b in itertools.islice(itertools.product(out, _node(op, argument, most)), most)]
    return out


def texts(pattern: str, most: int = 4000) -> list[str]:
    return sorted(set(_all(_parser.parse(pattern), most)))
