"""Name checks, template parameters and repeatable pseudo-random values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters and length bounds of generated text.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
TEXT_LENGTH = (5, 10)

_IDENTIFIER = re.compile(r"[A-Za-z0-9_]+")


def check_identifier(name: str) -> str:
    """Reject table names with anything but letters, digits and underscores."""
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"invalid table name {name!r}: only letters, digits and underscores")
    return name


def is_identifier(name: Column) -> Column:
    """Whether a name would pass :func:`check_identifier`."""
    return name.rlike(rf"\A{_IDENTIFIER.pattern}\z")


def extension(path: str) -> str:
    return path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""


def is_internal(name: Column) -> Column:
    """Names starting with an underscore."""
    return name.startswith("_")


# A value drawn from a hash of the row's identity is the same however rows are partitioned and
# however often a lost task is run again.


def draw(identity: Column, salt: str) -> Column:
    """A whole number in [0, 2**32) fixed by ``identity`` and ``salt``."""
    digest = F.md5(F.concat_ws("|", identity.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def draw_uniform(identity: Column, salt: str, low: float, high: float) -> Column:
    return F.lit(low) + draw(identity, salt) / F.lit(float(2**32)) * F.lit(high - low)


def draw_integer(identity: Column, salt: str, low: int, high: int) -> Column:
    return F.lit(low) + F.pmod(draw(identity, salt), F.lit(high - low + 1))


def draw_choice(identity: Column, salt: str, choices: list) -> Column:
    at = F.pmod(draw(identity, salt), F.lit(len(choices))).cast("int")
    return F.element_at(F.array(*[F.lit(c) for c in choices]), at + 1)


def draw_boolean(identity: Column, salt: str) -> Column:
    return F.pmod(draw(identity, salt), F.lit(2)) == 1


def draw_text(identity: Column, salt: str) -> Column:
    """Lowercase text of 5 to 10 letters."""
    low, high = TEXT_LENGTH
    length = draw_integer(identity, f"{salt}/length", low, high)
    letters = [
        F.substring(F.lit(LETTERS), draw_integer(identity, f"{salt}/{i}", 1, len(LETTERS)).cast("int"), 1)
        for i in range(high)
    ]
    return F.substring(F.concat(*letters), F.lit(1), length.cast("int"))
