"""String and number text, with the whitespace rules of Python's ``str``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Unicode white space plus the four separators U+001C..U+001F.
SPACE = r"[\s\x1c-\x1f]"


def strip(column: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(column, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def clean_text(column: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(column, rf"(?U){SPACE}+", " "))


def as_text(column: Column) -> Column:
    """Text of a value; a missing one reads ``None``."""
    return F.coalesce(column.cast("string"), F.lit("None"))


def without_commas(column: Column) -> Column:
    return F.replace(column, F.lit(","), F.lit(""))


#: What Python's float reads, in plain digits: no type letters, hexadecimals or digit groups by underscore.
_NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$"
_NAN = r"(?i)^[+-]?nan$"
_INFINITE = r"(?i)^([+-]?)inf(inity)?$"


def amount(column: Column, on_error: str = "raise") -> Column:
    """``1,234.5`` as a double; text that is no number raises, or is null with ``on_error="null"``.

    ``nan`` is a missing value and becomes null.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be raise or null")
    plain = strip(without_commas(column))
    number = F.when(plain.rlike(_NUMBER), plain.try_cast("double")).when(
        plain.rlike(_INFINITE), F.when(plain.startswith("-"), float("-inf")).otherwise(float("inf"))
    )
    if on_error == "null":
        return number
    message = F.concat(F.lit("could not convert to a number: "), column)
    return F.when(number.isNotNull() | plain.rlike(_NAN), number).otherwise(
        F.when(column.isNotNull(), F.raise_error(message).cast("double"))
    )


def part_after(column: Column, marker: str) -> Column:
    """The stripped text between the first and the second marker; empty without a marker."""
    parts = F.split(column, rf"\Q{marker}\E")
    return F.when(column.contains(marker), strip(F.get(parts, F.lit(1)))).otherwise(
        F.when(column.isNotNull(), F.lit(""))
    )


def resolve(base: str, href: Column) -> Column:
    """Site address in front of a relative link."""
    return F.concat(F.lit(base), href)


def fill_template(template: str, **fields: Column) -> Column:
    """``{name}`` slots of a URL or prompt template filled with columns."""
    pieces, rest = [], template
    while True:
        at = min((rest.find("{%s}" % f) for f in fields if "{%s}" % f in rest), default=-1)
        if at < 0:
            break
        name = rest[at + 1:rest.index("}", at)]
        pieces += [F.lit(rest[:at]), fields[name]]
        rest = rest[at + len(name) + 2:]
    return F.concat(*pieces, F.lit(rest))
