"""Raw text to typed columns, as SQL expressions over a column name.

Tolerant parsers turn bad text into null. Strict ones fail the query, whatever
the session's ANSI mode, so a corrupt refund or ticket time never passes unseen.
No parser turns a number that is well formed into null: one beyond 64 bits fails, or is
kept, with up to 38 digits, by the parsers of wide numbers.
"""

from __future__ import annotations

# The words a tolerant boolean accepts, in any letter case.
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")

FULL_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def as_text(name: str) -> str:
    return f"CAST({name} AS STRING)"


def trimmed(name: str) -> str:
    return f"trim({as_text(name)})"


def lowered(name: str) -> str:
    return f"lower({trimmed(name)})"


def blank_as_null(name: str) -> str:
    return f"nullif({trimmed(name)}, '')"


def tolerant_date(name: str) -> str:
    """Year-month-day text only: a bare year or year-month is not a date here."""
    text = trimmed(name)
    return f"CASE WHEN {text} RLIKE r'{FULL_DATE}' THEN try_cast({text} AS DATE) END"


def failure(name: str, kind: str, what: str) -> str:
    """An expression of a type that fails the query, naming the column and its text."""
    return f"CAST(raise_error(concat('{name}: {what}: ', {as_text(name)})) AS {kind})"


def whole(name: str, decimal: str) -> str:
    """A 64-bit number from a decimal; one that does not fit fails."""
    return f"""CASE WHEN {decimal} IS NOT NULL
        THEN coalesce(try_cast({decimal} AS BIGINT), {failure(name, "BIGINT", "beyond 64 bits, stage wide numbers")}) END"""


def strict(name: str, kind: str) -> str:
    """Text of a type; null stays null, other text fails."""
    return f"""CASE WHEN {name} IS NOT NULL
        THEN coalesce(try_cast({name} AS {kind}), {failure(name, kind, "not a " + kind.split("(")[0].lower())}) END"""


def tolerant_integer(name: str) -> str:
    """Nearest whole number, halves away from zero; null if the text is none of up to 38 digits.

    Plain digits take the cheap cast; only other text pays for a decimal.
    """
    text = as_text(name)
    return f"coalesce(try_cast({text} AS BIGINT), {whole(name, f'try_cast({text} AS DECIMAL(38,0))')})"


def tolerant_boolean(name: str) -> str:
    def among(words: tuple[str, ...]) -> str:
        return f"{lowered(name)} IN ({', '.join(repr(word) for word in words)})"

    return f"CASE WHEN {among(TRUE_WORDS)} THEN true WHEN {among(FALSE_WORDS)} THEN false END"


def strict_timestamp(name: str) -> str:
    return strict(name, "TIMESTAMP_NTZ")


def strict_amount(name: str) -> str:
    return strict(name, "DECIMAL(38,2)")


def strict_integer(name: str) -> str:
    return f"coalesce(try_cast({name} AS BIGINT), {whole(name, strict(name, 'DECIMAL(38,0)'))})"


def wide_tolerant_integer(name: str) -> str:
    return f"try_cast({as_text(name)} AS DECIMAL(38,0))"


def wide_strict_integer(name: str) -> str:
    return strict(name, "DECIMAL(38,0)")


# What stands for a parser where numbers are wide.
WIDE = {tolerant_integer: wide_tolerant_integer, strict_integer: wide_strict_integer}
