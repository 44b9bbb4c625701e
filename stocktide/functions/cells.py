"""Reading published text cells: missing markers and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import NULL_TOKENS

# Spark's own cast would also take '1d' and 'nan', so the accepted shapes are spelled out.
_INTEGER = r"^[+-]?[0-9]+\z"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
# White space as Unicode has it, and the four separators among the control characters.
_WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)
# Digits of a count that bigint may hold.
_DIGITS = 19


def present(cell: Column, tokens=NULL_TOKENS) -> Column:
    """The cell, or null when it holds one of the markers for a missing value."""
    return F.when(~cell.isin(*tokens), cell)


def _plain(cell: Column) -> Column:
    """The cell without thousands commas and without white space of any kind at its ends."""
    return F.btrim(F.replace(cell, F.lit(","), F.lit("")), F.lit(_WHITE))


def parse_number(cell: Column) -> Column:
    """Text with optional thousands commas -> double; anything else is null."""
    plain = _plain(cell)
    return F.when(plain.rlike(_NUMBER), plain.try_cast("double"))


def parse_count(cell: Column) -> Column:
    """Text with optional thousands commas -> bigint; text that is no whole number is null.

    Decimal forms such as `12.0`, `1e16` and `1200e-02` are read exactly, digit by digit, with exponents and
    fractions of any length, as far as bigint reaches.

    Cells of nothing but digits and commas, which most are, are cast. All others go through a lambda, which keeps
    the many steps of reading them out of the code that is generated for a row: with them it is too long to be
    compiled.
    """
    bare = F.replace(cell, F.lit(","), F.lit(""))
    other = F.get(F.transform(F.array(cell), _spelled_count), F.lit(0))
    return F.when(bare.rlike(_INTEGER), bare.try_cast("bigint")).when(cell.isNotNull(), other)


def _spelled_count(cell: Column) -> Column:
    plain = _plain(cell)
    part = lambda pattern: F.regexp_extract(plain, pattern, 1)
    fraction = part(r"\.([0-9]*)")
    digits = F.ltrim(F.concat(part(r"^[+-]?([0-9]*)"), fraction), F.lit("0"))
    kept = F.rtrim(digits, F.lit("0"))
    power = part(r"[eE]([+-]?[0-9]+)\z")
    # Zeros behind the digits that are kept; an exponent beyond int's range leaves none that could be read.
    zeros = F.length(digits) - F.length(kept) - F.length(fraction) + F.when(power == "", 0).otherwise(power.try_cast("int"))
    fits = (zeros >= 0) & (F.length(kept) + zeros <= _DIGITS)
    spelled = F.concat(part("^([+-]?)"), kept, F.repeat(F.lit("0"), zeros))
    decimal = F.when(digits == "", F.lit(0)).when(fits, spelled.try_cast("bigint"))
    return F.when(plain.rlike(_INTEGER), plain.try_cast("bigint")).when(plain.rlike(_NUMBER), decimal)


def grouped_digits(count: Column) -> Column:
    """12345 -> '12,345'."""
    return F.format_number(count, 0)
