"""Text functions for titles."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelforge.constants import ACCENT_MAP, ALLOWED_CHARS


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def special_chars(column: Column | str) -> Column:
    """What is left of a text after all allowed characters are removed."""
    return F.regexp_replace(_column(column), f"[{ALLOWED_CHARS}]", "")


def special_char_list(column: Column | str) -> Column:
    """The characters outside the allowed class, in order, as an array."""
    return F.regexp_extract_all(_column(column), F.lit(f"([^{ALLOWED_CHARS}])"), F.lit(1))


def fold_accents(column: Column | str, mapping: Mapping[str, str] = ACCENT_MAP) -> Column:
    """Replace each mapped character by its letter, in one pass over the text."""
    keys = "".join(mapping)
    values = "".join(mapping.values())
    return F.translate(_column(column), keys, values)


def code_point(char: Column | str) -> Column:
    """``U+XXXX`` of a one-character text, at least four hex digits."""
    digits = F.hex(F.ascii(_column(char)))
    return F.concat(F.lit("U+"), F.lpad(digits, F.greatest(F.length(digits), F.lit(4)), F.lit("0")))


def is_ascii_letter(char: Column | str) -> Column:
    """Does the text start with an ASCII letter?"""
    return _column(char).rlike("^[a-zA-Z]")


def snake_case(column: Column | str) -> Column:
    return F.replace(F.lower(_column(column)), F.lit(" "), F.lit("_"))


def is_foreign(primary: Column | str, original: Column | str) -> Column:
    """The original title is known and differs from the primary title."""
    primary, original = _column(primary), _column(original)
    return F.coalesce((primary != original) & (original != ""), F.lit(False))


def csv_cells(line: Column | str) -> Column:
    """A CSV line as an array of cells, without those that are empty at its end, but with one at least.

    Quotes around a cell are taken off and doubled ones inside it halved; an empty cell is null. The line is gone through
    once, however many cells it has.
    """
    line = F.col(line) if isinstance(line, str) else line
    found = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'("(?:[^"]++|"")*+"|[^,]*+),'), F.lit(1))
    cells = F.transform(found, lambda cell: F.nullif(F.when(
        cell.startswith('"') & cell.endswith('"') & (F.length(cell) > 1), F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))).otherwise(cell), F.lit("")))

    def without_empty_end(all_cells: Column) -> Column:
        filled = F.array_position(F.reverse(F.transform(all_cells, lambda cell: cell.isNotNull())), True)
        kept = F.when(filled == 0, 1).otherwise(F.size(all_cells) - filled + 1)
        return F.slice(all_cells, F.lit(1), F.greatest(kept, F.lit(1)).cast("int"))

    plain = ~line.contains('"') & ~line.endswith(",") & (line != "")  # most lines: nothing to take off
    return F.when(plain, F.transform(F.split(line, ",", -1), lambda cell: F.nullif(cell, F.lit("")))).otherwise(
        F.transform(F.array(cells), without_empty_end)[0])  # the line is matched once, not once for each use
