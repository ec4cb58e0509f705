"""Which part of a text becomes the ``contents`` of a document."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NEWLINE = "\n"


def unix_lines(text: Column) -> Column:
    """``\\r\\n`` and lone ``\\r`` read as line ends, like ``\\n``."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit(NEWLINE)), F.lit("\r"), F.lit(NEWLINE))


def whole_content(text: Column) -> Column:
    """Every line followed by one newline; the empty text stays empty."""
    ended = (text == "") | text.endswith(NEWLINE) | text.endswith("\r")
    return F.concat(unix_lines(text), F.when(ended, F.lit("")).otherwise(F.lit(NEWLINE)))


def lines(text: Column) -> Column:
    """Array of the lines, without line ends; the empty text has none."""
    parts = F.split(whole_content(text), NEWLINE)
    # whole_content ends in a newline, so the last piece is always empty.
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def _joined(rows: Column) -> Column:
    return F.when(F.size(rows) == 0, F.lit("")).otherwise(
        F.concat(F.array_join(rows, NEWLINE), F.lit(NEWLINE))
    )


def top_lines(text: Column, n: int) -> Column:
    """The first ``n`` lines."""
    if n <= 0:
        return F.when(text.isNotNull(), F.lit(""))
    body = whole_content(text)
    head = F.substring_index(body, NEWLINE, n)
    return F.when(head == body, body).otherwise(F.concat(head, F.lit(NEWLINE)))


def bottom_lines(text: Column, n: int) -> Column:
    """The last ``n`` lines, last line first."""
    return _joined(F.slice(F.reverse(lines(text)), 1, max(n, 0)))


def top_bottom_lines(text: Column, top: int, bottom: int) -> Column:
    """The first ``top`` lines, then the last ``bottom`` of the rest, last first."""
    top, bottom = max(top, 0), max(bottom, 0)
    rows = lines(text)
    rest = F.slice(rows, F.lit(top + 1), F.size(rows))
    return _joined(F.concat(F.slice(rows, 1, top), F.slice(F.reverse(rest), 1, bottom)))


def select_content(text: Column, top: int = 0, bottom: int = 0) -> Column:
    """Content by setting: 0 and 0 takes the whole text, any other number cuts."""
    if top != 0 and bottom != 0:
        return top_bottom_lines(text, top, bottom)
    if top != 0:
        return top_lines(text, top)
    if bottom != 0:
        return bottom_lines(text, bottom)
    return whole_content(text)
