"""Scalar text, number and date functions as built-in
column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P
from .rules import col


def remove_text(c, text: str = " ") -> Column:
    """Literal (non-regex) removal, pandas ``str.replace(text, '')``."""
    return F.replace(col(c), F.lit(text), F.lit(""))


def first_chars(c, n: int = 1) -> Column:
    return F.substring(col(c), 1, n)


def words(c) -> Column:
    """pandas ``str.split()``: split on runs of white space, no empty words."""
    return F.split(F.trim(F.regexp_replace(col(c), r"\s+", " ")), " ")


def first_word(c) -> Column:
    return F.element_at(words(c), 1)


def last_word(c) -> Column:
    return F.element_at(words(c), -1)


def first_words(c, n: int = 3) -> Column:
    return F.array_join(F.slice(words(c), 1, n), " ")


def supplier_in_parens(c) -> Column:
    """Text between the last parentheses at the end: 'Vendor 3 (H00003)' -> 'H00003'."""
    return F.nullif(F.regexp_extract(col(c), P.SUPPLIER_IN_PARENS, 1), F.lit(""))


def as_number(c) -> Column:
    """Number of a plain number text, else null: a cast alone also reads '12D' and '5f'."""
    text = col(c)
    return F.when(text.rlike(r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"), text.try_cast("double"))


def number_in_text(c, pattern: str = P.NUMBER_PATTERN) -> Column:
    """First number in a text (``str.extract`` + ``to_numeric(errors='coerce')``)."""
    return as_number(F.regexp_extract(col(c), pattern, 1))


def currency_to_number(c) -> Column:
    """Strip ``$`` and thousands commas, then to number; bad text -> null."""
    return as_number(F.regexp_replace(col(c), r"[$,]", ""))


def item_codes(c, pattern: str = P.ITEM_CODE_PATTERN) -> Column:
    """All item codes in a text as an array (``re.findall``)."""
    return F.regexp_extract_all(col(c), F.lit(pattern), 0)


def upc_word(c) -> Column:
    """First word that starts with '4' and is longer than 10 characters."""
    picked = F.filter(words(c), lambda w: w.startswith("4") & (F.length(w) > 10))
    return F.try_element_at(picked, F.lit(1))


def collapse_blanks(c) -> Column:
    return F.regexp_replace(col(c), r"\s+", " ")


def break_before(c, marker: str = "CTN") -> Column:
    return F.replace(col(c), F.lit(marker), F.lit("\n" + marker))


def text_before(c, marker_pattern: str = P.MAIL_MARKER) -> Column:
    """Collapse white space, then keep the text before the first marker."""
    return F.element_at(F.split(collapse_blanks(c), marker_pattern), 1)


def photo_link(c, base: str = P.PHOTO_BASE) -> Column:
    """'<base>/<1st letter>/<2nd letter>/<code>.jpg' of the lower-cased code."""
    low = F.lower(col(c))
    return F.concat_ws("/", F.lit(base), F.substring(low, 1, 1), F.substring(low, 2, 1),
                       F.concat(low, F.lit(".jpg")))


def map_codes(c, pairs) -> Column:
    """Code map; unmapped values become null (pandas ``Series.map``)."""
    expr = None
    for k, v in pairs:
        expr = (F.when(col(c) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col(c) == F.lit(k), F.lit(v)))
    return expr


def replace_values(c, pairs) -> Column:
    """Value replacement map; unmapped values are kept (``Series.replace``)."""
    out = None
    for k, v in pairs:
        out = F.when(col(c) == F.lit(k), F.lit(v)) if out is None else out.when(col(c) == F.lit(k), F.lit(v))
    return col(c) if out is None else out.otherwise(col(c))


def first_match(cols, pattern: str = P.UPC_PATTERN) -> Column:
    """First column (in order) whose text matches; the matched group."""
    return F.coalesce(*[F.nullif(F.regexp_extract(col(c), pattern, 1), F.lit("")) for c in cols])


def longest(cols) -> Column:
    """Longest of several texts; the first one wins ties (python ``max(key=len)``)."""
    cols = [col(c) for c in cols]
    best = cols[0]
    for c in cols[1:]:
        best = F.when(F.length(c) > F.length(best), c).otherwise(best)
    return best


def month_end(as_of: _dt.date, lead_days: int = 0) -> Column:
    """Last day of the month of ``as_of + lead_days``."""
    return F.last_day(F.date_add(F.lit(as_of), lead_days))


def days_before(as_of: _dt.date, days: int) -> Column:
    return F.date_sub(F.lit(as_of), days)


def customer_from_path(c) -> Column:
    """Customer id = name of the folder holding the file."""
    return F.element_at(F.split(col(c), "/"), -2)
