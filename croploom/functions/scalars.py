"""Small column expressions: text, codes, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable so that ``body`` may use it many times at the cost of one."""
    return F.element_at(F.transform(F.array(value), body), 1)


def trailing_zeros(code: Column) -> Column:
    """Number of zeros at the end of a code."""
    return F.length(F.regexp_extract(code.cast("string"), "0*$", 0))


def round_half_even(value: Column) -> Column:
    """Round to a whole number, halves to the even neighbour."""
    return F.rint(value)


def norm_text(text: Column) -> Column:
    """Lower case, everything but letters and digits to blanks, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", " "))


def blank_to_null(text: Column) -> Column:
    """Text of blanks only becomes null."""
    return F.when(F.trim(text) != "", text)


def agree3(a: Column, b: Column, c: Column) -> Column:
    """1 where the three values are equal, 0 otherwise, also where one of them is null."""
    return F.coalesce((a == b) & (b == c), F.lit(False)).cast("int")


def underscores_to_spaces(text: Column) -> Column:
    return F.translate(text, "_", " ")


def spaces_to_underscores(text: Column) -> Column:
    return F.translate(text, " ", "_")


def layer_name(nuts: Column, year: Column) -> Column:
    """``<region>_<year>`` in lower case."""
    return F.concat_ws("_", F.lower(nuts), year.cast("string"))


def layer_region(name: Column) -> Column:
    """The region of a layer name, in upper case."""
    return F.upper(F.split_part(name, F.lit("_"), F.lit(1)))


def base_name(path: Column) -> Column:
    """File name without folders."""
    return F.substring_index(path, "/", -1)


def without_suffix(name: Column, suffix: str) -> Column:
    """``name`` less ``suffix`` where it ends with it."""
    return F.regexp_replace(name, _quoted(suffix) + "$", "")


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def stamp(ts: Column) -> Column:
    """The minute stamp used in report names."""
    return F.date_format(ts, "yyyyMMddHHmm")
