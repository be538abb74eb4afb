"""Column expressions that bring values of differently written copies to one form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OUTER = r"^[\s\x{a0}\x{2007}\x{202f}\x{200b}\x{feff}]+|[\s\x{a0}\x{2007}\x{202f}\x{200b}\x{feff}]+$"


def bare(c: Column) -> Column:
    """Text without outer blanks of any kind."""
    return F.regexp_replace(c.cast("string"), _OUTER, "")


def folded(c: Column) -> Column:
    """Text without outer blanks, in lower case."""
    return F.lower(bare(c))


def number_text(c: Column) -> Column:
    """A number by value: 1,234 and 1234.0 give 1234. Text that is no number stays as printed; null gives ''."""
    text = bare(c)
    plain = F.regexp_replace(text, r"(?<=\d),(?=\d{3})", "")
    number = plain.try_cast("decimal(38,9)")
    shown = F.regexp_replace(F.regexp_replace(number.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.coalesce(shown, text, F.lit(""))


def date_text(c: Column) -> Column:
    """A date by value as yyyy-MM-dd, from ISO dates and times and from `05 Apr 2011`. Other text stays; null gives ''."""
    text = bare(c)
    iso = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})(?:[T ].*)?$", 1)
    named = F.try_to_timestamp(text, F.lit("d MMM yyyy")).cast("date")
    found = F.coalesce(F.when(iso != "", iso.try_cast("date")), F.when(text.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4}$"), named))
    return F.coalesce(found.cast("string"), text, F.lit(""))


def set_text(c: Column, is_array: bool) -> Column:
    """A list as a set: its sorted distinct non-empty members joined by commas, from an array or a text with , ; or |."""
    parts = c.cast("array<string>") if is_array else F.split(F.regexp_replace(c, r"[\[\]{}\"']", ""), r"[,;|]")
    members = F.array_sort(F.array_distinct(F.filter(F.transform(parts, bare), lambda x: x.isNotNull() & (x != ""))))
    return F.coalesce(F.array_join(members, ","), F.lit(""))


def plain_text(c: Column) -> Column:
    """Text without outer blanks; null gives ''."""
    return F.coalesce(bare(c), F.lit(""))
