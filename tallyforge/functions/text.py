"""Text functions as column expressions."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# What makes two names editions of one event, in the order in which it is taken out.
EDITION_MARKS = [
    r"(?i)\(?\b(?:on\s+)?hiatus\b\)?",
    r"\b20\d{2}\b",
    r"(?i)\b\d{1,2}(?:st|nd|rd|th)\b",
    r"(?i)\b[ivx]+\b",
]
# Generation suffixes that are no part of a name.
SUFFIXES = ["jr", "sr", "ii", "iii"]


def _decomposed(c: Column) -> Column:
    """Compatibility decomposition (NFKD), in Arrow, since the JVM functions lack it."""
    def nfkd(v: pa.Array) -> pa.Array:
        return pc.utf8_normalize(v, form="NFKD")

    return F.arrow_udf(nfkd, "string")(c)


def plain(c: Column) -> Column:
    """Case-folded text without the marks that decomposition parts from their letters; letters of any script stay."""
    text = F.lower(F.regexp_replace(_decomposed(c), r"\p{Mn}+", ""))
    return F.replace(F.replace(text, F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def slug(c: Column) -> Column:
    """Lower-case words joined by hyphens; letters that do not decompose into a to z are left out, and 'unknown' stands for nothing."""
    s = F.regexp_replace(F.regexp_replace(plain(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", "unknown").otherwise(s)


def event_name(c: Column) -> Column:
    """An event's name without differences of presentation; the words of its edition stay."""
    return F.trim(F.regexp_replace(plain(c), "[^a-z0-9]+", " "))


def series_slug(c: Column) -> Column:
    """The slug of an event's name without what differs between its editions."""
    for pattern in EDITION_MARKS:
        c = F.regexp_replace(c, pattern, " ")
    return slug(c)


def name_words(c: Column) -> Column:
    """Lower-case words of a name in any script, marks and punctuation left out."""
    return F.filter(F.split(F.regexp_replace(plain(c), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def nickname_equal(a: Column, b: Column, canonical: Column) -> Column:
    """Whether two names of plain words have one surname and first names that a map from nickname to owner makes equal."""
    first = lambda w: F.try_element_at(w, F.lit(1))
    owner = lambda w: F.coalesce(F.try_element_at(canonical, first(w)), first(w))
    return F.coalesce((F.try_element_at(a, F.lit(-1)) == F.try_element_at(b, F.lit(-1))) & (owner(a) == owner(b)), F.lit(False))


def name_norm(c: Column) -> Column:
    """The words of a name joined by blanks, without a generation suffix."""
    words = name_words(c)
    last = F.element_at(F.when(F.size(words) > 0, words), -1)
    return F.array_join(F.when(last.isin(*SUFFIXES), F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))).otherwise(words), " ")


def paired(c: Column) -> Column:
    """The people of a cell joined by and, & or /; an empty list for one person or where a part is blank."""
    parts = F.transform(F.split(c, r"(?i)\s+and\s+|\s*[&/]\s*"), lambda p: F.trim(p))
    return F.when((F.size(parts) > 1) & F.forall(parts, lambda p: p != ""), parts).otherwise(F.array().cast("array<string>"))


def short_hash(*columns: Column) -> Column:
    """16 hex digits of the SHA-256 of columns joined by `|`."""
    return F.substring(F.sha2(F.concat_ws("|", *columns), 256), 1, 16)


def ordinal(c: Column) -> Column:
    """1st, 2nd, 3rd ... as a number; anything else is null."""
    return F.nullif(F.regexp_extract(F.trim(c), r"(?i)^(\d+)(?:st|nd|rd|th)$", 1), F.lit("")).cast("int")
