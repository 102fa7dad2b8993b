"""Text functions as columns; none leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All Unicode white space, line ends and separator controls included.
SPACE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
GENERIC_EN = (  # fixed values
    "id no num code name nm first last username user account acct acc key value data info desc "
    "note text content status type flag lat lng lon long loc location"
).split()


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without white space at either end, Unicode spaces and line ends included."""
    return F.btrim(col(x), F.lit(SPACE))


def norm(x: Column | str) -> Column:
    """Stripped and in lower case; null becomes ''."""
    return F.lower(strip(F.coalesce(col(x), F.lit(""))))


def blank_to_null(x: Column | str) -> Column:
    return F.nullif(strip(x), F.lit(""))


def tokens(x: Column | str) -> Column:
    """Runs of letters a-z in lower case, joined by a space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(col(x), F.lit(""))), "[^a-z]+", " "))


def parts(x: Column | str, separator: str) -> Column:
    """Split at a literal separator, strip, drop empty parts."""
    pieces = F.split(F.coalesce(col(x), F.lit("")), f"\\Q{separator}\\E")
    return F.filter(F.transform(pieces, strip), lambda p: p != "")


def normalize_category(x: Column | str) -> Column:
    return F.array_join(parts(F.replace(col(x), F.lit("\\"), F.lit("/")), "/"), "/")


def clean_cell(x: Column | str) -> Column:
    return strip(F.regexp_replace(F.coalesce(col(x), F.lit("")), r"(?U)[\s\x1c-\x1f]+", " "))


def title_level(x: Column | str) -> Column:
    """The section number before a title, '' for other lines."""
    return F.regexp_extract(col(x), r"^(\d+(\.\d+)*)\s+", 1)


def lines(x: Column | str) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(col(x), F.lit("")), "\n"), strip), lambda p: p != "")


def compose(labelled: dict[str, Column]) -> Column:
    """'label:value' of every value that is neither null nor blank, joined by ' | '."""
    said = [F.when(strip(v) != "", F.concat(F.lit(f"{k}:"), strip(v))) for k, v in labelled.items()]
    return F.concat_ws(" | ", *said)


def class_parts(x: Column | str) -> Column:
    """A classification's segments without spaces; either slash separates."""
    bare = F.translate(F.coalesce(col(x), F.lit("")), "\\ ", "/")
    return F.filter(F.split(bare, "/"), lambda p: p != "")


def stem(x: Column | str) -> Column:
    return F.regexp_replace(F.element_at(F.split(col(x), "/"), -1), r"\.[^.]*$", "")


def extension(x: Column | str) -> Column:
    return F.lower(F.regexp_extract(F.element_at(F.split(col(x), "/"), -1), r"\.([^.]+)$", 1))


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))
