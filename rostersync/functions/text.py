"""Text helpers. All are built-in column expressions, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def replace_text(col: Column, old: str, new: str) -> Column:
    """Literal (not regex) replacement of every occurrence."""
    return F.replace(col, F.lit(old), F.lit(new))


def rewrite_title(title: Column) -> Column:
    """``Lead, Maths`` -> ``Lead--Maths``, the spelling the older rules match on."""
    return replace_text(title, ", ", "--")


def normalise_company(company: Column, prefix_only: bool = False) -> Column:
    """Company name -> school name: drop the ``SA `` token, tighten `` - `` to ``-``.

    By default the token goes wherever it occurs; ``prefix_only`` drops it at the start alone.
    """
    if prefix_only:
        bare = F.when(company.startswith("SA "), company.substr(F.lit(4), F.length(company))).otherwise(
            company
        )
    else:
        bare = replace_text(company, "SA ", "")
    return replace_text(bare, " - ", "-")


def name_key(first: Column, last: Column) -> Column:
    """Lower-cased ``first.last``; NULL when either part is NULL."""
    return F.concat(F.lower(first), F.lit("."), F.lower(last))


def text_key(col: Column, strip_zeros: bool = False) -> Column:
    """An identifier of unknown type as text, optionally without leading zeros."""
    key = col.cast("string")
    if not strip_zeros:
        return key
    bare = F.ltrim(key, F.lit("0"))
    return F.when(bare == "", F.when(key != "", "0").otherwise(key)).otherwise(bare)


def matches_part(text: Column, part: Column, literal: bool = False) -> Column:
    """Does ``text`` contain ``part``, ignoring case?

    ``part`` is data used as a LIKE pattern: ``%`` and ``_`` are wildcards, empty text matches all
    non-NULL text, NULL matches nothing. Backslashes are doubled so they stand for themselves.
    ``literal`` compares plainly, without wildcards; so does a part that has none, which saves
    compiling a pattern per row.
    """
    plain = F.contains(F.lower(text), F.lower(part))
    if literal:
        return plain
    escaped = F.replace(part, F.lit("\\"), F.lit("\\\\"))
    pattern = F.ilike(text, F.concat(F.lit("%"), escaped, F.lit("%")))
    return F.when(part.contains("%") | part.contains("_"), pattern).otherwise(plain)
