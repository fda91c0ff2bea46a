"""Station names and searches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accented capitals that are folded, and what each becomes.
ACCENTED = "ÉÈÊËÀÂÎÏÔÛ"
PLAIN = "EEEEAAIIOU"

# The lone word ST. Word characters are spelled out: Java's \b counts accented letters as well.
_LONE_ST = r"(?<![A-Za-z0-9_])ST(?![A-Za-z0-9_])"


def normalize_name(name: Column, variant: str = "local") -> Column:
    """Key under which station names from different sources meet.

    ``local`` upper-cases before folding accents; ``warehouse`` folds first, so small accented
    letters survive as accented capitals.
    """
    if variant == "local":
        # Java upper-cases the sharp s to SS; keep it one letter.
        key = F.upper(F.replace(F.trim(name), F.lit("ß"), F.lit("ẞ")))
        key = F.translate(key, ACCENTED + "-", PLAIN + " ")
    elif variant == "warehouse":
        key = F.translate(F.upper(F.trim(F.translate(name, ACCENTED, PLAIN))), "-", " ")
    else:
        raise ValueError(f"unknown variant {variant!r}")
    # Most names have no such letters at all: the plain search spares them the pattern.
    return F.when(F.contains(key, F.lit("ST")), F.regexp_replace(key, _LONE_ST, "SAINT")).otherwise(key)


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def axis_label(departure: Column, arrival: Column) -> Column:
    """``A -> B``; NULL when either end is NULL."""
    return F.concat(departure, F.lit(" -> "), arrival)


def name_search(norm_name: Column, text: str, normalize_query: bool = False) -> Column:
    """Partial match of a search text; ``%`` and ``_`` stay wildcards.

    ``normalize_query`` also folds accents and dashes of the text like those of the names.
    """
    pattern = F.lit(text)
    pattern = normalize_name(pattern) if normalize_query else F.upper(pattern)
    # A backslash in the text is an ordinary character, not Spark's LIKE escape.
    pattern = F.replace(pattern, F.lit("\\"), F.lit("\\\\"))
    return F.like(norm_name, F.concat(F.lit("%"), pattern, F.lit("%")))


def label_search(label: Column, text: str) -> Column:
    """Case-insensitive partial match; ``%`` and ``_`` stay wildcards."""
    return F.ilike(label, F.lit("%" + text.replace("\\", "\\\\") + "%"))


def first_filled(texts: Column) -> Column:
    """First non-empty string of an array, else NULL."""
    return F.get(F.filter(texts, not_blank), F.lit(0))


def preferred_translation(translations: Column, language: str = "fr") -> Column:
    """Text in the wanted language, else the first translation that has a text."""
    wanted = F.get(F.filter(translations, lambda t: t["language"] == language), F.lit(0))["text"]
    return F.coalesce(
        F.when(not_blank(wanted), wanted),
        first_filled(F.transform(translations, lambda t: t["text"])),
    )
