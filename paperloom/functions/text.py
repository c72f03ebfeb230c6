"""Text folds and word functions, each defined once as a column expression.

All accept null (result null) and the empty string.  Whitespace is Unicode whitespace everywhere: Java's ``\\s`` is
ASCII only, so the class is spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace, as a Java regular expression class.
WS = r"[\s\x1c-\x1f\u0085\p{Z}]"
# Letters as the letter count takes them (no digits, no combining marks).
LETTER = r"[\p{L}\p{Nl}\p{No}]"
# What the word functions take for a word.
FORM_WORD = r"([A-Za-z]{3,})"


def strip(c: Column) -> Column:
    """Without whitespace of any kind at either end."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def normalise(c: Column) -> Column:
    """Whitespace runs become one space, none at the ends; case kept."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def casefold(c: Column) -> Column:
    """Case-blind form of a text by full case folding: upper case, then lower case, so that letters written as several
    in upper case are several here too (sharp s, ligatures), long s is s and final sigma sigma; dotless i stays.

    Texts of ASCII letters only need one pass.  Cherokee letters fold to the small ones.
    """
    # Letters whose upper case is not what they fold to, with stand-ins that have no case.
    raised = F.translate(F.upper(F.translate(c, "ẞı", "ß\ue000")), "\ue000", "ı")
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(F.lower(raised), "ς", "σ"))


def folded(c: Column) -> Column:
    """Case-blind and whitespace-blind form, for quotes and evidence."""
    return normalise(casefold(c))


def folded_hard(c: Column) -> Column:
    """As ``folded``, and punctuation counts as a space; for proposed names."""
    return normalise(F.regexp_replace(casefold(c), r"[^\p{L}\p{N}_\s\x1c-\x1f\u0085\p{Z}]+", " "))


def name_words(c: Column) -> Column:
    """The words of a title: runs of a-z and 0-9 of the case-blind form."""
    return F.filter(F.split(F.regexp_replace(casefold(c), "[^a-z0-9 ]+", " "), " +"), lambda w: w != "")


def section_key(c: Column) -> Column:
    """A section label as a key: case-blind, words joined by underscores, punctuation kept."""
    return F.replace(folded(c), F.lit(" "), F.lit("_"))


def form_words(c: Column) -> Column:
    """Upper-cased runs of three or more ASCII letters, once camel case is spaced; duplicates kept."""
    spaced = F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")
    return F.transform(F.regexp_extract_all(spaced, F.lit(FORM_WORD), F.lit(1)), F.upper)


def letters(c: Column) -> Column:
    """Number of letters in the whole text."""
    return F.regexp_count(c, F.lit(LETTER))


def is_true(c: Column) -> Column:
    """The spellings of yes; anything else, null included, is no."""
    # The spellings of true.
    return F.coalesce(F.lower(strip(c)).isin("true", "t", "yes", "y", "1"), F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", c)
