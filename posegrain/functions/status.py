"""Canonical spelling of unevenly written quality statuses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The documented statuses, compared without separators.
DOCUMENTED = ("valid", "insufficient_tags", "jump_rejected")


def _letters(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-z]", "")


def _same_word(word: Column, name: str) -> Column:
    """Equal, or one typing slip apart: one letter wrong, missing or extra, or two neighbours swapped.

    Long names (over 8 letters) may differ in two letters. ``invalid`` is not ``valid``.
    """
    target = name.replace("_", "")
    near = F.levenshtein(word, F.lit(target))
    swapped = (F.length(word) == len(target)) & (F.array_sort(F.split(word, "")) == F.array_sort(F.split(F.lit(target), "")))
    return (word == target) | F.when(F.length(word).between(len(target) - 2, len(target) + 2), (near <= (2 if len(target) > 8 else 1)) | ((near == 2) & swapped)).otherwise(False)


def canonical_status(raw: Column) -> Column:
    """The status without letter case, separators, quotes, a ``status=`` prefix, added details and typing slips.

    NULL, blank and letterless values give NULL. A status that is none of the documented ones comes out as
    its lower-case letters, so equal spellings still compare equal.
    """
    low = F.regexp_replace(F.lower(raw), r"^[^a-z]*status\s*[=:]", "")
    head = F.regexp_extract(low, r"^[^a-z]*([a-z][a-z_\s-]*)", 1)
    word, first = _letters(head), F.regexp_extract(head, "^[a-z]+", 0)
    out = F.when(raw.isNull() | (word == ""), None)
    for name in DOCUMENTED:
        out = out.when(word == name.replace("_", ""), name)
    for name in DOCUMENTED:
        out = out.when(_same_word(word, name), name)
    for name in DOCUMENTED:
        out = out.when(_same_word(first, name), name)
    return out.otherwise(word)
