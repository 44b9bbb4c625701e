"""Entity names: slugs, current names, suppression labels, spelling-insensitive keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import (
    GENERIC_NAME_WORDS,
    HOSPITAL_ALIASES,
    SUPPRESSED_HOSPITAL_LABEL,
    SUPPRESSED_SPECIALTY_LABELS,
)


def slug(name: Column) -> Column:
    """Lower case, spaces to hyphens, apostrophes dropped; other punctuation stays."""
    return F.replace(specialty_slug(name), F.lit("'"), F.lit(""))


def specialty_slug(name: Column) -> Column:
    """As `slug`, but apostrophes stay."""
    return F.replace(F.lower(name), F.lit(" "), F.lit("-"))


def current_name(name: Column, aliases: dict[str, str] = HOSPITAL_ALIASES) -> Column:
    """One exact lookup in a small fixed table; names not in it, and nulls, pass through."""
    pairs = [F.lit(text) for pair in aliases.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name) if pairs else name


def is_suppressed(
    hospital: Column,
    specialty: Column,
    hospital_label: str = SUPPRESSED_HOSPITAL_LABEL,
    specialty_labels=SUPPRESSED_SPECIALTY_LABELS,
) -> Column:
    """True for small-volume buckets; a missing name is false, never null."""
    return F.coalesce(hospital == hospital_label, F.lit(False)) | F.coalesce(
        specialty.isin(*specialty_labels), F.lit(False)
    )


def name_fingerprint(name: Column, generic=GENERIC_NAME_WORDS) -> Column:
    """Key shared by spellings that differ in case, punctuation, word order, plural or generic words."""
    bare = F.regexp_replace(F.lower(name), "['’]", "")
    words = F.split(F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}#]+", " ")), " ")
    singular = F.transform(words, lambda w: F.regexp_replace(w, r"(?<=\p{L}{3})s\z", ""))
    telling = F.array_except(singular, F.array(*[F.lit(w) for w in generic]))
    return F.concat_ws(" ", F.array_sort(telling))
