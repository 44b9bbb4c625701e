"""Header names. A header is a handful of strings, so these are plain Python."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from ..fixed_values import HEADER_NAMES, WIDE, WIDE_BANDS, WIDE_SPECIALTY


def clean_headers(names: Iterable[str]) -> list[str]:
    return [name.strip() for name in names]


def snake_header(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def snake_headers(names: Iterable[str], known: Mapping[str, str]) -> list[str]:
    """Known names by table, all others in snake case."""
    return [known.get(name, snake_header(name)) for name in names]


def family_of_header(names: Iterable[str]) -> str | None:
    """Shape family a header belongs to, or None when its columns fit none."""
    names = set(names)

    def has(column):
        return bool(names.intersection(HEADER_NAMES[column]))

    if not (has("archive_date") and has("adult_child")):
        return None
    if has("time_band") and has("hospital_name") and has("count"):
        return "long_early" if "Archive Date" in names else "long"
    if not names.intersection(WIDE_BANDS):
        return None
    if "HospitalName" in names:
        return WIDE
    return WIDE_SPECIALTY if "Speciality" in names else None
