"""Finding a column whose name varies between files and years."""

from __future__ import annotations

from collections.abc import Sequence

# A shorter candidate inside another word says nothing ("T" is in "date").
MIN_SUBSTRING = 3


def find_column(columns: Sequence[str], candidates: Sequence[str], required: bool = False) -> str | None:
    """Exact name first (case and outer blanks ignored), then a name containing a candidate."""
    by_name = {c.strip().lower(): c for c in columns}
    wanted = [c.lower() for c in candidates]
    for name in wanted:
        if name in by_name:
            return by_name[name]
    for column in columns:
        if any(len(w) >= MIN_SUBSTRING and w in column.lower() for w in wanted):
            return column
    if required:
        raise ValueError(f"none of {list(candidates)} among {list(columns)}")
    return None


def find_by_words(
    columns: Sequence[str], include: Sequence[str], exclude: Sequence[str] = ()
) -> str | None:
    """First column whose name has all of ``include`` and none of ``exclude``."""
    for column in columns:
        low = column.lower()
        if all(w in low for w in include) and not any(w in low for w in exclude):
            return column
    return None


# Per field the names it has had in the files, and the words of other names for it.
FIELDS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "date": (("DATE", "AAAAMMJJ", "DATE_OBS", "date", "aaaammjj"), ("date",)),
    "year": (("accident_year", "collision_year"), ("year",)),
    "index": (("collision_index", "accident_index"), ()),
}


def find_field(columns: Sequence[str], field: str) -> str | None:
    names, words = FIELDS[field]
    known = [name for name in names if name in columns]
    return known[0] if known else find_by_words(columns, words) if words else None
