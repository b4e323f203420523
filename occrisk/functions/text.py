"""Cleaning of free-text cells and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from occrisk.functions import labels as L

# FIXED VALUES: white space known to Python's strip() within Latin-1.
WHITE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def lookup(table: dict, key: Column, default: str | None = None) -> Column:
    """Decode ``key`` through a literal table; a miss gives ``default`` (or NULL).

    The map is a constant, so Catalyst folds it into the plan once.
    """
    pairs = [F.lit(part) for item in table.items() for part in item]
    found = F.element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def strip_all(col: Column) -> Column:
    """Strip every kind of white space of the single-byte encodings, not only blanks."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def is_placeholder(col: Column) -> Column:
    return F.trim(col).startswith(L.PLACEHOLDER_MARK)


def placeholder_to_null(col: Column) -> Column:
    """Trimmed text, or NULL where the source wrote a ``{...}`` placeholder."""
    return F.when(~is_placeholder(col), F.trim(col))


def occupation_code(col: Column) -> Column:
    """First six characters; placeholders and the all-zero code become NULL."""
    code = F.left(F.trim(col), F.lit(6))
    return F.when(~is_placeholder(col) & (code != L.BLANK_OCCUPATION), code)


def activity_prefix(col: Column) -> Column:
    """Four-character activity code: zero-padded, longer input is cut."""
    return F.lpad(F.trim(col), 4, "0")


def accident_type(col: Column) -> Column:
    """Map spellings (also double-encoded ones) to the known accident types."""
    text = F.lower(F.trim(col))
    out = None
    for fragment, label in L.ACCIDENT_TYPE_BY_FRAGMENT.items():
        hit = text.contains(fragment)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(text)


def says_yes(col: Column) -> Column:
    """Case-insensitive equality with 'Sim'; no trimming, NULL stays NULL."""
    return F.lower(col) == "sim"


def competence_part(col: Column, part: int) -> Column:
    """Year (1) or month (2) of a strict ``YYYY/MM`` text, else NULL."""
    strict = col.rlike(r"^[0-9]{4}/[0-9]{2}\z")
    return F.when(strict, F.split_part(col, F.lit("/"), F.lit(part)).cast("int"))


def year_of_file(name: Column) -> Column:
    """Competence year told by a landing file's name; NULL when it tells none.

    FIXED VALUES: the patterns below are those of the published files.
    ``.CAT.YYYYMM.`` wins, then the last run of four digits in the base name,
    then the one legacy file whose name carries no year (2021).
    """
    base = F.substring_index(name, "/", -1)
    structured = F.regexp_extract(name, r"(?i)\.CAT\.(\d{4})\d{2}\.", 1)
    runs = F.regexp_extract_all(base, F.lit(r"(\d{4})"), F.lit(1))
    last_run = F.get(runs, F.size(runs) - 1)
    legacy = F.lower(base).contains("copmp") | base.contains("04-05-06")
    return (
        F.when(structured != "", structured)
        .when(F.size(runs) > 0, last_run)
        .when(legacy, F.lit("2021"))
        .cast("int")
    )


def file_format(name: Column) -> Column:
    return F.upper(F.regexp_extract(name, r"\.([^./]+)$", 1))
