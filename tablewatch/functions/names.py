"""Names, paths and the pieces hidden in them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: names holding any of these characters are never monitored.
CJK_PATTERN = r"[一-龥]"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_name(name: str | Column) -> Column:
    """Lower-case, trimmed table name."""
    return F.trim(F.lower(_c(name)))


def qualified_name(db: str | Column, table: str | Column) -> Column:
    """``db.table`` in canonical form; null when either part is null."""
    return clean_name(F.concat(_c(db), F.lit("."), _c(table)))


def series_name(
    name: str | Column = "name",
    event_id: str | Column = "event_id",
    kind: str | Column = "source_kind",
) -> Column:
    """Identity of a monitored series: shared tables are told apart by their event id."""
    return F.when(
        _c(kind) == "shared_event", F.concat(_c(name), F.lit("+"), _c(event_id))
    ).otherwise(_c(name))


def schema_part(name: str | Column) -> Column:
    return F.split_part(_c(name), F.lit("."), F.lit(1))


def keep_name(
    name: str | Column,
    deny_schemas: Iterable[str] = (),
    deny_pattern: str | None = None,
) -> Column:
    """True for names outside the denied schemas, the denied pattern and the CJK range."""
    name = _c(name)
    keep = ~name.rlike(CJK_PATTERN)
    deny = list(deny_schemas)
    if deny:
        keep = keep & ~schema_part(name).isin(deny)
    if deny_pattern:
        keep = keep & ~name.rlike(deny_pattern)
    return keep


def in_progress(path: str | Column = "path") -> Column:
    """Files still being written."""
    return _c(path).contains(".inprogress.")


def partition_value(path: str | Column, key: str) -> Column:
    """Value of the first ``/key=value`` path segment, null when the segment is absent."""
    rest = F.split_part(_c(path), F.lit(f"/{key}="), F.lit(2))
    return F.nullif(F.substring_index(rest, "/", 1), F.lit(""))


def table_segment(path: str | Column) -> Column:
    """Last directory before the first ``day=`` segment, or before the file name."""
    path = _c(path)
    head = F.split_part(path, F.lit("/day="), F.lit(1))
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(path.contains("/day="), F.substring_index(head, "/", -1)).otherwise(folder)


def strip_scheme(path: str | Column) -> Column:
    """Drop ``scheme://authority`` (or ``scheme:``) in front of an absolute path."""
    return F.regexp_replace(_c(path), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def repair_location(path: str | Column, table: str | Column) -> Column:
    """Catalog paths that still point at a temporary folder are pointed at the table."""
    path = F.coalesce(strip_scheme(path), F.lit(""))
    last = F.element_at(F.split(path, "/"), -1)
    stale = (last != _c(table)) & path.rlike("tmp[12]?$")
    parent = F.regexp_replace(path, "[^/]+$", "")
    return F.when(stale, F.concat(parent, _c(table))).otherwise(path)
