"""Combined permission text, and what changed between two of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquarry.functions.text import ColumnOrName, as_column, plain, xml_escape
from fleetquarry.operators.joins import is_collated

UNKNOWN_ENTRY = "UNKNOWN"


#: Columns that hold the entries of a combined text.
ENTRY_LISTS = ("shared_entries", "ntfs_entries")


def array_changes(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Each item of ``left``, with whether ``right`` lacks it. Order and repeats are kept."""
    left, right = as_column(left), as_column(right)
    return F.transform(
        left,
        lambda item: F.struct(
            item.alias("item"),
            (~F.coalesce(F.array_contains(right, item), F.lit(False))).alias("changed"),
        ),
    )


def combined_permissions(entries: DataFrame, keys: list[str], lists: bool = False) -> DataFrame:
    """One text per folder: ``[Shared](who: rights)...[NTFS](who: rights DENY)...``.

    Both lists are built in one aggregation and ordered by who, rights and access type. With
    ``lists`` they are kept next to the text, as arrays ``shared_entries`` and ``ntfs_entries``, since a text cannot
    be cut again where a name holds ``)(`` or ``[NTFS]``. An empty list is one unknown entry.
    """
    by = ["security_principal", "file_system_rights", "access_control_type"]
    kinds = {name: kind for name, kind in zip(ENTRY_LISTS, ("SharedPermission", "NTFSPermission"))}

    def entry(row: Column | None = None) -> Column:
        who, rights, access = (F.col(c) if row is None else row[c] for c in by)
        deny = F.when(access == "AccessDenied", F.lit(" DENY")).otherwise(F.lit(""))
        return plain(F.concat(who, F.lit(": "), rights, deny))

    # a folder has few entries, and the report wants them in one cell; both lists are collected as one and the texts of
    # entries made after it, so that no more than the entries' own columns is moved
    number = F.when(F.lit(False), F.lit(0))
    for n, kind in enumerate(kinds.values()):
        number = number.when(F.col("permission_type") == kind, F.lit(n))
    spelled = [plain(c).alias(f"{c}_spelled") for c in by if is_collated(entries, c)]
    own = F.when(number.isNotNull() & entry().isNotNull(), F.struct(number.alias("kind"), *by, *spelled))
    listed = entries.groupBy(*keys).agg(F.sort_array(F.collect_list(own)).alias("__all"))

    def part(n: int) -> Column:
        items = F.transform(F.filter("__all", lambda x: x["kind"] == n), entry)
        return F.when(F.size(items) > 0, items).otherwise(F.array(F.lit(UNKNOWN_ENTRY)))

    rolled = listed.select(*keys, *[part(n).alias(name) for n, name in enumerate(kinds)])

    def text(items: str) -> Column:
        return F.concat(F.lit("("), F.array_join(items, ")("), F.lit(")"))

    combined = F.concat(F.lit("[Shared]"), text("shared_entries"), F.lit("[NTFS]"), text("ntfs_entries"))
    return rolled.select(*keys, combined.alias("permissions"), *(ENTRY_LISTS if lists else ()))


def permission_lists(text: ColumnOrName) -> tuple[Column, Column]:
    """The shared and the NTFS entries of a combined text; NULL for any other text."""
    text = as_column(text)

    def entries(section: Column) -> Column:
        inner = F.regexp_replace(section, r"^\(|\)$", "")
        return F.split(inner, r"\)\(")

    shared = F.regexp_extract(text, r"(?s)^\[Shared\](.*?)\[NTFS\]", 1)
    ntfs = F.regexp_extract(text, r"(?s)^\[Shared\].*?\[NTFS\](.*)$", 1)
    combined = text.startswith("[Shared]") & text.contains("[NTFS]")
    return F.when(combined, entries(shared)), F.when(combined, entries(ntfs))


def marked_line(
    mine: Column,
    other: Column,
    my_lists: tuple[Column, Column] | None = None,
    other_lists: tuple[Column, Column] | None = None,
) -> Column:
    """A permission text as HTML, entries that ``other`` lacks in red.

    Entries are escaped. A text without lists is ``None`` as it stands, else ``Unknown``. The lists are
    cut from the texts only where they are not given.
    """
    my_lists, other_lists = my_lists or permission_lists(mine), other_lists or permission_lists(other)

    def section(title: str, here: Column, there: Column) -> Column:
        def line(entry: Column) -> Column:
            text = xml_escape(entry["item"])
            red = F.concat(F.lit('<font color="red">'), text, F.lit("</font>"))
            return F.concat(F.when(entry["changed"], red).otherwise(text), F.lit("<br>"))

        lines = F.transform(array_changes(here, there), line)
        return F.concat(F.lit(f"<strong>{title}</strong><br>"), F.array_join(lines, ""))

    listed = F.concat(
        section("Shared", my_lists[0], other_lists[0]), section("NTFS", my_lists[1], other_lists[1])
    )
    return F.when(my_lists[0].isNotNull(), listed).when(mine == "None", F.lit("None")).otherwise(
        F.lit("Unknown")
    )
