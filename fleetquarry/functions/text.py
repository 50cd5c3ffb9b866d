"""Text cuts and predicates.

Positions are 1-based. Where a cut is impossible (delimiter missing, negative length) the
result is NULL unless the docstring says otherwise, so one bad row never stops a job.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def plain(value: ColumnOrName) -> Column:
    """Text that pattern functions take: under no collation. Whether case counts is theirs to say."""
    return as_column(value).cast("string")


# -- comparison ---------------------------------------------------------------------


def folded(value: ColumnOrName, ignore_case: bool = False) -> Column:
    """The form two strings are compared in: trailing blanks never count, case optionally."""
    text = F.rtrim(as_column(value))
    return F.lower(text) if ignore_case else text


def like_pattern(value: ColumnOrName, pattern: str, ignore_case: bool = False) -> Column:
    """LIKE with a caller's pattern: ``%``, ``_`` and ``[...]`` are wild, a backslash is itself."""
    text = plain(value)
    if ignore_case:
        text, pattern = F.lower(text), pattern.lower()
    if "[" not in pattern:
        return F.like(text, F.lit(pattern.replace("!", "!!")), F.lit("!"))
    return text.rlike(_like_to_regex(pattern))


def contains_pattern(value: ColumnOrName, pattern: str, ignore_case: bool = False) -> Column:
    """LIKE with the caller's pattern allowed anywhere in the value."""
    return like_pattern(value, f"%{pattern}%", ignore_case)


def one_of(value: ColumnOrName, allowed: Sequence[str], ignore_case: bool = False) -> Column:
    """Membership in a list of texts, trailing blanks and optionally case aside."""
    if not ignore_case:
        return as_column(value).isin(list(allowed))
    return folded(value, True).isin([a.rstrip(" ").lower() for a in allowed])


def _like_to_regex(pattern: str) -> str:
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        close = pattern.find("]", i + 2) if ch == "[" else -1
        if ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[")
            out.append(f"[{body}]")
            i = close
        else:
            out.append(re.escape(ch))
        i += 1
    return f"(?s)^{''.join(out)}$"


def glob_match(value: ColumnOrName, glob: str) -> Column:
    """Shell-style match of the whole value: ``*`` any text, ``?`` one character, no case."""
    body = "".join({"*": ".*", "?": "."}.get(ch) or re.escape(ch) for ch in glob)
    return plain(value).rlike(f"(?is)^{body}$")


def glob_any(value: ColumnOrName, globs: list[str]) -> Column:
    """True when any of ``globs`` matches; one regular expression for the whole list."""
    bodies = ["".join({"*": ".*", "?": "."}.get(c) or re.escape(c) for c in g) for g in globs]
    return plain(value).rlike(f"(?is)^(?:{'|'.join(bodies)})$")


# -- position cuts ------------------------------------------------------------------


def index_of(needle: ColumnOrName, value: ColumnOrName, start: int = 1) -> Column:
    """Position of ``needle`` (a literal when given as str) in ``value``, 0 when absent.

    An empty needle is never found, and a start below 1 means 1.
    """
    text = as_column(value)
    if isinstance(needle, str):
        if needle == "":
            return F.when(text.isNotNull(), F.lit(0))
        return F.locate(needle, text, max(start, 1))
    found = F.call_function("locate", needle, text, F.lit(max(start, 1)))
    return F.when(needle == "", F.when(text.isNotNull(), F.lit(0))).otherwise(found)


def leading(value: ColumnOrName, length: Column) -> Column:
    """The first ``length`` characters; NULL for a negative length."""
    return F.when(length >= 0, F.left(as_column(value), length))


def before_first(value: ColumnOrName, delimiter: str) -> Column:
    """Text before the first delimiter, the whole value when there is none."""
    return F.substring_index(as_column(value), delimiter, 1)


def after_first(value: ColumnOrName, delimiter: str, default: Column | None = None) -> Column:
    """Text after the first delimiter, ``default`` (NULL) when there is none."""
    text = as_column(value)
    at = F.locate(delimiter, text)
    rest = F.substring(text, at + F.lit(len(delimiter)), F.length(text))
    return F.when(at > 0, rest).when(at == 0, default if default is not None else F.lit(None))


def after_last(value: ColumnOrName, delimiter: str) -> Column:
    """Text after the last delimiter, the whole value when there is none."""
    return F.substring_index(as_column(value), delimiter, -1)


def strip_prefix(value: ColumnOrName, delimiter: str | None = None) -> Column:
    """Drop everything up to the last ``delimiter``; unchanged when no delimiter is given."""
    return after_last(value, delimiter) if delimiter else as_column(value)


def split_pick(value: ColumnOrName, separator: str, position: int) -> Column:
    """Zero-based piece of ``value`` cut at a literal separator, NULL past the end."""
    return F.get(F.split(plain(value), re.escape(separator)), position)


def second_segment(value: ColumnOrName) -> Column:
    """``b`` of ``a.b.c``; '' for ``a.b``, where the length comes out as 0; NULL without a dot."""
    parts = F.split(plain(value), "[.]")
    return F.when(F.size(parts) >= 3, parts[1]).when(F.size(parts) == 2, F.lit(""))


def path_leaf(value: ColumnOrName) -> Column:
    """Last component of a URL or path."""
    return F.substring_index(F.translate(as_column(value), "\\", "/"), "/", -1)


def unc_share(value: ColumnOrName) -> Column:
    r"""Share name of ``\\*\NAME``: from the fifth character, at most 200."""
    return F.substring(as_column(value), 5, 200)


def quoted_path(value: ColumnOrName, until: str = '" -s') -> Column:
    """Command path between the opening quote and ``until``; NULL when ``until`` is missing."""
    text = as_column(value)
    at = F.locate(until, text)
    return F.when(at > 1, F.substring(text, F.lit(2), at - F.lit(2)))


def digit_span(value: ColumnOrName) -> Column:
    """From the first digit up to the first digit that a blank follows.

    Without such a digit the rest of the text is taken, but '' where the text opens with a digit
    (a length of 0). Without any digit the result is ''.
    """
    text = plain(value)
    first = F.regexp_instr(text, F.lit("[0-9]"))
    last = F.regexp_instr(text, F.lit("[0-9] "))
    width = F.when(last > 0, last - first + 1).when(first == 1, F.lit(0)).otherwise(F.length(text))
    return F.when(first > 0, F.substring(text, first, width)).otherwise(
        F.when(text.isNotNull(), F.lit(""))
    )


# -- composition and clean-up -------------------------------------------------------


def remove_all(value: ColumnOrName, needles: list[str]) -> Column:
    """Remove every occurrence of each literal, one after the other."""
    text = as_column(value)
    for needle in needles:
        text = F.replace(text, F.lit(needle), F.lit(""))
    return text


def dotted_host(name: ColumnOrName, domain: ColumnOrName) -> Column:
    """``name.domain`` with the domain in lower case, or just the name without a domain."""
    name, domain = as_column(name), as_column(domain)
    return F.when(domain.isNull(), name).otherwise(F.concat(name, F.lit("."), F.lower(domain)))


def account(domain: ColumnOrName, name: ColumnOrName) -> Column:
    r"""``domain\name``; NULL when either part is NULL."""
    return F.concat(as_column(domain), F.lit("\\"), as_column(name))


def trustee(domain: ColumnOrName, name: ColumnOrName) -> Column:
    r"""``domain\name``, the bare name without a domain, a marker when nobody was resolved."""
    domain, name = as_column(domain), as_column(name)
    return (
        F.when(name.isNull(), F.lit("NOT_RESOLVED"))
        .when(domain.isNotNull(), account(domain, name))
        .otherwise(name)
    )


def cpu_text(name: ColumnOrName, cores: Column) -> Column:
    """Vendor or clock rate of a processor name plus its core total."""
    name = as_column(name)
    clock = F.substring(name, F.locate("@", name) + F.lit(2), F.lit(7))
    head = F.when(name.startswith("AMD"), F.lit("AMD")).otherwise(clock)
    return F.concat(head, F.lit(" (Cores:"), cores.cast("string"), F.lit(")"))


def instance_name(display_name: ColumnOrName, default_display: str) -> Column:
    """Text after the first parenthesis without closing ones; ``Default`` for one known name.

    A name without parentheses is returned whole.
    """
    text = as_column(display_name)
    inner = F.substring(text, F.locate("(", text) + F.lit(1), F.length(text))
    return F.when(folded(text) == default_display, F.lit("Default")).otherwise(
        F.replace(inner, F.lit(")"), F.lit(""))
    )


def short_build(file_version: ColumnOrName) -> Column:
    """Drop a trailing `` (build text)`` and turn each ``.0`` into ``.``; other text unchanged."""
    text = plain(file_version)
    at = F.locate(" (", text)
    cut = F.replace(leading(text, at - 1), F.lit(".0"), F.lit("."))
    return F.when(text.rlike(r"(?s)\(.*\)"), cut).otherwise(text)


def without_apostrophes(value: ColumnOrName) -> Column:
    return F.replace(as_column(value), F.lit("'"), F.lit(""))


def strip_tags(value: ColumnOrName) -> Column:
    return F.regexp_replace(plain(value), "<[^>]+>", "")


def xml_escape(value: ColumnOrName) -> Column:
    """Entities for ``&``, ``<`` and ``>``, the ampersand first."""
    text = as_column(value)
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def is_device_id(value: ColumnOrName) -> Column:
    """Resource ids of eight characters belong to devices, all others to users."""
    return F.length(as_column(value).cast("string")) == 8
