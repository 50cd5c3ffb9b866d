"""Share events and access entries: from raw text and numbers to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquarry.functions.codes import lookup
from fleetquarry.functions.numbers import mask_names
from fleetquarry.functions.text import ColumnOrName, glob_match, plain, trustee
from fleetquarry.operators.dictionaries import dictionary, with_mask_names

# ---- fixed values ------------------------------------------------------------------

SHARE_EVENT_IDS = [5142, 5143, 5144]
MODIFIED_EVENT_ID = 5143
MODIFIED_FIELDS = [
    "security_id",
    "account_name",
    "account_domain",
    "logon_id",
    "object_type",
    "share_name",
    "share_path",
    "old_remark",
    "new_remark",
    "old_max_users",
    "new_max_users",
    "old_share_flags",
    "new_share_flags",
    "old_sd",
    "new_sd",
]
CREATED_FIELDS = [
    "security_id",
    "account_name",
    "account_domain",
    "logon_id",
    "share_name",
    "share_path",
]
SYSTEM_ACCOUNT = "S-1-5-18"
# compared as they stand: the star is part of the name
EXCLUDED_SHARES = [
    "\\\\*\\SCCMContentLib$",
    "\\\\*\\SMS_DP$",
    "\\\\*\\SMSPKGD$",
    "\\\\*\\SMSSIG$",
    "\\\\*\\SMSPKGE$",
    "\\\\*\\SMS_OCM_DATACACHE",
]
ADMIN_SHARES = ["ADMIN$", "IPC$"]
ADMIN_SHARE_GLOB = "?$"

# ------------------------------------------------------------------------------------


def share_events(df: DataFrame) -> DataFrame:
    """Events about network shares."""
    return df.filter(F.col("instance_id").isin(SHARE_EVENT_IDS))


def message_values(message: ColumnOrName) -> Column:
    """Values of the ``label:<tab><tab>value`` lines of a message, in order, blanks included.

    Lines end at a line feed only, so a value of a lone carriage return is an empty value
    that keeps its place.
    """
    return F.regexp_extract_all(plain(message), F.lit("(?d)(.+):\t\t(.+)"), F.lit(2))


def parse_share_events(
    raw: DataFrame, sd_names: dict[str, dict[str, str]] | None = None
) -> DataFrame:
    """Named columns from share event messages; the field order depends on the event id.

    Events of the system account and of the excluded shares are left out.
    """
    # one-element explode: filters on the fields cannot be pushed below it, which would run
    # the pattern once more per condition
    values = share_events(raw).select("*", F.explode(F.array(message_values("message"))).alias("__v"))
    modified = F.col("instance_id") == MODIFIED_EVENT_ID

    def field(name: str) -> Column:
        out = F.when(modified, F.get(F.col("__v"), MODIFIED_FIELDS.index(name)))
        if name in CREATED_FIELDS:
            out = out.otherwise(F.get(F.col("__v"), CREATED_FIELDS.index(name)))
        return F.btrim(out, F.lit(" \t\r")).alias(name)

    keep = [c for c in raw.columns if c not in ("message", *MODIFIED_FIELDS)]
    # the label of the event: no carriage return or blank may stay behind it
    first_line = F.btrim(F.substring_index(F.col("message"), "\n", 1), F.lit(" \t\r"))
    parsed = values.select(*keep, first_line.alias("message"), *[field(n) for n in MODIFIED_FIELDS])
    excluded = [s.lower() for s in EXCLUDED_SHARES]
    system = F.lower("security_id") == SYSTEM_ACCOUNT.lower()
    hidden = F.lower("share_name").isin(excluded)
    shown = parsed.filter(~F.coalesce(system, F.lit(False)) & ~F.coalesce(hidden, F.lit(False)))
    if sd_names is None:
        return shown
    return shown.withColumns(
        {name: readable_sd(name, sd_names) for name in ("old_sd", "new_sd")}
    )


def readable_sd(sd: ColumnOrName, names: dict[str, dict[str, str]]) -> Column:
    """Access entries of a security descriptor: ``who: type (rights) | ...``.

    ``names`` holds dictionaries for "sid", "type" and "rights"; codes it lacks stay codes.
    Text without access entries is returned unchanged.
    """
    text = plain(sd)
    dacl = F.substring_index(F.get(F.split(text, "D:"), 1), "S:", 1)
    entries = F.regexp_extract_all(dacl, F.lit(r"\(([^()]*)\)"), F.lit(1))

    def named(kind: str, code: Column) -> Column:
        pairs = [F.lit(x) for pair in names.get(kind, {}).items() for x in pair]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), code), code) if pairs else code

    def readable(entry: Column) -> Column:
        part = F.split(entry, ";")
        return F.concat(
            named("sid", F.get(part, 5)),
            F.lit(": "),
            named("type", F.get(part, 0)),
            F.lit(" ("),
            named("rights", F.get(part, 2)),
            F.lit(")"),
        )

    joined = F.array_join(F.transform(entries, readable), " | ")
    whole = ~F.exists(entries, lambda e: F.size(F.split(e, ";")) < 6)
    return F.when(F.coalesce((F.size(entries) > 0) & whole, F.lit(False)), joined).otherwise(text)


def share_aces(
    raw: DataFrame,
    permission_type: str,
    rights: dict[int, str] | DataFrame,
    ace_types: dict[int, str] | DataFrame,
    ace_flags: dict[int, str] | DataFrame | None = None,
) -> DataFrame:
    """Permission rows from raw access entries.

    The names of masks, types and flags come from the caller, as dictionaries or as tables: (bits, name) for rights and
    flags, (code, name) for types. Entries on the file system leave out administrative shares and repeats.
    """
    if ace_flags is not None:
        name = F.coalesce("share_name", F.lit(""))
        admin = F.lower(name).isin([s.lower() for s in ADMIN_SHARES])
        raw = raw.filter(~admin & ~glob_match(name, ADMIN_SHARE_GLOB))

    def masked(df: DataFrame, mask: str, names: dict[int, str] | DataFrame, out: str) -> DataFrame:
        return with_mask_names(df, mask, names, out) if isinstance(names, DataFrame) else df.withColumn(out, mask_names(mask, names))

    raw = masked(raw, "access_mask", rights, "file_system_rights")
    kind = F.col("ace_type").cast("string")
    if isinstance(ace_types, DataFrame):
        listed = ace_types.groupBy(F.col("code").cast("int").alias("__code")).agg(F.min("name").alias("__type"))
        raw, kind = raw.join(dictionary(listed), F.col("ace_type") == F.col("__code"), "left"), F.coalesce("__type", kind)
    else:
        kind = lookup("ace_type", ace_types, kind)
    columns = [
        "resource_id",
        F.lit(permission_type).alias("permission_type"),
        F.col("share_name").alias("shared_folder_name"),
        "owner",
        trustee("trustee_domain", "trustee_name").alias("security_principal"),
        "file_system_rights",
        kind.alias("access_control_type"),
    ]
    if ace_flags is None:
        return raw.select(*columns)
    # even parts of the advisory size, so that the distinct meets no more in one task however large the files are
    flagged = masked(raw, "ace_flags", ace_flags, "access_control_flags").select(*columns, "access_control_flags")
    return flagged.hint("rebalance").distinct()
