"""Code lists of the reports, and the expressions that look codes up in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetquarry.functions.numbers import complement, mbit
from fleetquarry.functions.text import ColumnOrName, as_column, digit_span, folded, plain

# ---- fixed values ------------------------------------------------------------------

ENFORCEMENT_STATES = {
    1000: "Success",
    1001: "Already Compliant",
    1002: "Simulate Success",
    2000: "In Progress",
    2001: "Waiting for Content",
    2002: "Installing",
    2003: "Restart to Continue",
    2004: "Waiting for maintenance window",
    2005: "Waiting for schedule",
    2006: "Downloading dependent content",
    2007: "Installing dependent content",
    2008: "Restart to complete",
    2009: "Content downloaded",
    2010: "Waiting for update",
    2011: "Waiting for user session reconnect",
    2012: "Waiting for user logoff",
    2013: "Waiting for user logon",
    2014: "Waiting to install",
    2015: "Waiting retry",
    2016: "Waiting for presentation mode",
    2017: "Waiting for Orchestration",
    2018: "Waiting for network",
    2019: "Pending App-V Virtual Environment",
    2020: "Updating App-V Virtual Environment",
    3000: "Requirements not met",
    3001: "Host platform not applicable",
    4000: "Unknown",
    5000: "Deployment failed",
    5001: "Evaluation failed",
    5002: "Deployment failed",
    5003: "Failed to locate content",
    5004: "Dependency installation failed",
    5005: "Failed to download dependent content",
    5006: "Conflicts with another application deployment",
    5007: "Waiting retry",
    5008: "Failed to uninstall superseded deployment type",
    5009: "Failed to download superseded deployment type",
    5010: "Failed to updating App-V Virtual Environment",
}
OFFER_TYPES = {0: "Required", 2: "Available"}
COMPLIANCE_STATES = {
    1: "Compliant",
    4: "Compliant",
    2: "Non Compliant",
    5: "Status 5",
    6: "Status 6",
}
RESOURCE_TYPES = {5: "Device", 4: "User"}
PRINCIPALS = {
    "BUILTIN\\Пользователи": "BUILTIN\\Users",
    "BUILTIN\\Администраторы": "BUILTIN\\Administrators",
    "NT AUTHORITY\\СИСТЕМА": "NT AUTHORITY\\SYSTEM",
    "Все": "Everyone",
}
SHARE_MESSAGES = {
    "A network share object was modified.": "modify",
    "A network share object was deleted.": "delete",
    "A network share object was added.": "add",
    "Объект сетевой папки изменен.": "modify",
    "Объект сетевой папки удален.": "delete",
    "Объект сетевой папки добавлен.": "add",
}
SHARE_EVENT_LABELS = {"modify": "Изменение", "delete": "Удаление", "add": "Создание"}
SHARE_DIGEST_LABELS = {"modify": "Modify", "delete": "Delete", "add": "Add"}
PERMISSION_TYPES = {"NTFSPermission": "NTFS", "SharedPermission": "Shared"}
ACCESS_TYPES = {"AccessAllowed": "Allowed", "AccessDenied": "Denied"}
DEVICE_KIND_SERVER, DEVICE_KIND_OTHER = "Сервер", "Рабочая станция"

MEMORY_COUNTERS = ["PercentMemoryUsed", "% Used Memory", "Free Memory %"]
CPU_OBJECTS = ["Processor Information", "Processor"]
CPU_COUNTER = "% Processor Time"
OTHER_COUNTERS = [
    "% Free Space",
    "Used Percentage",
    "Disk - /var Used (%)",
    "Current Disk Queue Length",
    "Bytes Total/sec",
    "Interface Received Bytes Rate",
    "Interface Transmitted Bytes Rate",
]
SPACE_COUNTERS = ["% Free Space", "Used Percentage", "Disk - /var Used (%)"]
INTERFACE_COUNTERS = ["Interface Received Bytes Rate", "Interface Transmitted Bytes Rate"]
NETWORK_COUNTERS = ["Bytes Total/sec", *INTERFACE_COUNTERS]
INTERFACES = {"/0/1": "Management Interface", "/1/1": "Data Interface"}
DIRECTIONS = {
    "Interface Received Bytes Rate": "Received",
    "Interface Transmitted Bytes Rate": "Transmitted",
}

# install folder prefix -> product line; the longer prefix of a shared start comes first
PRODUCT_LINES = {
    "MSSQL10_50": "SQL Server 2008 R2",
    "MSSQL10": "SQL Server 2008",
    "MSSQL11": "SQL Server 2012",
    "MSSQL12": "SQL Server 2014",
    "MSSQL13": "SQL Server 2016",
    "MSSQL14": "SQL Server 2017",
}
DEFAULT_INSTANCE = "SQL Server (MSSQLSERVER)"
SERVER_SERVICE_PREFIX = "SQL Server ("
VENDOR_PREFIXES = ["Microsoft ", "Майкрософт "]
NO_SHARES = "No Shared Folders"
LINUX_EDITION = 13
NEUTRAL_LOCALE = 65535
ENGLISH_LOCALE = 1033
COLLECTION_FOLDER = 5000
SUPERSEDES = 6

# ---- expressions -------------------------------------------------------------------


def lookup(code: ColumnOrName, names: dict, default: Column | None = None) -> Column:
    """The name of a code; ``default`` (NULL) for unlisted codes.

    Codes that are texts are compared one by one, by the collation of ``code``.
    """
    if all(isinstance(known, str) for known in names):
        key, out = as_column(code), F.when(F.lit(False), F.lit(None).cast("string"))
        for known, name in names.items():
            out = out.when(key == known, F.lit(name))
        return out.otherwise(default) if default is not None else out
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), as_column(code))
    return F.coalesce(found, default) if default is not None else found


def enforcement_message(state: ColumnOrName, offer: ColumnOrName) -> Column:
    """Message of an enforcement state.

    An unlisted state falls through to the offer, and only a NULL state to "Unknown", so an
    unlisted non-NULL state of another offer has no message.
    """
    state, offer = as_column(state), as_column(offer)
    rest = F.when(offer == 2, F.lit("Available for Install")).when(
        state.isNull(), F.lit("Unknown")
    )
    return lookup(state, ENFORCEMENT_STATES, rest)


def compliance_text(
    applicable: ColumnOrName,
    detected: ColumnOrName,
    state: ColumnOrName,
    noncompliant: Column | None = None,
) -> Column:
    """Compliance as text, applicability and detection first.

    ``noncompliant`` replaces the text of state 2 and may be NULL there.
    """
    text = lookup(state, COMPLIANCE_STATES, F.lit("Unknown"))
    if noncompliant is not None:
        text = F.when(as_column(state) == 2, noncompliant).otherwise(text)
    return (
        F.when(as_column(applicable) == 0, F.lit("Not Applicable"))
        .when(as_column(detected) == 0, F.lit("Not Detected"))
        .otherwise(text)
    )


def member_type(resource_type: ColumnOrName) -> Column:
    return lookup(resource_type, RESOURCE_TYPES, F.lit("unknown"))


def principal(name: ColumnOrName) -> Column:
    return lookup(folded(name), PRINCIPALS, as_column(name))


def share_event_type(message: ColumnOrName, labels: dict[str, str]) -> Column:
    """Event type of the first message line in either language; other lines unchanged."""
    kinds = {text: labels[kind] for text, kind in SHARE_MESSAGES.items()}
    return lookup(folded(message), kinds, as_column(message))


def product_line(path: ColumnOrName) -> Column:
    """Product line from the install folder; ``_`` in a prefix stands for any character."""
    text = plain(path)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for prefix, name in PRODUCT_LINES.items():
        out = out.when(text.rlike(rf"(?s)\\{prefix.replace('_', '.')}"), F.lit(name))
    return out.otherwise(F.lit("Unknown"))


def os_family(caption: ColumnOrName) -> Column:
    caption = as_column(caption)
    return (
        F.when(caption.startswith("Red Hat"), F.lit("RHEL "))
        .when(caption.contains("Server"), F.lit("Windows Server "))
        .otherwise(F.lit("Windows "))
    )


def os_name(caption: ColumnOrName, build: ColumnOrName, servicing: ColumnOrName) -> Column:
    """``Windows Server 2012 R2`` style name, with the servicing name for builds 10 and up."""
    release = F.when(as_column(caption).contains("R2"), F.lit(" R2")).otherwise(F.lit(""))
    return F.concat(
        os_family(caption), digit_span(caption), release, plain(servicing_suffix(build, servicing))
    )


def servicing_suffix(build: ColumnOrName, servicing: ColumnOrName) -> Column:
    named = F.concat(F.lit(" ("), as_column(servicing), F.lit(")"))
    return F.when(as_column(build).startswith("10"), named).otherwise(F.lit(""))


def architecture(system_type: ColumnOrName) -> Column:
    return F.when(folded(system_type) == "X64-based PC", F.lit("x64")).otherwise(F.lit("x86"))


# ---- counters ----------------------------------------------------------------------


def counter_title(counter: ColumnOrName) -> Column:
    """One name for the counters that measure the same thing."""
    counter = as_column(counter)
    return (
        F.when(counter.isin(SPACE_COUNTERS), F.lit("% Used Space"))
        .when(counter.isin(NETWORK_COUNTERS), F.lit("Mbit/sec"))
        .otherwise(counter)
    )


def interface_title(instance: ColumnOrName, counter: ColumnOrName) -> Column:
    """Readable name of an appliance interface, other instance names unchanged."""
    instance, counter = as_column(instance), as_column(counter)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for suffix, title in INTERFACES.items():
        for name, direction in DIRECTIONS.items():
            out = out.when(
                instance.endswith(suffix) & (counter == name), F.lit(f"{title} ({direction})")
            )
    return out.otherwise(instance)


def counter_value(
    counter: ColumnOrName,
    value: ColumnOrName,
    mirrored: ColumnOrName,
    network: ColumnOrName,
) -> Column:
    """A counter in report units: free space as used (from the mirrored extreme), rates as Mbit."""
    counter = as_column(counter)
    return (
        F.when(counter == "% Free Space", complement(mirrored))
        .when(counter.isin(NETWORK_COUNTERS), mbit(network))
        .otherwise(as_column(value))
    )


def used_memory(counter: ColumnOrName, value: ColumnOrName, mirrored: ColumnOrName) -> Column:
    """Used memory percent; a free-memory counter is turned around."""
    return F.when(as_column(counter) == "Free Memory %", complement(mirrored)).otherwise(
        as_column(value)
    )
