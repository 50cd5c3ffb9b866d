"""Security audit search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.functions.text import before_first, contains_pattern, strip_prefix

# ---- fixed values ------------------------------------------------------------------

LOCKOUT_EVENT = 4740
TICKET_EVENT = 4768


def security_audit(
    events: DataFrame,
    event_ids: Sequence[int],
    target_user: str = "",
    service_name: str = "",
    address_delimiter: str | None = None,
    ordered: bool = True,
    case_insensitive: bool = False,
) -> DataFrame:
    """Logon, ticket and lockout events; which payload column means what depends on the id.

    ``address_delimiter`` cuts a prefix off the client address; without one it stays whole.
    """
    event = F.col("event_id")
    lockout, ticket = event == LOCKOUT_EVENT, event == TICKET_EVENT
    none = F.lit("na")

    def address(column: str):
        return strip_prefix(column, address_delimiter)

    found = events.filter(
        event.isin(list(event_ids))
        & contains_pattern("target_user", target_user, case_insensitive)
        & contains_pattern("string01", service_name, case_insensitive)
    )
    report = found.select(
        "event_id",
        F.col("creation_time").alias("event_time"),
        before_first("target_user", "@").alias("target_user"),
        F.lower(F.when(lockout, F.col("primary_domain")).otherwise(F.col("target_domain"))).alias(
            "target_domain"
        ),
        F.when(lockout, F.col("string02")).otherwise(F.col("string01")).alias("service_name"),
        F.when(lockout, none)
        .when(ticket, address("string07"))
        .otherwise(address("string05"))
        .alias("client_address"),
        F.when(ticket, F.col("string08")).otherwise(F.col("string06")).alias("client_port"),
        "target_sid",
        F.when(lockout, none).otherwise(F.col("string02")).alias("service_sid"),
        F.col("string04").alias("ticket_encryption"),
        F.col("string03").alias("ticket_options"),
        "category",
        "event_machine",
    )
    if not ordered:
        return report
    return report.orderBy(F.desc("event_time"), "event_machine", "target_user", "client_address")
