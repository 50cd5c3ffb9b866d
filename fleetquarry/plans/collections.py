"""Collections and their members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.functions.codes import COLLECTION_FOLDER, member_type


def collection_members(membership: DataFrame, collection: DataFrame) -> DataFrame:
    """Every membership with its member type and collection name, unknown collections included."""
    names = collection.select("collection_id", F.col("name").alias("collection"))
    return membership.join(names, "collection_id", "left").select(
        "collection_id",
        "resource_id",
        F.col("name").alias("member"),
        "resource_type",
        member_type("resource_type").alias("member_type"),
        "collection",
        "domain",
        "site_code",
    )


def device_collections(
    membership: DataFrame,
    collection: DataFrame,
    folder_member: DataFrame,
    folder: DataFrame,
    ordered: bool = True,
) -> DataFrame:
    """Collections of each member that are filed in a folder, by folder and collection name."""
    filed = (
        folder_member.filter(F.col("object_type") == COLLECTION_FOLDER)
        .join(folder.withColumnRenamed("name", "folder_name"), "container_node_id")
        .select(F.col("instance_key").alias("collection_id"), "folder_name")
    )
    described = collection.select(
        "collection_id", F.col("name").alias("collection_name"), "comment", "last_refresh"
    ).join(filed, "collection_id")
    members = membership.select("collection_id", F.col("name").alias("member"))
    report = members.join(described, "collection_id").select(
        "member", "collection_id", "collection_name", "comment", "folder_name", "last_refresh"
    )
    # the member breaks ties, so that one large collection is not sorted by one task
    return report.orderBy("folder_name", "collection_name", "member") if ordered else report
