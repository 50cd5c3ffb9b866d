"""Reports as SQL text with named parameters, for callers that pick tables and values when they run it.

Tables are parameters too (qualified names of any catalog and database); a list is one parameter of many values; the day
has a sentinel that stands for any day.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for "any day" in a day parameter.
ANY_DAY = datetime(1900, 1, 1)

#: :events and :system name tables; :domains (none: any) and :instance_ids are lists; :day is a day or the sentinel.
SHARE_EVENT_SEARCH = r"""
SELECT e.resource_id, concat(s.netbios_name, '.', lower(s.full_domain_name)) AS computer_name, s.resource_domain AS domain,
       concat(e.account_domain, '\\', e.account_name) AS changed_by, e.instance_id, substring(e.share_name, 5, 200) AS shared_folder,
       e.share_path, e.event_time
FROM IDENTIFIER(:events) AS e JOIN IDENTIFIER(:system) AS s ON s.resource_id = e.resource_id
WHERE (cardinality(:domains) = 0 OR array_contains(CAST(:domains AS ARRAY<STRING>), s.resource_domain))
  AND array_contains(CAST(:instance_ids AS ARRAY<BIGINT>), CAST(e.instance_id AS BIGINT))
  AND concat(s.netbios_name, '.', lower(s.full_domain_name)) LIKE :computer
  AND (CAST(:day AS TIMESTAMP_NTZ) = TIMESTAMP_NTZ'1900-01-01 00:00:00'
       OR (e.event_time > CAST(:day AS TIMESTAMP_NTZ) AND e.event_time < CAST(:day AS TIMESTAMP_NTZ) + INTERVAL 1 DAY))
"""

#: Articles that close a vulnerability, directly or one step up; the sheet is in a database of its own.
CVE_SUPERSEDENCE = """
WITH fixes AS (
  SELECT DISTINCT a.cve, u.article_id, u.ci_id
  FROM IDENTIFIER(:updates) AS u JOIN (SELECT DISTINCT cve, article FROM IDENTIFIER(:articles) WHERE cve IS NOT NULL) AS a ON a.article = u.article_id),
steps AS (SELECT DISTINCT ci_id, referenced_ci_id FROM IDENTIFIER(:relations) WHERE relation_type = 6)
SELECT cve, article_id, article_id AS newer_article_id, ci_id FROM fixes
UNION
SELECT f.cve, f.article_id, n.article_id, n.ci_id
FROM steps AS s JOIN fixes AS f ON f.ci_id = s.referenced_ci_id LEFT JOIN IDENTIFIER(:updates) AS n ON n.ci_id = s.ci_id
"""


def _argument(value) -> Column:
    """Literals and arrays of literals are all that a parameter may be; the text casts them."""
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value])
    return F.lit(str(value)) if isinstance(value, date) else F.lit(value)


def run(spark: SparkSession, report: str, values: Mapping[str, object]) -> DataFrame:
    """The rows of a report for given parameters; values never become part of its text.

    A list is one parameter, an empty one too; days and times are zone-less; None as a day is :data:`ANY_DAY`.
    """
    given = dict(values)
    if "day" in given and given["day"] is None:
        given["day"] = ANY_DAY
    return spark.sql(report, args={name: _argument(value) for name, value in given.items()})
