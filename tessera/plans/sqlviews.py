"""The license query as one SQL statement over the operator's own column and flag names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.photos import INVALID_COORD
from tessera.plans.broadcast import row_count_at_most

STATEMENT = """
    SELECT {hint} p.photo_id, p.longitude, p.latitude, p.license
    FROM {photos} AS p JOIN {licenses} AS l ON p.license = l.name
    WHERE p.marker = 0
      AND try_cast(l.{flag} AS INT) = 1
      AND NOT (p.longitude = {invalid} OR p.latitude = {invalid} OR p.license = '')
"""


def nonderivative_sql(
    spark: SparkSession, photos: DataFrame, licenses: DataFrame, flag: str = "NonDerivative", max_license_rows: int = 10_000
) -> DataFrame:
    """Photos (``marker = 0``) with valid coordinates and a license whose ``flag`` is 1, in SQL."""
    views = {"photos": "tessera_photos", "licenses": "tessera_licenses"}
    photos.createOrReplaceTempView(views["photos"])
    licenses.createOrReplaceTempView(views["licenses"])
    hint = "/*+ BROADCAST(l) */" if row_count_at_most(licenses, max_license_rows) else ""
    return spark.sql(STATEMENT.format(hint=hint, flag=flag, invalid=INVALID_COORD, **views))
