"""Photo metadata: projection, validity filters and the license join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.broadcast import broadcast_if_small

INVALID_COORD = -1.0
LICENSE_TABLE_MAX_ROWS = 10_000


def photo_project(photos: DataFrame) -> DataFrame:
    """Identifier, coordinates and license of photos (``marker = 0``); videos and NULL markers drop."""
    return photos.filter(F.col("marker") == 0).select("photo_id", "longitude", "latitude", "license")


def interesting(photos: DataFrame) -> DataFrame:
    """Photos whose coordinates are both valid (not −1.0) and whose license is non-empty.

    Any NULL among the three drops the row, like the SQL predicate it mirrors.
    """
    return photos.filter(
        (F.col("longitude") != INVALID_COORD)
        & (F.col("latitude") != INVALID_COORD)
        & (F.col("license") != "")
    )


def _name_col(licenses: DataFrame) -> str:
    for c in licenses.columns:  # header case may differ from the query
        if c.lower() == "name":
            return c
    raise ValueError("license table has no name column")


def with_license_flag(photos: DataFrame, licenses: DataFrame, flag: str = "NonDerivative") -> DataFrame:
    """Photos whose license has ``flag = 1``; only the photo columns are kept.

    Inner join on the license name: duplicate names in the license table multiply rows, and
    absent names drop the photo. The license table is broadcast once its size is checked.
    """
    name = _name_col(licenses)
    flag_col = next((c for c in licenses.columns if c.lower() == flag.lower()), None)
    if flag_col is None:
        raise ValueError(f"license table has no {flag} column")
    lic = licenses.filter(F.col(flag_col).try_cast("int") == 1).select(F.col(name).alias("_lic_name"))
    lic = broadcast_if_small(lic, LICENSE_TABLE_MAX_ROWS)
    joined = photos.join(lic, photos["license"] == lic["_lic_name"], "inner")
    return joined.select(*[photos[c] for c in photos.columns])


def nonderivative(photos: DataFrame, licenses: DataFrame) -> DataFrame:
    """Photos under a NonDerivative license."""
    return with_license_flag(photos, licenses, "NonDerivative")
