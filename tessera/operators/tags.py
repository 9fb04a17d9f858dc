"""Located, tagged photos and tag statistics per country.

Everything here is emitted in long form (one row per country and photo, or per country and
tag). Nothing gathers a whole country into one row: a single country can hold a third of
all photos, and a per-country list would put all of it in one task. Frequencies are counted
on the (country, tag) key, which has many groups and combines map-side before the shuffle,
so hot countries or hot tags are pre-aggregated where they are produced. A per-country map
is offered as a last, optional view over the already-counted rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import decode_tags, has_tags, photo_label
from tessera.operators.geo import assign_region


def pictures(
    photos: DataFrame,
    boxes: DataFrame,
    lon: str = "longitude",
    lat: str = "latitude",
    tags: str = "user_tags",
    keep: tuple[str, ...] = ("photo_id",),
    **assign_kwargs,
) -> DataFrame:
    """Photos with a country and at least one tag: ``*keep, latitude, longitude, country, tags``.

    Coordinates are read as doubles; tags are form-decoded then split on commas. Rows whose
    country is unknown, whose tags are empty, or whose tags fail to decode are dropped.
    """
    base = photos.select(
        *keep,
        F.col(lat).cast("double").alias("latitude"),
        F.col(lon).cast("double").alias("longitude"),
        decode_tags(F.col(tags)).alias("tags"),
    )
    located = assign_region(base, boxes, lon="longitude", lat="latitude", out="country", **assign_kwargs)
    # One predicate over the joined column and the tags: it stays above the join, so decoding
    # runs where the rows are already spread rather than inside the scan task.
    keep = F.when(F.col("country").isNotNull(), has_tags("tags")).otherwise(F.lit(False))
    return located.filter(keep).drop("country_ord")


def label(pics: DataFrame) -> DataFrame:
    """Display text ``(CC, t1, t2)`` per picture."""
    return pics.select(*[c for c in pics.columns if c not in ("tags",)], photo_label("country", "tags").alias("label"))


def country_count(pics: DataFrame) -> DataFrame:
    """``country, n``: pictures per country."""
    return pics.groupBy("country").agg(F.count(F.lit(1)).alias("n"))


def country_photos(pics: DataFrame, cols: tuple[str, ...] = ("photo_id",)) -> DataFrame:
    """Pictures grouped by country, long form: ``country, *cols``."""
    return pics.select("country", *cols)


def country_tags(pics: DataFrame, cols: tuple[str, ...] = ("photo_id",)) -> DataFrame:
    """All tags used in each country, repeats kept, long form: ``country, *cols, pos, tag``."""
    return pics.select("country", *cols, F.posexplode("tags").alias("pos", "tag"))


def country_tag_freq(pics: DataFrame) -> DataFrame:
    """``country, tag, n``: how often each tag is used in each country.

    The aggregation keys on (country, tag) directly, so the partial aggregate runs map-side
    and parallelism is never limited to the number of countries.
    """
    return (
        pics.select("country", F.explode("tags").alias("tag"))
        .groupBy("country", "tag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def tag_freq_map(freq: DataFrame) -> DataFrame:
    """``country, freq`` with ``freq`` a map tag → count, built last from ``country_tag_freq``.

    The map holds one entry per distinct tag of the country, so it is bounded by the tag
    vocabulary, not by the number of photos. Keep it as a display view.
    """
    return freq.groupBy("country").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("tag", "n")))).alias("freq")
    )

