"""Ratings: per-user means, normalisation, popularity, deterministic sampling and splits.

Tables use ``user_id, item_id, rating``. Per-user statistics are computed with a grouped
aggregate (partial aggregation map-side, so a user holding a third of all rows is folded
where it is read) and joined back on ``user_id``; that join is the only shuffle of the
ratings, and users holding a large share of the rows are salted over many tasks
(``tessera.plans.skew``). A window over ``user_id`` would instead send a hot user's rows to
a single task, so it is not used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_key
from tessera.plans.skew import join_per_key
from tessera.session import ensure_checkpoint_dir

MAX_RATING = 5.0


def user_avg(ratings: DataFrame, user: str = "user_id", rating: str = "rating") -> DataFrame:
    """``user_id, avg_rating, n``: mean rating and rating count per user."""
    return ratings.groupBy(user).agg(F.avg(rating).alias("avg_rating"), F.count(F.lit(1)).alias("n"))


def with_user_avg(ratings: DataFrame, user: str = "user_id", rating: str = "rating") -> DataFrame:
    """Ratings with their user's mean attached as ``avg_rating``.

    The join is skew-safe: users holding a large share of the rows are salted over many
    tasks (``tessera.plans.skew``), using the per-user counts the mean already computes.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    # One pass writes the per-user table (one row per user) to the shared checkpoint folder;
    # the hot-key choice and the join both read it instead of re-aggregating the ratings.
    avg = user_avg(ratings, user, rating).checkpoint(eager=True)
    return join_per_key(ratings, avg.select(user, "avg_rating"), user, counts=avg.select(user, "n"))


def normalize(
    ratings: DataFrame,
    method: str = "user",
    user: str = "user_id",
    rating: str = "rating",
    max_rating: float = MAX_RATING,
) -> DataFrame:
    """Rescale ratings: ``none`` (identity), ``user`` (divide by the user's mean) or ``max``
    (divide by ``max_rating``). Column order is kept; a zero mean gives NULL, not an error."""
    cols = ratings.columns
    if method == "none":
        return ratings
    if method == "max":
        return ratings.select(*[(F.col(c) / F.lit(max_rating)).alias(c) if c == rating else c for c in cols])
    if method == "user":
        j = with_user_avg(ratings, user, rating)
        return j.select(*[F.try_divide(F.col(c), F.col("avg_rating")).alias(c) if c == rating else c for c in cols])
    raise ValueError(f"unknown normalisation {method!r}")


def above_avg(ratings: DataFrame, user: str = "user_id", rating: str = "rating") -> DataFrame:
    """Ratings at or above their user's own mean (the user's liked items)."""
    j = with_user_avg(ratings, user, rating)
    return j.filter(F.col(rating) >= F.col("avg_rating")).select(*ratings.columns)


def known(ratings: DataFrame, rating: str = "rating") -> DataFrame:
    """Drop unknown ratings (0)."""
    return ratings.filter(F.col(rating) != 0)


def profile_mean(profile: DataFrame, rating: str = "rating"):
    """Scalar-subquery column: the mean of a profile's known ratings (NULL when empty)."""
    return known(profile, rating).select(F.avg(rating)).scalar()


def profile_good(profile: DataFrame, rating: str = "rating") -> DataFrame:
    """Known profile ratings at or above the profile's own mean.

    The mean is a scalar subquery evaluated once, not a join.
    """
    k = known(profile, rating)
    return k.filter(F.col(rating) >= profile_mean(profile, rating))


def with_new_user(
    ratings_norm: DataFrame,
    profile: DataFrame,
    user_id: int,
    user: str = "user_id",
    item: str = "item_id",
    rating: str = "rating",
) -> DataFrame:
    """Append a new user's known ratings, divided by their own mean, under ``user_id``."""
    new = known(profile, rating).select(
        F.lit(user_id).cast(ratings_norm.schema[user].dataType).alias(user),
        F.col(item).cast(ratings_norm.schema[item].dataType).alias(item),
        F.try_divide(F.col(rating).cast("double"), profile_mean(profile, rating)).alias(rating),
    )
    return ratings_norm.select(user, item, rating).unionByName(new)


def item_counts(ratings: DataFrame, item: str = "item_id") -> DataFrame:
    """``item_id, n``: rating rows per item (not distinct users)."""
    return ratings.groupBy(item).agg(F.count(F.lit(1)).alias("n"))


def popular_items(
    ratings: DataFrame, items: DataFrame | None = None, k: int = 100, item: str = "item_id"
) -> DataFrame:
    """The ``k`` most-rated items, ties by id: ``item_id, n[, title]``.

    ``orderBy(...).limit(k)`` plans as a map-side top-k (``TakeOrderedAndProject``); the
    k-row result is then broadcast to the item table for titles, absent ones staying NULL.
    """
    top = item_counts(ratings, item).orderBy(F.desc("n"), F.asc(item)).limit(k)
    if items is None:
        return top
    return with_titles(top, items, item)


def with_titles(top: DataFrame, items: DataFrame, item: str = "item_id") -> DataFrame:
    """Attach titles to a small, bounded result (a top-k). Absent titles stay NULL.

    Spark can't build the preserved side of an outer join, so the item table is first cut down by an
    inner join that streams it past the broadcast result; those few rows are then broadcast in turn.
    The item table is never shuffled.
    """
    few = items.select(item, "title").join(F.broadcast(top.select(item).distinct()), item)
    return top.join(F.broadcast(few), item, "left").select(*top.columns, "title")


def sample_items(candidates: DataFrame, n: int = 25, seed: int = 42, item: str = "item_id") -> DataFrame:
    """``n`` candidates chosen at random without replacement, reproducibly: the order is an
    md5 key of ``seed`` and the item id, so it does not depend on partitioning."""
    return candidates.orderBy(hash_key(seed, F.col(item)), F.asc(item)).limit(n)


def split_bounds(weights: Sequence[float]) -> list[int]:
    """Where the sides end among the 2^32 keys (the last side takes the rest)."""
    total, acc, bounds = float(sum(weights)), 0.0, []
    for w in weights[:-1]:
        acc += w
        bounds.append(round(acc / total * 2**32))
    return bounds


def hash_split_column(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.8, 0.2), seed: int = 5, out: str = "split",
    fn: str = "md5",
) -> DataFrame:
    """Add ``out`` = index of the side each row falls in, from a hash of ``keys``.

    The 32-bit key of ``md5(seed:keys)`` is compared with the cumulative weights, so the smallest
    weight that keeps its share is 2^-32. Unlike ``randomSplit``, a row's side does not depend on
    partitioning or task retries.
    """
    key = hash_key(seed, *[F.col(k) for k in keys], fn=fn)
    side = F.lit(len(weights) - 1)
    for i, bound in reversed(list(enumerate(split_bounds(weights)))):
        side = F.when(key < bound, F.lit(i)).otherwise(side)
    return df.withColumn(out, side)


def hash_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.8, 0.2), seed: int = 5, fn: str = "md5"
) -> list[DataFrame]:
    """Split ``df`` into disjoint parts that cover it, by a hash of ``keys``."""
    tagged = hash_split_column(df, keys, weights, seed, "_split", fn)
    return [tagged.filter(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 5) -> list[DataFrame]:
    """Spark's ``randomSplit`` (row sampling per partition), for parity with the reference."""
    return df.randomSplit(list(weights), seed=seed)


def exclude_seen(
    ranked: DataFrame, seen: DataFrame, score: str, n: int = 20, item: str = "item_id"
) -> DataFrame:
    """Top ``n`` of ``ranked`` by ``score`` (ties by id) after removing the items in ``seen``.

    A distributed anti-join, then a top-k; order is re-established after the set difference.
    """
    return (
        ranked.join(seen.select(item), item, "left_anti")
        .orderBy(F.desc(score), F.asc(item))
        .limit(n)
    )


def dedupe(ratings: DataFrame, how: str = "avg", keys=("user_id", "item_id"), rating: str = "rating") -> DataFrame:
    """One row per (user, item) with the mean (``avg``), ``max`` or ``min`` of its ratings;
    ``keep`` returns the table unchanged (duplicates pass through, as in the reference).
    Partially aggregated map-side, so a hot pair is folded before the shuffle."""
    if how == "keep":
        return ratings
    agg = {"avg": F.avg, "max": F.max, "min": F.min}.get(how)
    if agg is None:
        raise ValueError(f"unknown dedupe {how!r}")
    return ratings.groupBy(*keys).agg(agg(rating).alias(rating))
