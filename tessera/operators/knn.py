"""Content-based nearest neighbours over genre-count vectors.

Vectors are long tables ``(user_id, genre, n)``. The genre vocabulary is tiny, so joining on
``genre`` as a shuffle key would put whole genres in single tasks; the profile side (one row
per genre, counted against a bound first) is broadcast, and the per-user sums run as one
grouped aggregate keyed by user, partially aggregated map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import split_genres
from tessera.operators import ratings as R
from tessera.plans.broadcast import broadcast_if_small

VOCABULARY_MAX_ROWS = 1_000_000


def item_genres(items: DataFrame, item: str = "item_id", genres: str = "genres") -> DataFrame:
    """``item_id, genre``: one row per genre of each item (placeholder text kept as a genre)."""
    return items.select(item, F.explode(split_genres(F.col(genres))).alias("genre"))


def genre_counts(liked: DataFrame, genres_df: DataFrame, keys: tuple[str, ...], item: str = "item_id") -> DataFrame:
    """``*keys, genre, n``: how many liked items of each genre. Items without genres drop."""
    # Both join inputs are plain shuffles, so AQE's skew join splits a popular item's
    # partition at run time (tests/test_skew.py checks the final plan).
    return (
        liked.select(*keys, item)
        .join(genres_df, item)
        .groupBy(*keys, "genre")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def user_vectors(good: DataFrame, genres_df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """``user_id, genre, n`` for every user, from their liked (at-or-above-mean) ratings."""
    return genre_counts(good, genres_df, (user,), item)


def profile_vector(good_profile: DataFrame, genres_df: DataFrame, item: str = "item_id") -> DataFrame:
    """``genre, n`` of one profile's liked items."""
    return genre_counts(good_profile, genres_df, (), item)


def ranked_genres(vector: DataFrame) -> DataFrame:
    """``genre, n, rank``: a profile vector, largest count first, ties by name (one row per genre)."""
    return vector.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "genre")))


def user_cosine(vectors: DataFrame, pvec: DataFrame, user: str = "user_id") -> DataFrame:
    """``user_id, sim``: cosine similarity of every user vector to the profile vector.

    ``sim = dot / (sqrt(Σn²) · sqrt(Σp²))``, absent genres counting 0, so users sharing no
    genre score 0. An empty profile gives NULL similarities, which are dropped.
    """
    # One row per genre: broadcast after a bounded count, so the join never shuffles on the
    # handful of genre keys even where AQE is off. Beyond the bound, AQE's skew join splits.
    p = broadcast_if_small(pvec.select("genre", F.col("n").alias("p")), VOCABULARY_MAX_ROWS)
    pnorm = pvec.select(F.sqrt(F.sum(F.col("n") * F.col("n")).cast("double"))).scalar()
    sums = (
        vectors.join(p, "genre", "left")
        .groupBy(user)
        .agg(
            F.sum(F.col("n") * F.coalesce(F.col("p"), F.lit(0))).alias("dot"),
            F.sum(F.col("n") * F.col("n")).alias("nn"),
        )
    )
    sim = F.try_divide(F.col("dot").cast("double"), F.sqrt(F.col("nn").cast("double")) * pnorm)
    return sums.select(user, sim.alias("sim")).filter(F.col("sim").isNotNull())


def knn_users(cosine: DataFrame, k: int = 5, exclude=None, user: str = "user_id") -> DataFrame:
    """The ``k`` most similar users (ties by id), optionally excluding one id."""
    c = cosine if exclude is None else cosine.filter(F.col(user) != F.lit(exclude))
    return c.orderBy(F.desc("sim"), F.asc(user)).limit(k)


def knn_recommend(
    ratings: DataFrame,
    neighbours: DataFrame,
    profile: DataFrame,
    items: DataFrame | None = None,
    n: int = 20,
    only_good: bool = False,
    user: str = "user_id",
    item: str = "item_id",
    rating: str = "rating",
) -> DataFrame:
    """Items rated by the neighbours and not by the profile, ranked by the neighbours' mean
    rating (ties by id): ``item_id, avg_rating, n_ratings[, title]``.

    All neighbour ratings are used, or only their liked ones with ``only_good``. The neighbour
    list is a top-k, so broadcasting it is bounded by k.
    """
    src = R.above_avg(ratings, user, rating) if only_good else ratings
    theirs = src.join(F.broadcast(neighbours.select(user)), user, "left_semi")
    unseen = theirs.join(R.known(profile, rating).select(item), item, "left_anti")
    top = (
        unseen.groupBy(item)
        .agg(F.avg(rating).alias("avg_rating"), F.count(F.lit(1)).alias("n_ratings"))
        .orderBy(F.desc("avg_rating"), F.asc(item))
        .limit(n)
    )
    if items is None:
        return top
    return R.with_titles(top, items, item)


def vector_map(vectors: DataFrame, user: str = "user_id") -> DataFrame:
    """``user_id, vector``: each user's genre counts as a map genre → n (a display view).

    One entry per genre the user liked, so each map is bounded by the genre vocabulary.
    """
    return vectors.groupBy(user).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("genre", "n")))).alias("vector"))
