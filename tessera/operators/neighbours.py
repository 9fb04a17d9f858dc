"""Nearest users of many profiles at once, by cosine over genre counts.

A join on genre would make a row of every (profile, user) pair that share one. Here a stated set of profiles meets all
users in blocks instead:

1. A user is one row: genre numbers, counts and norm. Users are sorted by their strongest genre and its share of the
   norm, so that neighbouring users are alike, and written once to the shared folder.
2. Profiles are taken in segments of about ``SEGMENT``; each is broadcast (that many rows of at most the vocabulary's length) for one
   pass over the users. A task cuts its users into blocks. A block has an inverted list per genre, and the largest share of the norm
   that the genre has in any of its users: the products with a profile's own shares, added up, bound every cosine
   in the block. Profiles whose k-th best so far lies above the bound skip the block; for the others the genres that
   the block has are multiplied and added list by list.
3. A task keeps k users per profile, a window keeps the best k of all tasks.

So no more than k rows per profile and task are ever shuffled. The results are exact: similarities are computed as
``dot / (sqrt(nn) * sqrt(pp))`` from whole counts, and bounds have room for rounding.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.knn import VOCABULARY_MAX_ROWS
from tessera.plans.broadcast import broadcast_if_small
from tessera.session import shared_path

SEGMENT, BLOCK = 1024, 2048
#: Genres that are multiplied at once.
LISTS = 256
ROOM = 1e-9


class Users(NamedTuple):
    """Sparse rows: user i has the entries ``start[i]`` to ``start[i + 1]`` of ``genre`` (ascending) and ``n``."""

    id: np.ndarray
    start: np.ndarray
    genre: np.ndarray
    n: np.ndarray
    norm: np.ndarray

    @classmethod
    def of(cls, rows: pa.RecordBatch | pa.Table) -> Users:
        if isinstance(rows, pa.Table):
            rows = rows.combine_chunks().to_batches()[0] if rows.num_rows else pa.RecordBatch.from_pylist([], rows.schema)
        genre, n = rows["genre"], rows["n"]
        start = np.concatenate([[0], np.cumsum(genre.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (genre, n)]
        norm = np.sqrt(rows["nn"].to_numpy(zero_copy_only=False).astype(np.float64))
        return cls(rows["user"].to_numpy(zero_copy_only=False), start, flat[0].astype(np.int64), flat[1].astype(np.float64), norm)

    def cut(self, lo: int, hi: int) -> Users:
        a, b = self.start[lo], self.start[hi]
        return Users(self.id[lo:hi], self.start[lo : hi + 1] - a, self.genre[a:b], self.n[a:b], self.norm[lo:hi])

    def row(self) -> np.ndarray:
        """The user of each entry."""
        return np.repeat(np.arange(len(self.id)), np.diff(self.start))


def products(profiles: Users, who: np.ndarray, users: Users, genres: np.ndarray) -> np.ndarray:
    """The dot products of the profiles ``who`` with all users, over ``genres`` (sorted: those that users have)."""
    out = np.zeros((len(who), len(users.id)))
    place = np.full(len(profiles.id), -1)
    place[who] = np.arange(len(who))
    p_row, u_row = place[profiles.row()], users.row()
    for lo in range(0, len(genres), LISTS):
        part = genres[lo : lo + LISTS]
        sides = []
        for row, of, height in ((p_row, profiles, len(who)), (u_row, users, len(users.id))):
            at = np.minimum(np.searchsorted(part, of.genre), len(part) - 1)
            mine = np.flatnonzero((part[at] == of.genre) & (row >= 0))
            dense = np.zeros((height, len(part)))
            dense[row[mine], at[mine]] = of.n[mine]
            sides.append(dense)
        out += sides[0] @ sides[1].T
    return out


def best(score: np.ndarray, user: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's k largest scores and their users, ties to the smaller user; at least k columns."""
    order = np.lexsort((user, -score))[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(user, order, 1)


class Nearest:
    """The k nearest users so far of each profile of a segment, without the profile's own user."""

    def __init__(self, profiles: Users, k: int):
        self.profiles, self.k = profiles, k
        self.score = np.full((len(profiles.id), k), -np.inf)
        self.user = np.full((len(profiles.id), k), np.iinfo(np.int64).max)
        self.asked = self.met = 0

    def bounds(self, users: Users, genres: np.ndarray) -> np.ndarray:
        """No profile has a larger cosine with one of the users."""
        most = np.zeros(len(genres))
        np.maximum.at(most, np.searchsorted(genres, users.genre), users.n / users.norm[users.row()])
        at = np.minimum(np.searchsorted(genres, self.profiles.genre), max(len(genres) - 1, 0))
        share = np.where(genres[at] == self.profiles.genre, most[at], 0.0) * self.profiles.n if len(genres) else np.zeros(len(self.profiles.n))
        total = np.bincount(self.profiles.row(), share, len(self.profiles.id))
        return np.minimum(total / self.profiles.norm, 1.0)

    def meet(self, users: Users) -> None:
        genres = np.unique(users.genre)
        self.asked += len(self.profiles.id)
        who = np.flatnonzero(self.bounds(users, genres) + ROOM >= self.score[:, -1])
        self.met += len(who)
        if not len(who):
            return
        score = products(self.profiles, who, users, genres) / (users.norm[None, :] * self.profiles.norm[who, None])
        score[users.id[None, :] == self.profiles.id[who, None]] = -np.inf
        ids = np.broadcast_to(users.id, score.shape)
        if score.shape[1] > 4 * self.k:  # what is below the block's k-th score can't be among the best
            least = -np.partition(-score, self.k - 1, axis=1)[:, self.k - 1]
            width = int((score >= least[:, None]).sum(axis=1).max())
            pick = np.argsort(-score, axis=1, kind="stable")[:, :width]
            score, ids = np.take_along_axis(score, pick, 1), np.take_along_axis(ids, pick, 1)
        both = np.concatenate([self.score[who], score], 1), np.concatenate([self.user[who], ids], 1)
        self.score[who], self.user[who] = best(*both, self.k)

    def batch(self) -> pa.RecordBatch:
        found = self.score > -np.inf
        profile = np.repeat(self.profiles.id, self.k)[found.ravel()]
        return pa.RecordBatch.from_arrays([pa.array(profile), pa.array(self.user[found]), pa.array(self.score[found])], names=["profile", "user", "sim"])


def user_rows(vectors: DataFrame, path: str, user: str = "user_id") -> DataFrame:
    """``user, genre, n, nn``: a row per user with its genre numbers (ascending) and counts; alike users lie together.
    A user's row is as long as the vocabulary at most. Written below ``path``."""
    spark = vectors.sparkSession
    vectors.select(F.col(user).cast("long").alias("user"), "genre", F.col("n").cast("long").alias("n")).write.parquet(f"{path}/vectors")
    vectors = spark.read.parquet(f"{path}/vectors")
    # any distinct numbers will do; written, as they depend on partitions
    vectors.select("genre").distinct().withColumn("g", F.monotonically_increasing_id()).write.parquet(f"{path}/genres")
    numbers = broadcast_if_small(spark.read.parquet(f"{path}/genres"), VOCABULARY_MAX_ROWS)
    per_user = vectors.join(numbers, "genre").groupBy("user").agg(
        F.sort_array(F.collect_list(F.struct("g", "n"))).alias("e"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.max(F.struct("n", "g")).alias("top"),
    )
    per_user = per_user.where("nn > 0").withColumn("share", F.col("top.n") / F.sqrt("nn"))
    ordered = per_user.repartitionByRange(F.col("top.g"), F.col("share"), F.col("user")).sortWithinPartitions("top.g", "share", "user")
    ordered.select("user", F.col("e.g").alias("genre"), F.col("e.n").alias("n"), "nn").write.parquet(f"{path}/users")
    return spark.read.parquet(f"{path}/users")


def nearest_users(vectors: DataFrame, is_profile: F.Column, k: int = 5, user: str = "user_id") -> DataFrame:
    """``profile_id, rank, user_id, sim``: the ``k`` users most similar to each user for which ``is_profile`` (a condition on
    the column ``user``) holds, themselves left out; ties to the smaller id. Users without a common genre have similarity 0;
    users without genres take no part. ``vectors``: user, genre, n."""
    spark = vectors.sparkSession
    path = shared_path(spark, "neighbours", uuid.uuid4().hex)
    users = user_rows(vectors, path, user)
    profiles = users.where(is_profile)
    segments = -(-profiles.count() // SEGMENT)
    schema = "profile long, user long, sim double"
    for s in range(segments):
        rows = profiles.where(F.expr(f"pmod(xxhash64(user), {segments}) = {s}")).toArrow()  # about SEGMENT rows
        shared = spark.sparkContext.broadcast(Users.of(rows))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = Nearest(shared.value, k)
            for batch in batches:
                rows = Users.of(batch)
                for lo in range(0, len(rows.id), BLOCK):
                    found.meet(rows.cut(lo, min(lo + BLOCK, len(rows.id))))
            yield found.batch()

        # a job per segment, written at once: no plan grows with the number of segments
        users.mapInArrow(run, schema).write.mode("append").parquet(f"{path}/found")
        shared.destroy()
    found = spark.read.schema(schema).parquet(f"{path}/found") if segments else spark.createDataFrame([], schema)
    rank = F.row_number().over(Window.partitionBy("profile").orderBy(F.desc("sim"), "user"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select(F.col("profile").alias("profile_id"), "rank", F.col("user").alias("user_id"), "sim")
