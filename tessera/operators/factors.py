"""Recommendations straight from factor tables: the best unseen items of all users, and new users without a refit.

``top_items`` never multiplies a user with every item. Items are cut into bands of about ``BAND`` by the length of their
factor vectors. Users are dealt to blocks; each block reads all bands once, longest first, each behind the pairs of its users and the band's
items that are seen. Users stay where they are, so what is shuffled is the users, what they have seen, and a copy of the items for each block.
A product is at most the product of the lengths (Cauchy-Schwarz), so a user is done when the n-th best score
found is above their own length times the longest item to come; within a band, blocks of items are skipped by the same rule. What
a user has seen comes band by band, so no user's list is ever longer than a band.

``fold_in`` gives a new user the factors that ALS would with the item factors held fixed: (Σ vvᵀ + λnE) x = Σ rv. The
sums are one grouped aggregate with partial sums, so a user with a third of all ratings is added up where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

BAND, BLOCK, USERS = 16_384, 2_048, 512
#: Users of a block, at most: some 100 MB with the best that are found.
BLOCK_USERS = 400_000
#: Cuts of the range of lengths; a cut with more items than a band is dealt to several bands by hash.
CUTS = 64
ROOM = 1e-9

#: Users and seen pairs come to a block in so many pieces (of a band), as rows by themselves are slow to hand to Python.
PIECES = 64
#: Rows of a block: kind 0 users, 1 pairs of a user and an item of the band that are seen, 2 a band
MEETING = "block int, place int, kind int, users array<long>, features array<double>, ids array<long>, lengths array<double>"
FOUND = "user_id long, rank int, item_id long, score double"
#: Stands for a null item id.
NO_ID = np.iinfo(np.int64).min


class Band(NamedTuple):
    """Items by falling length of their vectors, and the length of the longest in any later band (-1: none or not known)."""

    id: np.ndarray
    factors: np.ndarray
    length: np.ndarray
    next_length: float


def shaped(values: pa.Array, rows: int) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1 if len(values) else 0)


class Best:
    """The n best items of some users; missing places have score -inf."""

    def __init__(self, features: np.ndarray, items: np.ndarray, scores: np.ndarray):
        self.features, self.items, self.scores = features, items, scores
        self.length = np.sqrt((features * features).sum(axis=1))
        self.asked = self.met = 0

    def open(self, length: float) -> np.ndarray:
        """Users for whom an item with a vector of this length may be among the best."""
        return self.length * length * (1 + ROOM) + ROOM >= self.scores[:, -1]

    def meet(self, band: Band, seen_row: np.ndarray, seen_at: np.ndarray) -> None:
        """``seen_row``, ``seen_at``: pairs of a user here and an item of the band that don't count."""
        n = self.scores.shape[1]
        for lo in range(0, len(band.id), BLOCK):
            ids, hi = band.id[lo : lo + BLOCK], lo + BLOCK
            who = np.flatnonzero(self.open(band.length[lo]))
            self.asked += len(self.length)
            self.met += len(who)
            if not len(who):
                return  # the items to come are no longer
            score = self.features[who] @ band.factors[lo:hi].T
            place = np.full(len(self.length), -1)
            place[who] = np.arange(len(who))
            mine = (seen_at >= lo) & (seen_at < hi) & (place[seen_row] >= 0)
            score[place[seen_row[mine]], seen_at[mine] - lo] = -np.inf
            better = (score >= self.scores[who, -1:]).any(axis=1)  # the others keep what they have
            who, score = who[better], score[better]
            if not len(who):
                continue
            if score.shape[1] > 4 * n:  # no item below the block's n-th score can be among the best
                least = -np.partition(-score, n - 1, axis=1)[:, n - 1]
                width = int((score >= least[:, None]).sum(axis=1).max())
                pick = np.argsort(-score, axis=1, kind="stable")[:, :width]
                score, ids = np.take_along_axis(score, pick, 1), ids[pick]
            else:
                ids = np.broadcast_to(ids, score.shape)
            score, ids = np.concatenate([self.scores[who], score], 1), np.concatenate([self.items[who], ids], 1)
            order = np.lexsort((ids, -score))[:, :n]
            self.scores[who], self.items[who] = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


def banded(items: DataFrame) -> DataFrame:
    """``item_id, features, length, band``: bands of about ``BAND`` items each, by length where lengths differ."""
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, v: s + v * v))
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("features").cast("array<double>").alias("features")).withColumn("length", length)
    ensure_checkpoint_dir(items.sparkSession)
    rows = rows.where("length is not null").checkpoint(eager=True)  # for the count, the cuts and the bands
    count = rows.count()
    cuts = min(CUTS, -(-count // BAND))
    edges = sorted(set(rows.approxQuantile("length", [i / cuts for i in range(1, cuts)], 0.25 / cuts))) if cuts > 1 else []
    cut = F.size(F.filter(F.array(*[F.lit(float(e)) for e in [*edges, float("inf")]]), lambda e: e < F.col("length")))
    rows = rows.withColumn("cut", cut)
    parts = {r["cut"]: -(-r["count"] // BAND) for r in rows.groupBy("cut").count().collect()}  # a row per cut
    first, at = {}, 0
    for c in sorted(parts):
        first[c], at = at, at + parts[c]
    pick = F.lit(None).cast("long")
    for c, n in parts.items():
        pick = F.when(F.col("cut") == c, F.expr(f"{first[c]} + pmod(xxhash64(item_id), {n})")).otherwise(pick)
    return rows.select("item_id", "features", "length", pick.alias("band"))


def top_items(users: DataFrame, items: DataFrame, seen: DataFrame, n: int = 10) -> DataFrame:
    """``user_id, rank, item_id, score``: the ``n`` items with the largest products of factors for every user, without those
    that ``seen`` (user_id, item_id) lists; ties to the smaller item. ``users``: user_id, features; ``items``: item_id,
    features, arrays of one length. Rows with null features are left out; repeated ids are rows of their own."""
    spark = users.sparkSession
    listed = banded(items)
    people = users.select(F.col("user_id").cast("long").alias("user_id"), F.col("features").cast("array<double>").alias("features"))
    people = people.where("features is not null").checkpoint(eager=True)
    bands = listed.groupBy("band").agg(F.max("length").alias("length")).orderBy(F.desc("length"), "band").collect()  # a row per band
    places = spark.createDataFrame([(b["band"], i) for i, b in enumerate(bands)], "band long, place int")
    listed = listed.withColumn("band", F.col("band").cast("long")).join(F.broadcast(places), "band")
    blocks = max(spark.sparkContext.defaultParallelism, -(-people.count() // BLOCK_USERS))
    block = F.pmod(F.xxhash64("user_id"), F.lit(blocks)).cast("int").alias("block")
    null = lambda *names: [F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in MEETING.split(", ")) if c in names]
    order = [f.split()[0] for f in MEETING.split(", ")]
    person = F.collect_list(F.struct("user_id", "features")).alias("rows")
    start = people.groupBy(block, F.pmod(F.xxhash64("user_id", "features"), F.lit(PIECES * PIECES)).alias("piece")).agg(person)
    start = start.select(
        "block", F.lit(-1).alias("place"), F.lit(0).alias("kind"), F.col("rows.user_id").alias("users"),
        F.flatten("rows.features").alias("features"), *null("ids", "lengths"),
    )
    pairs = seen.select(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id")).where("user_id is not null")
    here = pairs.join(listed.select("item_id", "place").distinct(), "item_id")
    pair = F.collect_set(F.struct("user_id", "item_id")).alias("rows")
    here = here.groupBy(block, "place", F.pmod(F.xxhash64("user_id", "item_id"), F.lit(PIECES)).alias("piece")).agg(pair)
    here = here.select(
        "block", "place", F.lit(1).alias("kind"), F.col("rows.user_id").alias("users"), F.col("rows.item_id").alias("ids"), *null("features", "lengths")
    )
    row = F.struct("item_id", "features", "length")
    packed = listed.groupBy("place").agg(F.collect_list(row).alias("rows"))  # about BAND items
    packed = packed.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "place", F.lit(2).alias("kind"),
        F.flatten("rows.features").alias("features"), F.col("rows.item_id").alias("ids"), F.col("rows.length").alias("lengths"), *null("users"),
    )
    rows = start.select(*order).unionByName(here.select(*order)).unionByName(packed.select(*order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = None, Block(n)
        for batch in batches:
            key = np.stack([batch.column("block").to_numpy(), batch.column("kind").to_numpy()])
            cut = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if lo < hi:
                    if key[0, lo] != at:
                        yield from now.found()
                        at, now = key[0, lo], Block(n)
                    now.read(batch.slice(lo, hi - lo), key[1, lo])
        yield from now.found()

    return rows.repartitionById(blocks, "block").sortWithinPartitions("block", "place", "kind").mapInArrow(run, FOUND)


def places_of(wanted: np.ndarray, ids: np.ndarray, by_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number in ``wanted``, place in ``ids``) of all equal values; ``by_id`` sorts ``ids``."""
    lo, hi = (np.searchsorted(ids, wanted, side, sorter=by_id) for side in ("left", "right"))
    many = hi - lo
    inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(np.arange(len(wanted)), many), by_id[np.repeat(lo, many) + inside]


class Block:
    """Some users, who meet one band after another."""

    def __init__(self, n: int):
        self.n, self.people, self.pairs, self.parts = n, [], [], None

    def read(self, rows: pa.RecordBatch, kind: int) -> None:
        if kind == 0:
            users = rows.column("users").flatten()
            self.people.append((users, shaped(rows.column("features").flatten(), len(users))))
        elif kind == 1:
            self.pairs.append((rows.column("users").flatten().to_numpy(), rows.column("ids").flatten().to_numpy()))
        elif self.people:
            for i in range(rows.num_rows):
                self.meet(*(rows.column(c).slice(i, 1).flatten() for c in ("ids", "features", "lengths")))

    def begin(self) -> None:
        self.id = pa.concat_arrays([u for u, _ in self.people])
        features = np.concatenate([f for _, f in self.people])
        self.known = np.flatnonzero(self.id.is_valid().to_numpy(zero_copy_only=False))
        self.known_id = self.id.fill_null(0).to_numpy()[self.known]
        self.by_id = np.argsort(self.known_id, kind="stable")
        self.parts = []
        for lo in range(0, len(features), USERS):
            own = features[lo : lo + USERS]
            shape = (len(own), self.n)
            self.parts.append(Best(own, np.full(shape, np.iinfo(np.int64).max), np.full(shape, -np.inf)))
        self.open = list(range(len(self.parts)))

    def meet(self, ids: pa.Array, features: pa.Array, lengths: pa.Array) -> None:
        if self.parts is None:
            self.begin()
        pairs, self.pairs = self.pairs, []
        lengths = lengths.to_numpy()
        # no later band has a longer item, so who is done here stays done
        self.open = [p for p in self.open if self.parts[p].open(lengths.max()).any()]
        if not self.open:
            return
        ids = ids.fill_null(NO_ID).to_numpy()
        order = np.lexsort((ids, -lengths))
        factors = shaped(features, len(ids))[order]
        band = Band(ids[order], factors, lengths[order], -1.0)
        user, item = (np.concatenate(c) for c in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
        of, at = places_of(item, band.id, np.argsort(band.id, kind="stable"))
        of, row = places_of(user[of], self.known_id, self.by_id)
        row, at = self.known[row], at[of]
        order = np.argsort(row, kind="stable")
        row, at = row[order], at[order]
        for p in self.open:
            lo, hi = np.searchsorted(row, [p * USERS, (p + 1) * USERS])
            self.parts[p].meet(band, row[lo:hi] - p * USERS, at[lo:hi])

    def found(self) -> Iterator[pa.RecordBatch]:
        for p, best in enumerate(self.parts or []):
            user, rank = np.nonzero(best.scores > -np.inf)
            cols = [self.id.take(pa.array(user + p * USERS)), pa.array((rank + 1).astype(np.int32))]
            cols += [pa.array(best.items[user, rank]), pa.array(best.scores[user, rank])]
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in FOUND.split(", ")])


def fold_in(ratings: DataFrame, items: DataFrame, rank: int, reg: float) -> DataFrame:
    """``user_id, features``: the factors of each user of ``ratings`` (user_id, item_id, rating) for the item factors
    ``items`` (item_id, features of length ``rank``), regularised by ``reg`` times the number of the user's ratings, as ALS does.
    Ratings of items without factors and null ratings don't count; users with no other have no row. ``reg`` is positive."""
    if reg <= 0:
        raise ValueError("without regularisation the equations of a user with few ratings have no single solution")
    v = [F.get("features", F.lit(i)).cast("double") for i in range(rank)]
    r = F.col("rating").cast("double")
    gram = [F.sum(v[i] * v[j]).alias(f"a{i}_{j}") for i in range(rank) for j in range(i + 1)]
    side = [F.sum(v[i] * r).alias(f"b{i}") for i in range(rank)]
    n_gram = len(gram)
    known = ratings.where(r.isNotNull()).join(items.select("item_id", "features"), "item_id")
    sums = known.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), *gram, *side)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            user, n, *cols = batch.columns
            cols = [c.to_numpy(zero_copy_only=False) for c in cols]
            a = np.zeros((batch.num_rows, rank, rank))
            for c, (i, j) in zip(cols, [(i, j) for i in range(rank) for j in range(i + 1)], strict=False):
                a[:, i, j] = a[:, j, i] = c
            a[:, range(rank), range(rank)] += reg * n.to_numpy(zero_copy_only=False)[:, None]
            b = np.stack(cols[n_gram:], axis=1)
            x = np.linalg.solve(a, b[:, :, None])[:, :, 0]
            yield pa.RecordBatch.from_arrays([user, pa.array(list(x), pa.list_(pa.float64()))], names=["user_id", "features"])

    kind = sums.schema["user_id"].dataType.simpleString()
    return sums.mapInArrow(solve, f"user_id {kind}, features array<double>")
