"""Collaborative filtering with ``pyspark.ml`` ALS: fit, score, grid report, new-user flow.

ALS needs 32-bit ids. When the ids fit they are cast; otherwise a dense numbering is built
by a distributed rank (``tessera.operators.prefix.dense_index``) and joined on, and mapped
back on output. Long iterations cut their lineage through ``checkpointInterval`` into the
cluster's checkpoint folder. Over ``SMALL`` ratings the fit is ``tessera.operators.als_slices``, as long as
a task can hold a side's factors and λ isn't next to nothing.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import als_slices, metrics
from tessera.operators import ratings as R
from tessera.operators.factors import fold_in
from tessera.operators.prefix import dense_index
from tessera.plans.cache import freed, persisted
from tessera.plans.pool import pooled
from tessera.sources.models import fit_or_load
from tessera.session import ensure_checkpoint_dir

INT_MAX = 2**31 - 1
#: Up to so many ratings ALS's own number of blocks is taken: there its copies are a few megabytes.
SMALL = 1_000_000
#: Ratings of a block, some 400 MB while it is built.
ROWS_PER_BLOCK = 31_500_000
FEW_BLOCKS = 4
#: From this rank on an iteration is mostly solving, and takes a block per core.
SOLVING_RANK = 16

# --- fixed values: the reference's tuning grid and its custom list -------------------------
GRID_RANKS = (8, 12)
GRID_ITERATIONS = (20, 30)
GRID_LAMBDAS = (0.01, 1.0, 10.0)
CUSTOM_CONFIGS = ((16, 30, 0.01), (12, 40, 0.01), (12, 30, 0.1), (16, 40, 0.01), (24, 40, 0.01), (32, 60, 0.01))
CHOSEN_CONFIG = (32, 60, 0.01)
# --- end of fixed values -------------------------------------------------------------------


def ids_fit_int(df: DataFrame, cols: Sequence[str]) -> bool:
    """True when every id column lies in the 32-bit range (one aggregation pass)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi")]
    row = df.agg(*aggs).first()
    for c in cols:
        lo, hi = row[f"{c}_lo"], row[f"{c}_hi"]
        if lo is not None and (lo < -INT_MAX - 1 or hi > INT_MAX):
            return False
    return True


class IdMap:
    """Casts ids to int when they fit, else numbers them densely (and maps them back)."""

    def __init__(self, ratings: DataFrame, user: str = "user_id", item: str = "item_id"):
        self.user, self.item = user, item
        self.dense = not ids_fit_int(ratings, [user, item])
        if self.dense:
            self.users = dense_index(ratings, user, "_u")
            self.items = dense_index(ratings, item, "_i")

    def to_int(self, df: DataFrame) -> DataFrame:
        if not self.dense:
            return df.withColumn(self.user, F.col(self.user).cast("int")).withColumn(
                self.item, F.col(self.item).cast("int")
            )
        return (
            df.join(self.users, self.user)
            .join(self.items, self.item)
            .drop(self.user, self.item)
            .withColumnRenamed("_u", self.user)
            .withColumnRenamed("_i", self.item)
        )

    def user_to_int(self, df: DataFrame) -> DataFrame:
        if not self.dense:
            return df.withColumn(self.user, F.col(self.user).cast("int"))
        return df.join(self.users, self.user).drop(self.user).withColumnRenamed("_u", self.user)

    def user_from_int(self, df: DataFrame, col: str = "user_id") -> DataFrame:
        """Put the original user ids back into ``col``."""
        if not self.dense:
            return df.withColumn(col, F.col(col).cast("long"))
        back = self.users.withColumnRenamed(self.user, "_orig").withColumnRenamed("_u", col)
        return df.join(back, col).withColumn(col, F.col("_orig")).drop("_orig")

    def items_to_int(self, df: DataFrame) -> DataFrame:
        if not self.dense:
            return df.withColumn(self.item, F.col(self.item).cast("int"))
        return df.join(self.items, self.item).drop(self.item).withColumnRenamed("_i", self.item)

    def item_from_int(self, df: DataFrame) -> DataFrame:
        if not self.dense:
            return df.withColumn(self.item, F.col(self.item).cast("long"))
        back = self.items.withColumnRenamed(self.item, "_orig").withColumnRenamed("_i", self.item)
        return df.join(back, self.item).drop(self.item).withColumnRenamed("_orig", self.item)


def estimator(
    rank: int, max_iter: int, reg: float, seed: int = 42, user: str = "user_id", item: str = "item_id",
    rating: str = "rating", checkpoint_interval: int = 5, blocks: int | None = None,
) -> ALS:
    """Explicit-feedback ALS; pairs unseen in training are dropped when scored.

    ``blocks`` is the number of user and of item blocks (see ``block_count``). Factors are checkpointed every
    ``checkpoint_interval`` iterations: without it 20 iterations overflow the stack on
    lineage depth, and a lost executor recomputes at most that many iterations.
    """
    est = ALS(
        rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol=user, itemCol=item, ratingCol=rating,
        coldStartStrategy="drop", checkpointInterval=checkpoint_interval, nonnegative=False,
    )
    if blocks:
        est = est.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    return est


def block_count(rows: int) -> int:
    """User and item blocks for so many ratings: few and large ones. Each iteration sends nearly every user's factors to each
    item block and the reverse, so its shuffle is the number of blocks times the size of both factor tables."""
    return 10 if rows <= SMALL else max(FEW_BLOCKS, rows // ROWS_PER_BLOCK)


def blocks_for(rows: int, rank: int, cores: int) -> int:
    """``block_count``, and for high ranks, where solving takes longer than sending, at least one wave of tasks."""
    few = block_count(rows)
    return max(few, cores) if rank >= SOLVING_RANK and rows > SMALL else few


def sizes(train: DataFrame, user: str = "user_id", item: str = "item_id") -> tuple[int, int, int]:
    """Ratings, and about how many users and items they have."""
    return tuple(train.agg(F.count(F.lit(1)), *[F.approx_count_distinct(c, 0.02) for c in (user, item)]).first())


def fit(
    train: DataFrame, rank: int, max_iter: int, reg: float, seed: int = 42, user: str = "user_id", item: str = "item_id", rating: str = "rating", **kw
) -> ALSModel:
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    names = {"user": user, "item": item, "rating": rating}
    if "blocks" not in kw:
        rows, users, items = sizes(train, user, item)
        if rows > SMALL and als_slices.fits(users, items, rank, reg):
            with als_slices.sliced(train, rows, **names) as slices:
                return als_slices.Course(slices, estimator(rank, max_iter, reg, seed, **names, **kw)).to(max_iter)
        kw["blocks"] = blocks_for(rows, rank, spark.sparkContext.defaultParallelism)
    return estimator(rank, max_iter, reg, seed, **names, **kw).fit(train)


def evaluate_mse(model: ALSModel, test: DataFrame, rating: str = "rating") -> DataFrame:
    """``mse, n`` of the model on ``test`` (pairs the model cannot score are left out)."""
    return metrics.mse(model.transform(test), rating, "prediction")


def param_label(rank: int, max_iter: int, reg: float) -> str:
    """``Rank{r}Iteration{i}Lambda{l:.2f}``, the key a model of the grid is saved under."""
    return f"Rank{rank}Iteration{max_iter}Lambda{reg:.2f}"


def model_key(rank: int, max_iter: int, reg: float, normalization: str, seed: int, data: str = "") -> str:
    """The folder of a saved model: its label, and all else that the fit depends on. ``data`` names the input."""
    return "-".join([param_label(rank, max_iter, reg), normalization, f"seed{seed}", *([data] if data else [])])


def grid_configs(
    ranks: Iterable[int] = GRID_RANKS, iterations: Iterable[int] = GRID_ITERATIONS, lambdas: Iterable[float] = GRID_LAMBDAS
) -> list[tuple[int, int, float]]:
    return [(r, i, lam) for r in ranks for i in iterations for lam in lambdas]


def grid_report(
    train: DataFrame,
    test: DataFrame,
    configs: Sequence[tuple[int, int, float]],
    seed: int = 42,
    model_dir: str | None = None,
    refit: bool = False,
    normalization: str = "user",
    data: str = "",
    parallelism: int = 4,
) -> DataFrame:
    """``rank, iteration, lambda, mse, n, label``: one fitted model per configuration, in the order of ``configs``.

    Both splits are cached for the duration (each configuration reads them again); with
    ``model_dir`` each model is saved under its ``model_key`` and reused on the next run. ``parallelism`` configurations are
    fitted at once: a fit is a chain of short stages that leaves most of a cluster idle.
    """
    spark: SparkSession = train.sparkSession
    ensure_checkpoint_dir(spark)
    with persisted(train, test) as (train, test), contextlib.ExitStack() as held:
        n, users, items = sizes(train)  # fills the cache once, before several fits would at once
        test.count()
        slices = None
        if n > SMALL and any(als_slices.fits(users, items, rank, reg) for rank, _, reg in configs):
            slices = held.enter_context(als_slices.sliced(train, n))
        blocks = block_count(n)
        # A fit on slices passes through those of fewer iterations; Spark's ALS can't be stopped and go on.
        on_slices = [c for c in dict.fromkeys(configs) if slices and als_slices.fits(users, items, c[0], c[2])]
        fits = [[c] for c in dict.fromkeys(configs) if c not in on_slices]
        for rank, reg in dict.fromkeys((rank, reg) for rank, _, reg in on_slices):
            fits.append([(rank, i, reg) for i in sorted(i for r, i, v in on_slices if (r, v) == (rank, reg))])
        if len(on_slices) == len(set(configs)):
            train.unpersist()  # the slices hold it

        def one(of: list[tuple[int, int, float]]) -> list[tuple]:
            rank, most, reg = of[-1]
            course = als_slices.Course(slices, estimator(rank, most, reg, seed)) if of[-1] in on_slices else None
            out = []
            for rank, iters, reg in of:

                def _fit():
                    return course.to(iters) if course else fit(train, rank, iters, reg, seed, blocks=blocks)

                if model_dir:
                    path = f"{model_dir.rstrip('/')}/{model_key(rank, iters, reg, normalization, seed, data)}"
                    model = fit_or_load(path, _fit, ALSModel.load, refit)
                else:
                    model = _fit()
                m = evaluate_mse(model, test).first()
                del model
                freed(spark)
                out.append((rank, iters, float(reg), m["mse"], m["n"], param_label(rank, iters, reg)))
            if course:
                course.drop()
            return out

        found = {c: row for of, rows in zip(fits, pooled(spark, one, fits, parallelism), strict=True) for c, row in zip(of, rows, strict=True)}
    schema = "rank int, iteration int, lambda double, mse double, n long, label string"
    return spark.createDataFrame([found[c] for c in configs], schema)


def report_table(report: DataFrame) -> DataFrame:
    """The grid report as written to disk: ``rank iteration lambda mse`` with λ as ``%.2f``
    and MSE as ``%f`` (always ``.`` decimals)."""
    return report.select(
        "rank",
        "iteration",
        F.format_string("%.2f", "lambda").alias("lambda"),
        F.format_string("%f", "mse").alias("mse"),
    )


def best_config(report: DataFrame) -> DataFrame:
    """The configuration with the least MSE (ties: smaller rank, iterations, λ)."""
    return report.orderBy("mse", "rank", "iteration", "lambda").limit(1)


def top_unseen(model: ALSModel, user_features: Sequence[float], seen: DataFrame, n: int) -> DataFrame:
    """The ``n`` best items for one user's factors that are not in ``seen``: ``item_id, prediction``.

    Seen items leave by an anti-join before anything is scored; the rest are scored where their factors lie
    and cut by a map-side top-k."""
    mine = F.array(*[F.lit(float(v)) for v in user_features])
    product = F.zip_with("features", mine, lambda a, b: a.cast("double") * b)
    return (
        model.itemFactors.withColumnRenamed("id", "item_id")
        .join(seen.select("item_id"), "item_id", "left_anti")
        .select("item_id", F.aggregate(product, F.lit(0.0), lambda s, v: s + v).cast("float").alias("prediction"))
        .orderBy(F.desc("prediction"), "item_id")
        .limit(n)
    )


def recommend_new_user(
    ratings: DataFrame,
    profile: DataFrame,
    user_id: int,
    items: DataFrame | None = None,
    n: int = 20,
    rank: int = 8,
    max_iter: int = 10,
    reg: float = 0.01,
    seed: int = 42,
    normalization: str = "user",
    model_path: str | None = None,
    refit: bool = False,
) -> DataFrame:
    """Add a new user's known ratings to the (normalised) table, fit ALS, and return their top
    ``n`` items not already rated: ``item_id, prediction[, title]``.

    With ``model_path`` the model is saved there, and the next call with the same path recommends from it
    without training (the saved model knows the user's ratings as they were then); ``refit`` trains again.
    """
    base = R.normalize(ratings, normalization)
    with persisted(R.with_new_user(base, profile, user_id)) as (train,):
        ids = IdMap(train)  # the id check and the fit both read the cached table

        def _fit():
            return fit(ids.to_int(train), rank, max_iter, reg, seed)

        model = fit_or_load(model_path, _fit, ALSModel.load, refit) if model_path else _fit()
        me = ids.user_to_int(
            train.sparkSession.range(1).select(F.lit(user_id).cast(train.schema["user_id"].dataType).alias("user_id"))
        )
        factors = model.userFactors.join(F.broadcast(me), F.col("id") == F.col("user_id")).select("features").first()
        known = R.known(profile).select("item_id")
        seen = ids.items_to_int(known)
        top = top_unseen(model, factors["features"] if factors else [], seen, n if factors else 0)
        rows = ids.item_from_int(top).collect()  # n rows
    schema = f"item_id {base.schema['item_id'].dataType.simpleString()}, prediction float"
    out = base.sparkSession.createDataFrame([(r["item_id"], r["prediction"]) for r in rows], schema)
    out = out.orderBy(F.desc("prediction"), "item_id")
    return R.with_titles(out, items) if items is not None else out


def recommend_folded(
    model: ALSModel, profile: DataFrame, items: DataFrame | None = None, n: int = 20, reg: float = 0.01, ids: IdMap | None = None
) -> DataFrame:
    """A new user's top ``n`` items not already rated, without training: ``item_id, prediction[, title]``.

    The user's known ratings, divided by their own mean, give factors for the model's item factors as they are
    (``factors.fold_in``); ``reg`` is the λ that the model was fitted with. A user without a known rating of an item of the model gets
    no rows. ``ids`` maps the items where the model was fitted on dense numbers.
    """
    known = R.known(profile)
    rated = known.select("item_id", F.try_divide(F.col("rating").cast("double"), R.profile_mean(profile)).alias("rating"))
    rated = ids.items_to_int(rated) if ids else rated
    known_items = model.itemFactors.withColumnRenamed("id", "item_id")
    mine = fold_in(rated.withColumn("user_id", F.lit(0)), known_items, model.rank, reg).first()
    seen = rated.select("item_id")
    top = top_unseen(model, mine["features"] if mine else [], seen, n if mine else 0)
    top = ids.item_from_int(top) if ids else top.withColumn("item_id", F.col("item_id").cast("long"))
    out = top.orderBy(F.desc("prediction"), "item_id")
    return R.with_titles(out, items).orderBy(F.desc("prediction"), "item_id") if items is not None else out
