"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the driver tables.

Every query reads whole tables (through the adapters in ``tessera.sources.testdata``) and is
matched by a DuckDB statement of the same name in ``tessera.plans.oracle`` unless it is a
model query (ALS, random forest), which gets a rows-only check. A ``limit`` appears only
where the query is a top-k report.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.codes import shift_codes
from tessera.functions.text import decode_tags
from tessera.operators import als, classify, factors, forest, geo, heavy, knn, metrics, neighbours, photos, split, tags, validate
from tessera.operators import ratings as R
from tessera.plans.cache import persisted, released
from tessera.plans.sqlviews import nonderivative_sql
from tessera.session import ensure_checkpoint_dir, shared_path
from tessera.sources import ledger, publish, textdata
from tessera.sources import testdata as td
from tessera.sources.models import fit_or_load
from tessera.sources.readers import parse_photo_lines
from tessera.sources.schemas import CREDIT_SHIFTED

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---- photos: projection, filters, license join ----------------------------------------------


def _interesting(spark, d):
    return photos.interesting(photos.photo_project(td.photos(spark, d)))


@query
def photo_project(spark, d):
    return photos.photo_project(td.photos(spark, d))


@query
def photo_interesting(spark, d):
    return _interesting(spark, d)


@query
def photo_nonderivative(spark, d):
    return photos.nonderivative(_interesting(spark, d), td.licenses(spark))


@query
def photo_nonderivative_sql(spark, d):
    return nonderivative_sql(spark, td.photos(spark, d), td.licenses(spark))


@query
def photo_count(spark, d):
    return td.photos(spark, d).agg(F.count(F.lit(1)).alias("n"))


@query
def photo_head(spark, d):
    return _interesting(spark, d).orderBy("photo_id").limit(5)


# ---- geo: point → region ------------------------------------------------------------------


@query
def geo_assign(spark, d):
    return geo.assign_region(td.points(spark, d), td.boxes(spark, d), strategy="grid")


@query
def geo_grid(spark, d):
    """The broadcast strategy by name."""
    return geo.assign_region(td.points(spark, d), td.boxes(spark, d), strategy="broadcast")


@query
def geo_range(spark, d):
    """The strategy for any number of boxes: a shuffle join on (level, cell)."""
    return geo.assign_region(td.points(spark, d), td.boxes(spark, d), strategy="shuffle")


# ---- tags per country ---------------------------------------------------------------------


def _pics(spark, d):
    return tags.pictures(td.photos(spark, d), td.boxes(spark, d))


@query
def tags_decode(spark, d):
    return td.photos(spark, d).select(
        "photo_id", F.posexplode(decode_tags(F.col("user_tags"))).alias("pos", "tag")
    )


@query
def photo_country_tags(spark, d):
    return _pics(spark, d).select("photo_id", "latitude", "longitude", "country", F.size("tags").alias("n_tags"))


@query
def photo_label(spark, d):
    return tags.label(_pics(spark, d)).select("photo_id", "country", "label")


@query
def country_photos(spark, d):
    return tags.country_photos(_pics(spark, d))


@query
def country_count(spark, d):
    return tags.country_count(_pics(spark, d))


@query
def country_tags(spark, d):
    return tags.country_tags(_pics(spark, d))


@query
def country_tag_freq(spark, d):
    return tags.country_tag_freq(_pics(spark, d))


@query
def photo_lines_tag_freq(spark, d):
    parsed = parse_photo_lines(td.photo_lines(spark, d))
    pics = tags.pictures(parsed, td.boxes(spark, d), keep=())
    return tags.country_tag_freq(pics)


@query
def country_top_tags(spark, d):
    """The ten most frequent tags of each country, found by bounded summaries and counted exactly."""
    each = _pics(spark, d).select("country", F.explode("tags").alias("tag"))
    return heavy.most_frequent(each, "country", "tag", k=10)


@query
def tags_published(spark, d):
    """Tag frequencies written twice to folders by country and read back: the second run writes nothing."""
    path = shared_path(spark, "published", uuid.uuid4().hex)
    ensure_checkpoint_dir(spark)
    freq = tags.country_tag_freq(_pics(spark, d)).checkpoint(eager=True)
    publish.publish(freq, path, ["country"])
    again = publish.publish(freq, path, ["country"])
    back = spark.read.parquet(path)
    return back.select("country", *[c for c in freq.columns if c != "country"], F.lit(again.written).alias("rewritten"))


# ---- scans of text ------------------------------------------------------------------------------


def _scan(spark, d, name):
    return ledger.scan_named(spark, textdata.written(spark, d, name), name)


@query
def scan_photos(spark, d):
    return _scan(spark, d, "photos").rows.select("photo_id", "user_id", "user_tags", "longitude", "latitude", "license", "marker")


@query
def scan_ratings(spark, d):
    return _scan(spark, d, "ratings").rows


@query
def scan_movies(spark, d):
    return _scan(spark, d, "movies").rows


@query
def scan_credit(spark, d):
    return _scan(spark, d, "credit").rows


@query
def scan_rejects(spark, d):
    """What the four scans reject, by reason and column."""
    out = None
    for name in textdata.TEXTS:
        found = ledger.summary(_scan(spark, d, name).rejects).select(F.lit(name).alias("source"), "reason", "column", "n")
        out = found if out is None else out.union(found)
    return out


@query
def ratings_complete(spark, d):
    """Ratings without a null, with what the pass that wrote them counted."""
    path = shared_path(spark, "complete", uuid.uuid4().hex)
    kept, _, n = validate.write_complete(textdata.loose_ratings(spark, d), ["user_id", "item_id", "rating"], path)
    return kept.select("*", *[F.lit(v).cast("long").alias(f"n_{c}") for c, v in sorted(n.items())])


# ---- ratings --------------------------------------------------------------------------------


SAMPLE_SEED = 42
SPLIT_SEED = 5


def _profile(spark, d, ratings=None):
    """The injected user's profile, written once to the shared checkpoint folder.

    Queries read it four to six times (mean, liked items, genre vector, norm, exclusions);
    a reliable checkpoint cuts that lineage so the ratings join behind it runs once.
    """
    ensure_checkpoint_dir(spark)
    return td.profile(spark, d, ratings).checkpoint(eager=True)


@query
def user_avg(spark, d):
    return R.user_avg(td.ratings(spark, d))


@query
def ratings_norm_user(spark, d):
    return R.normalize(td.ratings(spark, d), "user")


@query
def ratings_norm_max(spark, d):
    return R.normalize(td.ratings(spark, d), "max")


@query
def ratings_known(spark, d):
    return R.known(_profile(spark, d))


@query
def ratings_above_avg(spark, d):
    return R.above_avg(td.ratings(spark, d))


@query
def ratings_with_user(spark, d):
    norm = R.normalize(td.ratings(spark, d), "user")
    return R.with_new_user(norm, _profile(spark, d), td.PROFILE_USER_ID)


@query
def popular_items(spark, d):
    return R.popular_items(td.ratings(spark, d), td.items(spark, d), k=100)


@query
def sample_items(spark, d):
    return R.sample_items(R.popular_items(td.ratings(spark, d), td.items(spark, d), k=100), n=25, seed=SAMPLE_SEED)


@query
def hash_split(spark, d):
    return R.hash_split_column(td.ratings(spark, d), ["user_id", "item_id"], (0.8, 0.2), seed=SPLIT_SEED)


@query
def exact_split(spark, d):
    """Sides of exactly 80 and 20 % of the ratings."""
    return split.exact_split(td.ratings(spark, d), ["user_id", "item_id"], (0.8, 0.2), seed=SPLIT_SEED)


# ---- content-based nearest neighbours ---------------------------------------------------------


def _vectors(spark, d, liked=None):
    good = R.above_avg(td.ratings(spark, d)) if liked is None else liked
    return knn.user_vectors(good, knn.item_genres(td.items(spark, d)))


def _pvec(spark, d, prof):
    """Read for the products, the norm and the size check: written once (a row per genre)."""
    ensure_checkpoint_dir(spark)
    return knn.profile_vector(R.profile_good(prof), knn.item_genres(td.items(spark, d))).checkpoint(eager=True)


def _cosine(spark, d, prof, liked=None):
    return knn.user_cosine(_vectors(spark, d, liked), _pvec(spark, d, prof))


def _neighbours(spark, d, prof, liked=None, exclude=td.PROFILE_USER_ID):
    return knn.knn_users(_cosine(spark, d, prof, liked), k=5, exclude=exclude)


@query
def item_genres(spark, d):
    return knn.item_genres(td.items(spark, d))


@query
def user_vectors(spark, d):
    return _vectors(spark, d)


@query
def profile_good(spark, d):
    return R.profile_good(_profile(spark, d))


@query
def profile_vector(spark, d):
    """Genres of the profile's liked items, largest count first (``rank`` says which; ties by name)."""
    return knn.ranked_genres(_pvec(spark, d, _profile(spark, d)))


@query
def user_cosine(spark, d):
    return _cosine(spark, d, _profile(spark, d))


@query
def knn_users(spark, d):
    return _neighbours(spark, d, _profile(spark, d))


@query
def knn_recommend(spark, d):
    ensure_checkpoint_dir(spark)
    ratings = td.ratings(spark, d).checkpoint(eager=True)  # for the profile, the vectors and the neighbours' items
    prof = _profile(spark, d, ratings)
    return knn.knn_recommend(ratings, _neighbours(spark, d, prof, R.above_avg(ratings)), prof, td.items(spark, d))


@query
def knn_recommend_good(spark, d):
    prof = _profile(spark, d)
    ensure_checkpoint_dir(spark)
    liked = R.above_avg(td.ratings(spark, d)).checkpoint(eager=True)  # for the vectors and the neighbours' items
    return knn.knn_recommend(liked, _neighbours(spark, d, prof, liked), prof, td.items(spark, d))


@query
def knn_users_without_self(spark, d):
    """The profile's own user is in the table here, and is left out by id."""
    me = td.profile_user(td.ratings(spark, d)).first()["user_id"]
    return _neighbours(spark, d, _profile(spark, d), exclude=me)


@query
def knn_users_batch(spark, d):
    """The five nearest users of every user whose id is divisible by 100."""
    return neighbours.nearest_users(_vectors(spark, d), F.col("user") % 100 == 0, k=5)


@query
def top_items_all_users(spark, d):
    """The ten unseen items with the largest products of factors, for every user."""
    return factors.top_items(td.user_factors(spark, d), td.item_factors(spark, d), td.ratings(spark, d), n=10)


@query
def als_fold_in(spark, d):
    """Every user's two factors for fixed item factors."""
    folded = factors.fold_in(td.ratings(spark, d), td.item_taste(spark, d), rank=2, reg=0.1)
    return folded.select("user_id", *[F.round(F.get("features", F.lit(i)), 6).alias(f"x{i}") for i in range(2)])


# ---- metrics and validation -------------------------------------------------------------------


@query
def mse_pairs(spark, d):
    return metrics.mse(td.predicted(spark, d), "rating", "prediction")


@query
def mse_joined(spark, d):
    """Actual ratings joined with the predictions of the split's test side by (user, item): pairs of the train side have no
    prediction and vanish, pairs that were rated several times multiply."""
    _, scored = R.hash_split(td.predicted(spark, d), ["user_id", "item_id"], (0.8, 0.2), seed=SPLIT_SEED)
    return metrics.mse(metrics.join_predictions(td.ratings(spark, d), scored), "rating", "prediction")


@query
def ratings_norm_none(spark, d):
    return R.normalize(td.ratings(spark, d), "none")


@query
def split_survivors(spark, d):
    """Train and test rows of the split, and the test rows whose user and item were trained on."""
    train, test = R.hash_split(td.ratings(spark, d), ["user_id", "item_id"], (0.8, 0.2), seed=SPLIT_SEED)
    warm = test.join(train.select("user_id").distinct(), "user_id", "left_semi").join(
        train.select("item_id").distinct(), "item_id", "left_semi"
    )
    count = lambda df, side: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")
    return count(train, "train").union(count(test, "test")).union(count(warm, "survivors"))


@query
def auc_exact(spark, d):
    return metrics.auc(td.scored(spark, d), "label", "score")


@query
def exclude_seen(spark, d):
    ranked = R.item_counts(td.ratings(spark, d))
    top = R.exclude_seen(ranked, R.known(_profile(spark, d)), "n", n=20)
    return R.with_titles(top, td.items(spark, d))


@query
def validate_domain(spark, d):
    return validate.validate_int(td.answers(spark, d), "raw", lo=0, hi=5, blank_as=0)


# ---- ALS (model queries: rows-only checks) ------------------------------------------------------


ALS_SEED = 42
ALS_CONFIG = (8, 20, 0.01)  # rank, iterations, λ for the single-model queries


def _als_norm(spark, d):
    """User-normalised ratings; the model queries read them several times (id check, fit,
    evaluation), so they hold them in cache for the duration."""
    return R.normalize(td.ratings(spark, d), "user")


def _als_split(data):
    return R.hash_split(data, ["user_id", "item_id"], (0.8, 0.2), seed=SPLIT_SEED)


@query
def als_fit(spark, d):
    ensure_checkpoint_dir(spark)
    with released(spark), persisted(_als_norm(spark, d)) as (norm,):
        ids = als.IdMap(norm)
        with persisted(_als_split(ids.to_int(norm))[0]) as (train,):  # the split hashes each row: once
            model = als.fit(train, *ALS_CONFIG, seed=ALS_SEED)
        return ids.user_from_int(model.userFactors, "id").checkpoint(eager=True)


@query
def als_mse(spark, d):
    with released(spark), persisted(_als_norm(spark, d)) as (norm,):
        train, test = _als_split(als.IdMap(norm).to_int(norm))
        with persisted(train) as (train,):
            model = als.fit(train, *ALS_CONFIG, seed=ALS_SEED)
        row = als.evaluate_mse(model, test).first()
    return spark.createDataFrame([(row["mse"], row["n"])], "mse double, n long")


@query
def als_grid(spark, d):
    with released(spark), persisted(_als_norm(spark, d)) as (norm,):
        train, test = _als_split(als.IdMap(norm).to_int(norm))
        return als.grid_report(train, test, als.grid_configs(), seed=ALS_SEED)


@query
def als_recommend(spark, d):
    rank, iters, reg = als.CHOSEN_CONFIG
    with released(spark):
        return als.recommend_new_user(
            td.ratings(spark, d), _profile(spark, d), td.PROFILE_USER_ID, td.items(spark, d),
            n=20, rank=rank, max_iter=iters, reg=reg, seed=ALS_SEED,
        )


# ---- credit classifier --------------------------------------------------------------------------

CREDIT_SEED = classify.SEED


def _credit(spark, d):
    return shift_codes(td.credit_raw(spark, d), CREDIT_SHIFTED)


def _credit_model(spark, d):
    """The table (cached by the caller), its split, and the tuned model: fitted once per content of the table and
    saved in the shared folder, then loaded. The table's digest is part of the path."""
    df = _credit(spark, d).orderBy("id")  # the tuner's own split depends on the order of rows
    ensure_checkpoint_dir(spark)
    df = df.checkpoint(eager=True)
    row = F.xxhash64(*df.columns).cast("decimal(38,0)")
    digest = df.agg(F.sum(row).alias("h"), F.count(F.lit(1)).alias("n")).first()
    train, test = R.hash_split(df, ["id"], (0.75, 0.25), seed=CREDIT_SEED)
    path = shared_path(spark, "models", f"credit-{digest['n']}-{digest['h']}-seed{CREDIT_SEED}")

    def fit():
        with persisted(train) as (held,):
            return classify.build(df).fit(held)

    with released(spark):
        return df, train, test, fit_or_load(path, fit, classify.load)


@query
def credit_parse(spark, d):
    return _credit(spark, d)


@query
def label_index(spark, d):
    return classify.label_index(_credit(spark, d))


@query
def credit_features(spark, d):
    """The feature columns in the order in which the assembler takes them, with their sums."""
    df = _credit(spark, d)
    names = classify.feature_columns(df)
    each = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name"), F.col(c).cast("long").alias("v")) for i, c in enumerate(names)])
    rows = df.select(F.explode(each).alias("f"))
    return rows.groupBy(F.col("f.pos").alias("pos"), F.col("f.name").alias("name")).agg(F.sum("f.v").alias("total"))


def _scoring_input(spark, d):
    """Batch-scoring rows with what is wrong with each: the account state must be 0 to 3, the phone answer Y or N."""
    raw = _credit(spark, d).withColumn("account", F.col("balance").cast("int").cast("string"))
    raw = raw.withColumn("phone", F.when(F.col("hasPhone") == 1, "y").when(F.col("hasPhone") == 0, "N"))
    checked = validate.validate_int(raw, "account", lo=0, hi=3).withColumnsRenamed(
        {"value": "account_value", "is_valid": "account_valid", "reason": "account_reason"}
    )
    checked = validate.validate_choice(checked, "phone", ["Y", "N"])
    return checked.withColumn("is_valid", F.col("is_valid") & F.col("account_valid"))


@query
def credit_checked(spark, d):
    return _scoring_input(spark, d).select("id", "account_value", "account_reason", F.col("value").alias("phone_value"), F.col("reason").alias("phone_reason"), "is_valid")


@query
def credit_fit(spark, d):
    _, train, test, model = _credit_model(spark, d)
    return classify.best_params(model, train, test)


@query
def credit_score(spark, d):
    _, _, test, model = _credit_model(spark, d)
    return classify.score(model, test)


@query
def credit_score_nodes(spark, d):
    """Every customer scored by a forest that is a table of nodes."""
    df = _credit(spark, d)
    scored = forest.score_nodes(df, td.forest(spark), classify.feature_columns(df))
    return scored.select("id", "prediction", F.get("probability", F.lit(1)).alias("p1"))


@query
def credit_score_saved(spark, d):
    """Batch scoring by the saved model of the rows that pass the input check."""
    df, _, _, model = _credit_model(spark, d)
    valid, _ = validate.split_valid(_scoring_input(spark, d))
    return classify.score(model, df.join(valid.select("id"), "id", "left_semi"))
