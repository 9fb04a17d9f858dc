"""DuckDB statements matching the named queries (same column names, same values).

Each statement starts from the adapter CTEs of ``tessera.sources.testdata.SQL`` over the
driver's pre-registered views. Arrays are emitted in long form.
"""

from __future__ import annotations

from tessera.sources.schemas import CREDIT_COLUMNS, CREDIT_LABEL, CREDIT_SHIFTED
from tessera.sources.testdata import with_ctes

# Per-point best box: inclusive containment, least centre distance, then lowest ord.
_HITS = """
  {name} AS (
    SELECT {pid} AS pid, b.code, CAST(b.ord AS BIGINT) AS ord,
           sqrt((b.c_lat - {lat}) * (b.c_lat - {lat}) + (b.c_lon - {lon}) * (b.c_lon - {lon})) AS d
    FROM {src} JOIN boxes b
      ON b.min_lat <= {lat} AND {lat} <= b.max_lat AND b.min_lon <= {lon} AND {lon} <= b.max_lon
    QUALIFY row_number() OVER (PARTITION BY {pid} ORDER BY d, ord) = 1)"""

_DECODED = (
    "CASE WHEN regexp_matches(regexp_replace(user_tags, '%[0-9A-Fa-f]{2}', '', 'g'), '%') THEN NULL "
    "ELSE string_split(regexp_replace(url_decode(replace(user_tags, '+', ' ')), ',+\\z', ''), ',') END"
)

_INTERESTING = """
  interesting AS (
    SELECT photo_id, longitude, latitude, license FROM photos
    WHERE marker = 0 AND longitude <> -1.0 AND latitude <> -1.0 AND license <> '')"""

_PICS = f"""
  pbase AS (
    SELECT photo_id, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
           {_DECODED} AS tags
    FROM photos),
{_HITS.format(name="phits", pid="p.photo_id", lat="p.latitude", lon="p.longitude", src="pbase p")},
  pics AS (
    SELECT p.photo_id, p.latitude, p.longitude, h.code AS country, p.tags
    FROM pbase p JOIN phits h ON p.photo_id = h.pid
    WHERE p.tags IS NOT NULL AND len(p.tags) > 0 AND NOT (len(p.tags) = 1 AND p.tags[1] = ''))"""


def _q(body: str, *tables: str, extra: str = "") -> str:
    sql = with_ctes("SELECT 1", *tables)
    head = sql[: sql.rindex("\nSELECT 1")]
    if extra:
        head = head + "," + extra
    return head + "\n" + body


ORACLE: dict[str, str] = {
    # photos
    "photo_project": _q(
        "SELECT photo_id, longitude, latitude, license FROM photos WHERE marker = 0", "photos"
    ),
    "photo_interesting": _q("SELECT * FROM interesting", "photos", extra=_INTERESTING),
    "photo_nonderivative": _q(
        """SELECT p.* FROM interesting p JOIN licenses l
           ON TRY_CAST(l.NonDerivative AS INTEGER) = 1 AND p.license = l.Name""",
        "photos", "licenses", extra=_INTERESTING,
    ),
    "photo_count": _q("SELECT count(*) AS n FROM photos", "photos"),
    "photo_head": _q("SELECT * FROM interesting ORDER BY photo_id LIMIT 5", "photos", extra=_INTERESTING),
    # geo
    "geo_assign": _q(
        """SELECT p.id, p.lon, p.lat, h.code AS region, h.ord AS region_ord
           FROM points p LEFT JOIN hits h ON p.id = h.pid""",
        "points", "boxes",
        extra=_HITS.format(name="hits", pid="p.id", lat="p.lat", lon="p.lon", src="points p"),
    ),
    # tags
    "tags_decode": _q(
        f"""SELECT photo_id, CAST(generate_subscripts(tags, 1) - 1 AS INTEGER) AS pos, unnest(tags) AS tag
            FROM (SELECT photo_id, {_DECODED} AS tags FROM photos) WHERE tags IS NOT NULL""",
        "photos",
    ),
    "photo_country_tags": _q(
        "SELECT photo_id, latitude, longitude, country, CAST(len(tags) AS INTEGER) AS n_tags FROM pics", "photos", "boxes", extra=_PICS
    ),
    "photo_label": _q(
        "SELECT photo_id, country, '(' || country || ', ' || array_to_string(tags, ', ') || ')' AS label FROM pics",
        "photos", "boxes", extra=_PICS,
    ),
    "country_photos": _q("SELECT country, photo_id FROM pics", "photos", "boxes", extra=_PICS),
    "country_count": _q("SELECT country, count(*) AS n FROM pics GROUP BY country", "photos", "boxes", extra=_PICS),
    "country_tags": _q(
        """SELECT country, photo_id, CAST(generate_subscripts(tags, 1) - 1 AS INTEGER) AS pos, unnest(tags) AS tag FROM pics""",
        "photos", "boxes", extra=_PICS,
    ),
    "country_tag_freq": _q(
        "SELECT country, tag, count(*) AS n FROM (SELECT country, unnest(tags) AS tag FROM pics) GROUP BY country, tag",
        "photos", "boxes", extra=_PICS,
    ),
}
ORACLE["geo_range"] = ORACLE["geo_assign"]
ORACLE["geo_grid"] = ORACLE["geo_assign"]
ORACLE["photo_nonderivative_sql"] = ORACLE["photo_nonderivative"]

# Raw lines: fields by position (0-based 8, 10, 11), non-numeric or missing fields → NULL.
_LINE_PICS = _PICS.replace(
    """    SELECT photo_id, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
           {decoded} AS tags
    FROM photos)""".format(decoded=_DECODED),
    """    SELECT row_number() OVER () AS photo_id, TRY_CAST(f[12] AS DOUBLE) AS latitude,
           TRY_CAST(f[11] AS DOUBLE) AS longitude, {decoded} AS tags
    FROM (SELECT f, coalesce(f[9], '') AS user_tags
          FROM (SELECT string_split(value, chr(9)) AS f FROM photo_lines)))""".format(decoded=_DECODED),
)
ORACLE["photo_lines_tag_freq"] = _q(
    "SELECT country, tag, count(*) AS n FROM (SELECT country, unnest(tags) AS tag FROM pics) GROUP BY country, tag",
    "photo_lines", "boxes", extra=_LINE_PICS,
)


# ---- ratings ----------------------------------------------------------------------------------

_AVG = "uavg AS (SELECT user_id, avg(rating) AS avg_rating, count(*) AS n FROM ratings GROUP BY user_id)"
_GOOD = f"""{_AVG},
  good AS (SELECT r.user_id, r.item_id, r.rating FROM ratings r JOIN uavg a ON r.user_id = a.user_id
           WHERE r.rating >= a.avg_rating)"""
_NORM = f"""{_AVG},
  norm AS (SELECT r.user_id, r.item_id, r.rating / a.avg_rating AS rating
           FROM ratings r JOIN uavg a ON r.user_id = a.user_id)"""
_PMEAN = "(SELECT avg(rating) FROM profile WHERE rating <> 0)"
_POPULAR = """
  popular AS (
    SELECT c.item_id, c.n, i.title
    FROM (SELECT item_id, count(*) AS n FROM ratings GROUP BY item_id ORDER BY n DESC, item_id LIMIT 100) c
    LEFT JOIN items i ON c.item_id = i.item_id)"""


def _hex8(seed: int, *cols: str) -> str:
    key = " || ':' || ".join([f"'{seed}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT)"


ORACLE.update(
    {
        "user_avg": _q("SELECT * FROM uavg", "ratings", extra=_AVG),
        "ratings_norm_user": _q("SELECT * FROM norm", "ratings", extra=_NORM),
        "ratings_norm_max": _q("SELECT user_id, item_id, rating / 5.0 AS rating FROM ratings", "ratings"),
        "ratings_known": _q("SELECT * FROM profile WHERE rating <> 0", "profile"),
        "ratings_above_avg": _q("SELECT * FROM good", "ratings", extra=_GOOD),
        "ratings_with_user": _q(
            f"""SELECT user_id, item_id, rating FROM norm
                UNION ALL
                SELECT CAST(-1 AS BIGINT), item_id, CAST(rating AS DOUBLE) / {_PMEAN} FROM profile WHERE rating <> 0""",
            "ratings", "profile", extra=_NORM,
        ),
        "popular_items": _q("SELECT * FROM popular", "ratings", "items", extra=_POPULAR),
        "sample_items": _q(
            f"SELECT * FROM popular ORDER BY {_hex8(42, 'item_id')}, item_id LIMIT 25",
            "ratings", "items", extra=_POPULAR,
        ),
        "hash_split": _q(
            f"""SELECT user_id, item_id, rating,
                       CASE WHEN {_hex8(5, 'user_id', 'item_id')} < {round(0.8 * 2**32)} THEN 0 ELSE 1 END AS split
                FROM ratings""",
            "ratings",
        ),
    }
)

# ---- content-based nearest neighbours ------------------------------------------------------------

_KNN = f"""{_GOOD},
  ig AS (SELECT item_id, unnest(string_split(regexp_replace(genres, '\\|+\\z', ''), '|')) AS genre FROM items),
  uv AS (SELECT g.user_id, ig.genre, count(*) AS n FROM good g JOIN ig ON g.item_id = ig.item_id
         GROUP BY g.user_id, ig.genre),
  pgood AS (SELECT * FROM profile WHERE rating <> 0 AND rating >= {_PMEAN}),
  pv AS (SELECT ig.genre, count(*) AS n FROM pgood g JOIN ig ON g.item_id = ig.item_id GROUP BY ig.genre),
  cos AS (
    SELECT user_id, sim FROM (
      SELECT u.user_id,
             CAST(sum(u.n * coalesce(p.n, 0)) AS DOUBLE)
               / (sqrt(CAST(sum(u.n * u.n) AS DOUBLE)) * (SELECT sqrt(CAST(sum(n * n) AS DOUBLE)) FROM pv)) AS sim
      FROM uv u LEFT JOIN pv p ON u.genre = p.genre GROUP BY u.user_id)
    WHERE sim IS NOT NULL AND NOT isnan(sim)),
  nn AS (SELECT * FROM cos WHERE user_id <> -1 ORDER BY sim DESC, user_id LIMIT 5)"""


def _recommend(src: str) -> str:
    return f"""
      SELECT t.item_id, t.avg_rating, t.n_ratings, i.title
      FROM (SELECT item_id, avg(rating) AS avg_rating, count(*) AS n_ratings
            FROM {src} r
            WHERE r.user_id IN (SELECT user_id FROM nn)
              AND r.item_id NOT IN (SELECT item_id FROM profile WHERE rating <> 0)
            GROUP BY item_id ORDER BY avg_rating DESC, item_id LIMIT 20) t
      LEFT JOIN items i ON t.item_id = i.item_id"""


_KT = ("ratings", "items", "profile")
ORACLE.update(
    {
        "item_genres": _q("SELECT * FROM ig", *_KT, extra=_KNN),
        "user_vectors": _q("SELECT * FROM uv", *_KT, extra=_KNN),
        "profile_good": _q("SELECT * FROM pgood", *_KT, extra=_KNN),
        "profile_vector": _q(
            "SELECT genre, n, CAST(row_number() OVER (ORDER BY n DESC, genre) AS INTEGER) AS rank FROM pv", *_KT, extra=_KNN
        ),
        "user_cosine": _q("SELECT * FROM cos", *_KT, extra=_KNN),
        "knn_users": _q("SELECT * FROM nn", *_KT, extra=_KNN),
        "knn_recommend": _q(_recommend("ratings"), *_KT, extra=_KNN),
        "knn_recommend_good": _q(_recommend("good"), *_KT, extra=_KNN),
    }
)


# ---- metrics and validation ---------------------------------------------------------------------

ORACLE.update(
    {
        "mse_pairs": _q(
            "SELECT avg((rating - prediction) * (rating - prediction)) AS mse, count(*) AS n FROM predicted",
            "predicted",
        ),
        "auc_exact": _q(
            """SELECT CAST(sum(p * (2 * below + q)) AS DOUBLE) / CAST(2 * sum(p) * sum(q) AS DOUBLE) AS auc,
                      CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(q) AS BIGINT) AS n_neg
               FROM (SELECT p, q, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                                        AND 1 PRECEDING), 0) AS below
                     FROM (SELECT score, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS p,
                                  sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS q
                           FROM scored GROUP BY score))""",
            "scored",
        ),
        "exclude_seen": _q(
            """SELECT t.item_id, t.n, i.title
               FROM (SELECT item_id, count(*) AS n FROM ratings
                     WHERE item_id NOT IN (SELECT item_id FROM profile WHERE rating <> 0)
                     GROUP BY item_id ORDER BY n DESC, item_id LIMIT 20) t
               LEFT JOIN items i ON t.item_id = i.item_id""",
            "ratings", "items", "profile",
        ),
        "validate_domain": _q(
            """SELECT id, raw, value, reason, reason IS NULL AS is_valid FROM (
                 SELECT id, raw, value,
                        CASE WHEN raw IS NULL THEN 'blank'
                             WHEN value IS NULL THEN 'not an integer'
                             WHEN NOT (value >= 0 AND value <= 5) THEN 'out of range' END AS reason
                 FROM (SELECT id, raw,
                              CASE WHEN raw = '' THEN 0
                                   WHEN regexp_full_match(raw, '[+-]?[0-9]+') THEN TRY_CAST(raw AS INTEGER) END AS value
                       FROM answers))""",
            "answers",
        ),
    }
)


# ---- credit table -------------------------------------------------------------------------------

_CREDIT = "credit AS (SELECT id, " + ", ".join(
    f'"{c}" - 1 AS "{c}"' if c in CREDIT_SHIFTED else f'"{c}"' for c in CREDIT_COLUMNS
) + " FROM credit_raw)"

ORACLE.update(
    {
        "credit_parse": _q("SELECT * FROM credit", "credit_raw", extra=_CREDIT),
        "label_index": _q(
            """SELECT creditability, n,
                      CAST(row_number() OVER (ORDER BY n DESC, CAST(creditability AS VARCHAR)) - 1 AS DOUBLE) AS label
               FROM (SELECT creditability, count(*) AS n FROM credit GROUP BY creditability)""",
            "credit_raw", extra=_CREDIT,
        ),
    }
)

ORACLE.update(
    {
        "ratings_norm_none": _q("SELECT * FROM ratings", "ratings"),
        "knn_users_without_self": _q(
            """SELECT * FROM cos WHERE user_id <> (SELECT user_id FROM profile_user) ORDER BY sim DESC, user_id LIMIT 5""",
            *_KT, "profile_user", extra=_KNN,
        ),
        "mse_joined": _q(
            """SELECT avg((r.rating - p.prediction) * (r.rating - p.prediction)) AS mse, count(*) AS n
               FROM ratings r JOIN predicted p ON r.user_id = p.user_id AND r.item_id = p.item_id
               WHERE """ + f"{_hex8(5, 'p.user_id', 'p.item_id')} >= {round(0.8 * 2**32)}",
            "ratings", "predicted",
        ),
        "split_survivors": _q(
            f"""SELECT 'train' AS side, count(*) AS n FROM sides WHERE side = 0
                UNION ALL SELECT 'test', count(*) FROM sides WHERE side = 1
                UNION ALL SELECT 'survivors', count(*) FROM sides WHERE side = 1
                  AND user_id IN (SELECT user_id FROM sides WHERE side = 0)
                  AND item_id IN (SELECT item_id FROM sides WHERE side = 0)""",
            "ratings",
            extra=f"""sides AS (SELECT user_id, item_id,
                CASE WHEN {_hex8(5, 'user_id', 'item_id')} < {round(0.8 * 2**32)} THEN 0 ELSE 1 END AS side FROM ratings)""",
        ),
        "credit_features": _q(
            " UNION ALL ".join(
                f"""SELECT {i} AS pos, '{c}' AS name, CAST(sum("{c}") AS BIGINT) AS total FROM credit"""
                for i, c in enumerate(c for c in CREDIT_COLUMNS if c != CREDIT_LABEL)
            ),
            "credit_raw", extra=_CREDIT,
        ),
        "credit_checked": _q(
            """SELECT id, CAST(balance AS INTEGER) AS account_value,
                      CASE WHEN balance IS NULL THEN 'blank' WHEN NOT balance BETWEEN 0 AND 3 THEN 'out of range' END AS account_reason,
                      CASE WHEN "hasPhone" = 1 THEN 'Y' WHEN "hasPhone" = 0 THEN 'N' END AS phone_value,
                      CASE WHEN "hasPhone" IS NULL OR "hasPhone" NOT IN (0, 1) THEN 'blank' END AS phone_reason,
                      coalesce(balance BETWEEN 0 AND 3, false) AND coalesce("hasPhone" IN (0, 1), false) AS is_valid
               FROM credit""",
            "credit_raw", extra=_CREDIT,
        ),
    }
)

# ---- many users at once, factors, a forest's nodes ----------------------------------------------

_FEATURES = "CASE feature " + " ".join(f"""WHEN '{c}' THEN "{c}" """ for c in CREDIT_COLUMNS if c != CREDIT_LABEL) + " END"
ORACLE.update(
    {
        "knn_users_batch": _q(
            """SELECT profile_id, CAST(rank AS INTEGER) AS rank, user_id, sim FROM (
                 SELECT p.user_id AS profile_id, u.user_id, coalesce(d.dot, 0) / (u.norm * p.norm) AS sim,
                        row_number() OVER (PARTITION BY p.user_id ORDER BY coalesce(d.dot, 0) / (u.norm * p.norm) DESC, u.user_id) AS rank
                 FROM norms p JOIN norms u ON p.user_id % 100 = 0 AND p.user_id <> u.user_id
                 LEFT JOIN dots d ON d.p = p.user_id AND d.u = u.user_id)
               WHERE rank <= 5""",
            *_KT,
            extra=_KNN + """,
              norms AS (SELECT user_id, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM uv GROUP BY user_id),
              dots AS (SELECT a.user_id AS p, b.user_id AS u, CAST(sum(a.n * b.n) AS DOUBLE) AS dot
                       FROM uv a JOIN uv b ON a.genre = b.genre WHERE a.user_id % 100 = 0 GROUP BY ALL)""",
        ),
        "top_items_all_users": _q(
            """SELECT user_id, CAST(rank AS INTEGER) AS rank, item_id, score FROM (
                 SELECT u.user_id, i.item_id, list_dot_product(u.features, i.features) AS score,
                        row_number() OVER (PARTITION BY u.user_id ORDER BY list_dot_product(u.features, i.features) DESC, i.item_id) AS rank
                 FROM user_factors u, item_factors i
                 WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = u.user_id AND r.item_id = i.item_id))
               WHERE rank <= 10""",
            "ratings", "user_factors", "item_factors",
        ),
        "als_fold_in": _q(
            """SELECT user_id, round((d * p - b * q) / (a * d - b * b), 6) AS x0, round((a * q - b * p) / (a * d - b * b), 6) AS x1
               FROM (SELECT user_id, sum(x * x) + 0.1::DOUBLE * count(*) AS a, sum(x * y) AS b, sum(y * y) + 0.1::DOUBLE * count(*) AS d,
                            sum(x * rating) AS p, sum(y * rating) AS q
                     FROM ratings JOIN item_taste USING (item_id) GROUP BY user_id)""",
            "ratings", "item_taste",
        ),
        "credit_score_nodes": _q(
            f"""SELECT id, CAST(CASE WHEN sum(p) > sum(1 - p) THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
                       CAST(sum(p) / (sum(p) + sum(1 - p)) AS DOUBLE) AS p1
                FROM (SELECT id, tree, CAST(p AS DOUBLE) AS p FROM walk WHERE feature IS NULL) GROUP BY id""",
            "credit_raw", "forest",
            extra=f"""
              {_CREDIT},
              values_ AS (SELECT c.id, f.tree, f.node, f.feature, f.threshold, f.l, f.r, f.p, {_FEATURES} AS v FROM credit c, forest f),
              w0 AS (SELECT * FROM values_ WHERE node = 0),
              w1 AS (SELECT x.* FROM w0 JOIN values_ x ON x.id = w0.id AND x.tree = w0.tree AND x.node = CASE WHEN w0.v <= w0.threshold THEN w0.l ELSE w0.r END),
              w2 AS (SELECT x.* FROM w1 JOIN values_ x ON x.id = w1.id AND x.tree = w1.tree AND x.node = CASE WHEN w1.v <= w1.threshold THEN w1.l ELSE w1.r END),
              w3 AS (SELECT x.* FROM w2 JOIN values_ x ON x.id = w2.id AND x.tree = w2.tree AND x.node = CASE WHEN w2.v <= w2.threshold THEN w2.l ELSE w2.r END),
              walk AS (SELECT * FROM w0 UNION ALL SELECT * FROM w1 UNION ALL SELECT * FROM w2 UNION ALL SELECT * FROM w3)""",
        ),
    }
)

# ---- text scans, exact sides, heavy tags ---------------------------------------------------------

_HUNDREDTHS = "(CASE WHEN {v} < 0 THEN '-' ELSE '' END || CAST(abs({v}) // 100 AS VARCHAR) || '.' || lpad(CAST(abs({v}) % 100 AS VARCHAR), 2, '0'))"
_LON_TEXT = f"CASE WHEN photo_id % 11 = 0 THEN '-1.00' ELSE {_HUNDREDTHS.format(v='((photo_id * 7919) % 36000 - 18000)')} END"
_LAT_TEXT = f"CASE WHEN photo_id % 17 = 0 THEN '-1.00' ELSE {_HUNDREDTHS.format(v='((photo_id * 104729) % 18000 - 9000)')} END"
_KEY48 = "CAST(('0x' || md5(concat_ws(':', '5', {cols}))[1:12]) AS BIGINT)"
_PAIR = "CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR)"
ORACLE.update(
    {
        "scan_photos": _q(
            f"""SELECT photo_id, user_id, nullif(user_tags, '') AS user_tags, CAST({_LON_TEXT} AS FLOAT) AS longitude,
                       CAST({_LAT_TEXT} AS FLOAT) AS latitude, nullif(license, '') AS license, marker
                FROM photos WHERE photo_id % 23 <> 0 AND photo_id % 29 <> 0 AND photo_id % 31 <> 0""",
            "photos",
        ),
        "scan_ratings": _q("SELECT user_id, item_id, rating FROM ratings WHERE item_id % 41 <> 0", "ratings"),
        "scan_movies": _q("SELECT item_id, title || ', a \"part\"' AS title, genres FROM items WHERE item_id % 43 <> 0", "items"),
        "scan_credit": _q(
            "SELECT * EXCLUDE (id) FROM credit WHERE id % 19 <> 0 AND id % 37 <> 0", "credit_raw", extra=_CREDIT
        ),
        "scan_rejects": _q(
            """SELECT source, reason, "column", count(*) AS n FROM (
                 SELECT 'photos' AS source, CASE WHEN photo_id % 23 = 0 THEN 'too few fields' WHEN photo_id % 31 = 0 THEN 'too many fields'
                        ELSE 'bad value' END AS reason, CASE WHEN photo_id % 23 <> 0 AND photo_id % 31 <> 0 THEN 'longitude' END AS "column"
                 FROM photos WHERE photo_id % 23 = 0 OR photo_id % 29 = 0 OR photo_id % 31 = 0
                 UNION ALL SELECT 'credit', CASE WHEN id % 37 = 0 THEN 'too few fields' ELSE 'bad value' END, CASE WHEN id % 37 <> 0 THEN 'amount' END
                 FROM credit_raw WHERE id % 19 = 0 OR id % 37 = 0
                 UNION ALL SELECT 'ratings', 'bad value', 'rating' FROM ratings WHERE item_id % 41 = 0
                 UNION ALL SELECT 'movies', 'bad value', 'movieId' FROM items WHERE item_id % 43 = 0)
               GROUP BY ALL""",
            "photos", "credit_raw", "ratings", "items",
        ),
        "ratings_complete": _q(
            """SELECT user_id, item_id, rating, (SELECT count(*) FROM k) AS n_kept, (SELECT count(*) FILTER (user_id IS NULL) FROM loose) AS n_null_user_id,
                      (SELECT count(*) FILTER (item_id IS NULL) FROM loose) AS n_null_item_id,
                      (SELECT count(*) FILTER (rating IS NULL) FROM loose) AS n_null_rating, (SELECT count(*) FROM loose) AS n_rows
               FROM k""",
            "ratings",
            extra="""
              loose AS (SELECT CASE WHEN item_id % 53 <> 0 THEN user_id END AS user_id, CASE WHEN user_id % 59 <> 0 THEN item_id END AS item_id,
                               CASE WHEN (user_id + item_id) % 47 <> 0 THEN rating END AS rating FROM ratings),
              k AS (SELECT * FROM loose WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL)""",
        ),
        "exact_split": _q(
            f"""SELECT user_id, item_id, rating, CAST(CASE WHEN row_number() OVER (ORDER BY a, b) <= round(0.8 * n) THEN 0 ELSE 1 END AS INTEGER) AS split
                FROM (SELECT *, {_KEY48.format(cols=_PAIR)} AS a, {_KEY48.format(cols=_PAIR + ', CAST(rating AS VARCHAR)')} AS b, count(*) OVER () AS n
                      FROM ratings)""",
            "ratings",
        ),
        "country_top_tags": _q(
            """SELECT country, CAST(rank AS INTEGER) AS rank, tag, n FROM (
                 SELECT country, tag, count(*) AS n, row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, tag) AS rank
                 FROM (SELECT country, unnest(tags) AS tag FROM pics) GROUP BY country, tag)
               WHERE rank <= 10""",
            "photos", "boxes", extra=_PICS,
        ),
        "tags_published": _q(
            "SELECT country, tag, count(*) AS n, 0 AS rewritten FROM (SELECT country, unnest(tags) AS tag FROM pics) GROUP BY country, tag",
            "photos", "boxes", extra=_PICS,
        ),
    }
)
