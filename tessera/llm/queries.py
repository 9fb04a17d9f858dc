"""The registered queries of this folder and their DuckDB statements."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, bitpack, bpe, collocations, credentials, decontaminate, divergence, jaccard, license, quality, repeats, shards, urls
from tessera.llm.common import crc_of_id, small_batches, table

REGISTRY = {}
ORACLE: dict[str, str] = {}


def register(fn):
    @wraps(fn)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    REGISTRY[fn.__name__] = query
    return query


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@register
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, tokenizer("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register
def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shards.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), 16)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("matches", lambda m: m["kind"] == "exact")
    joined = lambda ms: F.array_join(F.sort_array(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    starts = F.transform(base, lambda m: m["first_word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
        F.transform("matches", lambda m: F.struct(m["label"], m["start"], m["end"], m["edits"])).alias("spans"),
    )


@register
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@register
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.token_index(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)


@register
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = urls.filter_urls(pages, urls.rule_table(spark, urls.LISTED), prefix="list_")
    judged = urls.filter_urls(listed, urls.rule_table(spark, urls.RULES))
    verdict = F.coalesce("verdict", "list_verdict", F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


@register
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@register
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@register
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), size=400)
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_of_id() % 5 == 0, F.lit(False))
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(~held))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "score", "predicted"
    )


@register
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=30, smoothing=5, scale=10**9, top=50)


@register
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, longest=4, share=80, top=2000)


@register
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = credentials.find_secrets(docs, credentials.fit(docs))
    named = lambda ms: F.array_join(F.transform(ms, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")
    count = lambda kind: F.size(F.filter("matches", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("matches", lambda m: m["kind"] != "markov")
    return found.select(
        "doc_id",
        *[count(kind) for kind in credentials.BASE],
        F.sha2(named(base).cast("binary"), 256).alias("base_sha256"),
        named(F.col("matches")).alias("spans"),
    )


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _case(listed: dict[str, str]) -> str:
    """The longest rule that fits, as SQL."""
    parts = []
    for rule in sorted(listed, key=len, reverse=True):
        host, slash, path = rule.partition("/")
        parts.append(f"WHEN (host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{slash}{path}') THEN '{rule}'")
    return f"CASE {' '.join(parts)} END"


def _verdict(column: str, listed: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in listed.items()) + " END"


ORACLE["op6_url_filter"] = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3 :] ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, {_case(urls.RULES)} AS rule, {_case(urls.LISTED)} AS listed FROM parts)
SELECT page_id, host, path, rule, coalesce({_verdict("rule", urls.RULES)}, {_verdict("listed", urls.LISTED)}, 'allow') AS verdict
FROM ruled"""

_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE["op7_decontaminate"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, w[i : i + least(13, len(w)) - 1] AS v
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
place AS (
  SELECT r, n, i, w[i : i + n - 1] AS v
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT len(v) AS n FROM win) WHERE len(w) >= n)),
found AS (SELECT place.r, place.n, place.i, win.item_id FROM place JOIN win ON place.v = win.v),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)"""

ORACLE["op8_jaccard_join"] = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, w[i : i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (
  SELECT c.a, c.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) c
  JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b
  WHERE 100 * shared >= 90 * (na.n + nb.n - shared)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n"""

ORACLE["op11_divergence"] = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (g.total + 5 * l.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, s.value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS a, y.source AS b, sum(abs(x.p - y.p)) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s
  ON s.lang = a.lang AND s.a = a.source AND s.b = b.source),
rows AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50"""

ORACLE["op12_collocations"] = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents),
p AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
g AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) s(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
t AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS MATERIALIZED (SELECT lang, phrase, k, f, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3)) s(m) WHERE m < k) GROUP BY ALL),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * c.f) // (x.f + y.f) AS score, j
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[j + 1 : c.k], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN t USING (lang)
WHERE rank <= 2000"""
