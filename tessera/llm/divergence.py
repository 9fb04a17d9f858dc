"""How the sources of a language differ in their words: count-cell ranking.

Terms are runs of ASCII letters (lower-cased) and characters beyond ASCII. Each language keeps the terms that at least
``min_docs`` of its documents hold. A group (language, source) gives a kept term with ``n`` occurrences the share
p = 1 + floor(scale * (n + smoothing) / (N + smoothing * V)), in whole numbers; so does the language as a whole (q).

* ``term`` rows: the terms that a group uses more than its language does, by p - q. All terms with equal (group count,
  language count) make one cell with one value, so only cells are ranked: values of cells are merged, the first ``top``
  values of each group are kept by their cumulative multiplicity, and only those cells are expanded to terms, in UTF-8 order.
* ``pair`` rows: for each other source of the language the sum of abs(p - p') over all kept terms. Sources are dealt to
  tiles by hash and terms to buckets; a task adds up one bucket for one pair of tiles as a matrix, a term that no source of
  either tile has counts as abs(zero - zero') without being sent.

Skew: occurrences are counted per task before any shuffle, which is keyed by (language, term); a source or language with a
third of the documents has at most one row per term after that, and a language's terms are dealt to buckets of bounded size.
The number of ``pair`` rows is the square of a language's sources: that is the result asked for.

Edge cases: null text, language or source count as empty strings, which are a language and a source like any others; repeated
rows are documents of their own; a group without kept terms has ``pair`` rows (value from its smoothing alone; 0 if its language
keeps none) and no ``term`` rows; a language with one source has no ``pair`` rows; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import slices, tidy, written
from tessera.llm.words import byte_table, cut_at_spaces

MIN_DOCS = 30
SMOOTHING = 5
SCALE = 10**9
TOP = 50
#: Entries of a task's counters before they are sent on.
ENTRIES = 1 << 18
#: Sources of a tile and terms of a bucket, on average (both are dealt by hash).
TILE, BUCKET = 64, 2048
LETTERS = byte_table(lower=True, keep=lambda b: b >= 0x80 or chr(b).isalpha())


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), df (documents), added up per task only. ``docs``: lang, source, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, df) in held.items():
                if n:
                    cols = [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(list(n), pa.binary()).cast(pa.string())]
                    cols += [pa.array(list(n.values()), pa.int64()), pa.array([df[t] for t in n], pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols, names=["lang", "source", "term", "n", "df"])
            held.clear()

        for part, texts in slices(batches):
            for lang, source, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, strict=True):
                n, df = held.setdefault((lang, source), (Counter(), Counter()))
                in_doc: set[bytes] = set()
                for piece in cut_at_spaces(text.translate(LETTERS)):
                    terms = piece.split()
                    n.update(terms)
                    in_doc.update(terms)
                df.update(in_doc)
            if sum(len(n) for n, _ in held.values()) > ENTRIES:
                yield from flush()
        yield from flush()

    return docs.select("lang", "source", "text").mapInArrow(tidy(run), "lang string, source string, term string, n long, df long")


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """lang, source, term, n, lang_n of the terms that a language keeps; a row per (group, term) with n > 0."""
    per_term = Window.partitionBy("lang", "term")  # at most one row per source
    return (
        counted(docs)
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
        .select("lang", "source", "term", "n", F.sum("n").over(per_term).alias("lang_n"), F.sum("df").over(per_term).alias("lang_df"))
        .where(F.col("lang_df") >= min_docs)
        .drop("lang_df")
    )


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """A row per (lang, source) of ``docs``: total (of its kept terms), lang_total and v (kept terms of the language)."""
    by_lang = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("v"))
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct()
    return groups.join(by_lang, "lang", "left").join(by_group, ["lang", "source"], "left").na.fill(0, ["lang_total", "v", "total"])


def share(count: str, total: str, smoothing: int, scale: int) -> F.Column:
    """p, exactly: products may pass 64 bits."""
    up = f"cast({count} + {smoothing} as decimal(19,0)) * cast({scale} as decimal(18,0))"
    return F.expr(f"1 + ({up}) div cast({total} + {smoothing} * v as decimal(19,0))")


def term_rows(kept: DataFrame, totals: DataFrame, smoothing: int, scale: int, top: int) -> DataFrame:
    group = ["lang", "source"]
    cells = kept.groupBy(*group, "n", "lang_n").agg(F.count(F.lit(1)).alias("m")).join(totals, group)
    p, q = share("n", "total", smoothing, scale), share("lang_n", "lang_total", smoothing, scale)
    cells = written(cells.select(*group, "n", "lang_n", "m", (p - q).alias("value")).where("value > 0"), "divergence-cells")
    merged = cells.groupBy(*group, "value").agg(F.sum("m").alias("m"))
    down = Window.partitionBy(*group).orderBy(F.desc("value"))
    # each value has a term at least: no rank up to `top` lies beyond the first `top` values
    first = merged.withColumn("i", F.row_number().over(down)).where(F.col("i") <= top)
    before = F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, -1))
    first = first.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top).select(*group, "value", "before")
    chosen = cells.join(first, [*group, "value"]).select(*group, "n", "lang_n", "value", "before")
    inside = F.row_number().over(Window.partitionBy(*group, "value").orderBy("term"))
    terms = kept.join(chosen, [*group, "n", "lang_n"]).withColumn("i", inside).where(F.col("i") <= top)
    ranked = terms.withColumn("rank", (F.col("before") + F.col("i")).cast("int")).where(F.col("rank") <= top)
    return ranked.select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


TILE_SUMS = "lang string, a string, b string, zero_a long, zero_b long, v long, s long, seen long"


def tile_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """The sums of one bucket of terms for all pairs of sources of two tiles. ``rows``: lang, i, j, bucket, tile,
    source, v, term (null: a source of the tiles, with the share x of a term it has not), x."""
    lang, i, j, v = rows["lang"].iloc[0], rows["i"].iloc[0], rows["j"].iloc[0], rows["v"].iloc[0]
    roster = rows[rows["term"].isna()].sort_values("source")
    names, tile, zero = roster["source"].to_numpy(), roster["tile"].to_numpy(), roster["x"].to_numpy(np.int64)
    entries = rows[rows["term"].notna()]
    term, _ = pd.factorize(entries["term"])
    at = pd.Index(names).get_indexer(entries["source"])
    seen = int(term.max()) + 1 if len(term) else 0
    shares = np.tile(zero, (seen, 1))
    shares[term, at] = entries["x"].to_numpy(np.int64)
    out = []
    for a in np.flatnonzero(tile == i):
        b = np.flatnonzero(tile == j)
        b = b[b > a] if i == j else b
        s = np.abs(shares[:, [a]] - shares[:, b]).sum(axis=0)
        out.append(pd.DataFrame({"lang": lang, "a": names[a], "b": names[b], "zero_a": zero[a], "zero_b": zero[b], "v": v, "s": s, "seen": seen}))
    return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in TILE_SUMS.split(", ")])


def pair_rows(kept: DataFrame, totals: DataFrame, smoothing: int, scale: int) -> DataFrame:
    per_lang = totals.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    dealt = totals.join(per_lang, "lang").select(
        "lang", "source", "total", "v",
        F.ceil(F.col("sources") / TILE).cast("int").alias("tiles"),
        F.greatest(F.ceil(F.col("v") / BUCKET), F.lit(1)).cast("int").alias("buckets"),
    )
    dealt = dealt.withColumn("tile", F.expr("cast(pmod(xxhash64(source), tiles) as int)"))
    zero = F.when(F.col("v") > 0, share("0L", "total", smoothing, scale)).otherwise(0)
    roster = dealt.select("lang", "source", "tile", "tiles", "v", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"), F.lit(None).cast("string").alias("term"), zero.alias("x"))
    entries = kept.join(dealt, ["lang", "source"]).select("lang", "source", "tile", "tiles", "v", F.expr("cast(pmod(xxhash64(term), buckets) as int)").alias("bucket"), "term", share("n", "total", smoothing, scale).alias("x"))
    with_tile = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda u: F.struct(F.least(u, "tile").alias("i"), F.greatest(u, "tile").alias("j")))
    both = roster.unionByName(entries).withColumn("ij", F.explode(with_tile))
    rows = both.select("lang", F.col("ij.i").alias("i"), F.col("ij.j").alias("j"), "bucket", "tile", "source", "v", "term", "x")
    sums = rows.groupBy("lang", "i", "j", "bucket").applyInPandas(tile_sums, TILE_SUMS)
    added = sums.groupBy("lang", "a", "b", "zero_a", "zero_b", "v").agg(F.sum("s").alias("s"), F.sum("seen").alias("seen"))
    value = F.expr("s + (v - seen) * abs(zero_a - zero_b)")
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = added.select("lang", F.explode(ways).alias("w"), value.alias("value")).select("lang", "w.source", "w.item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, smoothing: int = SMOOTHING, scale: int = SCALE, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank: see the module's text. ``scale`` is below 10^18."""
    plain = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = written(kept_terms(plain, min_docs), "divergence-terms")
    totals = written(group_totals(plain, kept), "divergence-groups")
    return pair_rows(kept, totals, smoothing, scale).unionByName(term_rows(kept, totals, smoothing, scale, top))
