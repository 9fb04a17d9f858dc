"""File sinks. All write through Spark's committers (one file per task unless asked)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Suppresses the ``_SUCCESS`` marker file of the Hadoop output committer.
_NO_SUCCESS_MARKER = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def write_tsv(df: DataFrame, path: str, single_file: bool = False, success_marker: bool = False) -> None:
    """Tab-separated with a header, overwriting ``path``.

    ``single_file`` funnels the output through one task (``coalesce(1)``); use it only for
    small results.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").option("header", True).option("sep", "\t")
    if not success_marker:
        writer = writer.options(**_NO_SUCCESS_MARKER)
    writer.csv(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Comma-separated with a header. Fields holding a comma or a quote are quoted, and embedded
    quotes are doubled, so titles round-trip through ``read_movies`` / ``read_user_input``."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_user_ratings(df: DataFrame, path: str, single_file: bool = False) -> None:
    """One user's ``item_id, title, rating`` as CSV; unknown ratings (0) are not written."""
    write_csv(
        df.filter(F.col("rating") != 0).select(
            F.col("item_id").alias("movieId"), "title", "rating"
        ),
        path,
        single_file=single_file,
    )


def write_report(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Space-separated metrics report with a header (``rank iteration lambda mse``).

    Numbers are written with ``.`` decimals whatever the locale.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", " ").csv(path)
