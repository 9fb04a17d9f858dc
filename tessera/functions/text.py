"""Text expressions: form-decoded tag lists, genre lists, display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import as_col


def url_form_decode(c) -> Column:
    """``application/x-www-form-urlencoded`` decoding (``+`` is a space, ``%XX`` a UTF-8 byte).

    A malformed escape gives NULL instead of failing the job.
    """
    return F.try_url_decode(as_col(c))


def decode_tags(c) -> Column:
    """Decode a comma list of tags, then split it.

    Decoding happens before splitting, so an encoded comma (``%2C``) separates tags. Trailing
    empty entries are dropped and inner ones kept, as ``String.split`` does on the JVM.
    """
    decoded = url_form_decode(c)
    return F.split(F.regexp_replace(decoded, r",+\z", ""), ",")


def has_tags(tags) -> Column:
    """At least one tag, and not just a single empty one. NULL lists count as no tags."""
    # [] and [""] are the only lists that join to "" — one reference to the list keeps the
    # predicate cheap when Catalyst pushes it below the decoding projection.
    return F.coalesce(F.array_join(as_col(tags), ",") != F.lit(""), F.lit(False))


def split_genres(c) -> Column:
    """Split a ``|``-separated genre string; trailing empty entries are dropped."""
    return F.split(F.regexp_replace(as_col(c), r"\|+\z", ""), r"\|")


def photo_label(country, tags) -> Column:
    """Display text ``(CC, t1, t2, ...)`` of a located photo."""
    return F.concat(F.lit("("), as_col(country), F.lit(", "), F.array_join(as_col(tags), ", "), F.lit(")"))


def param_label(rank, iterations, reg) -> Column:
    """``Rank{r}Iteration{i}Lambda{l:.2f}`` — the key a tuned model is saved under."""
    return F.format_string("Rank%dIteration%dLambda%.2f", as_col(rank), as_col(iterations), as_col(reg))
