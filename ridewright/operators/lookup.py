"""Keyed lookups: every point read of the business flow is one equi-join here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Words in the names of types whose values have no order.
UNORDERED = ("map<", "variant", "interval", "geometry", "geography")


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in ``order``; among equals the least by the other columns.

    An aggregate, not a window: rows of one key are reduced before the shuffle, so a key holding
    most of the table costs no more than any other. The columns of ``order`` are shuffled once, as
    part of the row; where another column has no order, beside it, and equals may give either row.
    """
    rest = [c for c in df.columns if c not in keys]
    ahead = F.struct(*dict.fromkeys(order)).alias("_order")
    others = [c for c in rest if c not in order]
    if any(word in kind for name, kind in df.dtypes if name in others for word in UNORDERED):
        first = F.min_by(F.struct(ahead, *others), F.struct(*order))
    else:
        first = F.min(F.struct(ahead, *others))
    taken = [F.col("_row._order" if c in order else "_row")[c].alias(c) for c in rest]
    return df.groupBy(*keys).agg(first.alias("_row")).select(*keys, *taken)


def latest_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The last row of each key by ``version``; pre-aggregated like :func:`one_per_key`."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*version))
    return df.groupBy(*keys).agg(last.alias("_row")).select(*keys, "_row.*")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    *,
    take: Sequence[str],
    keep_misses: bool = False,
    defaults: Mapping[str, Column] | None = None,
    first_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add the columns ``take`` of ``dim`` to ``df`` by key.

    ``on`` maps a column of ``df`` to the key of ``dim`` (or lists shared names). Rows without a
    match are dropped, or kept with ``defaults`` when ``keep_misses`` is set. Give ``first_by``
    when the key of ``dim`` may repeat; otherwise it has to be unique.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {name: name for name in on}
    keys = list(pairs.values())
    narrow = dim.select(*dict.fromkeys([*keys, *take, *(first_by or [])]))
    if first_by:
        narrow = one_per_key(narrow, keys, first_by)
    picked = narrow.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(f"_dim_{c}") for c in take]
    )
    match = [df[left] == picked[f"_key_{right}"] for left, right in pairs.items()]
    joined = df.join(picked, match, "left" if keep_misses else "inner")
    defaults = defaults or {}
    added = {
        c: F.coalesce(F.col(f"_dim_{c}"), defaults[c]) if c in defaults else F.col(f"_dim_{c}")
        for c in take
    }
    kept = [F.col(c) for c in df.columns if c not in added]
    return joined.select(*kept, *[value.alias(c) for c, value in added.items()])
