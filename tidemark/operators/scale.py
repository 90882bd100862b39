"""Skew and size: what the operators share to stay whole on hot keys.

Windows have no skew handling of their own: all rows of a key meet in one task.
So per-key maxima are aggregated (map-side first) and joined back, and the
neighbours of a row are found in pieces that exist for every key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored


def skew_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str
) -> DataFrame:
    """Equality join, null equal to null, whose hot keys adaptive execution can split.

    It splits a hot partition only where both sides were shuffled for the join.
    Null-safe keys are computed, so a side that already lies by key, such as an
    aggregate, is shuffled all the same.
    """
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in on]
    return left.join(right, reduce(lambda a, b: a & b, pairs), how)


def with_group_max(
    df: DataFrame, value: str, keys: Sequence[str], name: str, few_groups: bool = False
) -> DataFrame:
    """Add the largest `value` of the row's group, null keys forming a group.

    `few_groups` says that the groups are likely few. They are then written once,
    so that Spark knows their bytes and broadcasts them by its own threshold.
    """
    named = {k: f"_of_{k}" for k in keys}
    peaks = df.groupBy(*[F.col(k).alias(n) for k, n in named.items()]).agg(
        F.max(value).alias(name)
    )
    if few_groups:
        peaks = stored(peaks)
    return skew_join(df, peaks, list(named.items()), "left").drop(*named.values())


FILTER_WORDS = 1 << 20  # 8 MB: what a filter takes at most, whatever the number of keys
BITS_PER_KEY = 16
SHIFTS = (0, 19, 38)  # parts of a key's hash that each choose a bit


def _places(hashed: Column, words: Column) -> list[Column]:
    """Bits that the hash of a key sets in a filter of so many 64-bit words."""
    return [F.pmod(F.shiftrightunsigned(hashed, n), words.cast("long") * 64) for n in SHIFTS]


def bloom_filter(keys: DataFrame, columns: Sequence[str]) -> Column:
    """A Bloom filter of the keys as one array of 64-bit words, for `may_hold`.

    It is computed with the query that uses it, as a scalar subquery, and goes to all
    tasks. Its size is `BITS_PER_KEY` bits for each key, which lets through one of some
    200 others, and `FILTER_WORDS` at most; beyond that it lets through more.
    """
    counted = keys.agg(F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / 64).alias("_tm_n"))
    size = counted.select(F.least(F.greatest("_tm_n", F.lit(1)), F.lit(FILTER_WORDS)).cast("int").alias("_tm_words"))
    places = F.array(*_places(F.col("_tm_hash"), F.col("_tm_words")))
    hashes = keys.select(F.xxhash64(*columns).alias("_tm_hash"))
    bits = hashes.join(F.broadcast(size)).select(F.explode(places).alias("at")).select(  # one row
        F.shiftright("at", 6).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int")).alias("bits"),
    )
    empty = size.select(
        F.explode(F.sequence(F.lit(0), F.col("_tm_words") - 1)).alias("word"), F.lit(0).cast("long").alias("bits")
    )
    words = bits.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"])
    return words.agg(listed.alias("filter")).scalar()


def may_hold(held: Column, hashed: Column) -> Column:
    """Whether the key of an `xxhash64` may be in a Bloom filter; true for all that are."""
    return reduce(
        lambda a, b: a & b,
        [
            F.call_function("shiftrightunsigned", F.get(held, F.shiftright(at, 6).cast("int")), at.bitwiseAND(63).cast("int"))
            .bitwiseAND(1) == 1
            for at in _places(hashed, F.size(held))
        ],
    )


def _plain(column: str) -> Column:
    """A key that is null-safe in plain equality, so that windows and joins share one shuffle."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def neighbours(
    df: DataFrame,
    key: str,
    date: str,
    name: str,
    rest: Sequence[str],
    columns: Sequence[str],
    lowest_highest: Column | None = None,
    per_key: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Distinct rows with structs `previous` and `following` of `columns`: the rows
    before and after in their key, in order of date, name and the rest.

    Rows are shuffled once, by (key, date, name), where copies are dropped and the
    neighbours inside a name are found. Of each name only the first and last row go
    on to the windows over the names of a date, and of each date only its first and
    last row to the window over the dates of a key, which the calendar bounds. So
    every key is cut alike, however many rows it has. `key` must not be null.

    With `lowest_highest`, the smallest and largest value of that column on each date
    are found along the way, as `_low` and `_high`; `per_key` are aggregates of them
    over the dates of a key, which are added to its rows.
    """
    per_key = dict(per_key or {})
    spread = F.lit(None).cast("string") if lowest_highest is None else lowest_highest
    on = {"_d": _plain(date), "_n": _plain(name)}
    levels = [[key, "_d", "_n"], [key, "_d"], [key]]
    payload, place = F.struct(*columns), F.struct(*rest) if rest else F.struct(F.lit(0))
    whole = [c for c in df.columns]

    inside = Window.partitionBy(*levels[0]).orderBy(*rest) if rest else None
    placed = df.withColumns(on).repartition(*levels[0])
    rows = placed.dropDuplicates([*whole, "_d", "_n"]).withColumns(
        {
            "_before": F.lag(payload).over(inside) if rest else F.lit(None),
            "_after": F.lead(payload).over(inside) if rest else F.lit(None),
        }
    )
    names = placed.groupBy(*levels[0]).agg(  # copies change nothing here
        F.min_by(payload, place).alias("_first"),
        F.max_by(payload, place).alias("_last"),
        F.first(date).alias("_date"),
        F.first(name).alias("_name"),
        F.min(spread).alias("_low"),
        F.max(spread).alias("_high"),
    )
    on_date = Window.partitionBy(*levels[1]).orderBy("_name")
    names = names.withColumns(
        {"_name_before": F.lag("_last").over(on_date), "_name_after": F.lead("_first").over(on_date)}
    )
    by_name = F.struct("_name")
    dates = names.groupBy(*levels[1]).agg(
        F.min_by("_first", by_name).alias("_first"),
        F.max_by("_last", by_name).alias("_last"),
        F.first("_date").alias("_date"),
        F.min("_low").alias("_low"),
        F.max("_high").alias("_high"),
    )
    along, throughout = Window.partitionBy(key).orderBy("_date"), Window.partitionBy(key)
    dates = dates.select(
        *levels[1],
        F.lag("_last").over(along).alias("_date_before"),
        F.lead("_first").over(along).alias("_date_after"),
        *[c.over(throughout).alias(n) for n, c in per_key.items()],
    )
    edges = names.join(dates, levels[1]).select(
        *levels[0], "_name_before", "_name_after", "_date_before", "_date_after", *per_key
    )
    return rows.join(edges, levels[0]).select(
        *whole,
        F.coalesce("_before", "_name_before", "_date_before").alias("previous"),
        F.coalesce("_after", "_name_after", "_date_after").alias("following"),
        *per_key,
    )

