"""Mixing sources to target weights by systematic sampling.

A document's expected copies are its source's target over its source's size. Inside a
source, sums of expected copies run along the documents, ordered by size; a document
is taken once for every whole number that its step of the sum crosses, all sums being
moved by one random offset per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import apart, own, whitespace_words
from tidemark.session import ensure_checkpoint_dir

WEIGHTS = (5, 2, 1)
MOST = 3          # a target is at most so many times its source
SALTS = 64        # a size class of a source is dealt to so many cells
SEED = 7

ADDED = ("size", "source_size", "target", "copies", "taken")


def _number(text: Column, digits: int) -> Column:
    """The number that the first hexadecimal digits of the text's md5 spell."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def size_class(n: Column) -> Column:
    """Number of a positive integer's class, four to each doubling."""
    bits = F.length(F.bin(n))
    return (bits * 4 + F.floor(n * 8 / F.pow(F.lit(2.0), bits)) - 4).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[float], most: int, seed: int) -> DataFrame:
    """The target, expected copies and offset of every source, one row each.

    Weights repeat over the sources by code point, null last. All targets add up to the
    sum of sizes. A target stops at `most` times its size and what it can't take goes to
    the others by weight: in the order of size to weight, the common level is the largest
    quotient of what earlier sources leave and the weights that are left.

    Sources, not documents, are ordered here: one row of a few numbers for each.
    """
    every = Window.orderBy("_tm_null", "_tm_source")
    place = F.pmod(F.row_number().over(every) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), place)).withColumn(
        "cap", most * F.col("source_size").cast("double")
    )
    full = Window.orderBy(F.col("cap") / F.col("weight"), "_tm_null", "_tm_source")
    all_rows = Window.partitionBy(F.lit(1))
    earlier = full.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    weights_left = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    target = F.least("cap", F.col("_tm_level") * F.col("weight"))
    # 20 bits, so that sums with a whole number of steps stay exact
    offset = _number(F.concat_ws(":", "_tm_source", "_tm_null", F.lit(seed)), 5) / F.lit(2.0**20)
    return (
        weighed.withColumn("_tm_level", left / weights_left)
        .withColumn("_tm_level", F.max("_tm_level").over(all_rows))
        .withColumn("target", target)
        .withColumn("_tm_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("_tm_offset", offset)
        .select("_tm_source", "_tm_null", "source_size", "target", "_tm_rate", "_tm_offset")
    )


def mix(
    docs: DataFrame,
    source: str = "source",
    doc_id: str = "doc_id",
    text: str = "text",
    size: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Add `size`, `source_size`, `target`, `copies` and `taken` (copies times size).

    `size` is the number of white-space words unless given; null text has 0. Null
    sources are one source. A source without any size has target 0 and no copies. A
    document has at most `most` copies. Repeated rows count one by one. Input columns
    named like an added one are replaced. Reruns agree: order and offset come from
    hashes of the rows; rows equal in size and id are taken in the order of their texts' hashes.
    An empty table gives no rows.

    `carry` has the columns to keep, all if None. With it, what is kept and the sizes are written
    once, so texts are read and counted once; else they are read twice, for the cells and
    for the result, and only the cells are written.

    Documents are numbered inside cells (source, size class, hash of id), each far
    smaller than a source, and cells are added up in one small table. So a source that
    holds most rows is spread over many tasks, and rows are shuffled once.
    """
    given = own(docs, "_tm_given")
    docs = docs if size is None else docs.withColumn(given, size)
    docs, (source, doc_id, text), kept = apart(docs, ADDED, source, doc_id, text)
    kept = [c for c in kept if c != given and (carry is None or c in carry)]
    counted = F.size(whitespace_words(F.col(text))).cast("long") if size is None else F.col(given)
    named = [F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col("size")]
    rows = docs.withColumn("size", counted).withColumns(
        {
            "_tm_source": F.coalesce(F.col(source), F.lit("")),
            "_tm_null": F.col(source).isNull(),
            "_tm_hash": F.xxhash64(F.col(text)),
            "_tm_class": size_class(F.col("size") + 1),
            "_tm_salt": (_number(F.concat_ws(":", *named, F.lit(seed)), 4) % SALTS).cast("int"),
        }
    )
    cell = ["_tm_source", "_tm_null", "_tm_class", "_tm_salt"]
    ensure_checkpoint_dir(docs.sparkSession)
    if carry is not None:
        rows = rows.select(*dict.fromkeys([*kept, doc_id, "size", "_tm_hash", *cell])).checkpoint()
    cells = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_tm_rows"), F.sum("size").alias("_tm_size"))
    cells = cells.checkpoint() if carry is None else cells
    sources = cells.groupBy("_tm_source", "_tm_null").agg(F.sum("_tm_size").alias("source_size"))
    along = Window.partitionBy("_tm_source", "_tm_null").orderBy("_tm_class", "_tm_salt")
    offsets = cells.withColumn("_tm_before", F.sum("_tm_rows").over(along) - F.col("_tm_rows")).drop("_tm_rows", "_tm_size")
    plan = offsets.join(source_targets(sources, weights, most, seed), ["_tm_source", "_tm_null"])

    inside = Window.partitionBy(*cell).orderBy("size", F.col(doc_id), "_tm_hash")
    step = F.col("_tm_before") + F.col("_tm_place")

    def crossed(n: Column) -> Column:
        return F.floor(F.col("_tm_rate") * n + F.col("_tm_offset"))

    copies = F.least(crossed(step) - crossed(step - 1), F.lit(most)).cast("int")
    return (
        rows.withColumn("_tm_place", F.row_number().over(inside))
        .join(plan, cell)
        .withColumn("copies", copies)
        .select(
            *kept, "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        )
    )


def emit(mixed: DataFrame) -> DataFrame:
    """The rows that the mix takes, each as often as it has copies."""
    return mixed.filter("copies > 0").withColumn("_tm_copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("_tm_copy")
