"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_checkpoint_dir

SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"

# Bytes of words after A-Z became a-z; all others become spaces. Bytes from 0x80 on
# belong to code points beyond ASCII, which are word characters.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
    for b in range(256)
)


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, also where `body` uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def whitespace_words(text: Column) -> Column:
    """The words between white space (space and \\x09 to \\x0D); null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed != "", F.split(trimmed, SPACE + "+")).otherwise(
        F.array().cast("array<string>")
    )


def own(df: DataFrame, name: str) -> str:
    """A column name like `name` that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def apart(df: DataFrame, added: Iterable[str], *used: str) -> tuple[DataFrame, list[str], list[str]]:
    """Make room for added columns: the frame, the names of the used columns in it, the columns to keep.

    Columns named like an added one go; a used one stays under a free name, but isn't kept.
    """
    taken = {a.lower() for a in added}
    names = [own(df, f"_tm_{c}") if c.lower() in taken else c for c in used]
    kept = [c for c in df.columns if c.lower() not in taken]
    out = df.select(*kept, *[F.col(c).alias(n) for c, n in dict(zip(used, names, strict=True)).items() if c != n])
    return out, names, kept


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{root}/{name}-{uuid.uuid4()}"


def null_safe(left: str, right: str, pairs: Sequence[tuple[str, str]]) -> Column:
    """Equality of columns of two aliased frames, null equal to null."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}")) for a, b in pairs],
    )


def extended(df: DataFrame, carry: Sequence[str] | None, added: T.StructType) -> tuple[list[str], T.StructType]:
    """The columns to carry and the schema with `added` after them.

    A carried column with the name of an added one gives way to it.
    """
    names = {f.name for f in added}
    kept = [c for c in (df.columns if carry is None else carry) if c not in names]
    fields = {f.name: f for f in df.schema}
    return kept, T.StructType([*(fields[c] for c in kept), *added])


class Recent:
    """What was used last: `size` to twice as many entries, older ones forgotten."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys: Iterable) -> list:
        """Those of the keys that aren't remembered; the others are in `new` then."""
        new, old, unknown = self.new, self.old, []
        for k in keys:
            if k not in new:
                if k in old:
                    new[k] = old[k]
                else:
                    unknown.append(k)
        return unknown

    def keep(self, found: Mapping) -> None:
        self.new.update(found)
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}


class Scratch:
    """Tables written to the shared folder, removed when the block ends.

    Lineage is cut at each of them, and Spark knows their sizes.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.tables = spark, scratch(spark, name), 0

    def __enter__(self) -> Scratch:
        return self

    def table(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        path = f"{self.path}/{self.tables}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame) -> DataFrame:
        """What outlives the block: a checkpoint, which Spark itself cleans up."""
        return df.checkpoint()

    def __exit__(self, *error) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
