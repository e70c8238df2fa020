"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.session import work_dir

# Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# A table may be hinted for broadcast only when its size is known to be below.
BROADCAST_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, *working: Column) -> DataFrame:
    """The input columns as one struct ``row`` beside working columns, so that
    working names never clash with names of the input."""
    return df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"), *working)


def unpacked(df: DataFrame, columns: list[str], outputs: dict[str, Column]) -> DataFrame:
    """Input columns, then the outputs; an input column whose name equals an
    output's (case aside) gives way to it."""
    taken = {name.lower() for name in outputs}
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns if c.lower() not in taken],
                     *[value.alias(name) for name, value in outputs.items()])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later steps start from files
    that outlive any executor, and every reader sees the same rows."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, size: int) -> DataFrame:
    """Broadcast hint when ``size`` bytes, known beforehand, are few; beyond
    that Spark joins by shuffle."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def let(value: Column, body) -> Column:
    """``body`` applied to ``value`` that is evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def uniform(*parts) -> Column:
    """A double in [0, 1) that follows from the parts alone."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 11)
    return bits.cast("double") * F.lit(2.0 ** -53)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors once per application, so
    that functions for their Python workers can be imported there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{package.name}-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
