"""Range joins by bins: extents are cut into fixed bins, points meet them by equality on (keys, bin), and the range itself decides.

No row holds all extents of a key, and a key with very many is dealt over its bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bytes of input files for a partition of work whose rows are sorted in memory.
SHARE = 4 << 20


def parts(rows: DataFrame) -> int:
    """Partitions for work on these rows: one for each 4 MB of the files they come from, the shuffle partitions at least.

    So a task's rows, and its memory, stay the same however large the input is.
    """
    spark = rows.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in rows.inputFiles()]
    size = sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARE))


def dealt(rows: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """Rows over all shuffle partitions, or ``n``, by keys, ahead of work that is heavy for their size.

    Few small rows stand in one split of a file, and adaptive execution joins small partitions; a number given holds.
    """
    return rows.repartition(n or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def bin_of(at: Column, width: float) -> Column:
    return F.floor(at / width).cast("long")


def bins_of(low: Column, high: Column, width: float) -> Column:
    """Bins that an extent touches; none for an extent that is empty, not finite or of no place."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    return F.when(finite(low) & finite(high) & (low <= high), F.sequence(bin_of(low, width), bin_of(high, width)))


def points_in(points: DataFrame, extents: DataFrame, keys: list[str], at: str, low: str, high: str, width: float, closed: bool = False) -> DataFrame:
    """Pairs of points and extents of equal keys with low <= at < high, or <= high if ``closed``. Columns of both; other names must differ."""
    cut = extents.withColumn("__bin", F.explode(bins_of(F.col(low), F.col(high), width)))
    placed = points.where(F.col(at).isNotNull()).withColumn("__bin", bin_of(F.col(at), width))
    upper = F.col(at) <= F.col(high) if closed else F.col(at) < F.col(high)
    return placed.join(cut, [*keys, "__bin"]).where((F.col(at) >= F.col(low)) & upper).drop("__bin")
