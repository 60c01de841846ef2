"""Use every core on an input that comes in one split."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Hand the rows of a scan that has a single split out to all cores; leave any other as it is.

    The row rules cost far more than a read, and one small file, or a compressed one that cannot be split, would
    put them all in one task. Only such a file is dealt out: no input of several splits is shuffled here,
    whatever the number of cores. Counting the splits plans a read and runs nothing.
    """
    single = df.rdd.getNumPartitions() == 1
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if single else df
