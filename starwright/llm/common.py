"""Small helpers that several operators of this folder share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starwright.session import materialize, scratch_path

__all__ = [
    "first_by_hash", "keyed_text", "lookup_join", "materialize", "partitions", "read_table", "scratch_path",
    "shared_text", "spread", "stored", "stored_by",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the text alone, so that no other column of the input can clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def shared_text(path: str) -> str:
    """The content of a vocabulary file, which travels with the tasks (a few MB at most)."""
    return Path(path).read_text(encoding="utf-8")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Like ``materialize``, with the stronger codec that packed numbers and texts deserve."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, column: str, buckets: int, label: str) -> DataFrame:
    """Like ``stored``, bucketed by a column, so that a join on it leaves these rows in place.

    Buckets belong to a table of the catalog.  The frame keeps what it has read of it, so its
    name goes at once; its files lie, and end, with the other scratch tables.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    writer = df.write.option("compression", "zstd").option("path", path)
    writer.bucketBy(buckets, column).saveAsTable(name)
    frame = spark.table(name)
    frame.schema  # noqa: B018 - resolved while the name is known
    spark.sql(f"DROP TABLE {name}")
    return frame


#: A written table of at most so many rows of a few numbers (some 50 MB) may be broadcast.
BROADCAST_ROWS = 500_000


def lookup_join(
    large: DataFrame, written: DataFrame, on: str | list[str], how: str = "inner"
) -> DataFrame:
    """Join with a written table: broadcast if its counted rows are few, else merged.

    The hint also keeps Spark from sending out ``large`` where it underrates an explode.
    """
    if written.count() <= BROADCAST_ROWS:
        return large.join(F.broadcast(written), on, how)
    return large.join(written.hint("merge"), on, how)


#: Groups in which the rows of one key are ranked before they meet.
HASH_GROUPS = 256


def first_by_hash(rows: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """The ``most`` rows of each key that come first by ``order``, a hash.

    Ranked in groups by hash first, so what meets in a task for one key is bounded by
    ``most * HASH_GROUPS`` rows, however many tasks and rows there are.
    """
    for parts in ([key, F.pmod(F.xxhash64(order), F.lit(HASH_GROUPS))], [key]):
        place = F.row_number().over(Window.partitionBy(*parts).orderBy(order))
        rows = rows.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")
    return rows


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly before each becomes many; a small file would be a single task."""
    return df.repartition(partitions(df.sparkSession))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
