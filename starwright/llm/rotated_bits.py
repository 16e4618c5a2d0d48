"""Nearest neighbours from randomly rotated one-bit codes.

A vector, less the centre of all, is scaled to length one and turned by a random rotation; its
code is one sign bit per dimension, packed.  With two scalars (its length, and how well the
signs fit it) the bits give an unbiased estimate of its inner product with any query, and a
bound of the estimate's error.  A scan of the codes thus knows, for every query, a range that
holds each distance; only vectors whose smallest distance can still reach the best ones found
so far are compared exactly.

All rows are indexed.  Queries come in blocks of bounded size, each broadcast and scanned
against the index where it lies; a task returns its best rows per query, never a pair more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.llm.common import scratch_path, stored

#: Queries that are broadcast at once, and rows that are estimated against them at once.
QUERY_BLOCK, ROW_BLOCK = 8192, 512
PAIR_BLOCK = 1 << 15
#: Width of the error bound in standard deviations.
WIDTH = 2.5
SEED = 7
#: Lengths between which all squares and sums of them fit in 32-bit numbers.
SHORT, LONG = 1e-15, 1e15


def usable(vectors: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """``vec_id, vector`` (floats) without rows that take no part.

    Those have no id, no vector, another number of components than ``dims``, components that
    are null or not finite, or are zero throughout.
    """
    wrong = F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return vectors.select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector")
    ).where(
        F.col("vec_id").isNotNull()
        & (F.size("vector") == dims)
        & ~wrong
        & F.exists("vector", lambda x: x != 0)
    )


def dimensions(vectors: DataFrame, vector_col: str) -> int:
    """The most frequent number of components, the smallest if several are; 0 without vectors."""
    sizes = vectors.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("d")).count()
    row = sizes.orderBy(F.desc("count"), "d").first()
    return row.d if row else 0


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, dims)


def centre_of(vectors: DataFrame, dims: int) -> np.ndarray:
    """Mean of all vectors: a sum per task, then per component."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(dims), 0
        for batch in batches:
            total += _matrix(batch.column(0), dims).sum(axis=0)
            rows += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([total], pa.list_(pa.float64())), pa.array([rows], pa.int64())],
            names=["total", "n"],
        )

    sums = vectors.select("vector").mapInArrow(add, "total array<double>, n long")
    rows = (
        sums.select(F.posexplode("total").alias("i", "x"), "n")
        .groupBy("i").agg(F.try_divide(F.sum("x"), F.sum("n")).alias("x")).collect()
    )
    mean = np.zeros(dims)
    for row in rows:
        mean[row.i] = row.x or 0.0
    return mean


class Coder:
    """The centre and the rotation that vectors and queries share."""

    def __init__(self, centre: np.ndarray, seed: int = SEED) -> None:
        self.centre = centre
        self.width = -(-len(centre) // 8) * 8
        noise = np.random.default_rng(seed).standard_normal((self.width, self.width))
        rotation, triangle = np.linalg.qr(noise)
        # Signs of the diagonal make the rotation uniform; missing dimensions are zero.
        self.rotation = (rotation * np.sign(np.diag(triangle)))[: len(centre)].astype(np.float32)

    def turned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rotated directions from the centre, and distances to it."""
        away = vectors - self.centre
        length = np.linalg.norm(away, axis=1)
        unit = (away / np.maximum(length, 1e-300)[:, None]).astype(np.float32)
        return unit @ self.rotation, length

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed bits, distance to the centre, and inner product of direction and code."""
        turned, length = self.turned(vectors)
        bits = np.packbits(turned > 0, axis=1)
        fit = np.abs(turned).sum(axis=1) / np.sqrt(self.width)
        return bits, length, np.where(length > 0, fit, 1.0)

    def squared_range(
        self, bits: np.ndarray, length: np.ndarray, fit: np.ndarray,
        turned: np.ndarray, query_length: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest squared distance of each row (down) to each query (across).

        A range that cannot be told, as squares overflow, is all that a distance can be.
        """
        # Squares of much longer or shorter vectors are no 32-bit numbers.
        used = np.concatenate([length, query_length])
        usual = ((used == 0) | ((used > SHORT) & (used < LONG))).all()
        kind = np.float32 if usual else np.float64
        signs = np.unpackbits(bits, axis=1).astype(np.float32) * 2 - 1
        estimate = (signs @ turned.T) / (np.sqrt(self.width) * fit).astype(np.float32)[:, None]
        spread = np.sqrt(np.maximum(0, 1 - fit**2)) / (fit * np.sqrt(max(1, self.width - 1)))
        # The last term covers the rounding of 32-bit numbers.
        error = (WIDTH * spread + 1e-5).astype(np.float32)[:, None]
        both = (2 * length).astype(kind)[:, None] * query_length.astype(kind)
        squares = ((length**2)[:, None] + query_length**2).astype(kind)
        middle, reach = squares - both * estimate, both * error
        reach = reach + squares * kind(1e-6)
        low, high = np.maximum(middle - reach, 0), middle + reach
        if not usual:
            unknown = ~(np.isfinite(low) & np.isfinite(high))
            low[unknown], high[unknown] = 0, np.inf
        return low, high


def build_index(vectors: DataFrame, coder: Coder, dims: int) -> DataFrame:
    """``vec_id, vector, bits, length, fit`` for every usable row, written once."""
    schema = T.StructType([
        *vectors.schema.fields,
        T.StructField("bits", T.BinaryType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("fit", T.DoubleType()),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bits, length, fit = coder.encode(_matrix(batch.column(1), dims))
                packed = pa.array([row.tobytes() for row in bits], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), packed, pa.array(length), pa.array(fit)],
                    names=schema.names,
                )

    return stored(vectors.mapInArrow(encode, schema), "ann-index")


class Best:
    """The nearest rows of each query so far: distances, then ids, in ascending order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, most: int) -> None:
        self.queries, self.vectors, self.most = ids, vectors, most
        self.scores = np.full((len(ids), most), np.inf)
        self.found = np.full((len(ids), most), np.iinfo(np.int64).max)

    def candidates(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray):
        """Places (row, query) of a block that may be among the best."""
        limit = self.scores[:, -1] ** 2
        if len(low) >= self.most and np.isinf(limit).any():
            # The k-th largest distance that rows of this block can have bounds the k-th best;
            # one more, as a query's own row does not count.
            k = min(self.most, len(low) - 1)
            limit = np.minimum(limit, np.partition(high, k, axis=0)[k])
        # In 64 bits: the square of a small distance is no 32-bit number.
        limit = limit * (1 + 1e-6)
        tie = (low <= limit) & (ids[:, None] < self.found[:, -1])
        return np.nonzero(((low < limit) | tie) & (ids[:, None] != self.queries))

    def add(self, rows: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        """Compare the given pairs exactly and keep the best of each query."""
        for start in range(0, len(rows), PAIR_BLOCK):
            r, q = rows[start : start + PAIR_BLOCK], queries[start : start + PAIR_BLOCK]
            # Added in the order of the components, so that every engine gets the same bits.
            exact = np.sqrt(np.cumsum((vectors[r] - self.vectors[q]) ** 2, axis=1)[:, -1])
            touched, local = np.unique(q, return_inverse=True)
            owner = np.concatenate([np.repeat(np.arange(len(touched)), self.most), local])
            score = np.concatenate([self.scores[touched].ravel(), exact])
            found = np.concatenate([self.found[touched].ravel(), ids[r]])
            order = np.lexsort((found, score, owner))
            first = np.searchsorted(owner[order], np.arange(len(touched)))
            kept = order[first[:, None] + np.arange(self.most)]
            self.scores[touched], self.found[touched] = score[kept], found[kept]


def scan(index: DataFrame, coder: Coder, ids: np.ndarray, vectors: np.ndarray, most: int):
    """Best rows of every task for a block of queries: ``query_id, vec_id, score``."""
    shipped = index.sparkSession.sparkContext.broadcast((ids, vectors))
    dims = vectors.shape[1]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shipped.value
        turned, query_length = coder.turned(vectors)
        best = Best(ids, vectors, most)
        for whole in batches:
            for start in range(0, whole.num_rows, ROW_BLOCK):
                batch = whole.slice(start, ROW_BLOCK)
                numbers = batch.column("vec_id").to_numpy()
                bits = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8)
                low, high = coder.squared_range(
                    bits.reshape(batch.num_rows, -1),
                    batch.column("length").to_numpy(), batch.column("fit").to_numpy(),
                    turned, query_length,
                )
                rows, queries = best.candidates(low, high, numbers)
                best.add(rows, queries, numbers, _matrix(batch.column("vector"), dims))
        # A distance may be infinite in double precision; places without a row are not shown.
        real = np.isfinite(best.scores) | (best.found != np.iinfo(np.int64).max)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(ids, most)[real.ravel()]),
                pa.array(best.found[real]), pa.array(best.scores[real]),
            ],
            names=["query_id", "vec_id", "score"],
        )

    return index.mapInArrow(look, "query_id long, vec_id long, score double"), shipped


def _blocks(queries: DataFrame, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The query set in blocks of bounded size; one block at a time is on the driver."""
    ids, rows = [], []
    for row in queries.toLocalIterator():
        ids.append(row.vec_id)
        rows.append(row.vector)
        if len(ids) == QUERY_BLOCK:
            yield np.array(ids, np.int64), np.array(rows, np.float64).reshape(-1, dims)
            ids, rows = [], []
    if ids:
        yield np.array(ids, np.int64), np.array(rows, np.float64).reshape(-1, dims)


def nearest(
    spark: SparkSession, vectors: DataFrame, is_query: Column, most: int = 10,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The ``most`` nearest rows of each query: ``query_id, rank, vec_id, score``.

    ``is_query`` is an expression on ``vec_id``.  ``score`` is the Euclidean distance of the
    vectors as given, in double precision; ranks count from 1, ties go to the smaller id.  A
    query with fewer other rows gets all of them.  Rows with the query's id are its own.  Rows
    that take no part (see ``usable``) are neither found nor asked; a repeated row is found as
    often as it is there, and a repeated query is asked once.  No usable row, no result.
    """
    dims = dimensions(vectors, vector_col)
    rows = usable(vectors, id_col, vector_col, dims)
    coder = Coder(centre_of(rows, dims) if dims else np.zeros(1))
    index = build_index(rows, coder, dims)
    asked = index.where(is_query).select("vec_id", "vector").dropDuplicates(["vec_id"])
    folder = scratch_path(spark, "ann-found")
    for number, (ids, block) in enumerate(_blocks(asked, dims)):
        found, shipped = scan(index, coder, ids, block, most)
        found.write.parquet(f"{folder}/block-{number}")
        shipped.unpersist()
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    schema = "query_id long, vec_id long, score double"
    if not asked.take(1):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return (
        spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= most)
        .select("query_id", "rank", "vec_id", "score")
    )
