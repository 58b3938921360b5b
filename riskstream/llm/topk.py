"""Exact top-k inner products with block-at-a-time pruning.

Vectors are cut into blocks of neighbouring rows. A block's forward index holds its rows; beside it
stand the largest and smallest value of each term (component). For a query, the sum of its
components times the better of the two bounds every score in the block. Each query takes the blocks
in falling order of that bound, scores whole blocks, and stops when the bound is under its k-th
score. Equal scores can still win by a smaller id, so only a strictly lower bound stops it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm.common import written

#: Rows of a block, rows of a group of blocks that travels together, queries that do, and results.
BLOCK, GROUP, CHUNK, K = 256, 4_096, 4_096, 20
#: Bytes of a group as doubles, and of the groups that one task meets its queries with.
GROUP_BYTES, PIECE_BYTES = 4 << 20, 64 << 20
#: Below these all sums of products are exact in single and in double precision.
EXACT_SINGLE, EXACT = float(1 << 24), float(1 << 53)
#: How whole numbers are packed, by the bytes of one.
KINDS = {1: "<i1", 2: "<i2", 4: "<f4", 8: "<f8"}


def usable(vector: Column) -> Column:
    """Not null, and every component finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))


def _matrix(vectors: pa.ListArray, scale: int) -> np.ndarray:
    """The vectors as whole numbers, short ones filled up with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    filled = np.arange(lengths.max(initial=0)) < lengths[:, None]
    matrix = np.zeros(filled.shape)
    matrix[filled] = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale)
    return matrix


def _packed(ids: np.ndarray, matrix: np.ndarray) -> tuple[bytes, bytes, int]:
    most = np.abs(matrix).max(initial=0)
    size = 1 if most < 1 << 7 else 2 if most < 1 << 15 else 4 if most < 1 << 24 else 8
    return ids.tobytes(), matrix.astype(KINDS[size]).tobytes(), matrix.shape[1]


def packed_rows(vectors: DataFrame, rows: int, scale: int) -> DataFrame:
    """(ids, matrix, width): runs of at most ``rows`` neighbouring rows of a partition, no shuffle. Wide rows
    make shorter runs."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, matrix = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"), scale)
            step = max(1, min(rows, GROUP_BYTES // (8 * max(1, matrix.shape[1]))))
            for i in range(0, len(ids), step):
                packed = _packed(ids[i:i + step], matrix[i:i + step])
                yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(packed, (pa.binary(), pa.binary(), pa.int32()), strict=True)],
                                                 ["ids", "matrix", "width"])

    return vectors.mapInArrow(pack, "ids binary, matrix binary, width int")


def _unpacked(ids: bytes, matrix: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, dtype=np.int64)
    kind = KINDS[len(matrix) // (len(keys) * width)] if width else "<f4"
    return keys, np.frombuffer(matrix, dtype=kind).reshape(len(keys), width)


class Best:
    """The k best of each query of a chunk so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors.astype(np.float64), k
        self.single = self.vectors.astype(np.float32)
        self.most = np.abs(self.vectors).max(initial=0)
        self.found = np.zeros((len(ids), k), dtype=np.int64)
        self.score = np.zeros((len(ids), k), dtype=np.int64)
        self.size = np.zeros(len(ids), dtype=np.int64)
        self.kth = np.full(len(ids), -np.inf)

    def held(self, query: np.ndarray) -> np.ndarray:
        """Which places of these queries are taken."""
        return np.arange(self.k) < self.size[query, None]

    def add(self, query: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        if not len(query):
            return
        who = np.unique(query)
        held = self.held(who)
        query = np.concatenate((np.repeat(who, self.size[who]), query))
        found, score = np.concatenate((self.found[who][held], found)), np.concatenate((self.score[who][held], score))
        order = np.lexsort((found, -score, query))
        query, found, score = query[order], found[order], score[order]
        starts = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
        counts = np.diff(np.append(starts, len(query)))
        place = np.arange(len(query)) - np.repeat(starts, counts)
        keep = place < self.k
        at = query[keep], place[keep]
        self.found[at], self.score[at] = found[keep], score[keep]
        self.size[who] = np.minimum(counts, self.k)
        full = who[counts >= self.k]
        self.kth[full] = self.score[full, self.k - 1]

    def search(self, ids: np.ndarray, rows: np.ndarray) -> None:
        width = min(self.vectors.shape[1], rows.shape[1])
        most = self.most * max(float(rows.max(initial=0)), -float(rows.min(initial=0))) * max(width, 1)
        if most >= EXACT:
            self.search_long(ids, self.vectors[:, :width], rows[:, :width])
            return
        kind = np.float32 if most < EXACT_SINGLE else np.float64
        queries = (self.single if kind is np.float32 else self.vectors)[:, :width]
        rows = rows[:, :width].astype(kind)
        starts = np.arange(0, len(ids), BLOCK)
        high, low = np.maximum.reduceat(rows, starts, axis=0), np.minimum.reduceat(rows, starts, axis=0)
        bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
        order = np.argsort(-bounds, axis=1, kind="stable")
        everyone = np.arange(len(queries))
        for turn in range(len(starts)):
            block = order[:, turn]
            live = bounds[everyone, block] >= self.kth
            if not live.any():
                break
            block = np.where(live, block, -1)
            passed = [self.passing(np.flatnonzero(block == b), queries, ids[starts[b]:starts[b] + BLOCK], rows[starts[b]:starts[b] + BLOCK])
                      for b in np.unique(block[live])]
            self.add(*(np.concatenate(x) for x in zip(*passed, strict=True)))

    def passing(self, asking: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of the rows that may be among the k best of a query."""
        scores = queries[asking] @ rows.T
        least = self.kth[asking].astype(scores.dtype)
        if len(ids) > self.k and np.isneginf(least).any():  # the block's own k-th score, as nothing else is known
            others = np.where(ids == self.ids[asking, None], -np.inf, scores)
            least = np.maximum(least, np.partition(others, -self.k, axis=1)[:, -self.k])
        q, d = np.divmod(np.flatnonzero(scores >= least[:, None]), len(ids))
        other = ids[d] != self.ids[asking[q]]
        q, d = q[other], d[other]
        return asking[q], ids[d], scores[q, d].astype(np.int64)

    def search_long(self, ids: np.ndarray, queries: np.ndarray, rows: np.ndarray) -> None:
        """Whole numbers too large for doubles: exact, without pruning."""
        numbers = [[int(x) for x in row] for row in rows]
        top = (1 << 63) - 1
        for at, own in enumerate(self.ids):
            vector = [int(x) for x in queries[at]]
            scored = ((max(-top, min(top, sum(map(int.__mul__, vector, row)))), -int(i)) for i, row in zip(ids, numbers, strict=True) if i != own)
            best = heapq.nlargest(self.k, scored)
            self.add(np.full(len(best), at), np.array([-i for _, i in best], dtype=np.int64), np.array([s for s, _ in best], dtype=np.int64))

    def rows(self) -> pd.DataFrame:
        held = self.held(np.arange(len(self.ids)))
        return pd.DataFrame({"query_id": np.repeat(self.ids, self.size), "vec_id": self.found[held], "score": self.score[held]})


def top_k(queries: DataFrame, vectors: DataFrame, k: int = K, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each row of ``queries``
    with the rows of ``vectors`` that have another id (all, if fewer); ties to the smaller vec_id.

    Both tables: (vec_id, vector). Components become floor(``scale`` * x). Rows with no id, no vector
    or a component that is null or not finite take no part; short vectors count as filled up with
    zeros, scores are held to the range of long. A repeated query id is asked once, with the smallest
    of its vectors; repeated rows of ``vectors`` are candidates each.

    Both are packed, written and dealt into pieces, and each task meets one piece of the queries with
    one of the groups, which it reads where they lie: nothing is copied, broadcast or collected. There
    are about as many tasks as the session has shuffle partitions, more if their groups get too large.
    Inside a task a chunk of queries meets the groups in turn and its k-th scores are kept over them.
    """
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    good = lambda df: df.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    double = F.col("vector").cast("array<double>").alias("vector")
    groups = written(packed_rows(good(vectors).select(F.col("vec_id").cast("long"), double), GROUP, scale), "blocks")
    asked = good(queries).select(F.col("vec_id").cast("long"), double).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = written(asked, "asked")
    chunks = written(packed_rows(asked.repartition(-(-asked.count() // CHUNK) or 1), CHUNK, scale), "queries")
    n_groups, size = groups.agg(F.count("*"), F.coalesce(F.sum(F.length("ids") + F.length("matrix")), F.lit(0))).first()
    across = max(1, min(chunks.count(), tasks // 4))
    down = max(1, min(n_groups, max(-(-tasks // across), -(-size // PIECE_BYTES))))
    asking = chunks.select(F.col("ids").alias("q_ids"), F.col("matrix").alias("q"), F.col("width").alias("q_width")).repartition(across)
    met = asking.hint("shuffle_replicate_nl").crossJoin(groups.repartition(down))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best, held = None, None
        for batch in batches:
            for q_ids, q, q_width, ids, matrix, width in batch.itertuples(index=False):
                if held != q_ids:
                    if best is not None:
                        yield best.rows()
                    best, held = Best(*_unpacked(q_ids, q, q_width), k), q_ids
                best.search(*_unpacked(ids, matrix, width))
        if best is not None:
            yield best.rows()

    found = met.mapInPandas(search, "query_id long, vec_id long, score long")
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
