"""Exact top-k by inner product: ball trees per shard, searched by branch and bound.

Rows are dealt into shards of about ``SHARD_ROWS`` and queries into blocks of
about ``BLOCK`` by a hash of their identifiers, and each shard meets each block
once, so no task holds more than one of either. A shard's rows form a ball tree;
nodes are opened in the order of the most that an inner product with a row inside
can be, and a search ends when that bound falls below the current kth score. A
first round over one shard per block gives every query a kth score, which all
shards then share: a shard only returns what can still enter the result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.common import kept

K = 5
EVERY = 50
SCALE = 256
SHARD_ROWS = 8192
BLOCK = 4096
LEAF = 128
EXACT = 1 << 20  # components below it: sums of products are exact as doubles
NONE = -(1 << 62)


def scaled(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and integer components of the rows that take part."""
    whole = F.forall(
        vector_col,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return vectors.where(
        F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & whole
    ).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * SCALE)).alias("v"),
    )


def matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Integer vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(rows), width), dtype=np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out if np.abs(out).max(initial=0) >= EXACT else out.astype(np.float64)


class BallTree:
    """Nodes as centre, radius and either two children or a range of row places."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.places: list[np.ndarray | None] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        todo = [(np.arange(len(rows)), -1, 0)]
        while todo:
            places, parent, side = todo.pop()
            here = rows[places].astype(np.float64)
            centre = here.mean(axis=0)
            far = np.sqrt(((here - centre) ** 2).sum(axis=1))
            node = len(centres)
            centres.append(centre)
            radii.append(far.max())
            if parent >= 0:
                pair = self.children[parent] or (0, 0)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            if len(places) <= LEAF or not far.max():
                self.places.append(places)
                self.children.append(None)
                continue
            self.places.append(None)
            self.children.append((0, 0))
            # Split half and half along the line between two far points.
            one = here[far.argmax()]
            two = here[((here - one) ** 2).sum(axis=1).argmax()]
            order = np.argsort(here @ (two - one), kind="stable")
            half = len(order) // 2
            todo.append((places[order[:half]], node, 0))
            todo.append((places[order[half:]], node, 1))
        self.centres, self.radii = np.array(centres), np.array(radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that each query's inner product with a row of each node can be."""
        q = queries.astype(np.float64)
        norms = np.sqrt((q**2).sum(axis=1))
        most = q @ self.centres.T + norms[:, None] * self.radii
        size = np.abs(q) @ np.abs(self.centres.T) + norms[:, None] * self.radii
        return most + 1e-9 * size + 1e-6  # above rounding


def search(tree: BallTree, ids: np.ndarray, query: np.ndarray, own: int, most, k: int, kth: int):
    """(score, vec_id) of the best k rows that reach ``kth``; smaller ids win ties."""
    best_scores = np.empty(0, dtype=np.int64)
    best_ids = np.empty(0, dtype=np.int64)
    frontier = [(-most[0], 0)]
    while frontier:
        bound, node = heapq.heappop(frontier)
        if -bound < kth:
            break
        places = tree.places[node]
        if places is None:
            for child in tree.children[node]:
                if most[child] >= kth:
                    heapq.heappush(frontier, (-min(-bound, most[child]), child))
            continue
        scores = (tree.rows[places] @ query).astype(np.int64)
        fits = (scores >= kth) & (ids[places] != own)
        if not fits.any():
            continue
        best_scores = np.concatenate([best_scores, scores[fits]])
        best_ids = np.concatenate([best_ids, ids[places[fits]]])
        if len(best_ids) > k:
            order = np.lexsort((best_ids, -best_scores))[:k]
            best_scores, best_ids = best_scores[order], best_ids[order]
        if len(best_ids) == k:
            kth = max(kth, int(best_scores.min()))
    return zip(best_scores.tolist(), best_ids.tolist())


FOUND = "query_id long, vec_id long, score long"


def _searcher(k: int):
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(queries):
            width = max(rows["v"].map(len).max(), queries["q"].map(len).max())
            points, asked = matrix(rows["v"], width), matrix(queries["q"], width)
            ids = rows["vec_id"].to_numpy()
            tree = BallTree(points)
            for start in range(0, len(asked), 256):
                part = asked[start : start + 256]
                most = tree.bounds(part)
                for n, query in enumerate(part):
                    row = queries.iloc[start + n]
                    hits = search(
                        tree, ids, query, row["query_id"], most[n], k, row["kth"]
                    )
                    found += [(row["query_id"], i, s) for s, i in hits]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype="int64")

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = EVERY,
    k: int = K,
) -> DataFrame:
    """The k best rows of each query: query_id, rank, vec_id, score.

    Queries are the rows whose id is a multiple of ``every``. Rows with a null
    id, a null vector, or a null or non-finite component take no part; an empty
    vector scores 0, a shorter one counts as ending in zeros. Rows that repeat an
    id are candidates each, but never for the query of that id, which is asked
    once. Other columns are not read; an empty table gives no rows. Components
    are taken to stay below 2**31 / 256, as scores are 64-bit.
    """
    rows = kept(scaled(vectors, id_col, vector_col))
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    n_rows, n_asked = rows.count(), asked.count()
    shards, blocks = max(1, -(-n_rows // SHARD_ROWS)), max(1, -(-n_asked // BLOCK))

    def dealt(n: int, seed: int):
        return F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")

    def everywhere(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    sharded = rows.withColumn("shard", dealt(shards, 1))
    queries = asked.select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), dealt(blocks, 2).alias("block")
    )

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        keys = ["shard", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
            _searcher(k), FOUND
        )

    home = F.pmod(F.col("block"), F.lit(shards)).cast("int")
    first = meet(
        sharded.withColumn("block", everywhere(blocks)).where(F.col("shard") == home),
        queries.withColumns({"shard": home, "kth": F.lit(NONE)}),
    )
    bounds = kept(
        _best(first, k)
        .groupBy("query_id")
        .agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    )
    shared = queries.join(bounds, "query_id", "left").withColumn(
        "kth", F.coalesce("kth", F.lit(NONE))
    )
    found = meet(
        sharded.withColumn("block", everywhere(blocks)),
        shared.withColumn("shard", everywhere(shards)),
    )
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
