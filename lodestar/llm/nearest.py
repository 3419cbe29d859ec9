"""Nearest neighbours by a block matrix join of int8 tiles.

Equal vectors are merged first.  Queries are cut into blocks of rows, candidates into
stripes; the tile of block and stripe is one matrix product of int8 codes.  With codes
``u' = scale * code`` of the unit vectors and ``e = |u - u'|``, the cosine differs from the
product of the codes by at most ``e_q + e_c + e_q * e_c``.  A tile keeps, for each query,
what may still be among its ``k`` nearest by these bounds; the heaps of all tiles are
merged per query the same way, and the pairs that survive are recomputed in double
precision on the original vectors.  Nothing that could be in the answer is dropped.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, and rows
without id take no part; of rows that repeat an id the greatest vector (array order) stands;
vectors of another length than the query's are no candidates; fewer candidates than ``k`` are
all returned; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import stage
from lodestar.llm.exchange import on_table, on_tables
from lodestar.operators.skew import salted_key_join

K = 5
BLOCK = 1024  # query vectors in a tile
STRIPE = 4096  # candidate vectors in a tile, about

_CODES = "node bigint, dim int, codes binary, error double, scale double, asked boolean"
_NEAR = "query bigint, node bigint, low double, high double"
_NEAR_ARROW = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("low", pa.float64()),
                         ("high", pa.float64())])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v)``: one row per id with a vector that can be compared."""
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(id_col).cast("bigint").alias("id"),
                           F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~odd)
            .where(F.exists("v", lambda x: x != 0))
            .groupBy("id").agg(F.max("v").alias("v")))


def merge_equal(rows: DataFrame, is_query: F.Column, k: int) -> DataFrame:
    """``(node, v, ids, asked)``: distinct vectors, their ``k`` least ids and how many ask.

    The node's name is its least id.  Each task passes on at most ``k`` ids of a vector.
    """
    def run(it):
        own: dict[bytes, list] = {}  # as large as the task's share of the input at most
        for batch in it:
            for i, v, q in zip(*(batch.column(c).to_pylist() for c in ("id", "v", "q"))):
                at = own.setdefault(np.array(v, np.float64).tobytes(), [[], 0])
                at[1] += q
                if len(at[0]) < k:
                    heapq.heappush(at[0], -i)
                elif -i > at[0][0]:
                    heapq.heapreplace(at[0], -i)
        if own:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(v).tolist() for v in own),
                 pa.array([[-i for i in ids] for ids, _ in own.values()], pa.list_(pa.int64())),
                 pa.array([n for _, n in own.values()], pa.int64())], ["v", "ids", "asked"])

    parts = rows.select("id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"),  # -0.0 is 0.0
                        is_query.alias("q")).mapInArrow(
        run, "v array<double>, ids array<bigint>, asked bigint")
    least = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k)
    return parts.groupBy("v").agg(least.alias("ids"), F.sum("asked").alias("asked")).select(
        F.element_at("ids", 1).alias("node"), "v", "ids", "asked")


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()  # huge and tiny components stay finite
    return v / np.linalg.norm(v)


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    tops = np.abs(a).max(), np.abs(b).max()
    if not 1e-140 < min(tops) <= max(tops) < 1e140:  # squares would vanish or overflow
        return float(np.dot(_unit(a), _unit(b)))
    return float(np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))))


def encode(nodes: DataFrame) -> DataFrame:
    """Int8 codes of unit vectors, with their scale and the length of what is lost."""
    def run(it):
        for batch in it:
            out = []
            for node, v, asked in zip(*(batch.column(c).to_pylist() for c in ("node", "v", "asked"))):
                u = _unit(np.array(v, np.float64))
                scale = np.abs(u).max() / 127
                code = np.rint(u / scale).astype(np.int8)
                error = np.linalg.norm(u - scale * code) * (1 + 1e-6) + 1e-12
                out.append((node, len(u), code.tobytes(), float(error), float(scale), asked > 0))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.float64(), pa.bool_()))],
                    ["node", "dim", "codes", "error", "scale", "asked"])

    return nodes.select("node", "v", "asked").mapInArrow(run, _CODES)


def _matrix(table: pa.Table, dim: int):
    codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.int8).reshape(-1, dim)
    return (table.column("node").to_numpy(), codes, table.column("scale").to_numpy(),
            table.column("error").to_numpy())


def _tile(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """Pairs of the tile that may be among a query's ``k`` nearest, with their bounds."""
    if not queries.num_rows or not candidates.num_rows:
        return _NEAR_ARROW.empty_table()
    dim = queries.column("dim")[0].as_py()
    q, qc, qs, qe = _matrix(queries, dim)
    c, cc, cs, ce = _matrix(candidates, dim)
    # sums of up to 1,040 products of int8 are exact in float32
    kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64
    near = (qc.astype(kind) @ cc.astype(kind).T).astype(np.float64) * (qs[:, None] * cs[None, :])
    slack = qe[:, None] + ce[None, :] + qe[:, None] * ce[None, :]
    low, high = near - slack, near + slack
    n = len(c)
    bar = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(q), -np.inf)
    i, j = np.nonzero(high >= bar[:, None])
    return pa.table([pa.array(q[i]), pa.array(c[j]), pa.array(low[i, j]), pa.array(high[i, j])],
                    schema=_NEAR_ARROW)


def _merge(near: pa.Table, k: int) -> pa.Table:
    """A query's pairs whose upper bound reaches its ``k``-th largest lower bound."""
    heap: list[float] = []
    for low in near.column("low").to_pylist():
        if len(heap) < k:
            heapq.heappush(heap, low)
        elif low > heap[0]:
            heapq.heapreplace(heap, low)
    bar = heap[0] if len(heap) == k else -np.inf
    return near.filter(pa.array(near.column("high").to_numpy() >= bar))


def _exact(it):
    for batch in it:
        score = [cosine(np.array(a), np.array(b)) for a, b in zip(
            batch.column("vq").to_pylist(), batch.column("vc").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("query"), batch.column("node"), pa.array(score, pa.float64())],
            ["query", "node", "score"])


def nearest(vectors: DataFrame, id_col: str, vector_col: str, is_query: F.Column, k: int = K,
            block: int = BLOCK, stripe: int = STRIPE) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest others of each query row by cosine.

    ``is_query`` is a condition on ``id``.
    """
    rows = usable(vectors, id_col, vector_col)
    # the nearest k + 1 nodes hold k ids besides the query's own
    nodes = stage(merge_equal(rows, is_query, k + 1), "nearest-nodes")
    codes = stage(encode(nodes), "nearest-codes")
    total = codes.agg(F.count("*"), F.count_if("asked")).first()
    stripes, blocks = max(1, -(-total[0] // stripe)), max(1, -(-total[1] // block))

    def place(n: int, seed: int) -> F.Column:
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(n).cast("bigint"))

    def every(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    of = ["dim", "block", "stripe", "node", "codes", "error", "scale"]
    q = codes.where("asked").withColumn("block", place(blocks, 1)).withColumn("stripe", every(stripes))
    c = codes.withColumn("stripe", place(stripes, 2)).withColumn("block", every(blocks))
    tile = ["dim", "block", "stripe"]
    # toDF gives the two sides, read from one table, columns of their own
    found = q.select(of).toDF(*of).groupBy(*tile).cogroup(c.select(of).toDF(*of).groupBy(*tile)).applyInArrow(
        on_tables(_tile, k=k + 1), _NEAR)
    pairs = found.groupBy("query").applyInArrow(on_table(_merge, k=k + 1), _NEAR)
    v = nodes.select("node", "v")
    scored = (pairs.join(v.withColumnRenamed("v", "vc"), "node")
              .join(v.select(F.col("node").alias("query"), F.col("v").alias("vq")), "query")
              .select("query", "node", "vq", "vc")
              .mapInArrow(_exact, "query bigint, node bigint, score double"))

    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    lists = (scored.join(nodes.select("node", F.explode("ids").alias("id")), "node")
             .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
             .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("near")))
    answers = nodes.where("asked > 0").select(F.col("node").alias("query"), "v", "asked").join(lists, "query")
    # a vector that many queries share answers them in several tasks
    asking = rows.where(is_query).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    each = salted_key_join(asking, answers, "v", "asked", spread_col="id")
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    return each.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "n")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("id"),
        F.col("n.score").alias("score"))
