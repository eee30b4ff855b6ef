"""Exact top-k by inner product: global score histograms, refined until the kth score is known."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.vectors import by_length, slices, usable
from starloom.staging import settle

#: Vectors in a block, and bins of a histogram round.
BLOCK, BINS = 1024, 1024
#: Bytes of query blocks that a task holds, and pairs of blocks that Python holds.
PART, HELD = 16 << 20, 16
#: Scores beyond count as this much; so do scaled components, whose products are told apart below it.
LARGEST = 1 << 61
_BLOCKS = "block bigint, dim int, ids binary, numbers binary, top bigint, square double"


def _blocks(vectors: DataFrame, scale: float) -> DataFrame:
    """Rows of up to BLOCK vectors of one length: ids and floor(scale * component) as bytes, of 4 bytes
    a number where all of a block fit, else of 8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for rows, matrix in by_length(batch.column(1)):
                with np.errstate(over="ignore"):
                    scaled = np.floor(scale * matrix.astype(np.float64))
                scaled = np.clip(scaled, -float(LARGEST), float(LARGEST)).astype("<i8")
                for a in range(0, len(rows), BLOCK):
                    part = scaled[a : a + BLOCK]
                    top = int(np.abs(part).max(initial=0))
                    if top < 1 << 31:
                        part = part.astype("<i4")
                    yield pa.RecordBatch.from_pydict(
                        {
                            "block": pa.array([made], pa.int64()),
                            "dim": pa.array([part.shape[1]], pa.int32()),
                            "ids": [ids[rows[a : a + BLOCK]].tobytes()],
                            "numbers": [part.tobytes()],
                            "top": pa.array([top], pa.int64()),
                            "square": [float((part.astype(np.float64) ** 2).sum(axis=1).max())],
                        }
                    )
                    made += 1

    return settle(vectors.mapInArrow(run, _BLOCKS), "vector_blocks")


def _numbers(raw: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4" if len(raw) == 4 * rows * dim else "<i8").reshape(rows, dim)


def _exact(scores: np.ndarray, q: np.ndarray, c: np.ndarray) -> None:
    """Sets the scores whose sums may not fit 64 bits, in whole numbers of any size, cut at LARGEST."""
    q_top = np.abs(q).max(axis=1).astype(np.float64)
    c_top = np.abs(c).max(axis=1).astype(np.float64)
    for i in np.flatnonzero(q_top * c_top.max() * q.shape[1] >= LARGEST / 2):
        at = np.flatnonzero(q_top[i] * c_top * q.shape[1] >= LARGEST / 2)
        sums = c[at].astype(object) @ q[i].astype(object)
        scores[i, at] = [min(max(int(x), -LARGEST), LARGEST) for x in sums]


def _scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids and their scores, exact; a query's own id is masked."""
    q_ids, c_ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
    q, c = _numbers(row["q_numbers"], len(q_ids), row["dim"]), _numbers(row["numbers"], len(c_ids), row["dim"])
    largest = int(row["top"]) * int(row["q_top"]) * row["dim"]
    if largest < 2**53:
        scores = (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    else:
        scores = q.astype(np.int64) @ c.T.astype(np.int64)
        if largest >= LARGEST:
            _exact(scores, q, c)
    return q_ids, c_ids, np.where(q_ids[:, None] == c_ids, np.iinfo(np.int64).min, scores)


def _states(row: dict, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query of a block: lowest score in question, bin width, how many still wanted."""
    place = np.array([s["place"] for s in row["states"]])
    out = []
    for name in ("low", "width", "wanted"):
        values = np.zeros(n, np.int64)
        values[place] = [s[name] for s in row["states"]]
        out.append(values)
    return tuple(out)


def top_k(
    vectors: DataFrame, is_query: Column, k: int, scale: float = 256.0
) -> DataFrame:
    """For each query row of ``vectors(vec_id, embedding)`` its k best rows: query_id, rank,
    vec_id, score.

    Score: inner product of floor(scale * component), an integer. Queries are the rows where
    ``is_query`` holds; candidates are all rows of the same length but those of the query's own
    id. Ties go to the smaller vec_id; a query with fewer candidates gets them all. Rows with a
    null id, or a vector that is null, empty, or has null or non-finite components take no part.
    Repeated rows are candidates each; an empty table, or no query, gives no rows. Scores are exact up
    to 2**61 either way; larger ones count as 2**61 and are ties.

    Every round scores all candidates in blocks and sums, per query, a histogram of the scores
    in question; the bin in which the kth score lies is the next round's range, until a bin is
    one score wide. A task sends no bins below those that hold k scores of its own block, for
    the kth score of all can't lie there. The last pass keeps what reaches the kth score; of equal
    scores a block keeps no more than are wanted. Query blocks are cut into parts of PART bytes; a
    task scores one part against the candidates of one file range, so the work of a query spreads over
    all of them. The parts are shuffled once a round, not copied for each task, and nothing is broadcast: the
    joins are hinted, since Spark would judge a state by its file, which is far smaller than its rows.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("asks")
    )
    candidates = _blocks(rows.select("vec_id", "embedding"), scale)
    queries = _blocks(rows.where("asks").select("vec_id", "embedding"), scale)
    # no score is larger than the largest squared length
    bound = candidates.agg(F.max("square")).first()[0] or 0
    bound = min(int(bound * (1 + 1e-9)) + 1, LARGEST)
    blocks, size = queries.agg(F.count("block"), F.sum(F.octet_length("numbers").cast("long"))).first()
    # a few parts at least, for where candidates lie in few files
    parts = max(1 + (size or 0) // PART, min(blocks, isqrt(int(spark.conf.get("spark.sql.shuffle.partitions")))))
    asked = queries.select(
        F.col("block").alias("q_block"), "dim", F.col("ids").alias("q_ids"),
        F.col("numbers").alias("q_numbers"), F.col("top").alias("q_top"),
    )

    def pairs(state: DataFrame) -> DataFrame:
        held = state.groupBy("q_block").agg(
            F.collect_list(F.struct("place", "low", "width", "wanted")).alias("states")
        )
        mine = asked.join(held.hint("merge"), "q_block").repartition(parts)
        return candidates.join(mine.hint("shuffle_replicate_nl"), "dim")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["q_ids"]) // 8
                yield pa.RecordBatch.from_pydict(
                    {
                        "q_block": np.full(n, row["q_block"]),
                        "place": np.arange(n, dtype=np.int32),
                    }
                )

    width, span = 1, 2 * bound + 1
    while width * BINS < span:
        width *= BINS
    state = settle(
        asked.select("q_block", "q_ids")
        .mapInArrow(places, "q_block bigint, place int")
        .select(
            "q_block", "place", F.lit(-bound).cast("long").alias("low"),
            F.lit(width).cast("long").alias("width"), F.lit(k).cast("long").alias("wanted"),
        ),
        "topk_state",
    )

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, HELD):
            for row in batch.to_pylist():
                q_ids, _, scores = _scores(row)
                low, wide, wanted = _states(row, len(q_ids))
                known = scores > np.iinfo(np.int64).min
                bins = np.where(known, scores - low[:, None], -1) // wide[:, None]
                inside = (bins >= 0) & (bins < BINS)
                at = (np.arange(len(q_ids))[:, None] * BINS + bins)[inside]
                count = np.bincount(at, minlength=len(q_ids) * BINS).reshape(-1, BINS)
                above = np.cumsum(count[:, ::-1], axis=1)[:, ::-1] - count
                place, bucket = np.nonzero((count > 0) & (above < wanted[:, None]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "q_block": np.full(len(place), row["q_block"]),
                        "place": place.astype(np.int32),
                        "bin": bucket.astype(np.int64),
                        "n": count[place, bucket],
                    }
                )

    keys = ["q_block", "place"]
    while True:
        counted = (
            pairs(state)
            .mapInArrow(histogram, "q_block bigint, place int, bin bigint, n bigint")
            .groupBy(*keys, "bin")
            .agg(F.sum("n").alias("n"))
        )
        # at most BINS rows a query: the first bin from above that makes up what is wanted
        bins = F.sort_array(F.collect_list(F.struct("bin", "n")), asc=False)
        reached = F.aggregate(
            "bins",
            F.struct(F.lit(-1).cast("long").alias("bin"), F.lit(0).cast("long").alias("above"), F.lit(False).alias("done")),
            lambda acc, x: F.when(acc["done"], acc).otherwise(
                F.struct(
                    x["bin"].alias("bin"),
                    F.when(acc["above"] + x["n"] >= F.col("wanted"), acc["above"])
                    .otherwise(acc["above"] + x["n"]).alias("above"),
                    (acc["above"] + x["n"] >= F.col("wanted")).alias("done"),
                )
            ),
        )
        found = counted.groupBy(*keys).agg(bins.alias("bins"))
        step = state.join(found.hint("merge"), keys, "left").withColumn("reached", reached)
        done = F.coalesce(F.col("reached.done"), F.lit(False))
        width //= BINS
        state = settle(
            step.select(
                *keys,
                # too few candidates: everything from the lowest score on is wanted
                F.when(done, F.col("low") + F.col("reached.bin") * F.col("width"))
                .otherwise(F.col("low")).alias("low"),
                F.lit(max(width, 1)).cast("long").alias("width"),
                F.when(done, F.col("wanted") - F.col("reached.above"))
                .otherwise(F.col("wanted")).alias("wanted"),
            ),
            "topk_state",
        )
        if width < 1:
            break

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, HELD):
            for row in batch.to_pylist():
                q_ids, c_ids, scores = _scores(row)
                low, _, wanted = _states(row, len(q_ids))
                place, at = np.nonzero((scores >= low[:, None]) & (scores > np.iinfo(np.int64).min))
                value, ids = scores[place, at], c_ids[at]
                order = np.lexsort((ids, -value, place))
                place, value, ids = place[order], value[order], ids[order]
                first = np.searchsorted(place, place)
                tied = value == low[place]
                ties = np.cumsum(tied) - np.concatenate([[0], np.cumsum(tied)])[first]
                use = ~tied | (ties <= np.minimum(wanted[place], k))
                yield pa.RecordBatch.from_pydict(
                    {
                        "q_block": np.full(int(use.sum()), row["q_block"]),
                        "place": place[use].astype(np.int32),
                        "query_id": q_ids[place[use]],
                        "vec_id": ids[use],
                        "score": value[use],
                    }
                )

    kept = pairs(state).mapInArrow(
        keep, "q_block bigint, place int, query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return (
        kept.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
