"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, then exact checks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.graph import components
from starloom.llm.vectors import by_length, groups, usable
from starloom.staging import settle

#: Share of pairs at cosine 0.98 and above that one hash puts together when each vector goes to
#: its PROBES nearest vertices (0.94 and more, measured for 32 to 512 dimensions), set low.
PROBES, TOGETHER = 2, 0.9
#: Share of pairs that all tables may miss; rows of a bucket that one task compares at once.
MISSED, BUCKET_ROWS, BUCKET_GOAL = 1e-9, 4096, 20_000
_SEED = 987654321


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def hash_codes(matrix: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """Bucket codes, one row per vector, of shape (rows, tables, PROBES ** hashes).

    A hash turns the vector by three rounds of random signs and a Hadamard transform and takes the
    nearest of the 2d signed axes; as probes also the next nearest. A table's codes combine
    the choices of ``hashes`` hashes.
    """
    rows, d = matrix.shape
    size = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((rows, size))
    # lengths do not matter, and scaling keeps very large and very small numbers in range
    padded[:, :d] = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    random = np.random.default_rng(_SEED)
    out = np.zeros((rows, tables, PROBES**hashes), np.int64)
    for table in range(tables):
        codes = np.zeros((rows, 1), np.int64)
        for _ in range(hashes):
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * random.choice([-1.0, 1.0], size)) / math.sqrt(size)
            near = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :PROBES]
            vertex = 2 * near + (np.take_along_axis(turned, near, 1) < 0)
            codes = (codes[:, :, None] * (2 * size) + vertex[:, None, :]).reshape(rows, -1)
        out[:, table] = codes
    return out


def _numbers(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and codes of a group."""
    vectors = np.array([np.frombuffer(x.as_py(), "<f8") for x in rows["vector"]])
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    codes = np.array([np.frombuffer(x.as_py(), "<i8") for x in rows["codes"]])
    return vectors, codes


def _links(
    rows: pa.Table, table: int, code: int, block: tuple[int, int], shape: tuple[int, int],
    least: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i before j, that reach ``least`` and share no bucket before this one."""
    vectors, codes = _numbers(rows)
    codes = codes.reshape(len(codes), *shape)
    own = rows["own"].to_numpy()
    left = np.flatnonzero(own == block[0])
    right = np.flatnonzero(own == block[1])
    near = vectors[left] @ vectors[right].T >= least
    if block[0] == block[1]:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    i, j = left[i], right[j]
    fresh = np.ones(len(i), bool)
    for t in range(table + 1):
        a, b = codes[i, t], codes[j, t]
        for x in range(shape[1]):
            for y in range(shape[1]):
                same = a[:, x] == b[:, y]
                fresh &= ~(same if t < table else same & (a[:, x] < code))
    return i[fresh], j[fresh]


def _smallest(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest id among those that the pairs connect it with."""
    out = ids.copy()
    while True:
        before = out.copy()
        low = np.minimum(out[i], out[j])
        np.minimum.at(out, i, low)
        np.minimum.at(out, j, low)
        if (out == before).all():
            return out


def near_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding, label)``: vec_id, n_links, component_id,
    kept.

    Vectors of one label link if their cosine in double precision is ``least`` or more, for
    ``least`` from 0.98 on: the tables are as many as that takes to miss one pair in a
    billion. ``component_id`` is the smallest vec_id reachable, ``kept`` tells whether it is the
    row's own. Rows whose label, id or vector is null, or whose vector is empty, zero or has
    null or non-finite components, link with nothing: 0 links, their own component, kept.
    Vectors of different length do not link. Repeated rows link with each other; an empty table
    gives no rows.

    Equal vectors of a label are one class, compared once and counted as often as they are.
    A pair is counted in the first bucket it shares, so nothing has to be made distinct. A
    bucket of more than BUCKET_ROWS classes is cut into blocks, and pairs of blocks are tasks of
    their own; within one, links are reduced to a count and the smallest connected id per row.
    """
    if least < 0.98:
        raise ValueError("hashing is laid out for cosines of 0.98 and more")
    zero = F.forall("embedding", lambda x: x == 0)
    good = usable(F.col("embedding")) & ~zero & F.col("label").isNotNull()
    good = good & F.col("vec_id").isNotNull()
    good = F.coalesce(good, F.lit(False))
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    classes = (
        plain.where(good)
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    )
    # the largest label's rows set the number of hashes: buckets stay small, none is left out
    sizes = plain.where(good).groupBy("label").agg(
        F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")
    )
    most = sizes.agg(F.max("n"), F.max("d")).first()
    n, d = most[0] or 1, most[1] or 2
    hashes = 1 + int(math.log(max(n / BUCKET_GOAL, 1)) / math.log(2 * max(d, 2)))
    tables = math.ceil(math.log(MISSED) / math.log(1 - TOGETHER**hashes))
    shape = (tables, PROBES**hashes)
    double = F.transform("embedding", lambda x: x.cast("double"))

    def hashed(batches: Iterator[pa.RecordBatch], full: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in by_length(batch.column(3)):
                for a in range(0, len(rows), 2048):
                    at, part = rows[a : a + 2048], matrix[a : a + 2048]
                    codes = hash_codes(part, tables, hashes)
                    every = np.repeat(at, codes[0].size)
                    out = {
                        "label": batch.column(0).take(pa.array(every)),
                        "length": np.full(len(every), part.shape[1], np.int32),
                        "place": np.tile(np.repeat(np.arange(tables, dtype=np.int32), shape[1]), len(at)),
                        "code": codes.reshape(-1),
                    }
                    if full:
                        # each bucket row carries its vector and codes: tables * probes copies
                        packed = [codes[k].astype("<i8").tobytes() for k in range(len(at))]
                        raw = [part[k].astype("<f8").tobytes() for k in range(len(at))]
                        each = pa.array(np.repeat(np.arange(len(at)), codes[0].size))
                        out["id"] = batch.column(1).take(pa.array(every))
                        out["copies"] = batch.column(2).take(pa.array(every))
                        out["vector"] = pa.array(raw, pa.binary()).take(each)
                        out["codes"] = pa.array(packed, pa.binary()).take(each)
                    yield pa.RecordBatch.from_pydict(out)

    kind = classes.schema["label"].dataType.simpleString()
    keys = f"label {kind}, length int, place int, code bigint"
    source = classes.select("label", "id", "copies", double.alias("numbers"))
    hot = (
        source.mapInArrow(lambda batches: hashed(batches, False), keys)
        .groupBy("label", "length", "place", "code")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > BUCKET_ROWS)
        .withColumn("blocks", F.ceil(F.col("n") / (BUCKET_ROWS // 2)).cast("int"))
        .drop("n")
    )
    rows = source.mapInArrow(
        lambda batches: hashed(batches, True),
        f"{keys}, id bigint, copies bigint, vector binary, codes binary",
    )
    rows = rows.join(hot, ["label", "length", "place", "code"], "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))
    )
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns(
        {"first": F.least("own", "other"), "second": F.greatest("own", "other")}
    )
    group = ["label", "length", "place", "code", "first", "second"]
    rows = rows.select(*group, "own", "id", "copies", "vector", "codes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], []]
        for key, found in groups(batches, len(group)):
            if found.num_rows < 2:
                continue
            _, _, table, code, first, second = key
            i, j = _links(found, int(table), int(code), (first, second), shape, least)
            if not len(i):
                continue
            ids, copies = found["id"].to_numpy(), found["copies"].to_numpy()
            n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
            low = _smallest(len(ids), i, j, ids)
            at = np.flatnonzero(n)
            for column, part in zip(held, (ids[at], n[at].astype(np.int64), low[at])):
                column.append(part)
        if held[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c), pa.int64()) for c in held], names=["id", "n", "low"]
            )

    linked = (
        rows.repartition(*[F.col(c) for c in group])
        .sortWithinPartitions(*group)
        .mapInArrow(compare, "id bigint, n bigint, low bigint")
    )
    linked = settle(linked, "vector_links")
    joined = components(linked.where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")))
    counts = linked.groupBy("id").agg(F.sum("n").alias("n"))
    result = (
        classes.join(counts, "id", "left")
        .join(joined.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "label", "embedding",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    usual = plain.where(good).join(result, ["label", "embedding"])
    alone = plain.where(~good).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        usual.select("vec_id", "n_links", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
