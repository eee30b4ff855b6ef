"""Near-duplicate texts: one-permutation hashing with optimal densification, banded buckets, star
edges, and every link confirmed on the full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import text as tx
from starloom.llm.graph import components
from starloom.llm.vectors import groups
from starloom.staging import settle

#: Words of a shingle, rows of a band, and the share of links that all bands may miss.
WORDS, ROWS, MISSED = 5, 8, 1e-5
#: What one task compares at once: documents and bytes of a block of a cluster.
BLOCK_DOCS, BLOCK_BYTES = 500, 4 << 20
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def bands_for(least: float, rows: int = ROWS, missed: float = MISSED) -> int:
    """Bands of ``rows`` values that find a pair of similarity ``least`` but for ``missed``."""
    return math.ceil(math.log(missed) / math.log(1 - least**rows))


def _donors(bins: int, turn: int) -> np.ndarray:
    """For each bin the bin to ask in this turn; the same for every document."""
    with np.errstate(over="ignore"):
        x = tx.mix(np.arange(bins, dtype=np.uint64) + np.uint64(turn + 1) * np.uint64(1_000_003))
    return (x % np.uint64(bins)).astype(np.int64)


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One-permutation minima: a row of ``bins`` values per set of 64-bit hashes.

    One hash deals the elements into bins and each bin keeps its least. An empty bin asks other
    bins, in an order that depends on the bin and the turn only, and copies the first that was
    filled from the set itself. Empty sets have all bins at the largest value.
    """
    out = np.full((len(sets), bins), _NONE)
    if not sets:
        return out
    flat = tx.mix(np.concatenate(sets) ^ np.uint64(0x5851F42D4C957F2D))
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    place = ((flat >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    np.minimum.at(out.reshape(-1), row * bins + place.astype(np.int64), tx.mix(flat))
    filled = out != _NONE
    rows, empty = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    result, turn = out.copy(), 0
    while len(rows):
        donor = _donors(bins, turn)[empty]
        found = filled[rows, donor]
        result[rows[found], empty[found]] = out[rows[found], donor[found]]
        rows, empty, turn = rows[~found], empty[~found], turn + 1
    return result


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    rows = signature.reshape(len(signature), bands, -1)
    key = np.tile(np.arange(bands, dtype=np.uint64), (len(signature), 1))
    for k in range(rows.shape[2]):
        key = tx.mix(key * np.uint64(0xD1342543DE82EF95) + rows[:, :, k])
    return key


def _sketches(docs: DataFrame, bands: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in tx.chunks(batch.column(1)):
                sets = tx.word_shingles(batch.column(1).slice(a, b - a), WORDS)
                keys = band_keys(signatures(sets, bands * ROWS), bands).astype(np.int64)
                sums = [
                    np.array([tx.mix(s + np.uint64(salt)).sum(dtype=np.uint64) for s in sets], np.uint64)
                    for salt in (11, 23)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        *(pa.array(s.view(np.int64)) for s in sums),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), keys.reshape(-1)
                        ),
                    ],
                    names=["doc_id", "n", "one", "two", "bands"],
                )

    schema = "doc_id bigint, n bigint, one bigint, two bigint, bands array<bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def linked_groups(
    sets: list[np.ndarray], ids: np.ndarray, percent: int
) -> Iterator[np.ndarray]:
    """Groups of positions connected by links, each of two or more.

    Linked are sets with 100 * intersection >= percent * union. Each set that has joined a group is
    compared with all sets that have joined none, so no link to a new set is missed; sets
    already together are not compared again.
    """
    order = np.argsort(ids, kind="stable")
    size = np.array([len(s) for s in sets])
    values, dense = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(size)])
    flag = np.zeros(len(values), bool)
    rest = order[size[order] > 0]

    def laid(left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [dense[starts[k] : starts[k + 1]] for k in left]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(size[left])[:-1]])

    if not len(rest):
        return
    open_ = np.ones(len(rest), bool)
    flat, offsets = laid(rest)
    while open_.any():
        seed = int(np.flatnonzero(open_)[0])
        open_[seed] = False
        queue, group = [rest[seed]], [rest[seed]]
        while queue and open_.any():
            if open_.sum() * 2 < len(rest):
                rest = rest[open_]
                flat, offsets = laid(rest)
                open_ = np.ones(len(rest), bool)
            one = queue.pop()
            own = dense[starts[one] : starts[one + 1]]
            flag[own] = True
            both = np.add.reduceat(flag[flat].astype(np.int64), offsets)
            flag[own] = False
            union = size[one] + size[rest] - both
            hit = open_ & (100 * both >= percent * union)
            open_[hit] = False
            queue.extend(rest[hit].tolist())
            group.extend(rest[hit].tolist())
        if len(group) > 1:
            yield np.array(group)


def near_texts(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept.

    A document's set: its distinct shingles of five words, A-Z lower-cased; with fewer words
    its whole sequence as one; without words none. Documents link if 100 * intersection >=
    ``percent`` * union. ``component_id`` is the smallest doc_id reachable, ``kept`` tells
    whether it is the row's own. Null and empty texts link with nothing and are kept; rows with a
    null id link with nothing, have no component and are kept; rows of one id are one document;
    an empty table gives no rows. Texts are read whole, and sets compared by 64-bit hashes.

    Documents of equal sets are one class. A bucket gives one edge from each class to its smallest, so
    edges stay below classes times bands. The components of these edges are the clusters within
    which links are looked for: every pair that shares a bucket is in one cluster, so
    confirming sets there loses none. Clusters too large for a task are cut into blocks, and pairs of
    blocks are compared in tasks of their own.
    """
    bands = bands_for(percent / 100)
    sketch = settle(_sketches(docs, bands), "minhash_sketch")
    whole = sketch.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    same = ["one", "two", "n"]
    classes = settle(
        whole.groupBy(*same).agg(F.min("doc_id").alias("id")), "minhash_classes"
    )
    buckets = (
        whole.select("doc_id", "bands")
        .join(classes.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
        .select(F.col("doc_id").alias("id"), F.explode("bands").alias("bucket"))
    )
    centers = (
        buckets.groupBy("bucket")
        .agg(F.min("id").alias("center"), F.max("id").alias("other"))
        .where("center < other")
        .drop("other")
    )
    # written first: a join of two plain shuffles can have its large partitions split
    centers = settle(centers, "minhash_centers")
    stars = buckets.join(centers, "bucket").where("id <> center")
    clusters = components(
        stars.select(F.col("id").alias("a"), F.col("center").alias("b")).distinct()
    )
    clusters = settle(clusters.select(F.col("node").alias("id"), F.col("component").alias("cluster")), "minhash_clusters")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").join(clusters, "id")
    # of a cluster only its size in documents and bytes is needed to lay out blocks
    lengths = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.octet_length("text").alias("b"))
    large = (
        lengths.join(clusters, "id")
        .groupBy("cluster")
        .agg(F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("b") / BLOCK_BYTES)).cast("int").alias("blocks"))
        .where("blocks > 1")
    )
    rows = texts.join(large, "cluster", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")})
    group = ["cluster", "first", "second"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in groups(batches, len(group)):
            ids = found["id"].to_numpy()
            sets = []
            for part in found["text"].chunks:
                for a, b in tx.chunks(part):
                    sets += tx.word_shingles(part.slice(a, b - a), WORDS)
            for at in linked_groups(sets, ids, percent):
                yield pa.RecordBatch.from_pydict(
                    {"a": ids[at], "b": np.full(len(at), ids[at].min())}
                )

    links = (
        rows.select(*group, "id", "text")
        .repartition(*[F.col(c) for c in group])
        .sortWithinPartitions(*group)
        .mapInArrow(compare, "a bigint, b bigint")
    )
    joined = components(settle(links, "minhash_links")).withColumnRenamed("node", "id")
    found = classes.join(joined, "id", "left").select(
        *same, F.coalesce("component", "id").alias("component_id")
    )
    # classes without words and null ids have no match here
    usable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return (
        sketch.select("doc_id", *same)
        .join(found, same, "left")
        .select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(usable, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` without near duplicates: of each component the document of smallest id stays.

    All columns stay. Of rows repeated under one id one stays; rows with a null id all do.
    """
    kept = near_texts(docs, percent).where("kept").select("doc_id").distinct()
    known = docs.where(F.col("doc_id").isNotNull())
    return (
        known.join(kept, "doc_id", "left_semi")
        .dropDuplicates(["doc_id"])
        .unionByName(docs.where(F.col("doc_id").isNull()))
    )
