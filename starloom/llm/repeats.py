"""Long repeats between and within texts: a run-length index over the places where texts may agree.

Content-defined segments lead to the places: of every ``length``-byte string the least-hashed short
gram is its anchor, so equal strings have equal anchors, and strings of one anchor form a segment.
Segments that share their core bytes come to one task, which indexes the distinct ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import text as tx
from starloom.llm.vectors import groups, slices
from starloom.staging import new_path

#: Bytes of an anchor's gram, the core of its segments; bytes of segments indexed together; segments of
#: one core beyond which they are cut and told apart by more of the bytes around it.
GRAM, INDEX_BYTES, CORE_SEGMENTS = 48, 1 << 19, 4096
#: Bits of a place in a text; the rest of 64 are of the hash that chooses an anchor, in texts of any length.
PLACE_BITS = 31
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass
class RunLengthIndex:
    """The run-compressed Burrows-Wheeler transform of a text, with samples at the run ends.

    ``heads`` and ``lengths`` are the runs. Where a run starts, the text position of its first suffix and
    what that has in common with the suffix before it are kept; where it ends, the same of its last
    suffix and the one after. Inside a run these lengths fall by one from a text position to the next.
    """

    heads: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    first_common: np.ndarray
    last: np.ndarray
    last_common: np.ndarray

    def matching(self, n: int) -> np.ndarray:
        """Matching statistics of the text against itself, streamed in text order: for each
        position the longest match that starts at any other position."""
        best = np.zeros(n, np.int64)
        for at, common in ((self.first, self.first_common), (self.last, self.last_common)):
            sample = np.full(n, -1, np.int64)
            sample[at] = common
            place = np.where(sample >= 0, np.arange(n), -1)
            place = np.maximum.accumulate(place)
            known = place >= 0
            value = np.where(known, sample[place] - (np.arange(n) - place), 0)
            best = np.maximum(best, value)
        return best


#: Signs that the first sort of suffixes looks at, 9 bits each; each round doubles them.
_FIRST = 7
#: Stands behind every segment.
SEPARATOR = 256


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in the order of their suffixes; the end of the text comes before any sign, bytes
    before the separator.

    Also the rank of every position by its first 7, 14, 28 and so on bytes, equal where they are.
    """
    n = len(text)
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(8, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(_FIRST):  # 9 bits a byte
        key = key << np.uint64(9) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
    levels, depth = [rank], _FIRST
    while True:
        # only suffixes that are not alone in their class are sorted on
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return order, levels
        part = order[at]
        ahead = part + depth
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        both = rank[part].astype(np.int64) * (n + 1) + second
        inner = np.argsort(both, kind="stable")
        order[at], both = part[inner], both[inner]
        fresh = np.concatenate([[True], both[1:] != both[:-1]])
        new[at] |= fresh
        rank = rank.copy()
        rank[order[at]] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        levels.append(rank)
        depth *= 2


def _common(text: np.ndarray, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of each pair of suffixes, from the ranks: the longest
    steps first, each at most once, and the last few bytes one by one."""
    n, start = len(text), a
    for k in reversed(range(len(levels))):
        inside = np.maximum(a, b) < n
        equal = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        step = np.where(equal, _FIRST << k, 0)
        a, b = a + step, b + step
    live = np.arange(len(a))
    for _ in range(_FIRST - 1):
        live = live[np.maximum(a[live], b[live]) < n]
        live = live[text[a[live]] == text[b[live]]]
        a[live] += 1
        b[live] += 1
    return np.minimum(a - start, n - np.maximum(start, b - (a - start)))


def build_index(text: np.ndarray) -> RunLengthIndex:
    """Suffixes are sorted, then only runs and run ends are kept."""
    order, levels = suffix_array(text)
    bwt = np.where(order > 0, text[order - 1].astype(np.int16), -1)
    start = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
    end = np.concatenate([start[1:], [len(order)]]) - 1
    before, after = order[np.maximum(start - 1, 0)], order[np.minimum(end + 1, len(order) - 1)]
    first_common = _common(text, levels, order[start], before)
    last_common = _common(text, levels, order[end], after)
    first_common[0] = 0
    last_common[-1] = 0
    return RunLengthIndex(
        bwt[start], end - start + 1, order[start], first_common, order[end], last_common
    )


def repeated_starts(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment a flag per string of ``length`` bytes: whether it starts elsewhere too.

    The segments are laid end to end, after each a sign that is no byte. No string of a segment
    holds that sign, so none matches over one, whatever bytes the texts are of.
    """
    text = np.full(sum(map(len, segments)) + len(segments), SEPARATOR, np.int16)
    at = 0
    for segment in segments:
        text[at : at + len(segment)] = np.frombuffer(segment, np.uint8)
        at += len(segment) + 1
    matching = build_index(text).matching(len(text))
    out, at = [], 0
    for segment in segments:
        out.append(matching[at : at + max(len(segment) - length + 1, 0)] >= length)
        at += len(segment) + 1
    return out


def _windows(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Segments of a run of texts: row, first and last start (within the row), and core hash.

    A string's anchor is its gram of least hash, the leftmost of equals. The strings of one anchor
    are consecutive and all have the anchor's bytes, their core.
    """
    n, grams = len(data), length - GRAM + 1
    empty = np.empty(0, np.int64)
    if n < length:
        return empty, empty, empty, empty.astype(np.uint64)
    prefix = tx.prefix_hashes(data)
    at = np.arange(n - GRAM + 1)
    bits = np.uint64(PLACE_BITS)
    hashes = tx.span_hashes(prefix, at, at + GRAM)
    least = hashes >> bits << bits | at.astype(np.uint64)
    width = 1
    while width * 2 <= grams:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: n - length + 1], least[grams - width : grams - width + n - length + 1])
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    start = np.arange(n - length + 1)
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    valid = row_of[: n - length + 1] == row_of[length - 1 :]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    new &= valid
    first = np.flatnonzero(new)
    if not len(first):
        return empty, empty, empty, empty.astype(np.uint64)
    stop = np.flatnonzero(valid & np.concatenate([new[1:] | ~valid[1:], [True]]))
    core = hashes[anchor[first]]
    row = row_of[first]
    return row, first - offsets[row], stop - offsets[row], core


@contextmanager
def _tidy(spark: SparkSession):
    """Shuffle files of a finished write go at once, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def _settle(df: DataFrame, name: str) -> DataFrame:
    path = new_path(df.sparkSession, name)
    with _tidy(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def find_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """(one, two, spans): for each text that has any, the starts of its repeated strings.

    ``one`` and ``two`` name the text: two hashes of it, so equal texts are one. ``spans``
    are pairs (first, last): every string of ``length`` bytes that starts from first to last, in
    bytes from 0, also starts somewhere else in ``docs(text)``, in the same text or another row.
    """
    texts = docs.where(F.octet_length("text") >= length).select(
        F.xxhash64("text").alias("one"), F.hash("text").alias("two"), "text"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (batch.column(k).to_numpy() for k in (0, 1))
            for a, b in tx.chunks(batch.column(2)):
                data, offsets = tx.joined(batch.column(2).slice(a, b - a))
                row, first, last, core = _windows(data, offsets, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core.view(np.int64)), pa.array(one[a:b][row]), pa.array(two[a:b][row]),
                        pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                    ],
                    names=["core", "one", "two", "first", "last"],
                )

    places = _settle(
        texts.mapInArrow(cut, "core bigint, one bigint, two int, first int, last int"), "places"
    )
    # written first: a join of two plain shuffles can have its large partitions split
    shared = places.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    shared = _settle(shared, "shared_cores")
    # a text's own segments, at most one for each of its bytes
    wanted = (
        places.join(shared, "core")
        .groupBy("one", "two")
        .agg(F.collect_set(F.struct("first", "last", "core")).alias("places"))
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["core", "digest", "one", "two", "first", "segment"]
        types = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in slices(batches):
            columns: list[list] = [[] for _ in names]
            held = 0
            for one, two, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                for place in sorted(found, key=lambda p: p["first"]):
                    part = raw[place["first"] : place["last"] + length]
                    digest = hashlib.blake2b(part, digest_size=16).digest()
                    row = (place["core"], digest, one, two, place["first"], part)
                    for column, value in zip(columns, row):
                        column.append(value)
                    held += len(part)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types)], names=names
                    )
                    columns, held = [[] for _ in names], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names
            )

    parts = _settle(
        texts.join(wanted, ["one", "two"]).mapInArrow(
            segments,
            "core bigint, digest binary, one bigint, two int, first int, segment binary",
        ),
        "segments",
    )
    distinct = parts.groupBy("core", "digest").agg(
        F.first("segment").alias("segment"), F.count("*").alias("n")
    )
    # where the core stands is looked up in the few segments that are cut
    distinct = distinct.withColumns({"at": F.lit(-1), "width": F.lit(GRAM)})
    hits = _hits(_settle(distinct, "distinct_segments"), length)
    return (
        parts.select("core", "digest", "one", "two", "first")
        .join(_settle(hits, "segment_hits"), ["core", "digest"])
        .groupBy("one", "two")
        .agg(
            F.collect_set(
                F.struct((F.col("first") + F.col("low")).alias("first"), (F.col("first") + F.col("high")).alias("last"))
            ).alias("spans")
        )
    )


def _hits(distinct: DataFrame, length: int) -> DataFrame:
    """(core, digest, low, high): runs of repeated strings in ``distinct(core, digest, segment, n, at,
    width)``, different segments by the core they share. All strings of a segment hold its core, the
    ``width`` bytes at ``at``; equal strings have it at the same place.

    Segments of a core are indexed together. Around a core with too many of them each is cut in two: the
    strings with more bytes before the core, which share those next to it, and the strings with more
    behind. Core and shared bytes are the core of the cut segments, and they are indexed in their turn. A
    cut halves what is not shared, so after eight of them a core is the whole string.
    """
    crowded = (
        distinct.groupBy("core").agg(F.count("*").alias("m")).where(F.col("m") > CORE_SEGMENTS)
    ).select("core")
    crowded = _settle(crowded, "crowded_cores")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for _, found in groups(batches, 1):
            held += zip(*(found[c].to_pylist() for c in ("core", "digest", "segment", "n")))
            size += sum(len(x) for x in found["segment"].to_pylist())
            if size > INDEX_BYTES:
                yield matched(held)
                held, size = [], 0
        if held:
            yield matched(held)

    def matched(held: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        for (core, digest, segment, n), again in zip(
            held, repeated_starts([h[2] for h in held], length)
        ):
            # a segment that stands in several places is there once, and repeats itself
            again = again | (n > 1)
            edge = np.flatnonzero(np.diff(np.concatenate([[False], again, [False]]).astype(np.int8)))
            out += [(core, digest, a, b - 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
        columns = list(zip(*out)) or [[], [], [], []]
        types = [pa.int64(), pa.binary(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["core", "digest", "low", "high"]
        )

    hits = (
        distinct.join(crowded, "core", "left_anti")
        .repartition("core")
        .sortWithinPartitions("core")
        .select("core", "digest", "segment", "n")
        .mapInArrow(index, "core bigint, digest binary, low int, high int")
    )
    if crowded.isEmpty():
        return hits
    schema = "whole bigint, uncut binary, core bigint, digest binary, shift int, segment binary, n bigint, at int, width int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        types = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
        for batch in slices(batches, 2000):
            out = []
            for core, digest, segment, n, at, width in zip(*(c.to_pylist() for c in batch.columns)):
                for shift, part, place, wide in _halves(segment, core, at, width, length):
                    held = part[place : place + wide]
                    inner = int.from_bytes(hashlib.blake2b(held, digest_size=8).digest(), "big", signed=True)
                    mark = hashlib.blake2b(part + place.to_bytes(4, "big"), digest_size=16).digest()
                    out.append((core, digest, inner, mark, shift, part, n, place, wide))
            columns = list(zip(*out)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names
            )

    many = distinct.join(crowded, "core", "left_semi").select("core", "digest", "segment", "n", "at", "width")
    halves = _settle(many.mapInArrow(cut, schema), "cut_segments")
    inner = halves.groupBy("core", "digest").agg(
        *(F.first(c).alias(c) for c in ("segment", "at", "width")), F.sum("n").alias("n")
    )
    found = _settle(_hits(_settle(inner, "distinct_segments"), length), "cut_hits")
    # the hits are written: halves that many segments share can be split
    back = halves.select("whole", "uncut", "core", "digest", "shift").join(found, ["core", "digest"])
    place = [(F.col("shift") + F.col(c)).alias(c) for c in ("low", "high")]
    return hits.unionByName(
        back.select(F.col("whole").alias("core"), F.col("uncut").alias("digest"), *place)
    )


def _halves(
    segment: bytes, core: int, at: int, width: int, length: int
) -> Iterator[tuple[int, bytes, int, int]]:
    """The segment's strings with more bytes before the core, then those with more behind it: where
    the part begins, the part, and the place and width of the wider core in it."""
    last = len(segment) - length  # start of the last string
    if at < 0:
        # the leftmost gram of that hash that all strings hold is their anchor
        data = np.frombuffer(segment, np.uint8)
        places = np.arange(last, length - GRAM + 1)
        hashes = tx.span_hashes(tx.prefix_hashes(data), places, places + GRAM).view(np.int64)
        at = int(places[np.flatnonzero(hashes == core)[0]])
    free = length - width
    before = (free + 1) // 2
    # a string that starts at x has at - x bytes before the core
    split = min(last, at - before)
    if split >= 0:
        yield 0, segment[: split + length], at - before, width + before
    start = max(0, at - before + 1)
    if start <= last:
        yield start, segment[start:], at - start, width + free - before + 1


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed, n_spans, kept.

    Texts are UTF-8 bytes. Each byte is removed that lies in a string of ``length`` bytes which
    also starts anywhere else, in this text or another, judged on the texts as given; ``kept`` is what
    is left, as binary, and n_spans the number of maximal removed runs. Null texts count as empty;
    texts shorter than ``length`` stay whole. Repeated rows are copies of each other and lose
    everything if long enough. An empty table gives no rows.
    """
    spans = _settle(find_repeats(docs, length), "repeat_spans")
    rows = docs.select(
        "doc_id", "text", F.xxhash64("text").alias("one"), F.hash("text").alias("two")
    )
    joined = rows.join(spans, ["one", "two"], "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], [], []]
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = (text or "").encode()
                kept, gone, runs, at = [], 0, 0, 0
                reach = -1  # end of the removed run so far
                for span in sorted(found or (), key=lambda s: s["first"]):
                    a, b = span["first"], span["last"] + length
                    if a > reach:
                        runs += 1
                        kept.append(raw[at:a])
                    gone += max(0, b - max(a, reach))
                    reach = at = max(reach, b)
                kept.append(raw[at:])
                for column, value in zip(out, (len(raw), gone, runs, b"".join(kept))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]),
                    pa.array(out[3], pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return joined.mapInArrow(
        strike, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )
