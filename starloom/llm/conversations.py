"""Structure repair of conversations: cheapest edits that make the roles fit the grammar."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from starloom.llm.roles import FINE, CUT, GONE, RoleRepair, row_code
from starloom.staging import settle

#: Rows of a block, whose duplicates travel together, and bytes of texts in one part of a conversation.
BLOCK_BITS, PART_BYTES = 8, 4 << 20
_ROLE = {"u": "user", "a": "assistant"}
_SPACE = " \t\n\x0b\x0c\r"
_LINES = "array<struct<role:string,text:string>>"
_STATS = "n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, last string, low bigint, high bigint, turns bigint"
_loaded: list[RoleRepair] = []


def _repair() -> RoleRepair:
    """The grammar's tables, kept by the worker."""
    if not _loaded:
        _loaded.append(RoleRepair())
    return _loaded[0]


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` with damage by crc32 of ``conv_id:turn`` modulo 20.

    0 marks a row dropped (it stays, so that its conversation is known), 1 empties the text, 2 takes
    its full stops, exclamation and question marks, 3 repeats the row, 4 makes its role user. Nulls
    count as one space, but order and gaps take a null turn as null.
    """
    said = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    kind = F.crc32(said.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        (kind == 0).alias("dropped"), F.when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return rows.select(
        "conv_id", "turn", "role", "text", "dropped",
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"),
    ).drop("time")


def _placed(rows: DataFrame) -> DataFrame:
    """Rows in the order of conversation and turn, numbered by ``at`` over all tasks; a long
    conversation reaches over several. Equal turns go by role and the text's md5."""
    keys = ["conv_id", "turn", "role", "mark", "tie"]
    given = rows.select(
        "conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), "dropped"
    )
    marked = given.withColumns(
        {"mark": F.md5(F.col("text").cast("binary")), "tie": F.monotonically_increasing_id()}
    )
    spread = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    return settle(spread.withColumn("at", F.monotonically_increasing_id()), "turns")


def _duplicates(placed: DataFrame) -> DataFrame:
    """(block, again): the places of rows whose role and text came earlier in their conversation."""
    kept = placed.where(~F.col("dropped")).select("conv_id", "role", "mark", "at")
    firsts = kept.groupBy("conv_id", "role", "mark").agg(
        F.min("at").alias("first"), F.count("*").alias("n")
    )
    # written first: the side with the copies of one row can then be split
    firsts = settle(firsts.where("n > 1").drop("n"), "first_of_copies").alias("f")
    same = F.col("k.conv_id").eqNullSafe(F.col("f.conv_id"))
    same &= (F.col("k.role") == F.col("f.role")) & (F.col("k.mark") == F.col("f.mark"))
    later = kept.alias("k").join(firsts, same).where("k.at > f.first").select("k.at")
    found = later.groupBy(F.shiftright("at", BLOCK_BITS).alias("block")).agg(
        F.collect_list("at").alias("again")
    )
    return settle(found, "duplicate_turns")


class _Part:
    """Consecutive rows of one conversation."""

    def __init__(self, conv, at: int):
        self.conv, self.at = conv, at
        self.codes, self.lines, self.size = bytearray(), [], 0
        self.counts, self.illegal = [0, 0, 0, 0], 0
        self.head = self.last = self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        allowed = FINE if fault == 0 else CUT if fault == 3 else GONE
        self.codes.append(row_code(initial, allowed))
        self.lines.append((role, text))
        self.size += len(text)
        self.counts[fault] += 1
        if self.last is None:
            self.head = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def stats(self) -> tuple:
        return (
            len(self.codes), *self.counts[1:], self.illegal, self.head, self.last, self.low,
            self.high, self.turns,
        )

    def edited(self, edits: list[str], roles: list[str]) -> list[dict]:
        """The rows after their edits: one more entry than rows is what stands behind them."""
        out = []
        for k, (letters, given) in enumerate(zip(edits, roles)):
            for letter, x in zip(letters, given):
                if letter == "I":
                    out.append({"role": _ROLE[x], "text": ""})
                elif letter != "D":
                    role, text = self.lines[k]
                    out.append({"role": role if letter == "K" else _ROLE[x], "text": text})
        return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Part, bool]]:
    """Parts in order, and whether a part is its whole conversation: the rows before and after it
    are there and belong to others."""
    part, whole, before = None, False, None
    for batch in batches:
        for conv, at, turn, role, text, dropped, fault in zip(*(c.to_pylist() for c in batch.columns)):
            follows = before is not None and at == before + 1
            if part is None or not follows or conv != part.conv or part.size > PART_BYTES:
                other = part is not None and follows and conv != part.conv
                if part is not None:
                    yield part, whole and other
                part, whole = _Part(conv, at), other
            if not dropped:
                part.add(turn, role, text, fault)
            before = at
    if part is not None:
        yield part, False


def _gaps(low, high, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


def analysed(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text, dropped)`` in parts of conversations, written.

    A conversation that one task holds is one part with its cheapest repair: gaps, counts of faults,
    cost, audit and lines. Of longer ones each part has, for every stack it may begin with, the
    costs and the order of those it may end with, and its rows; ``joined_parts`` settles them.
    """
    placed = _placed(rows)
    body = F.rtrim(F.col("text"), F.lit(_SPACE))
    again = F.coalesce(F.array_contains("again", F.col("at")), F.lit(False))
    fault = (
        F.when(body == "", 1).when(again, 2)
        .when(~F.substring(body, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    )
    turns = (
        placed.withColumn("block", F.shiftright("at", BLOCK_BITS))
        .join(_duplicates(placed), "block", "left")
        .select("conv_id", "at", "turn", "role", "text", "dropped", fault.alias("fault"))
        .sortWithinPartitions("at")
    )
    conv = rows.schema["conv_id"]
    rest = f"at bigint, whole boolean, {_STATS}, cost bigint, audit string, lines {_LINES}, codes binary, ways string"
    schema = StructType([conv, *_parse_datatype_string(rest).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, arrow = _repair(), _arrow(schema)
        out, held = [], 0
        for part, whole in _parts(batches):
            codes = bytes(part.codes)
            if whole:
                tops, cost, trail = repair.run(codes)
                more, place, tail, end = repair.finish(tops)
                edits, roles = repair.way(trail, place)
                lines = part.edited([*edits, tail], [*roles, end])
                row = (cost + more, "".join(edits) + tail, lines, None, None)
            else:
                ways = []
                for node in range(repair.size):
                    tops, cost, _ = repair.run(codes, node)
                    ways.append([(n, c + cost) for n, c in tops])
                lines = [{"role": r, "text": t} for r, t in part.lines]
                row = (None, None, lines, codes, json.dumps(ways))
            out.append((part.conv, part.at, whole, *part.stats(), *row))
            held += part.size + 100
            if held > PART_BYTES:
                yield _batch(out, arrow)
                out, held = [], 0
        yield _batch(out, arrow)

    return settle(turns.mapInArrow(run, schema), "conversation_parts")


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _planned(parts: DataFrame) -> DataFrame:
    """For each part of a longer conversation where it begins and ends; the last one has the totals.

    Parts are small here: costs between stacks, no texts. They go from first to last, equal tops
    merging as row by row, and back along the cheapest way.
    """
    conv = parts.schema["conv_id"]
    rest = "at bigint, node int, place int, tail string, end string, last boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    schema = StructType([conv, *_parse_datatype_string(rest).fields])
    stats = [c.split()[0] for c in _STATS.split(", ")]

    def one(conv, held: list[dict]) -> list[tuple]:
        repair = _repair()
        tops, backs, sums, illegal, turns = ((0, 0),), [], [0, 0, 0], 0, 0
        last = low = high = None
        for part in held:
            ways, best = json.loads(part["ways"]), {}
            for place, (node, cost) in enumerate(tops):
                for inner, (new, more) in enumerate(ways[node]):
                    entry = (cost + more, place, inner)
                    if new not in best or entry < best[new]:
                        best[new] = entry
            ordered = sorted(best.items(), key=lambda kv: kv[1][1:])
            backs.append([(tops[e[1]][0], e[1], e[2]) for _, e in ordered])
            tops = tuple((node, e[0]) for node, e in ordered)
            sums = [x + part[c] for x, c in zip(sums, ("blank", "duplicate", "truncated"))]
            illegal += part["illegal"]
            if part["n"]:
                illegal += last is not None and last + part["head"] not in ("su", "ua", "au")
                last = part["last"]
            if part["turns"]:
                turns += part["turns"] - (part["low"] == high)
                low = part["low"] if low is None else low
                high = part["high"]
        cost, place, tail, end = repair.finish(tops)
        out = []
        for k in reversed(range(len(held))):
            node, before, inner = backs[k][place]
            final = k == len(held) - 1
            total = (_gaps(low, high, turns), *sums, illegal, cost) if final else (None,) * 6
            out.append((conv, held[k]["at"], node, inner, *((tail, end) if final else ("", "")), final, *total))
            place = before
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, held, key, out = _arrow(schema), [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["conv_id"] != key:
                    out += one(key, held)
                    held = []
                    if len(out) > 5000:
                        yield _batch(out, arrow)
                        out = []
                key = row["conv_id"]
                held.append(row)
        if held:
            out += one(key, held)
        yield _batch(out, arrow)

    small = parts.select("conv_id", "at", *stats, "ways")
    return small.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(run, schema)


def joined_parts(parts: DataFrame) -> DataFrame:
    """The parts of longer conversations with their share of the audit and their repaired lines."""
    plan = settle(_planned(parts), "part_plans")
    open_parts = parts.select("at", "lines", "codes").join(plan, "at")
    schema = StructType([*plan.schema.fields, *_parse_datatype_string(f"audit string, lines {_LINES}").fields])
    names = plan.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, arrow = _repair(), _arrow(schema)
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                part = _Part(row["conv_id"], row["at"])
                part.lines = [(x["role"], x["text"]) for x in row["lines"]]
                _, _, trail = repair.run(row["codes"], row["node"])
                edits, roles = repair.way(trail, row["place"])
                lines = part.edited([*edits, row["tail"]], [*roles, row["end"]])
                audit = "".join(edits) + row["tail"]
                yield _batch([(*(row[c] for c in names), audit, lines)], arrow)

    return settle(open_parts.mapInArrow(run, schema), "repaired_parts")


_TOTALS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _digests(parts: DataFrame) -> DataFrame:
    """One row per longer conversation: audits and lines of its parts in order. The digest is one
    stream over all lines; a part is let go as soon as it has gone in."""
    conv = parts.schema["conv_id"]
    rest = ", ".join(f"{c} bigint" for c in _TOTALS) + ", audit string, repaired_sha256 string"
    schema = StructType([conv, *_parse_datatype_string(rest).fields])
    lines = F.transform("lines", lambda x: F.concat(F.lit("\n"), x["role"], F.lit(":"), x["text"]))
    flat = parts.select("conv_id", "at", *_TOTALS, "audit", "last", F.concat_ws("", lines).alias("said"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, hasher, audit, first = _arrow(schema), hashlib.sha256(), [], True
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                said = row["said"].encode()
                if said:
                    hasher.update(said[1:] if first else said)
                    first = False
                audit.append(row["audit"])
                if row["last"]:
                    totals = (row[c] for c in _TOTALS)
                    yield _batch([(row["conv_id"], *totals, "".join(audit), hasher.hexdigest())], arrow)
                    hasher, audit, first = hashlib.sha256(), [], True

    spread = flat.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return spread.mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """Repaired conversations in parts: conv_id, at (the order of parts), audit, lines.

    ``rows`` as ``damage`` gives them. ``lines`` are structs of role and text; the lines of all parts
    of a conversation in order are the conversation.
    """
    parts = analysed(rows)
    more = joined_parts(parts.where(~F.col("whole")))
    return parts.where("whole").select("conv_id", "at", "audit", "lines").unionByName(
        more.select("conv_id", "at", "audit", "lines")
    )


def report(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text, dropped)``: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Faults are counted on the rows as given, by turn (null first; equal turns by role, then by the
    text's md5). The repair is the cheapest one, of equal costs the one of least audit. A conversation
    of dropped rows only has zeros, an empty audit and the empty digest; a null conv_id is a
    conversation of its own. Other columns are ignored; an empty table gives no rows.

    Conversations are sorted by ranges, so that a long one is spread over tasks. Its parts are solved
    for every stack they may begin with; only costs between stacks meet in one task, and at the
    end the stream of its lines, since the digest of a conversation is one.
    """
    parts = analysed(rows)
    digest = F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    whole = parts.where("whole").select(
        "conv_id", gaps.cast("bigint").alias("gaps"), *_TOTALS[1:], "audit",
        F.sha2(F.concat_ws("\n", digest).cast("binary"), 256).alias("repaired_sha256"),
    )
    longer = joined_parts(parts.where(~F.col("whole")))
    return whole.unionByName(_digests(longer))
