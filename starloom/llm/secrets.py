"""Secrets in texts: fixed patterns, and formats that are inferred from the labelled finds."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.grammars import Automaton, infer
from starloom.staging import settle

# Patterns by kind, in the order of kinds, and the least length of what they find.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": (re.compile(ASSIGN, re.IGNORECASE | re.ASCII), 2, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}
#: Characters of a candidate, its least length, and the signs that do not belong to its ends.
CANDIDATE, LEAST, _EDGE = re.compile("[A-Za-z0-9+/_.=-]{16,}"), 16, "."
#: Learning: values of a label at most, and unlabelled candidates; characters of the longest one learnt
#: from; distinct values that a label needs; bits by which a format must be likelier than plain text.
#: ``FLOOR``: a form that a smaller share of the unlabelled candidates has is not learnt as plain text.
MAX_VALUES, MAX_PLAIN, LONGEST, FEWEST, MARGIN, FLOOR = 2000, 4000, 256, 8, 24.0, 0.05
PLAIN = "plain"
_HEX_RUN = re.compile("[0-9a-f]{24,}")
_SPANS = "array<struct<kind:string,start:int,end:int>>"
_VALUES = "array<struct<label:string,value:string,start:int>>"


def base_spans(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, kind, label, value) of what the patterns find, by start, then kind.

    Each kind is searched on its own, leftmost first and without overlaps; matches that are too
    short are dropped but have taken their place. Offsets are in code points, the end exclusive.
    A find's label is its keyword in lower case without signs, or its kind.
    """
    found = []
    for kind in KINDS:
        pattern, group, least = PATTERNS[kind]
        if kind == "hex":  # runs are maximal, so short ones can be passed over at once
            pattern = _HEX_RUN
        elif kind == "access" and "AKIA" not in text:
            continue
        for m in pattern.finditer(text):
            value = m[group]
            if len(value) >= least:
                label = m[1].lower().replace("_", "") if kind == "assign" else kind
                found.append((m.start(), m.end(), kind, label, value))
    found.sort(key=lambda f: (f[0], KINDS.index(f[2])))
    return found


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, str]]:
    """(start, value) of every run that might be a credential and touches no span of ``taken``."""
    out = []
    for m in CANDIDATE.finditer(text):
        value = m[0].lstrip(_EDGE)
        start, value = m.end() - len(value), value.rstrip(_EDGE)
        if len(value) >= LEAST and not any(a < start + len(value) and start < b for a, b in taken):
            out.append((start, value))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, base (spans of the patterns) and found (their values
    with labels, and unlabelled candidates with their start), written. Texts are read once."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "base", "found"]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    value = pa.list_(pa.struct([("label", pa.string()), ("value", pa.string()), ("start", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                spans = base_spans(text)
                base.append([{"kind": s[2], "start": s[0], "end": s[1]} for s in spans])
                rest = candidates(text, [s[:2] for s in spans])
                found.append(
                    [{"label": s[3], "value": s[4], "start": None} for s in spans]
                    + [{"label": PLAIN, "value": v, "start": a} for a, v in rest]
                )
            columns = [batch.column(0), pa.array(base, span), pa.array(found, value)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select("doc_id", "text")
    schema = f"doc_id {kind}, base {_SPANS}, found {_VALUES}"
    return settle(rows.mapInArrow(run, schema), "secret_candidates")


def learn(labelled: DataFrame) -> dict[str, Automaton]:
    """An automaton for each label of ``labelled(label, value)``, plain text among them.

    Learnt from at most ``MAX_VALUES`` distinct values a label (``MAX_PLAIN`` of plain text), those of
    smallest hash, and of at most ``LONGEST`` characters; labels with under ``FEWEST`` have none. One task
    a label infers; the driver receives states, not values.
    """
    usable = labelled.where(
        F.col("label").isNotNull() & (F.length("value").between(1, LONGEST))
    ).groupBy("label", "value").agg(F.xxhash64("value").alias("hash"))
    # limited inside every task before the shuffle
    order = Window.partitionBy("label").orderBy("hash", "value")
    limit = F.when(F.col("label") == PLAIN, MAX_PLAIN).otherwise(MAX_VALUES)
    sample = usable.withColumn("k", F.row_number().over(order)).where(
        F.col("k") <= max(MAX_PLAIN, MAX_VALUES)
    )
    sample = sample.where(F.col("k") <= limit).select("label", "value")

    def inferred(pdf):
        import pandas as pd

        if len(pdf) < FEWEST:
            return pd.DataFrame({"label": [], "model": []}, dtype=str)
        label = pdf["label"].iloc[0]
        model = infer(pdf["value"], floor=FLOOR if label == PLAIN else 0.0)
        return pd.DataFrame({"label": [label], "model": [json.dumps(model.plain())]})

    rows = sample.groupBy("label").applyInPandas(inferred, "label string, model string").collect()
    return {r["label"]: Automaton(**json.loads(r["model"])) for r in sorted(rows)}


def likeliest(value: str, models: dict[str, Automaton]) -> tuple[str | None, float]:
    """The label whose format makes the value likeliest, and by how many bits more than plain text."""
    formats = [label for label in models if label != PLAIN]
    if PLAIN not in models or not formats:
        return None, 0.0
    label = min(formats, key=lambda x: (models[x].bits(value), x))
    return label, models[PLAIN].bits(value) - models[label].bits(value)


def find_secrets(
    docs: DataFrame, labelled: DataFrame | None = None, margin: float = MARGIN
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, base, added.

    ``base`` are the patterns' spans: kind, start, end in code points. ``added`` are candidates outside
    them that a learnt format makes likelier than plain text by ``margin`` bits or more: kind (``like_`` and
    the label), start, end, bits. Every candidate of every whole text is scored. Formats are learnt from
    the values that the patterns have labelled, and from ``labelled(label, value)`` if given; plain
    text from candidates without a label: a form that over a twentieth of them have is plain text.
    Without enough examples nothing is added.

    Null texts count as empty and have no spans; repeated rows give repeated rows; other columns
    are ignored; an empty table gives no rows.
    """
    found = scan(docs)
    values = found.select(F.explode("found").alias("f")).select("f.label", "f.value")
    if labelled is not None:
        values = values.unionByName(labelled.select("label", "value"))
    models = learn(values)
    kind = docs.schema["doc_id"].dataType.simpleString()
    added = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("bits", pa.float64())])
    )
    open_ones = F.filter("found", lambda f: f["start"].isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            out = []
            for places in batch.column(2).to_pylist():
                spans = []
                for place in places:
                    value = place["value"]
                    scored = known.get(value)
                    if scored is None:
                        scored = likeliest(value, models)
                        if len(known) > 20_000:
                            known.clear()
                        if len(value) <= LONGEST:
                            known[value] = scored
                    label, bits = scored
                    if label is not None and bits >= margin:
                        end = place["start"] + len(value)
                        spans.append({"kind": f"like_{label}", "start": place["start"], "end": end, "bits": bits})
                out.append(spans)
            columns = [batch.column(0), batch.column(1), pa.array(out, added)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "base", "added"])

    schema = f"doc_id {kind}, base {_SPANS}, added array<struct<kind:string,start:int,end:int,bits:double>>"
    return found.select("doc_id", "base", open_ones.alias("open")).mapInArrow(run, schema)


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def said(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas in the order they have."""
    one = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.concat_ws(",", one)


def in_order(base: Column, added: Column) -> Column:
    """Both kinds of spans by start, then kind as listed; formats come behind the patterns."""
    kinds = F.array(*(F.lit(k) for k in KINDS))

    def keyed(spans: Column) -> Column:
        rank = lambda s: F.coalesce(F.nullif(F.array_position(kinds, s["kind"]), F.lit(0)), F.lit(9))
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), rank(s).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")
            ),
        )

    return F.array_sort(F.concat(keyed(base), keyed(added)))
