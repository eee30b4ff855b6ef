"""Token counts at every prefix of a text, by dynamic programming over words."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence
from math import inf
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType, _parse_datatype_string

from starloom.llm.cache import Recent

#: Words that come in before a worker lets go of those it has not used since.
CACHE_WORDS = 300_000
#: Characters of a unit's beginning whose counts are shared.
HEAD = 6
_MARK = "\u2581"


class PrefixCounts:
    """Counts of a piece vocabulary (byte-pair merges, byte fallback) at every prefix.

    The merges never reach over a word's start, as no piece has the word mark after another
    character; this is checked on loading. Within a word, let t be the last token of a prefix.
    The prefix without t is encoded as its own encoding, so count[i] = count[i - len(t)] + 1, and t
    is the one piece that ends the prefix and stays apart from the token before it. Whether
    two tokens stay apart depends on these two alone and is remembered.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
        self.rank = {
            model.id_to_piece(i): -model.get_score(i)
            for i in range(model.get_piece_size())
            if not special(i)
        }
        if any(_MARK in p.lstrip(_MARK) for p in self.rank):
            raise ValueError("a piece holds a word mark after another character")
        self.byte_fallback = any(model.is_byte(i) for i in range(model.get_piece_size()))
        inner = {c for p in self.rank if len(p) > 1 for c in p}
        alone = "\n" if "\n" not in inner else ""
        self.units = re.compile(f"{_MARK}*[^{_MARK}{alone}]+|{_MARK}+|{alone or '$'}")
        self.apart: dict[tuple[str, str], bool] = {}
        self.history: dict[str, tuple] = {}
        self.pieces = {p for p in self.rank if len(p) > 1 and self.edges(p)[0]}
        by_end: dict[str, set[int]] = {}
        for piece in self.pieces:
            by_end.setdefault(piece[-2:], set()).add(len(piece))
        self.by_end = {end: sorted(sizes, reverse=True) for end, sizes in by_end.items()}
        self.heads: dict[str, tuple[list, list]] = {}
        self.cache: dict[str, bytes] = Recent(CACHE_WORDS, self.steps)

    def edges(self, piece: str) -> tuple[bool, list, list]:
        """Whether merging gives the piece back, and how its last and its first part change:
        (rank of the next merge, part before it), then (infinity, the whole)."""
        known = self.history.get(piece)
        if known is None:
            parts, left, right = list(piece), [], []
            while len(parts) > 1:
                ranks = [self.rank.get(x + y, inf) for x, y in zip(parts, parts[1:])]
                best = min(ranks)
                if best == inf:
                    break
                left.append((best, parts[0]))
                right.append((best, parts[-1]))
                at = ranks.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = len(parts) == 1, [*right, (inf, parts[-1])], [*left, (inf, parts[0])]
            if len(self.history) > 100_000:
                self.history.clear()
            self.history[piece] = known
        return known

    def stays(self, left: str, right: str) -> bool:
        """Whether merging the two tokens' characters together gives the two tokens.

        Either side merges on its own until a merge over their border is the best one left; of
        equal merges the leftmost comes first.
        """
        known = self.apart.get((left, right))
        if known is not None:
            return known
        _, ends, _ = self.edges(left)
        _, _, starts = self.edges(right)
        i = j = 0
        while True:
            (next_left, x), (next_right, y) = ends[i], starts[j]
            over = self.rank.get(x + y, inf)
            if over < next_left and over <= next_right:
                known = False
                break
            if next_left == next_right == inf:
                known = True
                break
            if next_left <= next_right:
                i += 1
            else:
                j += 1
        if len(self.apart) > 300_000:
            self.apart.clear()
        self.apart[left, right] = known
        return known

    def word(self, unit: str) -> list[int]:
        """Token count of each prefix of one unit; units that begin alike share their beginning."""
        by_end, apart = self.by_end, self.apart
        head = unit[:HEAD]
        known_head = self.heads.get(head)
        if known_head:
            last, count = known_head[0].copy(), known_head[1].copy()
        else:
            last, count = [""], [0]
        for i in range(len(last), len(unit) + 1):
            for size in by_end.get(unit[i - 2 : i], ()) if i > 1 else ():
                if size > i:
                    continue
                token = unit[i - size : i]
                if token in self.pieces:
                    left = last[i - size]
                    if not left:
                        break
                    known = apart.get((left, token))
                    if self.stays(left, token) if known is None else known:
                        break
            else:
                size, token = 1, unit[i - 1]
            last.append(token)
            # a character outside the vocabulary is its bytes, or one unknown token
            cost = 1
            if size == 1 and token not in self.rank and self.byte_fallback:
                cost = len(token.encode())
            count.append(count[i - size] + cost)
            if i == HEAD:
                self.heads[head] = last.copy(), count.copy()
        return count

    def steps(self, unit: str) -> bytes:
        """How the count changes from character to character; raises beyond 16 bits."""
        count = self.word(unit)
        return array("h", map(sub, count[1:], count)).tobytes()

    def table(self, text: str) -> np.ndarray:
        """Tokens of text[:i] for i from 0 to len(text)."""
        if not text:
            return np.zeros(1, np.int32)
        marked = _MARK + text.replace(" ", _MARK)
        steps = b"".join(map(self.cache.__getitem__, self.units.findall(marked)))
        counts = np.cumsum(np.frombuffer(steps, np.int16), dtype=np.int32)
        counts[0] = 0
        self.cache.turn()
        if len(self.heads) > CACHE_WORDS:
            self.heads.clear()
        return counts


_loaded: dict[str, PrefixCounts] = {}


def prefix_counts(model_file: str) -> PrefixCounts:
    """The table for a model file, kept by the worker."""
    if model_file not in _loaded:
        _loaded[model_file] = PrefixCounts(model_file)
    return _loaded[model_file]


def tokens_at(table: np.ndarray, chars: int) -> int:
    """Tokens of the first ``chars`` characters."""
    return int(table[min(chars, len(table) - 1)])


def longest_prefix(table: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    if table.max() <= budget:
        return len(table) - 1
    return int(np.flatnonzero(table <= budget)[-1])


def count_tokens(
    docs: DataFrame,
    model_file: str,
    limit: int | None = None,
    tables: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_tokens, and what is asked for.

    ``limit`` adds fit_chars, the characters of the longest prefix of at most that many tokens.
    ``tables`` adds prefix_tokens, the token count of every prefix from the empty one on.
    Both are read off the same table; nothing is encoded again. ``keep`` names columns of
    ``docs`` to hand on, other ones are left out. ``model_file`` must be readable on every
    executor. A null text counts as empty and has no tokens; repeated rows give repeated rows.
    A text of any length is one pass.
    """
    kept = docs.select("doc_id", *keep)
    found = "n_tokens bigint" + ", fit_chars bigint" * (limit is not None)
    found += ", prefix_tokens array<int>" * tables
    schema = StructType([*kept.schema.fields, *_parse_datatype_string(found).fields])
    width, names = len(kept.columns), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counts(model_file)
        for batch in batches:
            n, fit, held = [], [], []
            for text in batch.column(width):
                table = counter.table(text.as_py() or "")
                n.append(int(table[-1]))
                if limit is not None:
                    fit.append(longest_prefix(table, limit))
                if tables:
                    held.append(table)
            columns = [*batch.columns[:width], pa.array(n, pa.int64())]
            if limit is not None:
                columns.append(pa.array(fit, pa.int64()))
            if tables:
                columns.append(pa.array(held, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", *keep, "text").mapInArrow(run, schema)
