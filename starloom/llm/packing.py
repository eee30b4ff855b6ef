"""Packing by powers of two: no sequence holds more than one document."""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.cache import Recent

#: Parts of texts that come in before a worker lets go of those it has not used since, and odd words.
CACHE_PARTS, CACHE_WORDS = 100_000, 50_000
#: Ids, of four bytes, that a task holds before it hands them on.
HELD_IDS = 1 << 18
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint"


#: Characters of texts that take the short way: ASCII and Latin-1 without control characters. They are
#: in normal form, and none of them changes with what stands beside it.
_SHORT = "\t\n\r" + "".join(map(chr, [*range(32, 127), *range(161, 173), *range(174, 256)]))
_OTHER = re.compile(f"[^{re.escape(_SHORT)}]")


def _byte_letters() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable Latin-1 stands for itself, the rest
    follows from U+0100 on in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(printable)]
    return {b: 256 + k for k, b in enumerate(other)}


def _splitter(tokenizer) -> tuple[re.Pattern | None, re.Pattern]:
    """The tokenizer's own split of lower-cased texts of short characters, if it has that form, and
    what finds its special strings. Both come from the loaded tokenizer: its file, with all words
    and merges, is not parsed once more."""
    special = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
    split = tokenizer.pre_tokenizer
    steps = (json.loads(split.__getstate__()) if split else {}).get("pretokenizers") or [{}]
    pattern = steps[0].get("pattern", {}).get("Regex")
    kinds = {"L": "", "N": ""}
    for c in sorted(set(_SHORT.lower())):
        kind = unicodedata.category(c)[0]
        if kind in kinds:
            kinds[kind] += c
    if pattern is not None:
        for kind, chars in kinds.items():
            pattern = pattern.replace(f"\\p{{{kind}}}", chars)
        pattern = None if "\\p" in pattern else re.compile(pattern)
    return pattern, re.compile("|".join(special) or "$^")


class WordIds:
    """Ids of texts under a tokenizer that drops white space between words.

    Texts of short characters are lower-cased and split as the tokenizer splits them; each part is
    merged once and kept, with one look-up each time it comes. In other texts, and in those with
    special strings, words between spaces and line feeds are the unit, and the odd ones go through
    the whole tokenizer.
    """

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if array("I").itemsize != 4 or sys.byteorder != "little":
            raise RuntimeError("ids are written as the machine holds them: little-endian, 4 bytes")
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge, self.letters = self.tokenizer.model.tokenize, _byte_letters()
        self.split, self.special = _splitter(self.tokenizer)
        self.parts = Recent(CACHE_PARTS, self._merged)
        self.words = Recent(CACHE_WORDS, self._word)
        # the short way is taken only where it gives what the tokenizer gives
        probe = ("Hello, it's", "É²½ 12a", "straße!!'s", "aßÀ ª_x", "àíÿ.\t\r\nÑandú; ÷×", "''s'll 'D")
        if self.split and any(self._short(t) != self._whole(t) for t in probe):
            self.split = None

    def _merged(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.merge(part)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _short(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, self.split.findall(text.lower())))

    def _plain(self, text: str) -> bool:
        return bool(self.split) and not _OTHER.search(text) and not self.special.search(text)

    def _word(self, word: str) -> bytes:
        return self._short(word) if self._plain(word) else self._whole(word)

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        for text in texts:
            if self._plain(text):
                yield self._short(text)
            else:
                words = text.replace("\n", " ").split(" ")
                yield b"".join(map(self.words.__getitem__, words))
                self.words.turn()
            self.parts.turn()


_loaded: dict[str, WordIds] = {}


def word_ids(file: str) -> WordIds:
    """The encoder for a tokenizer file, kept by the worker."""
    if file not in _loaded:
        _loaded[file] = WordIds(file)
    return _loaded[file]


def binary_lengths(total: int, longest: int) -> list[int]:
    """As many pieces of ``longest`` as fit, then one for each bit of the rest, largest first."""
    rest = total % longest
    return [longest] * (total // longest) + [
        1 << bit for bit in range(longest.bit_length() - 1, -1, -1) if rest >> bit & 1
    ]


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, longest: int = 4096) -> DataFrame:
    """``docs(doc_id, text)`` cut into pieces whose lengths are powers of two.

    A document's ids are its text's, then ``end_id``. Each piece is a sequence of its own:
    sequences of one length form a bucket and are batched together without padding, and
    attention never sees two documents. Every task gives its buckets one after the other and
    numbers sequences in that order. Columns: doc_id, start (ids before the piece in its
    document), length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset (always 0).

    ``longest`` must be a power of two. Null texts are empty and give the end id alone; null
    ids are kept; repeated rows are packed again. An empty table gives no pieces. Nothing is
    shuffled: a document is read, cut, sorted and written in its own task.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_ids(tokenizer_file), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            held = 0
            texts = (text.as_py() or "" for text in batch.column(1))
            for doc, body in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids, start = memoryview(body + end), 0
                total = len(ids) // 4
                for length in binary_lengths(total, longest):
                    piece = ids[4 * start : 4 * (start + length)]
                    for column, value in zip(rows, (doc, start, length, bytes(piece), total)):
                        column.append(value)
                    start += length
                held += total
                if held > HELD_IDS:
                    yield _pieces(rows)
                    rows, held = [[], [], [], [], []], 0
            yield _pieces(rows)

    pieces = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PIECES)
    return pieces.sortWithinPartitions("length").withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")}
    )


def _pieces(rows: list[list]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    names = [part.split()[0] for part in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """One folder per length; any slice of a folder is a batch without padding."""
    pieces.write.partitionBy("length").parquet(folder)
