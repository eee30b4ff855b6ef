"""What a worker holds at a time does not follow the size of its batches."""

import pyarrow as pa
from pyspark.sql.types import LongType, StringType, StructField, StructType
from starloom.llm import packing, pii
from starloom.llm import text as tx
from starloom.llm.queries import tokenizer_path


class Docs:
    """Stands in for a table: gives the function that Spark would run on its batches."""

    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])
    columns = schema.names

    def mapInArrow(self, run, schema):
        return run


def test_pseudonyms_are_handed_on_in_runs_of_bounded_bytes():
    texts = [None, "", *[f"mail me at a.{i}@example.com " + "x" * 4000 for i in range(600)], "y" * 900_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=Docs.columns)
    out = list(pii.pseudonymize(Docs(), b"k", count="n")(iter([batch])))
    # a text that is longer stands alone
    assert all(part.num_rows == 1 or sum(len(x or "") for x in part[1].to_pylist()) <= tx.CHUNK_BYTES for part in out)
    rows = pa.Table.from_batches(out).to_pylist()
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    f = pii.Feistel(b"k")
    assert [(r["text"], r["n"]) for r in rows] == [(None, 0) if t is None else pii.pseudonyms(t, f) for t in texts]


def test_the_tokenizer_file_is_not_parsed_in_python(monkeypatch):
    parsed, loads = [], packing.json.loads
    monkeypatch.setattr(packing.json, "load", lambda source: parsed.append(source.name))
    monkeypatch.setattr(packing.json, "loads", lambda text: parsed.append(len(text)) or loads(text))
    words = packing.WordIds(tokenizer_path("word_bpe_49k.json"))
    assert words.split is not None and all(isinstance(x, int) and x < 10_000 for x in parsed)
    text = "Hello <|endoftext|> it's 12a"
    assert next(words.encode([text])) == words._whole(text)
