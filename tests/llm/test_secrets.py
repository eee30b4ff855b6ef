"""Secret scan: patterns against a plain search, formats against planted credentials."""

import hashlib
import random
import re
from collections import Counter
from math import log2

import pytest
from pyspark.sql import functions as F
from starloom.llm import grammars, secrets
from starloom.llm.queries import QUERIES

from test_operators import CLASHES, SCHEMA, edge_rows, passage

HEX, UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def brute(text):
    """Spans found by trying every position, kind by kind, without regular expressions for runs."""
    text = text or ""
    out = []
    for kind, start_with, chars, least in (("access", "AKIA", UPPER, 20), ("hex", "", HEX, 24)):
        at = 0
        while at < len(text):
            end = at + len(start_with)
            if text.startswith(start_with, at) and end < len(text) and text[end] in chars:
                while end < len(text) and text[end] in chars:
                    end += 1
                if end - at >= least:
                    out.append((at, 1 + (kind == "hex"), kind, end))
                at = end
            else:
                at += 1
    key = re.compile("|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) + "" for w in
                              ("password", "passwd", "secret", "token", "api_key", "apikey")))
    body = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
    at = 0
    while m := key.search(text, at):
        end = m.end()
        end += text[end : end + 1] in ("'", '"') and text[end : end + 1] != ""
        while text[end : end + 1] == " ":
            end += 1
        at = m.start() + 1
        if text[end : end + 1] not in ("=", ":") or end >= len(text):
            continue
        end += 1
        while text[end : end + 1] == " ":
            end += 1
        if text[end : end + 1] in ("'", '"') and end < len(text):
            end += 1
        low = end
        while end < len(text) and text[end] in body:
            end += 1
        if end > low:
            at = end
            if end - low >= 6:
                out.append((m.start(), 0, "assign", end))
    return [(k, a, e) for a, _, k, e in sorted(out)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{e}" for k, a, e in spans).encode()).hexdigest()


def texts(rng, n):
    parts = ["token", "Secret", "API_KEY", "apikey", "passwd", "password", "ſecret", "toKen", "=", ":", " ", "  ", '"', "'",
             "AKIA", "A1B2C3D4E5F6G7H8J9K0", "0123456789abcdef01234567", "abc", "xyz12", "\n", "ä", "𝒰", ".", "==", "deadbeef" * 4, "secret=token : abcdefgh"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_patterns_on_random_texts():
    for text in texts(random.Random(1), 4000):
        found = [(k, a, e) for a, e, k, _, _ in secrets.base_spans(text)]
        assert found == brute(text), text


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_registered_query_on_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = rows_of(QUERIES["op12_grammar_secret_scan"](spark, folder))
    assert len(found) == len(docs)
    for r in docs:
        base, f = brute(r.text), found[r.doc_id]
        count = Counter(k for k, _, _ in base)
        assert (f.n_assign, f.n_access, f.n_hex) == tuple(count[k] for k in secrets.KINDS)
        assert f.base_sha256 == digest(base)
        spans = f.spans.split(",") if f.spans else []
        assert [s for s in spans if not s.startswith("like_")] == [f"{k}:{a}:{e}" for k, a, e in base]


def planted(rng, n):
    """Labelled credentials of two formats, the same formats without a label, and plain long words."""
    key = lambda: "sk-" + "".join(rng.choice(UPPER.lower() + UPPER) for _ in range(28))
    code = lambda: "-".join("".join(rng.choice("0123456789") for _ in range(4)) + rng.choice("XYZ") for _ in range(5))
    word = lambda: "".join(rng.choice(["tion", "lich", "ment", "schaft", "ing", "er"]) for _ in range(rng.randint(5, 8)))
    labelled = [f"api_key = '{key()}' and password: {code()} {word()}" for _ in range(n)]
    hidden = [f"{word()} see {key()}, or {code()}. {word()}" for _ in range(n // 10)]
    card = lambda: "".join(rng.choice("0123456789") for _ in range(16))
    clean = [f"{word()} {word()}.{word()} {card()} {passage(k, 30)} http://www.{word()}.example.com/{word()}" for k in range(n)]
    return labelled, hidden, clean


def test_formats_without_a_label_are_found(spark):
    labelled, hidden, clean = planted(random.Random(5), 150)
    rows = [(k, t, "en", "s", 1) for k, t in enumerate([*labelled, *hidden, *clean])]
    found = rows_of(secrets.find_secrets(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    caught = 0
    for k, text in enumerate([*labelled, *hidden, *clean]):
        got = {text[s.start : s.end] for s in found[k].added}
        if k < 150:
            assert len(found[k].base) == 2 and not got
        elif k < 165:
            want = {text.split(" ")[2].rstrip(","), text.split(" ")[4].rstrip(".")}
            assert got <= want
            caught += len(got)
        else:
            assert not got
    assert caught >= 29


def test_edge_rows(spark):
    rows = [*edge_rows(), (90, 'token="' + "ab12" * 50_000 + '"', "en", "a", 1), (91, "AKIA" + "Z" * 16, "en", "a", 1), (91, "AKIA" + "Z" * 15, "en", "a", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in [*CLASHES, "base", "found", "label", "value"]})
    got = Counter((r.doc_id, tuple(tuple(s) for s in r.base)) for r in secrets.find_secrets(df).collect())
    assert got == Counter((r[0], tuple((k, a, e) for k, a, e in brute(r[1]))) for r in rows)
    assert secrets.find_secrets(df.limit(0)).count() == 0


def test_own_labels_can_be_given(spark):
    rng = random.Random(9)
    plate = lambda: "ZQ_" + "".join(rng.choice("0123456789") for _ in range(9)) + "=" + rng.choice("ABC") * 6
    own = spark.createDataFrame([("plate", plate()) for _ in range(60)] + [("few", "x" * 20)], "label string, value string")
    docs = [(k, f"{passage(k, 9)} {'long' * rng.randint(5, 8)} {plate()}", "en", "s", 1) for k in range(60)]
    out = secrets.find_secrets(spark.createDataFrame(docs, SCHEMA), own)
    # the plain candidates hold plates too, as often as anything else: nothing tells them apart
    assert all(s.kind == "like_plate" for r in out.collect() for s in r.added)


@pytest.mark.parametrize("seed", range(3))
def test_automata_are_distributions_and_know_their_language(seed):
    rng = random.Random(seed)
    words = ["ab" * rng.randint(1, 6) + "0" for _ in range(800)]
    model = grammars.infer(words)
    for step, end, miss in zip(model.steps, model.end, model.miss):
        total = sum(2 ** -bits for bits, _ in step.values()) + 2**-end + 15 * 2**-miss
        assert total <= 1 + 1e-9
    # lengths without memory need one state for going on; equal lengths up to nine need nine
    loop = grammars.infer(["0" * (1 + int(rng.expovariate(0.3))) for _ in range(500)])
    assert len(loop.steps) <= 3
    assert len(grammars.infer(["0" * rng.randint(1, 9) for _ in range(500)]).steps) == 10
    assert model.bits("ababab0") < model.bits("ababab") and model.bits("ababab0") < model.bits("0baba0")
    assert grammars.infer([]).bits("x") > 3
    tree = grammars.infer(["0"] * 90 + ["g"] * 10)
    assert abs(tree.bits("0") - (-log2(0.9) + log2(10))) < 0.2
