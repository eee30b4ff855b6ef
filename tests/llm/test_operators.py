"""Operators against brute force, exact round trips and held-out accuracy, on edge cases and on
the whole small tables."""

import hashlib
import html.parser
import math
import random
import re
import time
import tracemalloc
import urllib.parse
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from starloom.llm import (
    graph, minhash, mixing, packing, pii, quality, repeats, tokens, topk, urls, vecdedup, vectors,
)
from starloom.llm import text as tx
from starloom.llm.queries import QUERIES, URL_RULES, tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use inside; inputs may have them too.
CLASHES = ["n", "id", "one", "two", "core", "hash", "size", "bucket", "component", "threshold", "n_bytes", "score", "label", "spans"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def passage(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def edge_rows():
    base, long = passage(1, 120), passage(2, 40_000)
    words = base.split(" ")
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t\x0b", "en", None, 4),
        (4, "one two three", "en", "b", 13), (5, "ONE two three", None, "b", 13),
        (6, base, "en", "a", 1), (7, base, "en", None, 1), (7, base, "en", None, 1),
        (8, " ".join(words[:60] + ["x"] + words[61:]), "en", "", 1),
        (9, " ".join(words[:30] + passage(3, 60).split(" ") + words[90:]), "de", "b", 1),
        (10, long, "en", "a", 1), (11, passage(4, 50) + " " + long[:5000], "en", "c", 1),
        (12, "ä" * 300 + "日本" * 200, "ja", "c", 1), (13, "zz " * 400, "en", "c", 1),
        (14, "mail a.b@mail8.example.com or +1 (988) 555-2485", "en", "\U0001f600", 1),
        (None, base, "en", "a", 1), (None, None, None, None, None),
        (15, passage(1, 119) + " tail", "en", "a", 1), (-3, "a b c d e f", "en", "a", 1),
    ]
    return rows


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    return df.withColumns({c: F.lit(7) for c in CLASHES})


@pytest.fixture(scope="module")
def nothing(edge):
    return edge.limit(0)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


# texts and hashes -----------------------------------------------------------------------------


def shingle_sets(texts):
    out = []
    for text in texts:
        w = WORD.findall((text or "").translate(LOWER))
        out.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    return out


def test_word_shingles_count_like_sets():
    texts = [r[1] for r in edge_rows()]
    found = tx.word_shingles(pa.array(texts, pa.string()), 5)
    sets = shingle_sets(texts)
    assert [len(s) for s in found] == [len(s) for s in sets]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(found[i], found[j])) == len(sets[i] & sets[j])


def test_chunks_cover_all_rows():
    texts = pa.array(["a" * 10, None, "b" * 500, "", "c"])
    assert [k for a, b in tx.chunks(texts, 20) for k in range(a, b)] == [0, 1, 2, 3, 4]


# components -----------------------------------------------------------------------------------


def brute_components(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 160)]
    edges += [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(5, 5), (5, 4)]
    rows = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges] + [(None, 3)]
    got = graph.components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in got} == brute_components(edges)
    assert graph.components(spark.createDataFrame([], "a string, b string")).count() == 0


# 1 pseudonyms ---------------------------------------------------------------------------------


def test_feistel_is_a_permutation():
    f = pii.Feistel(b"k")
    for n in (1, 2, 7, 100, 1000):
        image = [f.permute(v, n, "t") for v in range(n)]
        assert sorted(image) == list(range(n))
        assert [f.permute(v, n, "t", back=True) for v in image] == list(range(n))


VALUES = [
    "a.B-7@mail8.example.com", "42.144.35.254", "4041894974608795", "4041-8949-7460-8795",
    "+1 (988) 555-2485", "2001-02-28", "28.02.2001", "02/28/2001", "3/4/1999", "123-45-6789",
    "password=b7db7aa4a5fcc78305", 'token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae"',
    "DE89 3704 0044 0532 0130 00",
]


@pytest.mark.parametrize("value", VALUES)
def test_pseudonyms_keep_format_and_turn_back(value):
    f = pii.Feistel(b"k")
    text = f"before {value}, after"
    new, n = pii.pseudonyms(text, f)
    assert n == 1 and value not in new and len(new) == len(text)
    assert re.sub(r"\d", "9", re.sub("[a-zA-Z]", "x", new)).split() == re.sub(
        r"\d", "9", re.sub("[a-zA-Z]", "x", text)
    ).split() or "token" in value or "password" in value
    assert pii.pseudonyms(new, f, back=True) == (text, 1)
    assert pii.pseudonyms(f"other {value}", f)[0][6:] == new[7 : 7 + len(value)]
    assert pii.pseudonyms(text, pii.Feistel(b"other"))[0] != new


@pytest.mark.parametrize(
    "text", ["1234567890123456", "999.1.1.1", "v 1.2.3", "2021-13-45", "000-12-3456", "a@b", "12:30", ""]
)
def test_what_fails_validation_stays(text):
    assert pii.pseudonyms(text, pii.Feistel(b"k")) == (text, 0)


def test_cards_stay_valid():
    f = pii.Feistel(b"k")
    for k in range(50):
        payload = [int(c) for c in f"4{k:014d}"]
        card = "".join(map(str, [*payload, pii.luhn_digit(payload)]))
        digits = [int(c) for c in pii.pseudonyms(card, f)[0]]
        assert pii.luhn_digit(digits[:-1]) == digits[-1] and digits[0] > 0


def valid_cards(text):
    """Begin and end of every Luhn number of 13 to 19 digits in whole groups."""
    groups = [g.span() for g in re.finditer("[0-9]+", text)]
    out = []
    for i, (a, _) in enumerate(groups):
        for j in range(i, len(groups)):
            b = groups[j][1]
            d = [int(c) for c in text[a:b] if c.isdigit()]
            joined = re.fullmatch("[0-9]+(?:[ -][0-9]+)*", text[a:b])
            if joined and 13 <= len(d) <= 19 and d[0] and pii.luhn_digit(d[:-1]) == d[-1]:
                out.append((a, b))
    return out


def random_value(rng, kind):
    if kind == "card":
        size = rng.choice([13, 15, 16, 16, 16, 19])
        d = [rng.randint(1, 9), *(rng.randint(0, 9) for _ in range(size - 2))]
        card = "".join(map(str, [*d, pii.luhn_digit(d)]))
        sep = rng.choice(["", " ", "-"])
        return sep.join(card[k : k + 4] for k in range(0, size, 4))
    if kind == "ip":
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "phone":
        form = rng.choice(["+1 ({}) {}-{}", "({}) {}-{}", "+1 {} {} {}", "{}-{}-{}"])
        return form.format(rng.randint(200, 999), rng.randint(200, 999), rng.randint(1000, 9999))
    if kind == "email":
        return f"j{rng.randint(0, 999)}.x@mail{rng.randint(0, 9)}.example.com"
    return rng.choice(["12/27", "7", "42", "123", "2024", "12345", "3.5", "word"])


def test_values_beside_other_digits():
    f, rng = pii.Feistel(b"k"), random.Random(11)
    for _ in range(1500):
        kinds = [rng.choice(["card", "ip", "phone", "email", "", ""]) for _ in range(rng.randint(1, 6))]
        values = [random_value(rng, kind) for kind in kinds]
        text = " ".join(values)
        new, n = pii.pseudonyms(text, f)
        assert len(new) == len(text) and pii.pseudonyms(new, f, back=True) == (text, n)
        for a, b in valid_cards(text):
            assert new[a:b] != text[a:b], text
        at = 0
        for kind, value in zip(kinds, values):
            assert not kind or new[at : at + len(value)] != value, (value, text, new)
            if kind == "ip":
                assert all(int(p) < 256 for p in new[at : at + len(value)].split("."))
            at += len(value) + 1


@pytest.mark.parametrize("cards", [3, 9, 40])
@pytest.mark.parametrize("size", [1, 4, 16])
def test_cards_of_a_chain_get_the_same_method_however_many_there_are(cards, size):
    f, rng = pii.Feistel(b"k"), random.Random(31)
    texts = []
    for _ in range(cards):
        d = [rng.randint(1, 9), *[rng.randint(0, 9) for _ in range(14)]]
        digits = "".join(map(str, [*d, pii.luhn_digit(d)]))
        texts.append(" ".join(digits[k : k + size] for k in range(0, 16, size)))
    text = " ".join(texts)
    new, n = pii.pseudonyms(text, f)
    assert n == cards and pii.pseudonyms(new, f, back=True) == (text, n)
    if size > 1:  # others near by do not move their places: as if each stood alone
        assert new == " ".join(pii.pseudonyms(t, f)[0] for t in texts)
    else:  # groups of one digit were left as they were in a chain of over two such cards
        assert sum(a != b for a, b in zip(text, new)) > 10 * cards


def test_a_long_chain_takes_time_that_grows_with_it():
    f, rng = pii.Feistel(b"k"), random.Random(32)
    text = " ".join(str(rng.randint(0, 9999)) for _ in range(20_000))
    started = time.monotonic()
    new, n = pii.pseudonyms(text, f)
    assert n > 1000 and pii.pseudonyms(new, f, back=True) == (text, n)
    assert time.monotonic() - started < 60


@pytest.mark.parametrize(
    ("text", "n", "end"),
    [
        ("4785380592391139 12/27", 1, " 12/27"), ("4111 1111 1111 1111 12", 1, " 12"),
        ("4111111111111111 4111111111111111", 2, ""), ("+1 (826) 555-4081 190.137.223.204", 2, ""),
        ("DE89 3704 0044 0532 0130 00 EUR 1000", 1, " EUR 1000"), ("826-555-4081-12", 1, "-12"),
        ("1(826) 555-4081", 1, ""), (" ".join(["4111 1111 1111 1111 1234"] * 30), 30, " 1234"),
    ],
)
def test_a_value_ends_where_it_ends(text, n, end):
    f = pii.Feistel(b"k")
    new, got = pii.pseudonyms(text, f)
    assert got == n and new.endswith(end) and pii.pseudonyms(new, f, back=True) == (text, n)
    for a, b in valid_cards(text):
        assert new[a:b] != text[a:b]


def test_tables_of_numbers_turn_back():
    f, rng = pii.Feistel(b"k"), random.Random(12)
    for size in (5, 20, 300):
        for _ in range(20):
            text = " ".join(str(rng.randint(0, 10 ** rng.randint(1, 6))) for _ in range(size))
            new, n = pii.pseudonyms(text, f)
            assert pii.pseudonyms(new, f, back=True) == (text, n)


@pytest.mark.parametrize(
    "value",
    [
        "MyPass!2024", "P@ss!word1", "eyJ" + "aB3_" * 700 + "tail99", "0a1b" * 900, '"two words, 42 more"',
        "'it\\\'s a 2nd one'", '"first77\nsecond88"', "0" * 600 + "abc" * 200, "aBcDeF12",
        "İİpaß\u212aword77x", "日本passé12",
    ],
)
def test_secrets_are_replaced_whole(value):
    f = pii.Feistel(b"k")
    text = f"x password={value} rest 12"
    new, n = pii.pseudonyms(text, f)
    assert n == 1 and len(new) == len(text) and new.endswith(" rest 12")
    assert pii.pseudonyms(new, f, back=True) == (text, 1)
    for k in range(11, 11 + len(value) - 2):  # nowhere are three signs of the value left to read
        if all(c.isascii() and c.isalnum() for c in text[k : k + 3]):
            assert len(value) > 100 or new[k : k + 3] != text[k : k + 3]
    for k in range(11, 11 + len(value) - 40, 40):
        assert new[k : k + 40] != text[k : k + 40]
    assert new[-20:-8] != text[-20:-8]


def test_short_hexadecimal_turns_back():
    f = pii.Feistel(b"k")
    for k in range(256):
        for value in (f"{k:02x}", f"{k:02X}", f"a{k:02X}"):
            assert f.text(f.text(value, "t"), "t", back=True) == value


def test_pseudonymize_rows(edge, nothing):
    out = pii.pseudonymize(edge, b"k", count="n_replaced")
    assert out.columns == [*edge.columns, "n_replaced"]
    rows, before = out.orderBy("doc_id").collect(), edge.orderBy("doc_id").collect()
    assert len(rows) == len(before) and sum(r.n_replaced for r in rows) == 2
    changed = [r.doc_id for r in rows if r.n_replaced]
    assert changed == [14] and "a.b@mail8" not in [r.text for r in rows if r.doc_id == 14][0]
    assert Counter(r.text for r in rows if r.doc_id != 14) == Counter(
        r.text for r in before if r.doc_id != 14
    )
    assert pii.pseudonymize(nothing, b"k").count() == 0


def test_whole_table_turns_back(spark, folder, docs):
    rows = QUERIES["op1_feistel_pii"](spark, folder).collect()
    from starloom.llm.queries import PII_KEY

    f, texts = pii.Feistel(PII_KEY), {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts) and sum(r.n_replaced for r in rows) > 50
    email = re.compile(r"[a-z]+\.\d+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}")
    for r in rows:
        assert pii.pseudonyms(r.text, f, back=True) == (texts[r.doc_id], r.n_replaced)
        for value in email.findall(texts[r.doc_id]):
            assert value not in r.text


def test_other_digits_and_long_addresses_are_undone():
    """Digits of other scripts are no digits here; addresses of any length are replaced."""
    f, rng = pii.Feistel(b"k"), random.Random(21)
    parts = ["+٤٤ 1234 567 890", "1٩2.168.1.1", "192.168.1.1", "4111 1111 1111 1111", "²34-56-7890", "2020-٠1-01", "١٢٣", " ", "-", "12", "(020) 555 0100"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 8)))
        new, n = pii.pseudonyms(text, f)
        assert pii.pseudonyms(new, f, back=True) == (text, n)
        assert [c for c in new if not c.isascii()] == [c for c in text if not c.isascii()]
    for address in ("a" * 65 + "@example.com", "u@" + "b1." * 12 + "org", "x" * 5000 + ".y@" + "q-" * 300 + "z.net"):
        new, n = pii.pseudonyms(f"to {address}, please", f)
        assert n == 1 and address not in new and new[3 : 3 + address.index("@")] != address[: address.index("@")]
        assert pii.pseudonyms(new, f, back=True) == (f"to {address}, please", 1)
    for long in ("a" * 400_000, "a." * 200_000, "a@" * 100_000, "x@" + "a." * 200_000, "x@" + "a-" * 200_000):
        pii.pseudonyms(long, f)  # in time that grows with the text


# 2 token counts -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def test_every_prefix_has_its_count(pieces):
    counter = tokens.prefix_counts(tokenizer_path("piece_bpe_32k.model"))
    rng = random.Random(5)
    parts = ["the", "international", "  ", "x▁▁y", "aaaaaaaaaaaaaaaaa", "é\n", "日本語", "<s>", "<0x0A>", "\x00", "\t", "​"]
    for _ in range(150):
        text = rng.choice(["", " "]).join(rng.choice(parts) for _ in range(rng.randint(0, 6)))
        table = counter.table(text)
        assert table.tolist() == [len(pieces.encode(text[:i])) for i in range(len(text) + 1)]
        for budget in (0, 1, 3):
            fit = [i for i, n in enumerate(table) if n <= budget]
            assert tokens.longest_prefix(table, budget) == fit[-1]


def test_counts_equal_library(spark, folder, docs, pieces, edge, nothing):
    want = {r.doc_id: r.text for r in docs.collect()}
    for r in QUERIES["op2_prefix_token_counts"](spark, folder).collect():
        n = len(pieces.encode(want[r.doc_id]))
        assert (r.n_tokens, r.n_bytes) == (n, len(want[r.doc_id].encode()))
        assert r.over_limit == (n > 4096)
    path = tokenizer_path("piece_bpe_32k.model")
    out = tokens.count_tokens(edge, path, 10, tables=True).collect()
    want = Counter((r[0], len(pieces.encode(r[1] or ""))) for r in edge_rows())
    assert Counter((r.doc_id, r.n_tokens) for r in out) == want
    assert all(r.prefix_tokens[-1] == r.n_tokens and r.prefix_tokens[r.fit_chars] <= 10 for r in out)
    assert tokens.count_tokens(nothing, path).count() == 0


# 3 repeats ------------------------------------------------------------------------------------


def brute_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(
        hashlib.md5(raw[i : i + length]).digest() for raw in raws for i in range(len(raw) - length + 1)
    )
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[hashlib.md5(raw[i : i + length]).digest()] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        yield len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept


@pytest.mark.parametrize("letters", [2, 20])
def test_index_finds_repeated_strings(letters):
    rng = random.Random(letters)
    for _ in range(20):
        base = bytes(rng.choice(range(97, 97 + letters)) for _ in range(300))
        segments = []
        for _ in range(rng.randint(1, 9)):
            a = rng.randint(0, 200)
            part = bytearray(base[a : a + rng.randint(5, 90)])
            if rng.random() < 0.5:
                part[rng.randrange(len(part))] = 98
            segments.append(bytes(part))
        count = Counter(s[i : i + 12] for s in segments for i in range(len(s) - 11))
        for s, found in zip(segments, repeats.repeated_starts(segments, 12)):
            assert found.tolist() == [count[s[i : i + 12]] > 1 for i in range(len(s) - 11)]


def test_index_is_run_length_compressed():
    text = np.frombuffer(passage(9, 60).encode() * 20, np.uint8)
    index = repeats.build_index(text)
    assert index.lengths.sum() == len(text) and len(index.heads) < len(text) / 8
    once = len(text) // 20
    assert (index.matching(len(text))[:once] == len(text) - once - np.arange(once)).all()


@pytest.mark.parametrize("letters", [b"\0a", b"\0ab", b"\0\xff\x01"])
def test_index_takes_any_bytes(letters):
    """Also bytes that might be taken for the end of a segment."""
    rng = random.Random(len(letters))
    for _ in range(60):
        segments = [bytes(rng.choice(letters) for _ in range(rng.randint(3, 40))) for _ in range(rng.randint(1, 9))]
        count = Counter(s[i : i + 6] for s in segments for i in range(len(s) - 5))
        for s, found in zip(segments, repeats.repeated_starts(segments, 6)):
            assert found.tolist() == [count[s[i : i + 6]] > 1 for i in range(len(s) - 5)]


@pytest.mark.parametrize("seed", range(3))
def test_halves_hold_every_string_once(seed):
    """Equal strings come to equal wider cores, however their segments go on, down to whole strings."""
    rng = random.Random(seed)
    length, gram = 120, repeats.GRAM
    middle = bytes(rng.choice(b"ab") for _ in range(gram))
    keys = {}
    for _ in range(60):
        left, right = (bytes(rng.choice(b"ab") for _ in range(3)) * 40 for _ in range(2))
        a, b = rng.randint(0, length - gram), rng.randint(0, length - gram)
        segment = left[len(left) - a :] + middle + right[:b]
        if len(segment) < length:
            continue
        todo = [(0, segment, a, gram)]
        while todo:
            shift, part, at, width = todo.pop()
            assert all(x <= at and at + width <= x + length for x in range(len(part) - length + 1))
            if width == length:
                assert len(part) == length and at == 0
                keys.setdefault(part, set()).add((at, width))
                continue
            halves = list(repeats._halves(part, 0, at, width, length))
            starts = [s + x for s, p, _, _ in halves for x in range(len(p) - length + 1)]
            assert sorted(starts) == list(range(len(part) - length + 1))
            for s, p, place, wide in halves:
                assert part[s : s + len(p)] == p and wide > width
                todo.append((shift + s, p, place, wide))
    assert len(keys) > 100


def nul_rows():
    """One string that stands once but reads like the end of a text, a zero byte and a beginning."""
    rng = random.Random(8)
    one, two = ("".join(rng.choice("abcdefgh") for _ in range(n)) for n in (150, 49))
    texts = [one + "\0" + two]
    for k in range(6):
        texts.append("".join(rng.choice("ijklmnop") for _ in range(100)) + one)
        texts.append(two + one[:1] + "".join(rng.choice("qrstuvwx") for _ in range(200)))
    texts += ["".join(rng.choice("\0a") for _ in range(600)) + one + "\0" for _ in range(3)]
    texts += ["\0" * 450, "\0" * 199, "a" + "\0" * 200, "\0" * 200 + "b"]
    return texts


@pytest.mark.parametrize("crowd", [4096, 2])
def test_repeats_of_texts_with_zero_bytes(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CORE_SEGMENTS", crowd)
    texts = nul_rows()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(df).collect()}
    assert got == dict(enumerate(brute_repeats(texts, 200)))


@pytest.mark.parametrize("crowd", [4096, 1])
def test_repeats_of_edges(edge, nothing, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CORE_SEGMENTS", crowd)
    got = Counter((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(edge).collect())
    assert got == Counter(brute_repeats([r[1] for r in edge_rows()], 200))
    assert repeats.remove_repeats(nothing).count() == 0


def test_repeats_of_whole_table(spark, docs, folder):
    rows = docs.orderBy("doc_id").collect()
    got = {r.doc_id: r for r in QUERIES["op3_run_length_repeats"](spark, folder).collect()}
    for row, want in zip(rows, brute_repeats([r.text for r in rows], 200)):
        r = got[row.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == want[:3]
        assert r.kept_sha256 == hashlib.sha256(want[3]).hexdigest()


# 4 vectors ------------------------------------------------------------------------------------


def near_rows(seed=3, dim=24):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for label in (1, 2, None):
        for _ in range(12):
            center = rng.normal(size=dim)
            for spread in (0, 0.02, 0.03, 0.04, 0.3, 0):
                rows.append((k, (center * rng.choice([1, 3]) + spread * rng.normal(size=dim)).tolist(), label))
                k += 1
    rows += [(k, None, 1), (k + 1, [], 1), (k + 2, [0.0] * dim, 1), (k + 3, [float("nan")] * dim, 1)]
    rows += [(k + 4, [None] + [1.0] * (dim - 1), 1), (k + 5, [1.0] * 3, 1), (k + 6, [1.0] * 3, 1)]
    rows += [(k + 7, [1e200] * dim, 2), (k + 8, [1e-200] * dim, 2), rows[0], (None, rows[0][1], 1)]
    return rows


VECTORS = "vec_id bigint, embedding array<double>, label int"


def brute_near(rows, least=0.98):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.sqrt((v**2).sum())

    units = [unit(v) if i is not None and label is not None else None for i, v, label in rows]
    links, edges = Counter(), []
    for a in range(len(rows)):
        for b in range(a):
            if units[a] is None or units[b] is None or rows[a][2] != rows[b][2]:
                continue
            if len(units[a]) == len(units[b]) and units[a] @ units[b] >= least:
                links[a] += 1
                links[b] += 1
                edges.append((rows[a][0], rows[b][0]))
    top = brute_components(edges)
    return Counter(
        (r[0], links[k], top.get(r[0], r[0]), top.get(r[0], r[0]) == r[0]) for k, r in enumerate(rows)
    )


@pytest.mark.parametrize("bucket", [4096, 4])
def test_near_vectors(spark, monkeypatch, bucket):
    monkeypatch.setattr(vecdedup, "BUCKET_ROWS", bucket)
    rows = near_rows()
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("id", "n", "code")})
    got = Counter(map(tuple, vecdedup.near_vectors(df).collect()))
    assert got == brute_near(rows)
    assert vecdedup.near_vectors(df.limit(0)).count() == 0


def test_more_hashes_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(vecdedup, "BUCKET_GOAL", 1)
    rows = near_rows(8)
    got = Counter(map(tuple, vecdedup.near_vectors(spark.createDataFrame(rows, VECTORS)).collect()))
    assert got == brute_near(rows)


def test_near_vectors_whole_table(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, r.label) for r in table]
    got = Counter(map(tuple, QUERIES["op4_cross_polytope_vectors"](spark, folder).collect()))
    assert got == brute_near(rows)


# 5 quality ------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark, folder):
    rows = {r.doc_id: r for r in QUERIES["op5_nb_svm_quality"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in rows.items())
    held = [(rows[x.doc_id].predicted, x.quality) for x in labels if rows[x.doc_id].held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def test_fitted_on_4000_rows(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality, "fit", lambda rows, labels: taken.append(len(rows)))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    quality.train(docs, docs.select("doc_id", (F.col("doc_id") % 2).alias("quality")))
    assert taken == [4000]


def test_quality_edges(spark, edge, nothing, folder, docs):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(docs, labels)
    out = quality.score(edge, model, "how_good").collect()
    assert len(out) == len(edge_rows())
    empty = {r.how_good for r in out if not (r.text or "")}
    assert len(empty) == 1
    assert quality.score(nothing, model, "how_good").count() == 0
    odd = spark.createDataFrame([(None, 1, 0), (6, None, 0), (6, 5, 0)], labels.schema)
    for none in (labels.limit(0), odd):
        assert quality.train(edge, none).score(np.array([3, 4]), np.zeros(quality.BUCKETS, bool)) == 0.5
    one = spark.createDataFrame([(k, 1, 0) for k in range(9)], labels.schema)
    assert quality.train(edge, one).score(np.array([3]), np.zeros(quality.BUCKETS, bool)) > 0.5


def test_training_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    """Copies of an id count once, and what is collected ends before the bound is passed."""
    taken = []
    monkeypatch.setattr(quality, "fit", lambda rows, labels: taken.append([len(r) for r in rows]))
    docs = [(k, f"text number {k} " + passage(k, 30)) for k in range(40)] + [(7, "a " * 9)] * 500 + [(8, None)] * 3
    docs = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    labels = docs.select("doc_id", F.lit(1).alias("quality")).distinct()
    quality.train(docs, labels, max_rows=20)
    quality.train(docs, labels, max_buckets=4000)
    quality.train(docs, labels.union(labels), max_buckets=10**9)
    out = zlib.crc32
    usable = sum(out(str(k).encode()) % 4 != 2 for k in range(40))
    assert len(taken[0]) == 20 and sum(taken[1]) <= 4000 < sum(taken[2]) and len(taken[2]) == 2 * usable


def brute_fit(rows, labels, c, epochs):
    """Ratios from dicts, and the dual solved one coordinate at a time in plain Python, until it stands."""
    good, bad = Counter(), Counter()
    for found, y in zip(rows, labels):
        (good if y else bad).update(found.tolist())
    total = [sum(x.values()) + quality.BUCKETS for x in (good, bad)]
    ratio = {
        b: math.log((good[b] + 1) / total[0]) - math.log((bad[b] + 1) / total[1]) for b in {*good, *bad}
    }
    units = []
    for found in rows:
        v = {b: ratio[b] for b in found.tolist()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1
        units.append({b: x / size for b, x in v.items()})
    w, bias, alpha = defaultdict(float), 0.0, [0.0] * len(rows)
    for _ in range(epochs):
        for i, (v, y) in enumerate(zip(units, labels)):
            sign = 1 if y else -1
            slack = 1 - sign * (sum(w[b] * x for b, x in v.items()) + bias)
            new = min(max(alpha[i] + slack / (sum(x * x for x in v.values()) + 1), 0), c)
            step = (new - alpha[i]) * sign
            alpha[i] = new
            bias += step
            for b, x in v.items():
                w[b] += step * x
    return ratio, units, w, bias, alpha


def test_ratios_and_dual_solution_against_brute_force():
    rng = random.Random(11)
    labels = np.array([rng.random() < 0.5 for _ in range(90)], np.int64)
    rows = []
    for y in labels:
        some = {rng.randrange(60 if y else 40, 120 if y else 100) for _ in range(12)}
        rows.append(np.array(sorted(some), np.uint32))
    ratio, units, w, bias, alpha = brute_fit(rows, labels, 1.0, 400)
    signs = np.where(labels == 1, 1.0, -1.0)

    def primal(weights, b):
        square = sum(x * x for x in weights.values()) + b * b
        margins = [s * (sum(weights[k] * x for k, x in v.items()) + b) for s, v in zip(signs, units)]
        return square / 2 + sum(max(0.0, 1 - m) for m in margins)

    square = sum(x * x for x in w.values()) + bias * bias
    dual = sum(alpha) - square / 2
    assert primal(w, bias) - dual < 1e-3 * dual  # the brute solution is the optimum
    values = [np.array([v[b] for b in found.tolist()], np.float32) for v, found in zip(units, rows)]
    got, b = quality._descend(rows, values, signs, 1.0, 200)
    found = defaultdict(float, {k: got[k] for k in ratio})
    # the descent stops where no step changes a dual value by 0.02
    assert primal(found, b) < primal(w, bias) * 1.02
    model = quality.fit(rows, labels, epochs=200)
    for k, r in ratio.items():
        assert model.square[k] == pytest.approx(r * r, rel=1e-4, abs=1e-9)
    seen = np.zeros(quality.BUCKETS, bool)
    scores = [model.score(x, seen) for x in rows]
    margins = [sum(w[k] * x for k, x in v.items()) + bias for v in units]
    order = lambda xs: np.argsort(np.argsort(xs))
    assert np.corrcoef(order(scores), order(margins))[0, 1] > 0.99
    assert not seen.any()


def test_byte_grams_against_plain_integers():
    text = "Some tëxt, twice: Some tëxt!"
    raw, want = text.encode(), Counter()
    for kind, n in enumerate(quality.BYTE_GRAMS):
        for i in range(len(raw) - n + 1):
            code = int.from_bytes(raw[i : i + n], "little")
            want[((code + kind + 1) * 0x9E3779B97F4A7C15 % 2**64) >> 47] += 1
    (found,) = quality.features(pa.array([text], pa.string()))
    assert not want - Counter(found.tolist())


def test_features_do_not_depend_on_neighbours():
    texts = [r[1] for r in edge_rows()]
    together = quality.features(pa.array(texts, pa.string()))
    for text, found in zip(texts, together):
        (alone,) = quality.features(pa.array([text], pa.string()))
        assert np.array_equal(np.sort(alone), np.sort(found))


# 6 packing ------------------------------------------------------------------------------------


def check_pieces(rows, texts, longest):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        assert r.length & (r.length - 1) == 0 and r.length <= longest and r.offset == 0
        assert len(r.ids) == 4 * r.length
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        parts = sorted(by_doc[doc], key=lambda r: r.start)
        assert [r.start for r in parts] == np.cumsum([0, *[r.length for r in parts]])[:-1].tolist()
        assert np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist() == ids
        assert {r.doc_tokens for r in parts} == {len(ids)}


def test_sequences_are_numbered_by_length(docs):
    file = tokenizer_path("word_bpe_49k.json")
    rows = packing.pack(docs.repartition(3), file, 2).select("sequence_id", "length").collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    runs = Counter()
    lengths = [(r.sequence_id >> 33, r.length) for r in sorted(rows)]
    for one, two in zip([None, *lengths], lengths):
        runs[two] += one != two
    assert set(runs.values()) == {1}  # in a task every bucket is one run


def test_packing(spark, docs, edge, nothing, tmp_path):
    file = tokenizer_path("word_bpe_49k.json")
    check_pieces(packing.pack(docs, file, 2).collect(), {r.doc_id: r.text for r in docs.collect()}, 4096)
    odd = edge.where("doc_id <> 7 and doc_id is not null")
    out = packing.pack(odd, file, 2, 64)
    check_pieces(out.collect(), {r.doc_id: r.text for r in odd.collect()}, 64)
    assert packing.pack(edge.where("doc_id = 7 or doc_id is null"), file, 2).count() > 4
    assert packing.pack(nothing, file, 2).count() == 0
    packing.write_buckets(out, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == out.count()


def test_words_encode_as_in_their_text():
    from tokenizers import Tokenizer

    file = tokenizer_path("word_bpe_49k.json")
    tokenizer, own, rng = Tokenizer.from_file(file), packing.WordIds(file), random.Random(4)
    parts = ["the", "'s", "<|endoftext|>", " <|startoftext|> ", "́", "É", "12 34", " ", " ", "İ", "\n", "  ", "日本", "\x00", "It's"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        (got,) = own.encode([text])
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    # every character of ASCII and Latin-1 beside every kind, on the short way and off it
    letters = [chr(c) for c in range(0x180)] + ["'s", "'LL", "<|", "|>", " ", "\n", "Σ", "\u0301"] * 9
    assert own.split is not None
    for _ in range(6000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        (got,) = own.encode([text])
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_caches_stay_within_bytes(docs):
    """Long strings are not kept; what was used lately comes back after a turn."""
    from starloom.llm.cache import LONGEST, Recent

    made = Recent(3, lambda key: key * 2)
    assert made["x" * (LONGEST + 1)] == "x" * 2 * (LONGEST + 1) and not made
    for key in "abcda":
        made[key]
    made.turn()
    assert not made and made["a"] == "aa" and set(made) == {"a"}


# 7 top k --------------------------------------------------------------------------------------


def brute_top(rows, asks, k):
    usable = [
        (i, np.floor(256 * np.array(v, float)).astype(int))
        for i, v in rows
        if i is not None and v and not any(x is None or not np.isfinite(x) for x in v)
    ]
    out = Counter()
    for i, q in usable:
        if asks(i):
            best = sorted((-int(q @ v), j) for j, v in usable if j != i and len(v) == len(q))[:k]
            out.update((i, n + 1, j, -s) for n, (s, j) in enumerate(best))
    return out


@pytest.mark.parametrize("block", [1024, 7])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows = [(k, rng.integers(-2, 3, 6).astype(float).tolist()) for k in range(120)]
    rows += [(k, rows[0][1]) for k in range(120, 150)] + [(150, [1.0]), (152, [2.0, 1.0]), (153, [1.0, 1.0])]
    rows += [(160, None), (162, []), (164, [float("inf")] * 6), (166, [None] * 6), (None, [1.0] * 6), rows[3]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1))
    got = Counter(map(tuple, topk.top_k(df, F.col("vec_id") % 10 == 0, 5).collect()))
    assert got == brute_top(rows, lambda i: i % 10 == 0, 5)
    assert topk.top_k(df, F.lit(False), 5).count() == 0
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0, 5).count() == 0


def test_top_k_of_large_components(spark):
    """One large component changes nobody else's result; scores beyond 2**61 are ties."""
    rng = np.random.default_rng(3)
    rows = [(k, (rng.normal(size=4) * 10.0 ** rng.integers(-2, 8)).tolist()) for k in range(60)]
    rows += [(60, [2.0**26, 1.0, 0.0, -(2.0**27)]), (61, [1e300, 0.0, 0.0, 0.0]), (62, [0.0, 0.0, 0.0, 1e15]), (63, [-1e300, 1e5, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    cut = lambda x: max(min(x, 2**61), -(2**61))
    whole = [(i, [cut(math.floor(256 * x)) for x in v]) for i, v in rows]
    want = Counter()
    for i, q in whole:
        best = sorted((-cut(sum(a * b for a, b in zip(q, v))), j) for j, v in whole if j != i)[:7]
        want.update((i, n + 1, j, -s) for n, (s, j) in enumerate(best))
    assert Counter(map(tuple, topk.top_k(df, F.lit(True), 7).collect())) == want


def test_top_k_whole_table(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = Counter(map(tuple, QUERIES["op7_histogram_top_k"](spark, folder).collect()))
    assert got == brute_top(rows, lambda i: i % 50 == 0, 5)


def test_top_k_sends_no_blocks_through_the_driver(spark, monkeypatch):
    """Query blocks were copied for every slot and broadcast by the size of their file."""
    rng, plans, settle = np.random.default_rng(7), [], topk.settle
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(topk, "settle", lambda df, name: plans.append(plan_of(df)) or settle(df, name))
    monkeypatch.setattr(topk, "BLOCK", 10)
    monkeypatch.setattr(topk, "PART", 100)
    rows = [(k, rng.integers(-9, 10, 5).astype(float).tolist()) for k in range(200)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 4 == 0, 3)
    plans.append(plan_of(found))
    assert len(plans) > 4 and not any("Broadcast" in p or "explode" in p for p in plans)
    assert Counter(map(tuple, found.collect())) == brute_top(rows, lambda i: i % 4 == 0, 3)


# 8 URLs ---------------------------------------------------------------------------------------


def test_blocks_reach_aliases(spark):
    link = lambda u: f'<html><link rel="canonical" href="{u}"></html>'
    hop = lambda u: f'<meta http-equiv="refresh" content="0; url={u}">'
    pages = [
        (1, "http://a.org/x", link("http://b.net/es/1")),  # its canonical page is blocked
        (2, "http://c.org/y#top", hop("http://a.org/x")),  # redirects to 1
        (3, "http://WWW.Example.com/en/1?q", link("http://b.net/es/1")),  # allowed by its own rule
        (4, "http://d.org/z", link("/z2")), (5, "http://d.org/z2", None),
        (6, None, link("http://b.net/es/1")), (7, "nonsense", "<html>"), (8, "http://e.org", ""),
        (9, "http://f.org/log", None), (9, "http://f.org/log", None), (None, "https://x.net/fr/?a", None),
        (10, "http://h.com?x/y", None), (11, "http://example.com/en/", None),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    rules = urls.rules_table(spark, [
        ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
        ("block", "net", "/es/"), ("block", "net", "/fr/"),
    ])
    log = spark.createDataFrame([("http://f.org/log", "http://c.org/y")], "a string, b string")
    rows = urls.judge(df.withColumn("rule", F.lit(1)), rules, log).collect()
    got = Counter((r.page_id, r.rule, r.verdict) for r in rows)
    assert got == Counter([
        (1, None, "block"), (2, None, "block"), (3, "www.example.com/en/", "allow"),
        (4, None, "allow"), (5, None, "allow"), (6, None, "allow"), (7, None, "allow"),
        (8, None, "allow"), (9, None, "block"), (9, None, "block"), (None, "net/fr/", "block"),
        (10, None, "allow"), (11, "example.com/en/", "block"),
    ])
    assert {(r.host, r.path) for r in rows if r.page_id in (3, 6, 7, 10)} == {
        ("www.example.com", "/en/1"), ("", ""), ("h.com", ""),
    }
    assert urls.judge(df.limit(0), rules).count() == 0


class Links(html.parser.HTMLParser):
    """The first canonical link and the first refresh of a page, as a parser sees them."""

    CDATA_CONTENT_ELEMENTS = ("script", "style", "textarea", "title")

    def __init__(self, text):
        super().__init__(convert_charrefs=False)
        self.link = self.goal = None
        self.feed(text or "")
        self.close()

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in reversed(attrs)}
        if tag == "link" and self.link is None and attrs.get("rel", "").lower() == "canonical":
            self.link = attrs.get("href", "").strip()
        if tag == "meta" and self.goal is None and attrs.get("http-equiv", "").lower() == "refresh":
            head, _, goal = attrs.get("content", "").partition("=")
            if head.strip().lower().endswith("url"):
                self.goal = goal.strip().strip("\"'").strip()


def raw_node(url):
    """Host in lower case, path and query, as they stand."""
    if not url or "://" not in url:
        return None
    rest = url.split("://", 1)[1].split("#")[0]
    at = min([rest.find(c) for c in "/?" if c in rest] or [len(rest)])
    return rest[:at].translate(LOWER) + rest[at:]


def plain_node(url):
    if raw_node(url) is None:
        return None
    parts = urllib.parse.urlsplit(url)
    name = parts.netloc.rpartition("@")[2].lower()
    port = {"http": "80", "https": "443"}.get(parts.scheme)
    for end in (f":{port}", ":"):
        name = name.removesuffix(end)
    # a path from the top goes through the resolver alone
    place = urllib.parse.urlsplit(urllib.parse.urljoin("http://x/", parts.path or "/")).path
    return name + place + (f"?{parts.query}" if "?" in url.split("#")[0] else "")


def brute_verdicts(pages, rules):
    def rule_of(at):
        name, place = re.match(r"([^/?]*)([^?]*)", at).groups()
        fits = [r for r in rules if (name == r[1] or name.endswith("." + r[1])) and place.startswith(r[2])]
        return max(fits, key=lambda r: len(r[1] + r[2]), default=None)

    group = {}

    def find(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for _, url, text in pages:
        a = raw_node(url)
        if a is None:
            continue
        found = Links(text)
        for b in (plain_node(url), *(plain_node(urllib.parse.urljoin(url, x)) for x in (found.link, found.goal) if x)):
            if b is not None:
                group[find(a)] = find(b)
    bad = {find(x) for x in list(group) if (r := rule_of(x)) and r[0] == "block"}
    out = Counter()
    for page, url, _ in pages:
        a = raw_node(url)
        rule = rule_of(a) if a is not None else None
        blocked = a is not None and find(a) in bad
        out[page, rule and rule[1] + rule[2], rule[0] if rule else "block" if blocked else "allow"] += 1
    return out


def odd_pages(rng, n):
    hosts = ["a.org", "b.org", "example.com", "x.net", "WWW.Example.com", "a.org:80", "me:pw@b.org", "b.org:443", "c.org:8080"]
    places = ["", "/", "/x/y", "/x/./y", "/x/../en/z", "/en/z", "/es/1", "/../fr/2/..", "/fr/2/.", "/x/y?q=../1", "/a/b;c", "/x/y#f"]  # urljoin would merge //
    links = ["../en/z?a=1&amp;b=2", "/es/1", "./", "..", "../../../..", "//x.net/fr/", "http://x.net/es/1", "https://a.org:443/x/y", "?q=1", "#top",
             "z.html", "HTTP://B.org", "http://b.org/", " /x/y ", "&#47;es&#x2F;1", "mailto:a@b.org", "", "/x/%2e%2e/y", "a;b/../c"]
    url = lambda: rng.choice(["http", "https"]) + "://" + rng.choice(hosts) + rng.choice(places)
    out = []
    for k in range(n):
        link, quote = rng.choice(links) if rng.random() < 0.7 else url(), rng.choice("\"'")
        tag = rng.choice([
            f"<link rel=canonical href={quote}{link}{quote}>", f"<LINK href={quote}{link}{quote} REL='Canonical' />",
            f"<meta http-equiv=refresh content={quote}0; URL={link}{quote}>",
            f"<!-- <link rel=canonical href={quote}{link}{quote}> -->", f"<script>'<link rel=canonical href={quote}{link}{quote}>'</script>",
        ])
        out.append((k, url() if rng.random() < 0.95 else rng.choice([None, "nonsense", "a:b"]), f"<html><head>{tag}</head><p>text" if rng.random() < 0.6 else None))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_aliases_against_a_resolver_and_a_parser(spark, seed):
    pages = odd_pages(random.Random(seed), 60)
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    rows = urls.judge(df, urls.rules_table(spark, URL_RULES)).collect()
    want = brute_verdicts(pages, URL_RULES)
    got = Counter((r.page_id, r.rule, r.verdict) for r in rows)
    assert got == want, [(x, pages[x[0]]) for x in list((got - want))[:4]]


def test_aliases_on_the_whole_table(spark, folder):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    rows = QUERIES["op8_redirect_url_filter"](spark, folder).collect()
    assert Counter((r.page_id, r.rule, r.verdict) for r in rows) == brute_verdicts(pages, URL_RULES)


# 9 mixing -------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while True:
        total = sum(weight[s] for s in open_)
        out.update({s: left * weight[s] / total for s in open_})
        full = {s for s in open_ if out[s] > cap * sizes[s] + 1e-9}
        if not full:
            return out
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= full
        if not open_:
            return out


def check_mix(rows, source_of, slack):
    sizes, taken, targets = Counter(), Counter(), {}
    for r in rows:
        s = source_of[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        targets[s] = r.target
        assert r.taken == r.size * r.copies and r.taken <= 2 * r.size
    want = brute_targets(sizes)
    for s in sizes:
        assert targets[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= slack(s)
    return taken


def test_mix_of_whole_table(docs):
    rows = mixing.mix(docs).collect()
    source_of = {r.doc_id: r.source for r in docs.collect()}
    biggest = defaultdict(int)
    for r in rows:
        biggest[source_of[r.doc_id]] = max(biggest[source_of[r.doc_id]], r.size)
    check_mix(rows, source_of, lambda s: biggest[s])
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_mix_edges(edge, nothing):
    rows = mixing.mix(edge).collect()
    assert len(rows) == len(edge_rows())
    assert Counter((r.doc_id, r.size) for r in rows) == Counter(
        (r[0], len(WORD.findall(r[1] or ""))) for r in edge_rows()
    )
    copies = Counter()
    for r in rows:
        copies[r.doc_id] += r.copies
    out = mixing.mixed(edge)
    assert out.columns == edge.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: n for k, n in copies.items() if n})
    names = ["_mix_none", "_mix_source", "_mix_copy", "_MIX_threshold", "a`b", "c.d", "copies", "source_key"]
    clash = edge.withColumns({n: F.lit(5) for n in names})
    again = mixing.mixed(clash)
    assert again.columns == clash.columns
    assert all(r[n] == 5 for r in again.collect() for n in names)
    assert Counter(r.doc_id for r in again.collect()) == Counter(r.doc_id for r in out.collect())
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


# 10 near-duplicate texts ----------------------------------------------------------------------


def brute_texts(rows, percent):
    """(id, text) rows; every pair that shares a shingle is compared."""
    sets = shingle_sets([r[1] for r in rows])
    held, edges = defaultdict(list), []
    for i, found in enumerate(sets):
        both = Counter(j for g in found for j in held[g]) if rows[i][0] is not None else Counter()
        for j, n in both.items():
            if 100 * n >= percent * (len(found) + len(sets[j]) - n):
                edges.append((rows[i][0], rows[j][0]))
        if rows[i][0] is not None:
            for g in found:
                held[g].append(i)
    top = brute_components(edges)
    return Counter(
        (r[0], len(s), top.get(r[0], r[0]), top.get(r[0], r[0]) == r[0]) for r, s in zip(rows, sets)
    )


def test_signatures_agree_as_often_as_similar():
    rng = np.random.default_rng(1)
    for n, share in ((400, 0.8), (30, 0.8), (6, 0.5)):
        agree = []
        for _ in range(60):
            both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            cut = int(n * share)
            a, b = minhash.signatures([both[:cut] if n * 1 else both, both], 256)
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - share) < 0.06


@pytest.mark.parametrize(("percent", "block"), [(85, 2000), (80, 3)])
def test_near_texts(spark, edge, nothing, monkeypatch, percent, block):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    base = passage(20, 200).split(" ")
    rows = [(r[0], r[1]) for r in edge_rows()]
    rng = random.Random(6)
    for k in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 9)}"
        rows.append((100 + k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in CLASHES})
    got = Counter(map(tuple, minhash.near_texts(df, percent).collect()))
    assert got == brute_texts(rows, percent)
    assert minhash.near_texts(nothing).count() == 0
    kept = minhash.keep_one(edge, percent)
    assert kept.columns == edge.columns
    want = {r[0] for r in brute_texts([(r[0], r[1]) for r in edge_rows()], percent) if r[3]}
    assert Counter(r.doc_id for r in kept.collect() if r.doc_id is not None) == Counter(
        k for k in want if k is not None
    )
    assert kept.where("doc_id is null").count() == 2


def test_near_texts_whole_table(spark, folder, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = Counter(map(tuple, QUERIES["op10_densified_minhash"](spark, folder).collect()))
    assert got == brute_texts(rows, 85)


def test_groups_reach_over_batches():
    table = pa.table({"k": [1, 1, 2, 2, 2, 3], "v": list(range(6))})
    parts = list(vectors.groups(iter(table.to_batches(max_chunksize=2)), 1))
    assert [(int(k[0]), t["v"].to_pylist()) for k, t in parts] == [(1, [0, 1]), (2, [2, 3, 4]), (3, [5])]


def test_features_of_a_chunk_take_little_memory():
    """Chunks of a batch are small, and a text's features do not depend on them."""
    rng = random.Random(41)
    words = ["Alpha", "beta", "7", "gamma,", "delta"]
    texts = pa.array([" ".join(rng.choices(words, k=400)) for _ in range(300)], pa.string())
    pieces = list(tx.chunks(texts, quality.FEATURE_BYTES))
    assert len(pieces) > 3
    tracemalloc.start()
    found = []
    for a, b in pieces:
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        part = quality.features(texts.slice(a, b - a))
        assert tracemalloc.get_traced_memory()[1] - held < 30 << 20
        found += [np.unique(x) for x in part]
    tracemalloc.stop()
    whole = [np.unique(x) for x in quality.features(texts)]
    assert all(np.array_equal(x, y) for x, y in zip(found, whole)) and len(found) == len(whole)
