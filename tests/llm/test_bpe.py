"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from logwarden.llm import bpe_codec, queries

ODD = ["", " ", "\n\n  a", "x" * 30_000, "  \t\n\r\x0b\x1c\x1d   　 z", "a<|endoftext|> b<|endoftext|>", "<|endoftext|",
       "don't we'll I'M 'S it's", "é▁😀‎ ￿", "\x00\x01", "日本語" * 2000, "ꟋꟌ a Ᲊ߿ࢇ Ա՘", "<|endoftext|>" * 3]


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.Codec(bpe_codec.load_vocabulary())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe_codec.TOKENIZER)


def texts(count=4000):
    rng = random.Random(11)
    any_char = lambda: chr(rng.choice([rng.randrange(32, 127), 32, rng.randrange(32, 0x3000), rng.randrange(0x10000, 0x11000)]))
    return ODD + ["".join(any_char() for _ in range(rng.randrange(40))) for _ in range(count)] + [
        "".join(rng.choice("aabcdehilnorstu e'") for _ in range(rng.randrange(80))) for _ in range(count)]


def test_encodes_and_decodes_as_the_library_does(codec, library):
    some = texts()
    want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    got = codec.encode(some)
    assert [x.tolist() for x in got] == want
    assert [codec.decode(x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in want]
    rng = random.Random(4)
    for _ in range(3000):  # ids in any order: broken byte runs
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(9))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_pairs_that_fit_are_those_that_merging_leaves_alone(codec):
    rng, table = random.Random(9), codec.table
    pairs = [(rng.randrange(50_256), rng.randrange(50_256)) for _ in range(3000)]
    pairs += [(int(table.left[i]), int(table.right[i])) for i in rng.sample(range(256, 50_256), 500)]
    pairs += [(i, i) for i in rng.sample(range(50_256), 500)]
    a, b = np.array(pairs).T
    merged = [bpe_codec.exact_merge(table, table.spelled[i] + table.spelled[j]) == [i, j] for i, j in pairs]
    assert bpe_codec.compatible(table, a, b).tolist() == merged
    assert 0 < sum(merged) < len(pairs)


def test_merging_together_is_merging_one_by_one(codec):
    words = [w for t in texts(300) for w in map(str.encode, codec.words_of(t))][:4000] + [b"", b"a", b"aaaaaaa", b"zzz" * 60]
    assert bpe_codec.exact_merges(codec.table, words) == [bpe_codec.exact_merge(codec.table, w) for w in words]


def test_matches_are_the_longest(codec):
    table, words = codec.table, [b" unbelievable", b"xyzzyq", "née".encode(), b"aaaa" * 40]
    known = set(table.spelled[:50_256])
    flat, counts = bpe_codec.speculate(table, words)
    for word, found in zip(words, np.split(flat, np.cumsum(counts)[:-1])):
        place = 0
        for i in found.tolist():
            longest = max(n for n in range(1, len(word) - place + 1) if word[place:place + n] in known)
            assert table.spelled[i] == word[place:place + longest]
            place += longest
        assert place == len(word)


def test_query_on_a_whole_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in queries.op13_bpe(spark, sf).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (rows[d.doc_id].n_tokens, rows[d.doc_id].ids_sha256) == (len(ids), digest(",".join(map(str, ids))))
        assert rows[d.doc_id].decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))


def test_odd_rows_and_decoding(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, None, None, None), (0, "", "x", 1), (7, "a", "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, token_ids int")
    encoded = bpe_codec.encode_documents(docs)
    found = encoded.collect()
    assert sorted((r.doc_id is None, r.doc_id, r.decoded) for r in found) == sorted((i is None, i, t or "") for i, t, _, _ in rows)
    back = bpe_codec.decode_documents(encoded.unionByName(
        spark.createDataFrame([(99, None, None)], encoded.schema))).collect()
    assert {(r.doc_id, r.text) for r in back} == {(i, t or "") for i, t, _, _ in rows} | {(99, "")}
    assert bpe_codec.digest_columns(bpe_codec.encode_documents(docs.limit(0))).collect() == []
