"""The corpus pipeline as a whole against plain versions of its stages, and long words of the SentencePiece codec."""

import random

import numpy as np

import corpus_pipeline
from logwarden.llm import exact_dedup, near_dedup, sentencepiece_codec, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join("".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(n))


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept_by_plain_rules(docs, toxic, items):
    left = [d for d in docs if d[0] not in toxic]
    groups = {}
    for i, text in left:
        groups.setdefault("".join((text or "").split()), []).append((i, text))
    left = sorted(min(g, key=lambda d: (-len(d[1] or ""), d[0])) for g in groups.values())
    sets, root = {i: shingles(t) for i, t in left}, {i: i for i, _ in left}
    for a, _ in left:  # ascending ids: each takes the least id it is linked with
        for b, _ in left:
            if b < a and sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                root[a] = min(root[a], root[b])
    return {i for i, t in left if root[i] == i and not any(item in " ".join((t or "").lower().split()) for item in items)}


def test_run_against_plain_rules(spark, tmp_path):
    rng = random.Random(17)
    texts = [sentence(rng, rng.randrange(40, 90)) for _ in range(90)]
    docs, labels, toxic = list(enumerate(texts)), [], set()
    for i in range(90, 150):  # toxic ones are labelled, some of them are not
        docs.append((i, f"{sentence(rng, 30)} you stupid idiot {sentence(rng, 5)} stupid moron"))
        toxic.add(i)
    item = sentence(rng, 25)
    docs += [(200, texts[3]), (201, texts[3].replace(" ", "  ", 1)), (202, " ".join([*texts[5].split()[:-1], "zz"])),
             (203, f"{sentence(rng, 20)} {item} {sentence(rng, 20)}"), (204, None), (205, ""), (206, " \n")]
    labels = [(i, 1, int(i in toxic)) for i, _ in docs if i % 3 and i < 150]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = kept_by_plain_rules(docs, toxic, [item])
    assert {r.doc_id for r in found} == want
    assert 201 in want and 3 not in want and not {200, 202, 203} & want
    table, by_id = sentencepiece_codec.load_pieces(), dict(docs)
    codec = sentencepiece_codec.Codec(table)
    for r in found:
        assert r.roundtrip and codec.decode(list(r.token_ids)) == (by_id[r.doc_id] or "")


def test_long_words_in_windows(monkeypatch):
    table = sentencepiece_codec.load_pieces()
    rng = np.random.default_rng(6)
    letters = list("abcdeinorst") + ["é", "日", "\U0001f600", "▁"]
    for size in (65, 300, 1000):
        word = "".join(rng.choice(letters, size))
        whole = sentencepiece_codec._encode_long(table, word)
        monkeypatch.setattr(sentencepiece_codec, "WINDOW", 37)
        assert sentencepiece_codec._encode_long(table, word) == whole
        monkeypatch.undo()
        assert sentencepiece_codec._encode_together(table, [word], size) == [whole]


def test_columns_of_any_name_stay(spark, tmp_path):
    names = "_digest string, _keep_id int, _keep_digest int, _gone_id int, shard string"
    rows = [(i, t, f"own {i}", i, i, i, f"s{i}") for i, t in enumerate(["a b c d e f", "a bc def", None, "", "x y z"])]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {names}")
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and {(r.doc_id, r["_digest"]) for r in kept.collect()} == {
        (0, "own 0"), (2, "own 2"), (4, "own 4")}
    assert near_dedup.drop_near_duplicates(docs).count() == 5
    sharding.write_shards(docs, f"{tmp_path}/shards", 2)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(i, f"s{i}") for i in range(5)}
    placed = {r.doc_id: r.shard for r in sharding.assign_shards(docs, 2).collect()}
    assert {r.doc_id: r["_shard"] for r in back.collect()} == placed
