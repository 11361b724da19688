"""Cross-entropy differences against a plain version, and a vocabulary that follows the corpus."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logwarden.llm import lm_score
from logwarden.llm.common import held_out

S = lm_score


def plain(docs, target):
    """{doc_id: (tokens, target loss, background loss)} from plain counts."""
    tokens = {i: S.TOKEN.findall(t or "") for i, t in docs}
    totals = Counter(w.lower() for words in tokens.values() for w in words)
    top = {w for w, _ in sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:S.WORDS]}
    symbol = lambda w: w.lower() if w.lower() in top else ("class", S.shape(w))
    models = []
    for ids in (target, set(tokens)):
        pairs, own = Counter(), Counter()
        for i in ids:
            line = ["edge", *map(symbol, tokens[i]), "edge"]
            pairs.update(zip(line, line[1:]))
            own.update((w.lower(), S.shape(w)) for w in tokens[i] if w.lower() not in top)
        models.append((pairs, own))
    everything = models[1][1]

    def bigram(pairs):
        seen, followers, single = Counter(), Counter(), Counter()
        for (a, b), n in pairs.items():
            seen[a] += n
            followers[a] += 1
            single[b] += n
        whole = sum(single.values()) + S.ADDED * S.SYMBOLS
        weight = lambda a: S.FOLLOWER_WEIGHT * followers[a] + 1
        return lambda a, b: (pairs[a, b] + weight(a) * (single[b] + S.ADDED) / whole) / (seen[a] + weight(a))

    def inside(counts):
        def share(word, kind, n_of):
            members = [k for k in everything if k[1] == kind]
            listed = [k for k in members if everything[k] >= S.LEAST_SEEN]
            rest = [k for k in members if everything[k] < S.LEAST_SEEN]
            whole = sum(everything[k] for k in members) + S.ADDED * (len(listed) + 1)
            known = (word, kind) in listed
            held = [(word, kind)] if known else rest
            usual = (sum(everything[k] for k in held) + S.ADDED) / whole
            if n_of is not None:
                usual = (sum(n_of[k] for k in held) + S.PRIOR * usual) / (sum(n_of[k] for k in members) + S.PRIOR)
            return usual / (1 if known else max(1, len(rest)))
        return lambda w: share(w.lower(), S.shape(w), counts)

    out = {}
    for i, words in tokens.items():
        line, losses = ["edge", *map(symbol, words), "edge"], []
        for (pairs, own), counts in zip(models, (models[0][1], None)):
            p, q = bigram(pairs), inside(counts)
            loss = -sum(math.log(p(a, b)) for a, b in zip(line, line[1:]))
            loss -= sum(math.log(q(w)) for w in words if w.lower() not in top)
            losses.append(loss / (len(line) - 1))
        out[i] = (len(words), *losses)
    return out


def corpus(seed=5, size=60):
    rng = random.Random(seed)
    common = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    docs = [(i, " ".join(rng.choice(common) if rng.random() < 0.8 else "".join(
        rng.choice("klmnopK7") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(40)))) for i in range(size)]
    return docs + [(size, None), (size + 1, ""), (size + 2, "!!! Only, marks; 123 123 ÄÖ 日本"), (size + 3, "Aa aA AA")]


@pytest.mark.parametrize("joined", [False, True])
def test_losses_against_a_plain_version(spark, monkeypatch, joined):
    monkeypatch.setattr(S, "WORDS", 30)  # most words are in classes
    monkeypatch.setattr(S, "SYMBOLS", 30 + S.SHAPES + 1)
    monkeypatch.setattr(S, "EDGE", 30 + S.SHAPES)
    monkeypatch.setattr(S, "BROADCAST_WORDS", -1 if joined else 10_000)
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, quality int")
    may = {r.doc_id for r in frame.where(~held_out(F.col("doc_id"))).collect()}
    want = plain(docs, {i for i, _ in docs if i % 2 and i in may})
    # workers read the constants where the package is loaded anew, so the whole job runs in this process
    found = {r.doc_id: r for r in local_scores(frame, labels)}
    assert found.keys() == want.keys()
    for i, (n, target, background) in want.items():
        r = found[i]
        assert r.n_tokens == n and r.target_loss == pytest.approx(target, abs=2e-4)
        assert r.background_loss == pytest.approx(background, abs=2e-4)
        assert r.score == pytest.approx(target - background, abs=4e-4)


def local_scores(frame, labels):
    return S.score_documents(frame, labels).collect()


def test_words_told_apart_grow_with_the_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    sizes = []
    for share in (4, 1):
        part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
        words = S.count_words(part.select("text", F.lit(False).alias("wanted"))).cache()
        listed = words.where(F.col("background") >= S.LEAST_SEEN)
        sizes.append(listed.count())
        outside = 1 - listed.agg(F.sum("background")).first()[0] / words.agg(F.sum("background")).first()[0]
        words.unpersist()
    assert sizes[1] > 2 * sizes[0]
    assert outside < 0.05
