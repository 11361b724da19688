"""Cross-entropy difference: matched target and background n-gram models over one vocabulary.

The models are class bigrams. Symbols are the commonest words, one each, and classes of all other
words by shape; a bigram table over symbols has a fixed size. What a word of a class is worth
within its class comes from a table of all words seen more than once, which grows with the corpus:
P(word | before) = P(symbol | symbol before) * P(word | symbol). Both models share all of it.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import BROADCAST_IDS, pieces, strings, usable_labels
from logwarden.operators.durable import durable

#: Symbols both models share: the commonest words, word shapes for all others, and the text's edge.
SYMBOLS, SHAPES = 1024, 64
WORDS = SYMBOLS - SHAPES - 1
EDGE = SYMBOLS - 1

#: A word is told apart from others of its class if it occurs this often; rarer ones share what is left.
LEAST_SEEN = 2

#: The table of words goes to every worker up to this many words (16 bytes each, by a count made
#: first); a larger one is joined with the documents' words, none of which is common.
BROADCAST_WORDS = 2_000_000

#: A task passes its word counts on when it holds this many.
HELD_WORDS = 500_000
CACHE_WORDS = 400_000

#: A token's code holds its symbol in the lower bits.
PLACE_BITS = 20

#: Weight of a symbol's every follower, and count added to every symbol and word.
FOLLOWER_WEIGHT, ADDED = 1.0, 0.5

#: Words' worth of background that a class of the target model starts from.
PRIOR = 200.0

TOKEN = re.compile(r"\w+|[^\w\s]+")
SCHEMA = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def shape(word: str) -> int:
    """The class of a word outside the vocabulary: one of 8 kinds by one of 8 lengths."""
    if not (word[0].isalnum() or word[0] == "_"):
        kind = 0
    elif word.isalpha():
        kind = 3 + (0 if word.islower() else 1 if word.isupper() else 2)
        kind = kind if word.isascii() else 6 if word.islower() else 7
    else:
        kind = 1 if word.isdigit() else 2
    return 8 * kind + min(len(word) - 1, 15) // 2


def word_key(word: str, kind: int) -> int:
    """A word of a class, as a signed 64-bit hash: the one that Spark's xxhash64 has of the same text."""
    value = xxhash.xxh64_intdigest(f"{kind} {word}".encode("utf-8", "surrogatepass"), 42)
    return value - (1 << 64) if value >> 63 else value


class Symbols:
    """Symbol ids of whole texts, with a bounded memory of words.

    With the sorted keys of a word table, a token's code also holds the place of its word there:
    1 and on for words of the table, then one place for the rest of each class, 0 for symbols of
    their own.
    """

    def __init__(self, vocabulary: dict[str, int], keys: np.ndarray | None = None):
        self.vocabulary, self.keys, self.seen = vocabulary, keys, {}

    def _learn(self, words: list[str]) -> None:
        """Codes of words not seen so far."""
        codes, kinds = [], []
        for w in words:
            known = self.vocabulary.get(w.lower())
            kinds.append(-1 if known is not None else shape(w))
            codes.append(known if known is not None else WORDS + kinds[-1])
        if self.keys is not None:
            other = [i for i, kind in enumerate(kinds) if kind >= 0]
            keys = np.array([word_key(words[i].lower(), kinds[i]) for i in other], np.int64)
            at = np.searchsorted(self.keys, keys)
            there = np.zeros(len(at), bool)
            there[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] == keys[at < len(self.keys)]
            for i, place, found in zip(other, at.tolist(), there.tolist()):
                codes[i] |= (place + 1 if found else len(self.keys) + 1 + kinds[i]) << PLACE_BITS
        self.seen.update(zip(words, codes))

    def codes(self, texts: list[str]) -> list[np.ndarray]:
        """Codes of each text's tokens between two edges."""
        tokens = [TOKEN.findall(t) for t in texts]
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
        new = set(chain.from_iterable(tokens)).difference(self.seen)
        if new:
            self._learn(list(new))
        look = self.seen.__getitem__
        return [np.fromiter((EDGE, *map(look, words), EDGE), np.int64, len(words) + 2) for words in tokens]

    def rare(self, text: str) -> Counter:
        """Words of the text that are no symbols, with their class: (word, class) to count."""
        counts, out = Counter(TOKEN.findall(text)), Counter()
        for w, n in counts.items():
            low = w.lower()
            if low not in self.vocabulary:
                out[low, shape(w)] += n
        return out


def count_words(marked: DataFrame) -> DataFrame:
    """(word, kind, background, target, key): every word of all documents and of the target's."""
    def counted(batches):
        counts = {True: Counter(), False: Counter()}

        def passed_on():
            for wanted, held in counts.items():
                n = pa.array(held.values(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.lower() for w in held], pa.string()), pa.array(list(map(shape, held)), pa.int32()),
                     n, n if wanted else pa.array(np.zeros(len(held), np.int64))],
                    ["word", "kind", "background", "target"])
            counts[True].clear()
            counts[False].clear()

        for batch in batches:
            for part in pieces(batch):
                for text, wanted in zip(strings(part.column("text")), part.column("wanted").to_pylist()):
                    counts[bool(wanted)].update(TOKEN.findall(text))
                if len(counts[True]) + len(counts[False]) > HELD_WORDS:
                    yield from passed_on()
        yield from passed_on()

    found = marked.mapInArrow(counted, "word string, kind int, background long, target long")
    return found.groupBy("word", "kind").agg(
        F.sum("background").alias("background"), F.sum("target").alias("target")).withColumn(
        "key", F.xxhash64(F.concat(F.col("kind").cast("string"), F.lit(" "), F.col("word"))))


def learn_vocabulary(words: DataFrame) -> dict[str, int]:
    """The commonest words of all documents, ties in the order of the words."""
    totals = words.groupBy("word").agg(F.sum("background").alias("n"))
    top = totals.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    return {r["word"]: i for i, r in enumerate(top)}


def mark_target(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """The texts, and whether they are the target's. Ids are broadcast only behind a count; beyond it
    Spark shuffles the texts by id and splits skewed ids."""
    ids = F.broadcast(target_ids) if target_ids.count() <= BROADCAST_IDS else target_ids
    return docs.select("doc_id", "text").join(ids, "doc_id", "left").select(
        "text", F.coalesce("wanted", F.lit(False)).alias("wanted"))


def bigram_counts(marked: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """code (previous * SYMBOLS + next), how often in all documents and how often in the target's."""
    def counted(batches):
        symbols = Symbols(vocabulary)
        everything = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        target = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for batch in batches:
            for part in pieces(batch):
                codes = {True: [], False: []}
                for ids, wanted in zip(symbols.codes(strings(part.column("text"))), part.column("wanted").to_pylist()):
                    codes[bool(wanted)].append(ids[:-1] * SYMBOLS + ids[1:])
                for wanted, held in codes.items():
                    if held:
                        found = np.bincount(np.concatenate(held), minlength=SYMBOLS * SYMBOLS)
                        everything += found
                        if wanted:
                            target += found
        at = np.flatnonzero(everything)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(everything[at]), pa.array(target[at])], ["code", "background", "target"])

    return marked.mapInArrow(counted, "code long, background long, target long").groupBy("code").agg(
        F.sum("background").alias("background"), F.sum("target").alias("target"))


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Log of the interpolated bigram probabilities; a symbol with many followers leans more on single symbols."""
    single = counts.sum(0, dtype=float) + ADDED
    single = (single / single.sum()).astype(np.float32)
    seen = counts.sum(1, keepdims=True, dtype=float).astype(np.float32)
    followers = (FOLLOWER_WEIGHT * (counts > 0).sum(1, keepdims=True) + 1.0).astype(np.float32)
    return np.log((counts + followers * single[None, :]) / (seen + followers)).astype(np.float32)


@dataclass
class ClassTotals:
    """Per class: tokens in all and in the target's documents, words of the table, and the words left out of it."""

    tokens: np.ndarray
    target: np.ndarray
    words: np.ndarray
    rest_tokens: np.ndarray
    rest_target: np.ndarray
    rest_words: np.ndarray

    @staticmethod
    def of(rare: DataFrame) -> ClassTotals:
        listed = F.col("background") >= LEAST_SEEN
        rows = rare.groupBy("kind").agg(
            F.sum("background"), F.sum("target"), F.count_if(listed), F.sum(F.when(listed, 0).otherwise(F.col("background"))),
            F.sum(F.when(listed, 0).otherwise(F.col("target"))), F.count_if(~listed)).collect()
        held = np.zeros((6, SHAPES))
        for r in rows:
            held[:, r[0]] = r[1:]
        return ClassTotals(*held)

    def losses(self, kind, background, target, log):
        """(target, background) loss of words of a class within it, from their counts.

        The background adds ADDED to every word of the table and once for all the rest; the target
        starts each class with PRIOR words' worth of the background.
        """
        whole = self.pick(self.tokens, kind) + ADDED * (self.pick(self.words, kind) + 1)
        usual = (background + ADDED) / whole
        wanted = (target + PRIOR * usual) / (self.pick(self.target, kind) + PRIOR)
        return -log(wanted), -log(usual)

    @staticmethod
    def pick(values: np.ndarray, kind):
        if isinstance(kind, Column):
            return F.element_at(F.array(*[F.lit(float(v)) for v in values]), kind + 1)
        return values[kind]

    def rest(self) -> tuple[np.ndarray, np.ndarray]:
        """The same for a word left out of the table: an equal share of what is left of its class."""
        target, background = self.losses(np.arange(SHAPES), self.rest_tokens, self.rest_target, np.log)
        share = np.log(np.maximum(self.rest_words, 1))
        return target + share, background + share


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_tokens, target_loss, background_loss, score.

    Losses are mean negative log probabilities (nats) of a document's tokens and its end; score is
    target_loss - background_loss, lower for texts more like the target. The background model
    counts all documents, the target model all labelled documents of quality 1 that may be learnt
    from; vocabulary, order and smoothing are the same. Null and empty texts consist of their
    end alone. Without target documents the target model is uniform over symbols and as the
    background within a class. Repeated rows count as often as they occur and get equal scores; an
    empty table gives no rows; other columns are ignored.
    """
    wanted = usable_labels(labels, "quality").where("label = 1").select("doc_id", F.lit(True).alias("wanted"))
    marked = mark_target(docs, wanted)
    words = durable(count_words(marked), "lm-words")
    vocabulary = learn_vocabulary(words)
    rare = words.where(~F.col("word").isin(list(vocabulary))) if vocabulary else words
    totals = ClassTotals.of(rare)
    listed = rare.where(F.col("background") >= LEAST_SEEN).select("key", "kind", "background", "target")
    counts = durable(bigram_counts(marked, vocabulary), "lm-bigrams").toArrow()  # at most SYMBOLS^2 rows
    tables = []
    for column in ("target", "background"):
        held = np.zeros(SYMBOLS * SYMBOLS, np.float32)
        held[counts.column("code").to_numpy()] = counts.column(column).to_numpy()
        tables.append(log_probabilities(held.reshape(SYMBOLS, SYMBOLS)).ravel())
    del counts, held
    read = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    if totals.words.sum() <= BROADCAST_WORDS:
        return _scored_with_table(read, vocabulary, tables, listed, totals)
    return _scored_by_join(read, vocabulary, tables, listed, totals)


def _scored_with_table(docs: DataFrame, vocabulary: dict, tables: list, listed: DataFrame, totals: ClassTotals) -> DataFrame:
    found = listed.toArrow()
    order = np.argsort(found.column("key").to_numpy())
    keys, kind, background, target = (found.column(c).to_numpy()[order] for c in ("key", "kind", "background", "target"))
    within = [np.concatenate(([0], own, rest)).astype(np.float32)
              for own, rest in zip(totals.losses(kind, background, target, np.log), totals.rest())]
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, *tables, keys, *within))
    del found, order, kind, background, target

    def scored(batches):
        words, target, background, keys, own_target, own_background = shared.value
        symbols, mask = Symbols(words, keys), (1 << PLACE_BITS) - 1
        for batch in batches:
            for part in pieces(batch):
                rows = []
                for codes in symbols.codes(strings(part.column("text"))):
                    ids, place = codes & mask, codes[1:] >> PLACE_BITS
                    code = ids[:-1] * SYMBOLS + ids[1:]
                    rows.append((len(code), own_target[place].sum(dtype=float) - target[code].sum(dtype=float),
                                 own_background[place].sum(dtype=float) - background[code].sum(dtype=float)))
                n, t, b = (np.array(x) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n - 1, pa.int64()), pa.array(t / n), pa.array(b / n), pa.array((t - b) / n)],
                    ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return docs.mapInArrow(scored, SCHEMA)


def _scored_by_join(docs: DataFrame, vocabulary: dict, tables: list, listed: DataFrame, totals: ClassTotals) -> DataFrame:
    """The same where the table of words is too large to broadcast: the documents' words meet it in a join.

    Common words are symbols, so no word left here holds more than a small share of the tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, *tables))

    def partly(batches):
        words, target, background = shared.value
        symbols = Symbols(words)
        for batch in batches:
            for part in pieces(batch):
                sums, rare = [], []
                texts = strings(part.column("text"))
                for ids, text in zip(symbols.codes(texts), texts):
                    code = ids[:-1] * SYMBOLS + ids[1:]
                    sums.append((len(code), -target[code].sum(dtype=float), -background[code].sum(dtype=float)))
                    rare.append([{"key": word_key(w, k), "kind": k, "n": n} for (w, k), n in symbols.rare(text).items()])
                n, t, b = (np.array(x) for x in zip(*sums))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(t), pa.array(b),
                     pa.array(rare, pa.list_(pa.struct([("key", pa.int64()), ("kind", pa.int32()), ("n", pa.int64())])))],
                    ["doc_id", "n", "t", "b", "rare"])

    read = docs.mapInArrow(
        partly, "doc_id long, n long, t double, b double, rare array<struct<key: long, kind: int, n: long>>")
    read = durable(read.withColumn("row", F.monotonically_increasing_id()), "lm-partial")
    asked = read.select("row", F.explode("rare").alias("w")).select("row", "w.*")
    own_target, own_background = totals.losses(F.col("kind"), F.col("background"), F.col("target"), F.log)
    table = listed.select("key", own_target.alias("own_t"), own_background.alias("own_b"))
    rest_target, rest_background = totals.rest()
    met = asked.join(table, "key", "left").select(
        "row", (F.col("n") * F.coalesce("own_t", totals.pick(rest_target, F.col("kind")))).alias("t"),
        (F.col("n") * F.coalesce("own_b", totals.pick(rest_background, F.col("kind")))).alias("b"))
    sums = met.groupBy("row").agg(F.sum("t").alias("more_t"), F.sum("b").alias("more_b"))
    n, t, b = F.col("n"), F.col("t") + F.coalesce("more_t", F.lit(0.0)), F.col("b") + F.coalesce("more_b", F.lit(0.0))
    return read.drop("rare").join(sums, "row", "left").select(
        "doc_id", (n - 1).alias("n_tokens"), (t / n).alias("target_loss"), (b / n).alias("background_loss"),
        ((t - b) / n).alias("score"))
