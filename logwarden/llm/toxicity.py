"""Toxicity: a learnt lexicon, matched with Levenshtein automata over its trie, weighed by context."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import held_out, mix, pieces, sampled_texts, strings, utf8
from logwarden.operators.durable import durable

#: At most about this many labelled rows are learnt from.
LABEL_BOUND = 20_000

#: A term enters the lexicon if it is in this many toxic rows, nearly all its rows are toxic, and that
#: share is surely (at the lower end of its interval) above one half.
LEAST_ROWS, LEAST_SHARE, SURE_SHARE = 4, 0.9, 0.5

#: Lengths of word beginnings that may stand for a family of inflected words.
STEMS = range(3, 9)

#: Words this long may be misspelled by one edit, or by two.
ONE_EDIT, TWO_EDITS = 5, 9

#: Words on either side of a hit that are looked at, and words in the window of the density.
CONTEXT, WINDOW = 10, 50

#: A quoted hit that is not aimed at anybody counts this much.
QUOTED_WEIGHT = 0.4

#: Words of address and of report, and characters that stand for letters.
ADDRESS = frozenset("you your you're youre yourself u ur tu du vous sie tú usted".split())
REPORT = frozenset("said says wrote writes quote quoted quotes called reported reports word term".split())
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

THRESHOLD = 0.5
TOKEN = re.compile(r"[\w@$](?:[\w@$*!]*\w)?")
CACHE_WORDS = 400_000
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_hits int, n_misspelled int"


class Automaton:
    """The Levenshtein automaton of a word: a state is the set of (edits, position), one bit row per edit count."""

    def __init__(self, word: str, edits: int):
        self.size, self.edits = len(word), edits
        self.where: dict[str, int] = {}
        for i, c in enumerate(word):
            self.where[c] = self.where.get(c, 0) | 1 << i
        self.full = (1 << (len(word) + 1)) - 1

    def start(self) -> tuple[int, ...]:
        return tuple((1 << (e + 1)) - 1 for e in range(self.edits + 1))

    def step(self, state: tuple[int, ...], c: str) -> tuple[int, ...]:
        hits, below, out = self.where.get(c, 0), 0, []
        for e, row in enumerate(state):
            now = (row & hits) << 1
            if e:
                now |= state[e - 1] | state[e - 1] << 1 | below << 1  # inserted, replaced, left out
            below = now & self.full
            out.append(below)
        return tuple(out)

    def accepts(self, state: tuple[int, ...]) -> bool:
        return any(row >> self.size & 1 for row in state)


#: Keys of a trie node that no character can be: the term ends here, a family begins here.
ENDS, BEGINS = "", "begins"


@dataclass
class Lexicon:
    """Terms with their row counts in toxic and clean texts; a term ending in * is a word beginning.

    ``members`` are words of a family, with the beginning that stands for them: they have no count
    of their own, but a misspelling of one counts as its family.
    """

    counts: dict[str, tuple[int, int]]
    toxic: int
    clean: int
    known: frozenset[str] = frozenset()  # ordinary words that lie near a term
    members: dict[str, str] = field(default_factory=dict)
    trie: dict = field(default_factory=dict)
    halves: list = field(default_factory=list)
    swapped: dict[str, str] = field(default_factory=dict)  # words with two neighbouring letters swapped

    def __post_init__(self):
        heads, tails, middles = set(), set(), set()
        targets = {t: t for t in self.counts if not t.endswith("*")}
        for word, term in {**self.members, **targets}.items():
            node = self._node(word)
            node[ENDS] = term
            if len(word) >= ONE_EDIT:
                for i in range(len(word) - 1):
                    wrong = word[:i] + word[i + 1] + word[i] + word[i + 2:]
                    self.swapped[wrong] = min(self.swapped.get(wrong, term), term)
                parts = 3 if len(word) >= TWO_EDITS else 2
                heads.add(word[:len(word) // parts])
                tails.add(word[-(len(word) // parts):])
                if parts == 3:
                    middles.add(word[len(word) // 3:len(word) - len(word) // 3])
        for term in self.counts:
            if term.endswith("*"):
                self._node(term[:-1])[BEGINS] = term
        lengths = lambda x: sorted({len(y) for y in x})
        self.halves = [heads, lengths(heads), tails, lengths(tails), middles]

    def _node(self, word: str) -> dict:
        node = self.trie
        for c in word:
            node = node.setdefault(c, {})
        return node

    def weight(self, term: str, label: float | None = None) -> float:
        """Log odds of the term; for a row of the sample, as if the row were not in it."""
        a, b = self.counts[term]
        a, b = (max(a - label, 0), max(b - (1 - label), 0)) if label is not None else (a, b)
        if a < LEAST_ROWS - 1:
            return 0.0
        return math.log((a + 0.5) / (self.toxic + 1)) - math.log((b + 0.5) / (self.clean + 1))

    def exact(self, word: str) -> str | None:
        """The term that the word is or, else, begins with."""
        node, stem = self.trie, None
        for c in word:
            stem = stem or node.get(BEGINS)
            node = node.get(c)
            if node is None:
                return stem
        return node.get(ENDS) or stem or node.get(BEGINS)

    def near(self, word: str) -> str | None:
        """The term that the word misspells: the automaton of the word walks the trie.

        An edit leaves one half of a term whole (two edits one of three parts), so only words with
        the beginning, end or middle of a term are walked at all. A swap of two neighbours, which
        the automaton counts as two edits, is one slip like any other and is looked up.
        """
        if word in self.swapped:
            return self.swapped[word]
        heads, head_sizes, tails, tail_sizes, middles = self.halves
        if not (any(word[:n] in heads for n in head_sizes) or any(word[-n:] in tails for n in tail_sizes)
                or any(m in word for m in middles)):
            return None
        automaton = Automaton(word, 2 if len(word) >= TWO_EDITS - 1 else 1)
        best: tuple[int, str] | None = None
        stack = [(self.trie, automaton.start(), 0)]
        while stack:
            node, state, size = stack.pop()
            term = node.get(ENDS)
            if term and automaton.accepts(state):
                edits = next(e for e, row in enumerate(state) if row >> automaton.size & 1)
                if edits <= (2 if size >= TWO_EDITS else 1 if size >= ONE_EDIT else 0):
                    best = min(best or (edits, term), (edits, term))
            for c, child in node.items():
                if len(c) == 1:
                    then = automaton.step(state, c)
                    if any(then):
                        stack.append((child, then, size + 1))
        return best and best[1]

    def match(self, word: str) -> tuple[str, bool] | None:
        """Term and whether it is misspelled."""
        term = self.exact(word)
        if term:
            return term, False
        if word in self.known or len(word) < ONE_EDIT - 1:
            return None
        plain = word.translate(LOOKALIKES)
        term = (self.exact(plain) if plain != word and not plain.isdigit() else None) or self.near(plain)
        return (term, True) if term else None


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


class Scorer:
    """Features of whole texts, with a bounded memory of words already looked up."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.seen = lexicon, {}

    def hits(self, words: list[str]) -> dict[str, tuple[str, bool]]:
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
        found = {}
        for word in set(words):
            if word not in self.seen:
                self.seen[word] = self.lexicon.match(word)
            if self.seen[word]:
                found[word] = self.seen[word]
        return found

    def features(self, text: str, label: float | None = None) -> np.ndarray:
        """log weight, log count, different terms, share of words, densest window, misspelled; then the raw counts."""
        words = tokens(text)
        found = self.hits(words)
        if not found:
            return np.zeros(8)
        places = [i for i, w in enumerate(words) if w in found]
        quoted = _quoted(text)
        weights = []
        for i in places:
            around = set(words[max(0, i - CONTEXT):i + CONTEXT + 1])
            spared = (quoted[i] or around & REPORT) and not around & ADDRESS
            weights.append((QUOTED_WEIGHT if spared else 1.0) * self.lexicon.weight(found[words[i]][0], label))
        weights = np.maximum(weights, 0)
        if not weights.any():
            return np.zeros(8)
        hit = weights > 0
        at = np.array(places)[hit]
        strength = weights[hit]
        sums = np.concatenate(([0], strength.cumsum()))
        densest = (sums[np.searchsorted(at, at + WINDOW)] - sums[:-1]).max()
        terms = {found[words[i]][0] for i in at}
        wrong = sum(found[words[i]][1] for i in at)
        best = {t: self.lexicon.weight(t, label) for t in terms}
        return np.array([
            math.log1p(sum(best.values())), math.log1p(strength.sum()), math.log1p(len(terms)),
            math.log(1e-4 + strength.sum() / len(words)) - math.log(1e-4), math.log1p(densest),
            wrong / len(at), len(at), wrong])


def _quoted(text: str) -> np.ndarray:
    """For each token whether it lies between quotation marks of its line."""
    inside = np.zeros(len(text) + 1, bool)
    for line in re.finditer(r"[^\n]+", text):
        for span in re.finditer(r"\"[^\"\n]*\"|“[^”\n]*”|«[^»\n]*»|„[^“\n]*“", line[0]):
            inside[line.start() + span.start():line.start() + span.end()] = True
    # lower() may change the length of a text; positions then shift a little, never beyond its end
    return np.array([inside[min(m.start(), len(text))] for m in TOKEN.finditer(text.lower())], bool)


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    share: float

    def scores(self, texts: list[str], scorer: Scorer) -> tuple[np.ndarray, np.ndarray]:
        x = np.array([scorer.features(t) for t in texts]).reshape(-1, 8)
        line = np.column_stack((x[:, :6], np.ones(len(x)))) @ self.weights
        return 1 / (1 + np.exp(-np.clip(line, -500, 500))), x[:, 6:]


def _surely(hits: int, others: int, z: float = 1.96) -> float:
    """Lower end of the Wilson interval of a share."""
    n = hits + others
    p = hits / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def one_of_copies(sample: DataFrame) -> DataFrame:
    """The sample without most copies and near copies, which would make any word of one text look common.

    A row stays if it has the smallest id among those with its least hash of word triples, for two
    hashes. Copies always share both; rows of similarity s stay together with probability (1 - s)^2.
    """
    def hashed(batches):
        for batch in batches:
            for part in pieces(batch):
                raw, at = utf8(part.column("text"))
                out = []
                for i in range(part.num_rows):
                    words = bytes(raw[at[i]:at[i + 1]]).lower().split()
                    keys = np.array([zlib.crc32(b" ".join(words[k:k + 3])) for k in range(max(1, len(words) - 2))], np.uint64)
                    out.append([int(mix(keys + np.uint64(seed << 32)).min() >> np.uint64(1)) for seed in (1, 2)])
                first, second = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(first, pa.int64()), pa.array(second, pa.int64())],
                    ["doc_id", "text", "label", "first", "second"])

    marked = durable(sample.mapInArrow(hashed, "doc_id long, text string, label int, first long, second long"),
                     "toxicity-sketched")
    for key in ("first", "second"):
        marked = marked.join(marked.groupBy(key).agg(F.min("doc_id").alias(f"{key}_id")), key)
    return marked.where("doc_id = first_id and doc_id = second_id").select("text", "label")


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Words and word beginnings that mark toxic rows, from document counts made on the executors."""
    def counted(batches):
        counts = {0: Counter(), 1: Counter()}
        for batch in batches:
            for part in pieces(batch):
                for text, label in zip(strings(part.column("text")), part.column("label").to_pylist()):
                    words = set(tokens(text))
                    counts[label].update(words)
                    counts[label].update({f"{w[:n]}*" for w in words for n in STEMS if len(w) > n})
        for label, seen in counts.items():
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen.keys(), pa.string()), pa.array([label] * len(seen), pa.int32()),
                     pa.array(seen.values(), pa.int64())], ["term", "label", "n"])

    terms = sample.select("text", "label").mapInArrow(counted, "term string, label int, n long").groupBy("term").agg(
        F.sum(F.expr("if(label = 1, n, 0)")).alias("a"), F.sum(F.expr("if(label = 1, 0, n)")).alias("b"))
    terms = durable(terms.where("a + b > 1"), "toxicity-terms")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    # the bound of the sample bounds these rows: each has LEAST_ROWS toxic rows and few clean ones
    rows = terms.where((F.col("a") >= LEAST_ROWS) & (F.col("a") >= LEAST_SHARE * (F.col("a") + F.col("b")))).collect()
    sure = {r["term"]: (r["a"], r["b"]) for r in rows if _surely(r["a"], r["b"]) >= SURE_SHARE}
    families = {t: c for t, c in sure.items() if not t.endswith("*") or _family(t, c, sure)}
    covers = {t: _covers(t, c, families) for t, c in families.items()}
    kept = {t: c for t, c in families.items() if not covers[t]}
    # words that a beginning stands for stay targets of misspellings, with the weight of the family
    members = {t: _last(t, covers) for t, c in covers.items() if c and not t.endswith("*")}
    lexicon = Lexicon(kept, sizes.get(1, 0), sizes.get(0, 0), members=members)

    def ordinary(batches):  # clean words that a misspelling could be taken for
        for batch in batches:
            words = [w for w in batch.column("term").to_pylist() if lexicon.near(w)]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], ["term"])

    near = terms.where("b >= 2 and term not like '%*'").select("term").mapInArrow(ordinary, "term string")
    lexicon.known = frozenset(r["term"] for r in near.collect())  # bounded as the sample is
    return lexicon


def _family(stem: str, count: tuple[int, int], sure: dict[str, tuple[int, int]]) -> bool:
    """Whether a beginning stands for more than one word, so that no single word says it all."""
    return not any(c[0] >= 0.8 * count[0] for t, c in sure.items() if not t.endswith("*") and t.startswith(stem[:-1]))


def _last(term: str, covers: dict[str, list[str]]) -> str:
    """The beginning that stands for the term and that no shorter one stands for."""
    while covers[term]:
        term = min(covers[term], key=len)
    return term


def _covers(term: str, count: tuple[int, int], sure: dict[str, tuple[int, int]]) -> list[str]:
    """Shorter beginnings that are as sure."""
    word = term[:-1] if term.endswith("*") else term
    shorter = [f"{word[:n]}*" for n in STEMS if n < len(word)]
    return [s for s in shorter if s in sure and _surely(*sure[s]) >= 0.97 * _surely(*count)]


def fit_toxicity(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> Model:
    """Lexicon and weights of ``labels.toxic`` from a bounded sample of labelled rows.

    Every row of the sample is weighed as if it had not been counted for the lexicon.
    """
    sample = durable(one_of_copies(sampled_texts(docs, labels, "toxic", bound)), "toxicity-sample")
    lexicon = learn_lexicon(sample)

    def rows(batches):
        scorer = Scorer(lexicon)
        for batch in batches:
            for part in pieces(batch):
                label = part.column("label").to_pylist()
                x = [scorer.features(t, y).tolist() for t, y in zip(strings(part.column("text")), label)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.list_(pa.float64())), part.column("label")], ["x", "label"])

    found = sample.select("text", "label").mapInArrow(rows, "x array<double>, label int").toPandas()
    label = found["label"].to_numpy(float)
    x = np.array(found["x"].tolist()) if len(found) else np.zeros((0, 8))
    a = np.column_stack((x[:, :6], np.ones(len(x))))
    w = np.zeros(7)
    penalty = np.diag([0.3] * 6 + [0.01])
    for _ in range(40 if len(label) else 0):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w = w + np.linalg.solve((a * (p * (1 - p) + 1e-6)[:, None]).T @ a + penalty, a.T @ (label - p) - penalty @ w)
    if not len(label):
        w[-1] = -30.0
    return Model(lexicon, w, float(label.mean()) if len(label) else 0.0)


def score_toxicity(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_hits, n_misspelled.

    Only the text is an input of a score. Null and empty texts have no hit and get the score of a
    text without hits; repeated rows get equal scores; a missing id is not held out. Without
    labels every score is near 0. An empty table gives no rows; other columns are ignored.
    """
    model = fit_toxicity(docs, labels, bound)

    def scored(batches):
        scorer = Scorer(model.lexicon)
        for batch in batches:
            for part in pieces(batch):
                score, counts = model.scores(strings(part.column("text")), scorer)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score),
                     pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(counts[:, 0].astype(np.int32)),
                     pa.array(counts[:, 1].astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted", "n_hits", "n_misspelled"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text",
    ).mapInArrow(scored, SCHEMA)


def drop_toxic(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> DataFrame:
    """The documents with a score below the threshold, with their own columns; no shuffle of texts.

    Null and empty texts stay, as do all documents where there are no labels; repeated rows fare alike.
    """
    model = fit_toxicity(docs, labels, bound)

    def clean(batches):
        scorer = Scorer(model.lexicon)
        for batch in batches:
            for part in pieces(batch):
                score, _ = model.scores(strings(part.column("text")), scorer)
                yield part.filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(clean, docs.schema)
