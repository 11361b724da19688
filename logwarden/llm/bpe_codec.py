"""Byte-level BPE by speculation: the longest match proposes tokens, pairs of neighbours are verified.

A sequence of tokens is what the merges give if each token is what the merges make of its own bytes
and no merge ever crosses the edge between two neighbours. The second is a test of single pairs: it
undoes the merges of both sides from the latest to the first and looks whether a merge over the edge
would have come earlier. All pairs of many words are tested together. Words that fail are merged
one merge at a time.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import pieces, strings

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

#: Words of more bytes are not remembered, and are worked on one by one.
LONG_WORD = 64

#: Words whose tokens a worker remembers, and words that are merged together.
CACHE_WORDS, TOGETHER = 400_000, 4096

#: Fixed value: how a text is cut into words before the merges.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ASCII_WORDS = re.compile(r"""'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+""", re.ASCII)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_NEVER = 1 << 40

SCHEMA = "doc_id long, token_ids array<int>, decoded string"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    spelled: list[bytes]  # by id
    byte_ids: np.ndarray
    rank: np.ndarray  # by id: the number of the merge that makes it, -1 for a byte
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray  # sorted
    pair_rank: np.ndarray
    pairs: dict[tuple[int, int], tuple[int, int]]  # to rank and made token
    made: np.ndarray  # by rank
    probes: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # length, sorted hashes, ids, quick test
    sound: np.ndarray  # by id: the merges make this token of its bytes
    added: dict[str, int]


def load_vocabulary(path: str = TOKENIZER) -> Vocabulary:
    """Read a tokenizer file of byte-level BPE without normalizer, cut by the usual pattern."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cut = spec["model"], spec["pre_tokenizer"]
    if (model["type"], cut["type"], cut["add_prefix_space"], spec["normalizer"], spec["post_processor"]) != (
            "BPE", "ByteLevel", False, None, None) or model.get("ignore_merges") or model.get("dropout"):
        raise ValueError("not a plain byte-level BPE file")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added tokens that take in what stands beside them are not supported")
    letters = byte_letters()
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = 1 + max([*model["vocab"].values(), *added.values()])
    spelled = [b""] * size
    for name, i in (model["vocab"] | added).items():
        known = all(c in letters for c in name)
        spelled[i] = bytes(letters[c] for c in name) if known else name.encode()
    byte_ids = np.array([model["vocab"][c] for c, _ in sorted(letters.items(), key=lambda x: x[1])])
    rank, left, right = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
    pairs = {}
    for number, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        i, j, made = (model["vocab"][x] for x in (a, b, a + b))
        if rank[made] >= 0 or max(rank[i], rank[j]) >= number:
            raise ValueError("a token is made by two merges, or by a merge that comes before its parts")
        rank[made], left[made], right[made] = number, i, j
        pairs[i, j] = (number, made)
    keys = np.array([i << 32 | j for i, j in pairs], np.int64)
    order = np.argsort(keys)
    table = Vocabulary(
        spelled, byte_ids, rank, left, right, keys[order], np.array([r for r, _ in pairs.values()])[order], pairs,
        np.array([m for _, m in pairs.values()]), [], np.zeros(size, bool), added)
    by_length: dict[int, list[int]] = {}
    for i in model["vocab"].values():
        by_length.setdefault(len(spelled[i]), []).append(i)
    for length in sorted(by_length, reverse=True):
        ids = np.array(by_length[length])
        hashes = _hashes(np.frombuffer(b"".join(spelled[i] for i in ids), np.uint8), np.arange(len(ids)) * length, length)
        order = np.argsort(hashes, kind="stable")
        present = np.zeros(1 << 16, bool)
        present[hashes >> np.uint64(48)] = True
        table.probes.append((length, hashes[order], ids[order], present))
    names = sorted(model["vocab"].values())
    for i, ids in zip(names, exact_merges(table, [spelled[i] for i in names])):
        table.sound[i] = ids == [i]
    return table


def _running(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of byte times a falling power, and the rising powers that undo it (all modulo 2^64)."""
    with np.errstate(over="ignore"):
        falling = np.cumprod(np.full(len(raw) + 1, _INVERSE, np.uint64))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * falling[:-1])))
        rising = np.cumprod(np.full(len(raw) + 1, _BASE, np.uint64))
    return sums, rising


def _hashes(raw: np.ndarray, at: np.ndarray, length: int, running=None) -> np.ndarray:
    sums, rising = running or _running(raw)
    with np.errstate(over="ignore"):
        h = (sums[at + length] - sums[at]) * rising[at]
        return (h ^ (h >> np.uint64(29))) * _BASE


def longest_matches(table: Vocabulary, raw: np.ndarray, running, at: np.ndarray, room: np.ndarray):
    """For every place the longest token that begins there and fits the ``room``: its id and length."""
    token, length = table.byte_ids[raw[at]], np.ones(len(at), np.int64)
    open_, most = np.arange(len(at)), int(room.max(initial=0))
    for size, hashes, ids, present in table.probes:
        if size == 1 or size > most:
            continue
        some = open_[room[open_] >= size]
        h = _hashes(raw, at[some], size, running)
        likely = present[h >> np.uint64(48)]
        some, h = some[likely], h[likely]
        found = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        hit = hashes[found] == h
        if hit.any():
            token[some[hit]], length[some[hit]] = ids[found[hit]], size
            open_ = open_[length[open_] == 1]
    return token, length


def compatible(table: Vocabulary, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of neighbours: no merge crosses the edge between them.

    Both sides stand as whole tokens at the end of all merges. Going back, the later of the two
    last merges is undone (of equal ones the right one, as merges run from left to right). A merge
    over the edge would have come first if its rank is less than that of the merge undone, or
    equal to it where the right side is undone, which lies further right.
    """
    fits, open_ = np.ones(len(a), bool), np.arange(len(a))
    a, b, limit = a.astype(np.int64), b.astype(np.int64), np.full(len(a), _NEVER)
    while len(open_):
        key = a << 32 | b
        at = np.minimum(np.searchsorted(table.pair_keys, key), len(table.pair_keys) - 1)
        crossing = (table.pair_keys[at] == key) & (table.pair_rank[at] < limit)
        fits[open_[crossing]] = False
        ra, rb = table.rank[a], table.rank[b]
        on = ~crossing & ((ra >= 0) | (rb >= 0))
        open_, a, b, ra, rb = open_[on], a[on], b[on], ra[on], rb[on]
        undo_left = ra > rb
        limit = np.where(undo_left, ra, rb + 1)
        a, b = np.where(undo_left, table.right[a], a), np.where(undo_left, b, table.left[b])
    return fits


def exact_merge(table: Vocabulary, word: bytes) -> list[int]:
    """The merges themselves: always the pair of least rank, of equal ones the leftmost. n log n by a heap."""
    ids: list[int | None] = table.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    heap = [(*found, i, pair) for i, pair in enumerate(zip(ids, ids[1:])) if (found := table.pairs.get(pair))]
    heapq.heapify(heap)
    while heap:
        _, made, i, pair = heapq.heappop(heap)
        j = after[i]
        if j >= len(ids) or (ids[i], ids[j]) != pair:
            continue  # one of the two has been merged since
        ids[i], ids[j], after[i] = made, None, after[j]
        if after[j] < len(ids):
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < len(ids) and (found := table.pairs.get((ids[x], ids[y]))):
                heapq.heappush(heap, (*found, x, (ids[x], ids[y])))
    return [i for i in ids if i is not None]


def exact_merges(table: Vocabulary, words: list[bytes]) -> list[list[int]]:
    """The merges of many words, one merge of each word at a time, words of like length together."""
    out: list[list[int]] = [[]] * len(words)
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    while order and len(words[order[-1]]) > LONG_WORD:
        i = order.pop()
        out[i] = exact_merge(table, words[i])
    for k in range(0, len(order), TOGETHER):
        some = order[k:k + TOGETHER]
        for i, ids in zip(some, _merge_together(table, [words[i] for i in some])):
            out[i] = ids
    return out


def _merge_together(table: Vocabulary, words: list[bytes]) -> list[list[int]]:
    """A row a word, a column a byte. A merge leaves its token in the left column and empties the right one."""
    width = max(map(len, words)) + 1  # one empty column at the end
    ids = np.full((len(words), width), -1, np.int64)
    inside = np.arange(width) < np.array([len(w) for w in words])[:, None]
    ids[inside] = table.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    after = np.minimum(np.tile(np.arange(1, width + 1), (len(words), 1)), width - 1)
    before = np.tile(np.arange(-1, width - 1), (len(words), 1))

    def ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b  # never a known pair if either is -1
        at = np.minimum(np.searchsorted(table.pair_keys, key), len(table.pair_keys) - 1)
        return np.where((table.pair_keys[at] == key) & (b >= 0), table.pair_rank[at], _NEVER)

    rank = np.full(ids.shape, _NEVER)
    rank[:, :-1] = ranks(ids[:, :-1], ids[:, 1:])
    rows = np.arange(len(words))
    while len(rows):
        at = rank[rows].argmin(1)  # of equal ranks the leftmost
        on = rank[rows, at] < _NEVER
        rows, at = rows[on], at[on]
        gone = after[rows, at]
        ids[rows, at] = table.made[rank[rows, at]]
        ids[rows, gone], rank[rows, gone] = -1, _NEVER
        next_ = after[rows, gone]
        after[rows, at], before[rows, next_] = next_, at
        rank[rows, at] = ranks(ids[rows, at], ids[rows, next_])
        left = before[rows, at]
        some = left >= 0
        r, l_ = rows[some], left[some]
        rank[r, l_] = ranks(ids[r, l_], ids[r, at[some]])
    kept = ids >= 0
    flat, ends = ids[kept].tolist(), np.cumsum(kept.sum(1)).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def speculate(table: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All words cut greedily into longest matches: token ids, and the number of tokens of each word.

    Words advance together, a match at a time; of long words the matches at all places are found at
    once and followed one by one.
    """
    raw = np.frombuffer(b"".join(words), np.uint8)
    running = _running(raw)
    ends = np.cumsum([len(w) for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    long_ = ends - starts > LONG_WORD
    owners, tokens, steps = [], [], []
    open_ = np.flatnonzero(~long_ & (ends > starts))
    at = starts[open_]
    while len(open_):
        token, length = longest_matches(table, raw, running, at, ends[open_] - at)
        owners.append(open_)
        tokens.append(token)
        steps.append(np.full(len(open_), len(steps)))
        at = at + length
        on = at < ends[open_]
        open_, at = open_[on], at[on]
    for i in np.flatnonzero(long_).tolist():
        places = np.arange(starts[i], ends[i])
        token, length = (x.tolist() for x in longest_matches(table, raw, running, places, ends[i] - places))
        place, found = 0, []
        while place < len(token):
            found.append(token[place])
            place += length[place]
        owners.append(np.full(len(found), i))
        tokens.append(np.array(found))
        steps.append(np.arange(len(found)))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    owner = np.concatenate(owners)
    order = np.lexsort((np.concatenate(steps), owner))
    return np.concatenate(tokens)[order], np.bincount(owner, minlength=len(words))


def encode_words(table: Vocabulary, words: list[bytes]) -> list[list[int]]:
    """Token ids of each word: proposed by longest match, kept if every pair of neighbours fits, else merged."""
    if not words:
        return []
    flat, counts = speculate(table, words)
    owner = np.repeat(np.arange(len(words)), counts)
    beside = np.flatnonzero(owner[1:] == owner[:-1])
    failed = np.zeros(len(words), bool)
    failed[owner[beside[~compatible(table, flat[beside], flat[beside + 1])]]] = True
    failed[owner[~table.sound[flat]]] = True
    spelled, tokens, ends = table.spelled.__getitem__, flat.tolist(), np.cumsum(counts).tolist()
    out = [tokens[a:b] for a, b in zip([0, *ends], ends)]
    # the bytes rule out different strings of one hash
    wrong = [i for i, (w, p, fail) in enumerate(zip(words, out, failed.tolist()))
             if fail or b"".join(map(spelled, p)) != w]
    for i, ids in zip(wrong, exact_merges(table, [words[i] for i in wrong])):
        out[i] = ids
    return out


class Codec:
    """Encodes and decodes texts; remembers the tokens of words, up to a bound."""

    def __init__(self, table: Vocabulary):
        import regex
        from tokenizers import pre_tokenizers

        self.table, self.known, self.classes = table, {}, {}
        self.words = regex.compile(WORDS)
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        named = sorted(table.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, named)) + ")") if named else None

    def _agreed(self, char: str) -> bool:
        """The installed pattern library and the tokenizer library class this character alike (they may be
        of different Unicode versions)."""
        if char not in self.classes:
            probe = f"a{char}1{char}! {char}"
            cut = [probe[i:j] for _, (i, j) in self.library.pre_tokenize_str(probe)]
            self.classes[char] = cut == self.words.findall(probe)
        return self.classes[char]

    def words_of(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_WORDS.findall(text)
        if all(map(self._agreed, set(text))):
            return self.words.findall(text)
        return [text[i:j] for _, (i, j) in self.library.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts. The strings of added tokens become those tokens wherever they stand."""
        cut = []  # per text its words; an added token is a word of its own
        for text in texts:
            if self.added and self.added.search(text):
                parts = self.added.split(text)
                cut.append([w for i, p in enumerate(parts) for w in ([p] if i % 2 else self.words_of(p))])
            else:
                cut.append(self.words_of(text))
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        self.known.update((name, array("i", [i]).tobytes()) for name, i in self.table.added.items())
        new = [w for w in set(chain.from_iterable(cut)) if w not in self.known]
        ids = encode_words(self.table, [w.encode() for w in new])
        self.known.update((w, array("i", i).tobytes()) for w, i in zip(new, ids))
        look = self.known.__getitem__
        found = [np.frombuffer(b"".join(map(look, w)), np.int32) for w in cut]
        for w in new:
            if len(w) > LONG_WORD:
                del self.known[w]
        return found

    def decode(self, ids) -> str:
        """The text of ids; ids that the file lacks are left out, broken byte runs become U+FFFD."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else [i for i in ids if i is not None]
        size = len(self.table.spelled)
        if ids and not 0 <= min(ids) <= max(ids) < size:
            ids = [i for i in ids if 0 <= i < size]
        return b"".join(map(self.table.spelled.__getitem__, ids)).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """One row per document: doc_id, token_ids, decoded (the text that the ids give back).

    Ids are those of the merges in the tokenizer file. Null counts as empty, and an empty text has
    no ids; repeated rows get equal ids; an empty table gives no rows; other columns are ignored.
    Very long texts and words are encoded whole, in time n log n of a word at worst.
    """
    table = load_vocabulary(path)

    def rows(batches):
        codec = Codec(table)
        for batch in batches:
            for part in pieces(batch, limit=1_000_000):
                ids = codec.encode(strings(part.column("text")))
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.int32), *ids])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array([codec.decode(x) for x in ids], pa.string())],
                    ["doc_id", "token_ids", "decoded"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(rows, SCHEMA)


def decode_documents(encoded: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id and text of rows with doc_id and token_ids. Null ids decode to the empty text."""
    table = load_vocabulary(path)

    def rows(batches):
        codec = Codec(table)
        for batch in batches:
            text = [codec.decode(x or []) for x in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr("cast(doc_id as long) doc_id", "token_ids").mapInArrow(rows, "doc_id long, text string")


def digest_columns(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids (decimal, joined by commas) and of the decoded text."""
    return encoded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
