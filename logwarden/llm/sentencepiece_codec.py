"""SentencePiece encoding by batched Viterbi over piece scores, and exact decoding."""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logwarden.llm.common import pieces, strings

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: Words longer than this are advanced one by one, in windows of so many characters.
LONG_WORD, WINDOW = 64, 4096

#: Words whose pieces a worker remembers, and words of one length that advance together.
CACHE_WORDS, TOGETHER = 400_000, 4096

#: Fixed value: how much worse than the worst piece an unknown character is.
UNKNOWN_PENALTY = 10.0

SPACE = "▁"
#: Stands for the space mark where a text itself holds it. No valid text holds a lone surrogate.
LITERAL = "\ud800"

WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = "doc_id long, n_tokens long, token_ids array<int>, roundtrip boolean"


@dataclass
class Pieces:
    """Piece keys sorted by hash for each length in characters, and what each id stands for."""

    keys: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # length -> hashes, ids, scores, quick test
    unknown_score: float
    byte_ids: list[int]
    spelled: list[bytes]


def load_pieces(path: str = MODEL) -> Pieces:
    """Read a model file. Pieces never hold a space mark after another character, so that words are independent."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    by_length, spelled, byte_ids = defaultdict(list), [], [0] * 256
    scores = [model.get_score(i) for i in range(len(model))]
    normal = []
    for i in range(len(model)):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            spelled.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i):
            spelled.append(b"")
        else:
            if re.search(f"[^{SPACE}]{SPACE}", piece):
                raise ValueError("a piece of this model goes past the end of a word")
            spelled.append(piece.replace(SPACE, " ").encode())
            by_length[len(piece)].append((piece, i))
            normal.append(scores[i])
    keys = {}
    for length, found in by_length.items():
        codes = _codes([p for p, _ in found], length)
        h = _prefix(codes)[:, -1]
        order = np.argsort(h)
        if len(np.unique(h)) != len(h):
            raise ValueError("two pieces have one hash")
        ids = np.array([i for _, i in found])[order]
        present = np.zeros(1 << 16, bool)
        present[h >> np.uint64(48)] = True
        keys[length] = (h[order], ids, np.array(scores)[ids], present)
    return Pieces(keys, min(normal) - UNKNOWN_PENALTY, byte_ids, spelled)


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, length)


def _prefix(codes: np.ndarray) -> np.ndarray:
    """Running polynomial hashes of each row, one more column than the row has characters."""
    out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(codes.shape[1]):
            out[:, i + 1] = out[:, i] * _STEP + codes[:, i]
    return out


def _probe(table: Pieces, codes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Piece lengths from long to short, and by length, word and place the id (or -1) and score of the piece there."""
    running, size = _prefix(codes), codes.shape[1]
    lengths = sorted({1, *(n for n in table.keys if n <= size)}, reverse=True)
    ids = np.full((len(lengths), *codes.shape), -1, np.int32)
    scores = np.full((len(lengths), *codes.shape), -np.inf)
    with np.errstate(over="ignore"):
        for k, length in enumerate(lengths):
            if length not in table.keys:
                continue
            hashes, own, score, present = table.keys[length]
            power = np.uint64(1)
            for _ in range(length):
                power *= _STEP
            h = running[:, length:] - running[:, :size + 1 - length] * power
            rows, at = np.nonzero(present[h >> np.uint64(48)])
            h = h[rows, at]
            found = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[found] == h
            rows, at, found = rows[hit], at[hit], found[hit]
            ids[k, rows, at] = own[found]
            scores[k, rows, at] = score[found]
    # an unknown character stands alone, and only where no piece of one character fits
    scores[-1][ids[-1] < 0] = table.unknown_score
    return lengths, ids, scores


def _unknown(table: Pieces, char: str) -> list[int]:
    return [table.byte_ids[b] for b in (SPACE if char == LITERAL else char).encode()]


def encode_words(table: Pieces, words: list[str]) -> list[list[int]]:
    """Ids of each word's best pieces: the largest sum of scores, of equal sums the one with the longest last piece.

    Words of one length advance together, one end position at a time.
    """
    out: list[list[int]] = [[]] * len(words)
    by_length = defaultdict(list)
    for i, w in enumerate(words):
        by_length[len(w)].append(i)
    for length, members in by_length.items():
        if length == 0:
            continue
        if length > LONG_WORD:
            for i in members:
                out[i] = _encode_long(table, words[i])
            continue
        for k in range(0, len(members), TOGETHER):
            some = members[k:k + TOGETHER]
            for i, ids in zip(some, _encode_together(table, [words[i] for i in some], length)):
                out[i] = ids
    return out


def _encode_together(table: Pieces, words: list[str], size: int) -> list[list[int]]:
    lengths, ids, scores = _probe(table, _codes(words, size))
    length_of = np.array(lengths)
    rows = np.arange(len(words))
    best = np.zeros((len(words), size + 1))
    back = np.zeros((len(words), size + 1), np.int64)
    piece = np.zeros((len(words), size + 1), np.int64)
    for end in range(1, size + 1):
        first = next(k for k, n in enumerate(lengths) if n <= end)
        begin = end - length_of[first:]
        k = np.arange(first, len(lengths))
        # of equal sums the first, so the longest last piece
        sums = scores[k, :, begin] + best[:, begin].T
        taken = sums.argmax(0)
        best[:, end] = sums[taken, rows]
        back[:, end] = begin[taken]
        piece[:, end] = ids[first + taken, rows, begin[taken]]
    steps, at = [], np.full(len(words), size)
    while at.any():
        steps.append(np.where(at > 0, piece[rows, at], -2))
        at = back[rows, at]
    out = []
    for row, word in zip(np.array(steps[::-1]).T.tolist(), words):
        found = [i for i in row if i != -2]
        if -1 in found:  # spell unknown characters; their places follow from the pieces before them
            place, spelled = 0, []
            for i in found:
                spelled += [i] if i >= 0 else _unknown(table, word[place])
                place += table_length(table, i)
            found = spelled
        out.append(found)
    return out


def table_length(table: Pieces, i: int) -> int:
    return 1 if i < 0 else len(table.spelled[i].decode())


def _encode_long(table: Pieces, word: str) -> list[int]:
    """One long word, looked at in windows, so that memory beyond a few bytes a character is bounded."""
    size, longest = len(word), max(table.keys)
    best, back, chosen = array("d", [-np.inf]) * (size + 1), array("i", [0]) * (size + 1), array("i", [0]) * (size + 1)
    best[0] = 0.0
    for start in range(0, size, WINDOW):
        first, stop = max(0, start - longest + 1), min(size, start + WINDOW)
        lengths, all_ids, all_scores = _probe(table, _codes([word[first:stop]], stop - first))
        found = [(n, all_ids[k, 0].tolist(), all_scores[k, 0].tolist()) for k, n in enumerate(lengths)]
        for end in range(start + 1, stop + 1):
            for length, ids, scores in found:
                begin = end - length
                if begin >= first:
                    score = best[begin] + scores[begin - first]
                    if score > best[end]:
                        best[end], back[end], chosen[end] = score, length, ids[begin - first]
    out, end = [], size
    while end > 0:
        i = chosen[end]
        out.append([i] if i >= 0 else _unknown(table, word[end - back[end]]))
        end -= back[end]
    return [i for part in reversed(out) for i in part]


def words_of(text: str) -> list[str]:
    """The text with space marks, cut before each run of them. A text begins with an extra space mark."""
    if not text:
        return []
    return WORD.findall(SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE))


class Codec:
    """Encodes and decodes texts; remembers the pieces of words, up to a bound."""

    def __init__(self, table: Pieces):
        self.table, self.known = table, {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        words = [words_of(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = [w for w in set(chain.from_iterable(words)) if w not in self.known]
        # ids are kept as bytes: joining them makes no object for each id
        self.known.update((w, np.array(ids, np.int32).tobytes()) for w, ids in zip(new, encode_words(self.table, new)))
        look = self.known.__getitem__
        return [np.frombuffer(b"".join(map(look, w)), np.int32) for w in words]

    def decode(self, ids) -> str:
        """The text of ids: pieces one after another without the first space. Broken byte runs become U+FFFD."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join(map(self.table.spelled.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """One row per document: doc_id, n_tokens, token_ids, roundtrip (the ids decode to the very text).

    The ids are those of the best sum of piece scores in the model file, with UTF-8 bytes for
    characters that no piece holds. Every text survives the round trip, also one that holds the
    space mark itself. Null counts as empty, and an empty text has no ids; repeated rows get equal
    ids; an empty table gives no rows; other columns are ignored. Very long texts and words are
    encoded whole.
    """
    table = load_pieces(path)

    def rows(batches):
        codec = Codec(table)
        for batch in batches:
            for part in pieces(batch, limit=1_000_000):
                texts = strings(part.column("text"))
                ids = codec.encode(texts)
                same = [codec.decode(x) == t for x, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                     _lists(ids), pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "token_ids", "roundtrip"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(rows, SCHEMA)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and text of rows with doc_id and token_ids. Null ids decode to the empty text."""
    table = load_pieces(path)

    def rows(batches):
        codec = Codec(table)
        for batch in batches:
            text = [codec.decode(x or []) for x in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr("cast(doc_id as long) doc_id", "token_ids").mapInArrow(rows, "doc_id long, text string")
