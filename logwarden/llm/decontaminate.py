"""Benchmark decontamination by q-gram lemma filtering and banded alignment."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from logwarden.llm.common import mix, pieces, strings

#: Length of the q-grams (a power of two), edits allowed per character of a segment.
Q, EDIT_SHARE = 8, 0.08

#: Benchmark items are cut into segments of this many normalised characters, one every STRIDE. So a
#: verbatim excerpt of SEGMENT + STRIDE - 1 characters holds a whole segment wherever it begins.
SEGMENT, STRIDE = 40, 10

#: An item shorter than this many normalised characters must lie in the text as it is, between word edges.
SHORTEST = 24

#: Pairs of equal q-grams, windows of a text, and segments to align that are looked at at once.
PAIRS, WINDOWS, ALIGNED = 250_000, 200_000, 10_000

#: Benchmark characters that one pass over the documents holds; a larger benchmark takes several passes.
BLOCK_CHARS = 2_000_000

SCHEMA = "doc_id long, item_id long, start int, stop int, n_segments int, distance int"


def _plain_table() -> np.ndarray:
    """Code point to lower-case letter or digit, everything else to a space."""
    table = np.full(1 << 16, 32, np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


_TABLE: list[np.ndarray] = []


def normalized(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters and digits with single spaces between them, and the place of each in the text."""
    if not _TABLE:
        _TABLE.append(_plain_table())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = np.where(codes < 1 << 16, _TABLE[0][np.minimum(codes, (1 << 16) - 1)], codes)
    gap = plain == 32
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1]
    at = np.flatnonzero(keep)
    return plain[at], at


def qgrams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q characters from every place on, by doubling."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    h, step, width = codes.astype(np.uint64), np.uint64(0x100000001B3), 1
    with np.errstate(over="ignore"):
        while width < Q:
            h = h[:-width] * step + h[width:]
            step, width = step * step, width * 2
        return mix(h)


@dataclass
class Index:
    """Segments of benchmark items and their q-grams, sorted by hash."""

    items: np.ndarray      # item of each segment
    codes: list[np.ndarray]
    length: np.ndarray
    budget: np.ndarray     # edits allowed
    needed: np.ndarray     # q-grams that a region within the budget shares at least
    hashes: np.ndarray
    first: np.ndarray      # range of postings of each hash
    last: np.ndarray
    segment: np.ndarray    # postings
    place: np.ndarray
    present: np.ndarray    # quick test by the top bits of a hash
    brief: dict[int, dict[bytes, list[int]]]  # by length: short items by their characters


def build_index(items: list[tuple[int, str]]) -> Index:
    owner, codes = [], []
    brief: dict[int, dict[bytes, list[int]]] = defaultdict(lambda: defaultdict(list))
    for item, text in items:
        plain, _ = normalized(text or "")
        plain = plain[1:] if len(plain) and plain[0] == 32 else plain
        plain = plain[:-1] if len(plain) and plain[-1] == 32 else plain
        if len(plain) < SHORTEST:
            if len(plain):
                brief[len(plain)][plain.tobytes()].append(item)
            continue
        starts = list(range(0, max(1, len(plain) - SEGMENT + 1), STRIDE))
        if starts[-1] + SEGMENT < len(plain):
            starts.append(len(plain) - SEGMENT)
        for s in starts:
            owner.append(item)
            codes.append(plain[s:s + SEGMENT])
    lengths = np.array([len(c) for c in codes], np.int64)
    budget = (lengths * EDIT_SHARE).astype(np.int64)
    needed = lengths - Q + 1 - budget * Q
    while (short := needed < 1).any():  # a budget that the lemma cannot bound is lowered until it can
        budget[short] -= 1
        needed = lengths - Q + 1 - budget * Q
    grams = [qgrams(c) for c in codes]
    hashes = np.concatenate([np.zeros(0, np.uint64), *grams])
    segment = np.repeat(np.arange(len(codes)), [len(g) for g in grams])
    place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]])
    order = np.argsort(hashes, kind="stable")
    unique, first, count = np.unique(hashes[order], return_index=True, return_counts=True)
    present = np.zeros(1 << 22, bool)
    present[unique >> np.uint64(42)] = True
    return Index(np.array(owner), codes, lengths, budget, needed, unique, first, first + count,
                 segment[order], place[order], present, {n: dict(found) for n, found in brief.items()})


def candidates(index: Index, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments and first diagonals of bands that share enough q-grams with the text.

    A region within k edits of a segment keeps to k + 1 neighbouring diagonals and shares at
    least |segment| - Q + 1 - kQ q-grams with it (the q-gram lemma). Bands of 2(k + 1) diagonals
    that begin every k + 1 contain each such run of diagonals whole.
    """
    h = qgrams(codes)
    at = np.flatnonzero(index.present[h >> np.uint64(42)]) if len(h) else np.zeros(0, np.int64)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.minimum(np.searchsorted(index.hashes, h[at]), len(index.hashes) - 1)
    same = index.hashes[found] == h[at]
    at, found = at[same], found[same]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    many = index.last[found] - index.first[found]
    wide = len(codes) + 3 * SEGMENT
    parts = []
    turn = many.cumsum() // PAIRS  # bounded memory also where one q-gram fills text and segment
    for some in np.split(np.arange(len(at)), np.flatnonzero(np.diff(turn)) + 1):
        n, first = many[some], index.first[found[some]]
        posting = np.repeat(first - np.concatenate(([0], n.cumsum()[:-1])), n) + np.arange(n.sum())
        segment = index.segment[posting]
        diagonal = np.repeat(at[some], n) - index.place[posting]
        band = np.floor_divide(diagonal, index.budget[segment] + 1) + SEGMENT
        parts.append(np.unique(segment * wide + band, return_counts=True))
    keys, counts = parts[0]
    if len(parts) > 1:
        keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([c for _, c in parts])).astype(np.int64)
    # a band begins in the step of its first q-gram and takes in the next step
    after = np.minimum(np.searchsorted(keys, keys + 1), len(keys) - 1)
    together = counts + np.where(keys[after] == keys + 1, counts[after], 0)
    segment = keys // wide
    kept = together >= index.needed[segment]
    segment, band = segment[kept], keys[kept] % wide - SEGMENT
    return segment, band * (index.budget[segment] + 1)


def aligned_together(segments: np.ndarray, codes: np.ndarray, diagonals: np.ndarray, budget: int) -> tuple[np.ndarray, ...]:
    """Least edits between segments (rows of one length) and any stretch of the text within their bands.

    Columns are the 2(k + 1) diagonals of a band and k more on either side, so that a path whose
    edits leave the counted diagonals stays inside. All segments are aligned together, a character
    at a time. Returns edits, begin and end of the stretch; edits beyond the budget mean nothing.
    """
    length, width = segments.shape[1], 2 * (budget + 1) + 2 * budget
    columns, outside = np.arange(width, dtype=np.int32), np.int32(1 << 20)
    low = (diagonals - budget).astype(np.int32)[:, None]
    front = max(0, -int(low.min()))
    padded = np.full(front + max(len(codes), int(low.max()) + length + width) + 1, 1 << 21, np.int32)
    padded[front:front + len(codes)] = codes
    segments, base = segments.astype(np.int32), front + low + columns
    cost, origin = np.zeros(base.shape, np.int32), low + columns
    missing = np.full((len(segments), 1), outside, np.int32)
    for i in range(length):
        new = cost + (padded[base + i] != segments[:, i:i + 1])
        dropped = np.concatenate((cost[:, 1:] + 1, missing), axis=1)  # a character of the segment is missing in the text
        better = dropped < new
        new = np.where(better, dropped, new)
        come = np.where(better, np.concatenate((origin[:, 1:], missing), axis=1), origin)
        lead = new - columns  # an extra character in the text: each column from the best one to its left
        best = np.minimum.accumulate(lead, axis=1)
        source = np.maximum.accumulate(np.where(lead == best, columns, 0), axis=1)
        cost, origin = best + columns, np.take_along_axis(come, source, axis=1)
    rows = np.arange(len(segments))
    j = cost.argmin(axis=1)
    begin = np.maximum(origin[rows, j], 0)
    return cost[rows, j], begin, np.minimum(length + low[:, 0] + j, len(codes))


def aligned(segment: np.ndarray, codes: np.ndarray, diagonal: int, budget: int) -> tuple[int, int, int] | None:
    """One segment and band; None beyond the budget."""
    edits, begin, end = (int(x[0]) for x in aligned_together(segment[None, :], codes, np.array([diagonal]), budget))
    return (edits, begin, end) if edits <= budget else None


def short_matches(index: Index, codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, begin, end) of short items that lie between word edges of the normalised text."""
    if not index.brief:
        return []
    edge = np.concatenate(([True], codes == 32, [True]))  # what stands before each place, and after the last
    begins, out = np.flatnonzero(edge[:-1][:len(codes)] & (codes != 32)), []
    for length, items in index.brief.items():
        some = begins[begins + length <= len(codes)]
        some = some[edge[some + length + 1]]
        for k in range(0, len(some), WINDOWS):
            at = some[k:k + WINDOWS]
            windows = codes[at[:, None] + np.arange(length)]
            # a window is read as one value, so that the few that equal an item are found together
            whole = np.ascontiguousarray(windows).view(np.dtype((np.void, windows.itemsize * length))).ravel()
            hit = np.isin(whole, np.array([np.frombuffer(i, np.dtype((np.void, len(i))))[0] for i in items]))
            for begin, value in zip(at[hit].tolist(), whole[hit]):
                out += [(item, begin, begin + length) for item in items[value.tobytes()]]
    return out


def matches(index: Index, text: str) -> list[tuple[int, int, int, int, int]]:
    """(item, start, stop, segments, least distance) for every item that has a segment in the text."""
    codes, at = normalized(text)
    found: dict[int, tuple[int, int, set, int]] = {}

    def add(item: int, segment: int, distance: int, begin: int, end: int):
        start, stop = int(at[begin]), int(at[end - 1]) + 1
        old = found.get(item, (start, stop, set(), distance))
        found[item] = (min(old[0], start), max(old[1], stop), old[2] | {segment}, min(old[3], distance))

    segments, diagonals = candidates(index, codes)
    for length in np.unique(index.length[segments]):
        alike = np.flatnonzero(index.length[segments] == length)
        for k in range(0, len(alike), ALIGNED):
            some = alike[k:k + ALIGNED]
            s, budget = segments[some], int(index.budget[segments[some[0]]])
            edits, begin, end = aligned_together(np.array([index.codes[i] for i in s]), codes, diagonals[some], budget)
            for i in np.flatnonzero((edits <= budget) & (end > begin)):
                add(int(index.items[s[i]]), int(s[i]), int(edits[i]), int(begin[i]), int(end[i]))
    for item, begin, end in short_matches(index, codes):
        add(item, -1, 0, begin, end)
    return sorted((i, b, e, len(n), d) for i, (b, e, n, d) in found.items())


class Block:
    """Items of a part of the benchmark, sent to the executors once; a worker makes its index when it first needs it."""

    held: dict[str, Index] = {}

    def __init__(self, items: Broadcast):
        self.items, self.name = items, uuid.uuid4().hex

    def index(self) -> Index:
        if self.name not in Block.held:
            Block.held.clear()  # a worker holds one index at a time
            Block.held[self.name] = build_index(self.items.value)
        return Block.held[self.name]


def _blocks(benchmark: DataFrame) -> list[Block]:
    """The benchmark in blocks of bounded size, of which the driver holds one at a time.

    An item is text; null texts and ids are left out.
    """
    context = benchmark.sparkSession.sparkContext
    blocks, held, size = [], [], 0
    for row in benchmark.select("item_id", "text").where("item_id is not null and text is not null").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size > BLOCK_CHARS:
            blocks.append(Block(context.broadcast(held)))
            held, size = [], 0
    return [*blocks, Block(context.broadcast(held))] if held else blocks


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, start, stop, n_segments, distance.

    Found means: a segment of SEGMENT characters of the item (the whole item if it is shorter)
    lies in the document with at most EDIT_SHARE edits a character, after lower-casing and with
    anything but letters and digits as one space. An item shorter than SHORTEST characters must
    stand there as it is, between word edges. start and stop span the found segments in code
    points of the document's own text. Clean documents have no row. Null and empty texts, items
    without a letter or digit and empty tables give no rows; repeated rows give repeated
    rows; other columns are ignored. The documents are read once for every BLOCK_CHARS characters
    of benchmark; nothing is shuffled.
    """
    def scan(block: Block) -> Callable:
        def rows(batches):
            index = block.index()
            for batch in batches:
                for part in pieces(batch):
                    out = [(doc, *match) for doc, text in zip(part.column("doc_id").to_pylist(), strings(part.column("text")))
                           for match in matches(index, text)]
                    if out:
                        doc, item, start, stop, n, distance = zip(*out)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc, pa.int64()), pa.array(item, pa.int64()),
                             *(pa.array(x, pa.int32()) for x in (start, stop, n, distance))],
                            ["doc_id", "item_id", "start", "stop", "n_segments", "distance"])
        return rows

    read = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    found = [read.mapInArrow(scan(block), SCHEMA) for block in _blocks(benchmark)]
    if not found:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with their own columns; one narrow pass for each block.

    Documents with a null or empty text stay, as do repeated rows; an empty benchmark drops nothing.
    """
    def keep(block: Block) -> Callable:
        def rows(batches):
            index = block.index()
            for batch in batches:
                for part in pieces(batch):
                    yield part.filter(pa.array([not matches(index, t) for t in strings(part.column("text"))], pa.bool_()))
        return rows

    for block in _blocks(benchmark):
        docs = docs.mapInArrow(keep(block), docs.schema)
    return docs
