"""Near-duplicate removal by MinHash: banding, verification on full sets, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import mix, pieces, unused, utf8
from logwarden.llm.components import components
from logwarden.llm.quality import _SPACE, word_keys
from logwarden.operators.durable import durable

#: Minima per document; rows of a band by similarity in percent. 20 bands of 5 miss a pair of
#: similarity 0.85 once in 120,000 times, 25 bands of 4 a pair of similarity 0.8 once in 500,000.
HASHES = 100

#: One task takes this many different texts, or this many shingles, of one group at once.
MEMBERS, SHINGLES = 512, 1_000_000

SKETCH = "doc_id long, key_a long, key_b long, n_shingles long, bands array<long>"

_RANDOM = np.random.default_rng(20_250_101)
_FACTOR = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64)


def band_rows(percent: int) -> int:
    return 5 if percent >= 85 else 4


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted different shingle keys of each whole text, A-Z lower-cased; no word, no shingle.

    A text with fewer words than a shingle has one shingle, its whole sequence.
    """
    raw, at = utf8(texts)
    raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw).astype(np.uint8)
    filled = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    first, last = filled.copy(), filled.copy()
    first[1:] &= ~filled[:-1] | edge[1:-1]
    last[:-1] &= ~filled[1:] | edge[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    keys = word_keys(raw, begin, end)
    bounds = np.searchsorted(begin, at)
    joined = {}
    with np.errstate(over="ignore"):
        chain = np.full(len(keys), np.uint64(0x2545F4914F6CDD1D))
        for n in range(1, words + 1):  # joined[n][i]: key of words i .. i + n - 1
            chain = mix(chain[:len(keys) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + keys[n - 1:] + np.uint64(n)) \
                if len(keys) >= n else keys[:0]
            joined[n] = chain
    out = []
    for i in range(len(texts)):
        a, b = bounds[i], bounds[i + 1]
        n = b - a
        out.append(keys[:0] if n == 0 else np.unique(joined[words][a:b - words + 1]) if n >= words
                   else joined[n][a:a + 1])
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each universal hash over the set."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(shingles), 2048):
            some = shingles[None, k:k + 2048] * _FACTOR[:, None]
            some += _SHIFT[:, None]
            np.minimum(best, some.min(1), out=best)
    return best


def bands_of(shingles: np.ndarray, rows: int) -> np.ndarray:
    low = minima(shingles).reshape(-1, rows)
    with np.errstate(over="ignore"):
        key = np.arange(1, len(low) + 1, dtype=np.uint64)
        for j in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, j])
    return key.view(np.int64)


def sketch(docs: DataFrame, words: int, rows: int) -> DataFrame:
    """doc_id, a 128-bit key of the shingle set, its size, and its band keys."""
    def made(batches):
        for batch in batches:
            for part in pieces(batch):
                sets = shingle_sets(part.column("text"), words)
                with np.errstate(over="ignore"):
                    a = np.array([mix(s + np.uint64(1)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    b = np.array([mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                bands = [bands_of(s, rows) if len(s) else np.zeros(0, np.int64) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(a), pa.array(b), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "key_a", "key_b", "n_shingles", "bands"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(made, SKETCH)


def links_among(ids: np.ndarray, sets: list[np.ndarray], percent: int, asked: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets, each confirmed on the full sets.

    Every set that is asked for (all of them by default) is compared with every other one.
    """
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.concatenate(([0], sizes.cumsum()))
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    mark = np.zeros(len(values), np.int64)
    out = []
    for i in range(len(sets)) if asked is None else asked:
        own = code[start[i]:start[i + 1]]
        mark[own] = 1
        common = np.add.reduceat(mark[code], start[:-1])
        mark[own] = 0
        linked = np.flatnonzero(100 * common >= percent * (sizes[i] + sizes - common))
        for j in linked.tolist():
            x, y = find(i), find(j)
            if x != y:
                root[x] = y
                out.append((int(ids[i]), int(ids[j])))
    return out


def _edges(percent: int):
    """Links of one group of rows (rep, shingles, and optionally whether the row is asked for)."""
    def made(group: pa.Table) -> pa.Table:
        sets = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
        ids = group.column("rep").to_numpy()
        asked = None
        if "asked" in group.column_names:
            asked = np.flatnonzero(group.column("asked").to_numpy(zero_copy_only=False))
        found = links_among(ids, sets, percent, asked)
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return made


EDGE = "a long, b long"

#: Ids are broadcast to the documents up to this many (16 bytes each); beyond it texts are shuffled by id.
BROADCAST_IDS = 2_000_000


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * |intersection| >= percent * |union| of their sets of shingles of
    ``words`` words; component_id is the least doc_id reachable over links, and that document is
    kept. A document without words is linked with nothing; neither is a row without doc_id, whose
    component is null and which is kept. Rows with one doc_id are one node. Repeated rows and ties
    need no rule beyond the least doc_id. An empty table gives no rows; other columns are ignored.

    Equal sets are one class, so copies never meet in pairs. Classes that share a band form
    clusters. A cluster is verified in one task if it is small; the buckets of a larger one are cut
    into random chunks, verified chunk by chunk, and then the members of a bucket that are still
    in different components are compared across chunks. So every pair of classes that shares a
    band is either confirmed on full sets or already in one component.
    """
    rows = band_rows(percent)
    read = durable(sketch(docs, words, rows), "near-sketch")
    named = read.where("n_shingles > 0 and doc_id is not null")
    key = ["key_a", "key_b", "n_shingles"]
    classes = durable(named.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "near-classes")
    member = classes.select("rep", "n_shingles", F.explode("bands").alias("band"))
    shared = member.groupBy("band").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    clusters = components(member.join(shared, "band").select(F.col("rep").alias("a"), F.col("least").alias("b")))
    members = _clustered(classes, clusters)
    sized = durable(members.join(_sizes(members), "cluster").withColumn("large", _large()), "near-members")
    sets = durable(_with_sets(docs, sized.select("rep", "cluster", "large"), words), "near-sets")
    found = sets.where("not large").groupBy("cluster").applyInArrow(_edges(percent), EDGE)
    chunks = _chunks(sized.where("large"))
    if not sized.where("large").isEmpty():
        chunks = durable(chunks, "near-chunks")
        dealt = chunks.join(sets.where("large").select("rep", "shingles"), "rep")
        found = found.unionByName(dealt.groupBy("band", "chunk").applyInArrow(_edges(percent), EDGE))
    found = durable(found, "near-links")
    found = _across_chunks(chunks.where("chunks > 1"), sets, found, percent)
    roots = components(found).select(F.col("node").alias("rep"), "root")
    of_class = classes.join(roots, "rep", "left").select(*key, F.coalesce("root", "rep").alias("root"))
    full = read.drop("bands").join(of_class, key, "left")
    # a row without id is in no class of its own, though its key may be
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return full.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))


def _clustered(classes: DataFrame, clusters: DataFrame) -> DataFrame:
    """Members of clusters: rep, n_shingles, bands, cluster."""
    inside = clusters.select(F.col("node").alias("rep"), F.col("root").alias("cluster")).unionByName(
        clusters.select(F.col("root").alias("rep"), F.col("root").alias("cluster")).distinct())
    return classes.select("rep", "n_shingles", "bands").join(inside, "rep")


def _with_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The wanted reps with their shingles, computed again from the text of the document."""
    def made(batches):
        for batch in batches:
            for part in pieces(batch):
                sets = shingle_sets(part.column("text"), words)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in part.schema.names if c != "text"),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    [*(c for c in part.schema.names if c != "text"), "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    few = wanted.count() <= BROADCAST_IDS
    joined = texts.join(F.broadcast(wanted) if few else wanted.hint("shuffle_hash"), "rep").select(*wanted.columns, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema.fields)
    return joined.mapInArrow(made, f"{schema}, shingles binary")


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("total"))


def _large() -> Column:
    return (F.col("members") > MEMBERS) | (F.col("total") > SHINGLES)


def _chunks(large: DataFrame) -> DataFrame:
    """Members of each bucket of the large clusters, dealt at random into chunks of bounded size."""
    member = large.select("rep", "n_shingles", F.explode("bands").alias("band"))
    size = member.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total")).where("n > 1")
    count = F.greatest(F.ceil(F.col("n") / (MEMBERS // 2)), F.ceil(F.col("total") / (SHINGLES // 2)))
    return member.join(size.select("band", count.alias("chunks")), "band").withColumn(
        "chunk", F.pmod(F.xxhash64("rep", "band"), F.col("chunks")))


def _across_chunks(chunks: DataFrame, sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket that lie in different chunks and, so far, in different components.

    The members outside the commonest component of a bucket are asked for in every chunk of it,
    in bounded sets; so no pair of components that meet in a bucket is left out.
    """
    if chunks.isEmpty():
        return found
    roots = components(found).select(F.col("node").alias("rep"), "root")
    placed = durable(chunks.join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep")), "near-placed")
    weight = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    main = weight.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    mixed = durable(placed.join(main.where("roots > 1"), "band"), "near-mixed")
    if mixed.isEmpty():
        return found
    strays = mixed.where("root <> main")
    parts = strays.groupBy("band").agg(
        F.ceil(F.count(F.lit(1)) / (MEMBERS // 2)).alias("by_count"), F.ceil(F.sum("n_shingles") / (SHINGLES // 2)).alias("by_size"))
    parts = parts.select("band", F.greatest("by_count", "by_size").alias("parts"))
    base = mixed.join(parts, "band").select(
        "rep", "band", "chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("asked"))
    asked = strays.join(parts, "band").select(
        "rep", "band", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("band", "rep", F.lit(3)), F.col("parts")).alias("part"), F.lit(True).alias("asked"))
    grouped = base.unionByName(asked).join(
        sets.where("large").select("rep", "shingles"), "rep").groupBy("band", "chunk", "part")
    return durable(found.unionByName(grouped.applyInArrow(_edges(percent), EDGE)), "near-links")


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, the one with the least doc_id, with its own columns of any name.

    Rows with one doc_id are one document: all of them go if it does.
    """
    gone_id = unused(docs, "_gone_id")
    gone = near_duplicates(docs, words, percent).where("not kept").select(F.col("doc_id").alias(gone_id)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(gone_id), "left_anti")
