"""What the operators of this package share: inputs, Arrow text buffers, bounded label samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a batch are worked on in pieces of about this many text bytes.
PIECE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(frame: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as no column of the frame has."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` text bytes; a longer text is a slice of its own."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    part = np.cumsum(sizes.to_numpy(zero_copy_only=False)) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for begin, end in zip(edges[:-1], edges[1:]):
        yield batch.slice(begin, end - begin)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and the n + 1 offsets into them; null counts as empty."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    return raw, at - at[0]


def strings(texts: pa.Array) -> list[str]:
    return [t or "" for t in texts.to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Ids that a join may broadcast, by a count made first; more are shuffled.
BROADCAST_IDS = 2_000_000


def usable_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of all ids that may be learnt from.

    Rows without id or label and ids with two different labels are left out.
    """
    return (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other").select("doc_id", "label")
    )


def label_sample(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """At most about ``bound`` of the usable labels, chosen by a hash of the id.

    One rule at every size: an id is taken if its hash lies in the lowest ``bound / rows`` of the range.
    """
    usable = usable_labels(labels, label)
    rows = usable.count()
    share = min(1.0, bound / max(rows, 1))
    return usable.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) < int(share * (1 << 30)))


def sampled_texts(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """Text and label of the sampled rows. The sample is bounded, so its ids may be broadcast."""
    sample = label_sample(labels, label, bound)
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")
