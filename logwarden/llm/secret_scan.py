"""Secret scans with multipart credential linking, in DataFrame operations only.

Strong spans (assign, access, hex) stand by themselves. Weak candidates - an account name, a bare
key-like string, an endpoint - are noise alone; they are reported only where the complementary
parts of a credential lie within reach in the same document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.operators.durable import durable

#: Parts of one credential lie at most this many code points apart.
REACH = 200

QUOTED_VALUE = r"""["']?\x20*[:=]\x20*["']?"""

#: kind, pattern, group whose length counts, its least length. Order is the order of kinds.
STRONG = [
    ("assign", r"(?i:(password|passwd|secret|token|api_?key))" + QUOTED_VALUE + r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
WEAK = [
    ("ident", r"(?i:(user_?name|user|login|account|client_?id|access_?key_?id))" + QUOTED_VALUE
     + r"([A-Za-z0-9@._+-]+)", 2, 4),
    ("bare", r"[A-Za-z0-9+/]{40,}={0,2}", 0, 40),
    ("endpoint", r"(?i:(https?|jdbc:[a-z]+|ftp|s3a?|amqps?|mongodb|redis))://([A-Za-z0-9._~:/?#@$&*+,;=%-]+)", 2, 4),
]
KINDS = [kind for kind, *_ in STRONG + WEAK]

#: What a part is to a credential.
ROLE = {"access": "identifier", "ident": "identifier", "assign": "secret", "hex": "secret", "bare": "secret",
        "endpoint": "endpoint"}

SPAN = "array<struct<start:int,rank:int,stop:int>>"


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _fold(lengths: Column, kind: str, least: int) -> Column:
    """Spans of some matches, counted from the first piece, and how far they reach."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(seen: Column, x: Column) -> Column:
        begin = seen["at"] + x["gap"]
        end = begin + x["long"]
        one = F.array(F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("stop")))
        return F.struct(end.alias("at"), F.when(x["counted"] >= least, F.concat(seen["out"], one))
                        .otherwise(seen["out"]).alias("out"))

    return F.aggregate(lengths, start, step)


def _moved(parts: Column, by: Column) -> Column:
    return F.transform(parts, lambda s: F.struct(
        (s["start"] + by).alias("start"), s["rank"].alias("rank"), (s["stop"] + by).alias("stop")))


def spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches of a pattern, leftmost and not overlapping, as (start, rank of the kind, end) in code points.

    The pieces between the matches give the positions: each match starts after all earlier pieces
    and matches. Matches whose counted group is too short are dropped, after they took their place.
    A fold copies what it has found at every step, so n matches are folded in stretches of about
    the square root of n, which are then moved to their places.
    """
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    lengths = F.arrays_zip(
        F.transform(F.slice(pieces, 1, F.size(found)), F.length).alias("gap"),
        F.transform(found, F.length).alias("long"), F.transform(counted, F.length).alias("counted"))

    def stretched(x: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(x))).cast("int")
        first = F.sequence(F.lit(1), F.size(x), width)
        folded = F.transform(first, lambda at: _fold(F.slice(x, at, width), kind, least))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        placed = F.aggregate(folded, start, lambda seen, part: F.struct(
            (seen["at"] + part["at"]).alias("at"),
            F.concat(seen["out"], F.array(_moved(part["out"], seen["at"]))).alias("out")))
        return F.flatten(placed["out"])

    return F.when(text.rlike(pattern), _bound(lengths, stretched)).otherwise(F.array().cast(SPAN))


def _joined(parts: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(parts), lambda p: F.concat_ws(
        ":", F.element_at(names, p["rank"] + 1), p["start"].cast("string"), p["stop"].cast("string"))), ",")


def linked_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak parts (key, start, rank, stop) whose complementary parts lie within reach: doc_key and found.

    An interval join on bins wider than the reach by one, so that a part at the reach itself lies one
    bin away at most. A part need only know the last end and the first start of each role in its own
    bin and the two beside it, so bins are summed up before the join: three rows a weak part at
    most, however many parts a document has.
    """
    wide = reach + 1
    roles = F.create_map(*[F.lit(x) for k in KINDS for x in (KINDS.index(k), ROLE[k])])
    parts = parts.withColumn("role", roles[F.col("rank")]).withColumn("bin", F.floor(F.col("start") / wide))
    # A part is in every bin that it touches, so that its end is seen from the bin after its last one.
    last = F.greatest(F.col("bin"), F.floor((F.col("stop") - 1) / wide))
    bins = parts.withColumn("bin", F.explode(F.sequence("bin", last))).groupBy("doc_key", "bin").agg(*[
        f(F.when(F.col("role") == role, F.col(c))).alias(f"{role}_{c}")
        for role in ("identifier", "secret") for f, c in ((F.min, "start"), (F.max, "stop"))])
    weak = parts.where(F.col("rank") >= len(STRONG)).withColumn(
        "near", F.explode(F.sequence(F.col("bin") - 1, last + 1)))
    near = weak.join(bins.withColumnRenamed("bin", "near"), ["doc_key", "near"])

    def within(role: str) -> Column:
        inside = F.col("near").between(F.col("bin"), last)
        before = F.col("start") - F.col(f"{role}_stop") <= reach
        after = F.col(f"{role}_start") - F.col("stop") <= reach
        seen = F.when(F.col("near") < F.col("bin"), before).when(F.col("near") > last, after).otherwise(
            inside & F.col(f"{role}_start").isNotNull())
        return F.max(F.coalesce(seen, F.lit(False))).alias(role)

    both = near.groupBy("doc_key", "start", "rank", "stop", "role").agg(within("identifier"), within("secret"))
    complete = (
        F.when(F.col("role") == "identifier", F.col("secret"))
        .when(F.col("role") == "secret", F.col("identifier"))
        .otherwise(F.col("identifier") & F.col("secret")))
    return both.where(complete).groupBy("doc_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "stop"))).alias("linked"))


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: doc_id, base and linked span arrays (start, rank of the kind, end).

    Null counts as empty; a document without matches has empty arrays. Repeated rows each get
    their spans. The parts of a document are found within its row; only they are shuffled, for
    the join, never the text. An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        F.col("doc_id").alias("doc_id"), F.sha2(text, 256).alias("doc_key"),
        F.concat(*[spans(text, *rule) for rule in STRONG]).alias("base"),
        F.concat(*[spans(text, *rule) for rule in WEAK]).alias("weak"))
    found = durable(found, "secret-parts")
    parts = found.where(F.size("weak") > 0).dropDuplicates(["doc_key"]).select(
        "doc_key", F.explode(F.concat("base", "weak")).alias("p")).select("doc_key", "p.*")
    return found.join(linked_parts(parts, reach), "doc_key", "left").select(
        "doc_id", "base", F.coalesce("linked", F.array().cast(SPAN)).alias("linked"))


def digest_columns(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans as text."""
    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda p: p["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{kind}") for rank, (kind, *_) in enumerate(STRONG)]
    return scanned.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "linked")).alias("spans"), F.size("linked").cast("long").alias("n_linked"))
