"""Behavioural features of addresses too busy for one task.

A hot address is cut into blocks of ``hot_rows`` to twice as many requests, and (address, block)
takes the place of the address as the unit of work. Cuts follow the rows, not the clock: hours
that a cut falls into are counted by seconds, and seconds that alone exceed a block by instants.

* Comparisons with the previous or next request get *boundary rows*: the last (first) row of each
  group is also sent to the next (previous) block in which the group occurs.
* A trailing total is what has arrived less what has expired. A request that expires in its own
  block needs nothing more; one that expires in a later block is sent there as a narrow copy,
  summed up by instant. What arrived or expired in earlier blocks is one small row per block.

The result is exact for any cuts. Requests of one instant share a block, however many they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.functions.timekeys import MICROS
from logwarden.operators.durable import durable

# Stands for the missing address, whose requests form one group as in any window.
NULL_ADDRESS = "\u0000"

# Trailing totals: frame width, what a request adds, what it takes along when it expires.
TOTALS = {
    "_n60": (V.MINUTE_SECONDS, "_one", "_one"),
    "_n300": (V.FIVE_MINUTES_SECONDS, "_one", "_one"),
    "_n1800": (V.HALF_HOUR_SECONDS, "_one", "_one"),
    "_post300": (V.FIVE_MINUTES_SECONDS, "_post", "_post"),
    "_err300": (V.FIVE_MINUTES_SECONDS, "_err", "_err"),
    "_susp1800": (V.HALF_HOUR_SECONDS, "_susp", "_susp"),
    "_size3600": (V.HOUR_SECONDS, "_size", "_size"),
    "_sized3600": (V.HOUR_SECONDS, "_sized", "_sized"),
    "_urls3600": (V.HOUR_SECONDS, "_opens", "_closes"),
}
WIDTHS = sorted({seconds for seconds, _, _ in TOTALS.values()})
# Cuts are looked up by the hour; no frame reaches beyond the next one.
SLOT = V.HOUR_SECONDS * MICROS


def trailing_total(ordered: WindowSpec, seconds: int, entering: str, leaving: str) -> Column:
    """Sum over the last ``seconds``, by two frames that only ever grow."""
    so_far = ordered.rangeBetween(W.unboundedPreceding, W.currentRow)
    expired = ordered.rangeBetween(W.unboundedPreceding, -seconds * MICROS - 1)
    return F.sum(entering).over(so_far) - F.coalesce(F.sum(leaving).over(expired), F.lit(0))


def find_hot_addresses(clean: DataFrame, hot_rows: int) -> DataFrame | None:
    """Addresses (``_key``) with more than ``hot_rows`` rows.

    The pass reads the address column alone and usually finds nothing. There are at most
    rows / hot_rows of them; they are written, so that joins with them go by their true size.
    """
    key = F.coalesce(F.col("ip_address"), F.lit(NULL_ADDRESS)).alias("_key")
    counts = clean.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    names = durable(counts.filter(F.col("n") > hot_rows).select("_key"), "hot-names")
    return None if names.isEmpty() else names


def hot_features(
    rows: DataFrame, names: DataFrame, hot_rows: int, run_flags: Callable[..., DataFrame]
) -> DataFrame:
    """Rows of the hot addresses with flags, trailing totals and gap variance."""
    hot = rows.join(names, "_key")
    # The cuts read the times up to three times; the log is read and parsed for them once.
    times = durable(hot.select("_key", "_at"), "hot-times")
    cuts = durable(block_cuts(times, hot_rows), "hot-cuts")
    # Five narrow passes read the placed rows, so they are placed once.
    placed = durable(in_blocks(hot, cuts), "hot-rows")
    flagged = durable(_flagged(placed, run_flags), "hot")
    return _trailing_totals(flagged)


def block_cuts(times: DataFrame, hot_rows: int) -> DataFrame:
    """(_key, _slot, _cuts) per hour with rows: the blocks (start, block) of it and of the next hour.

    A block starts at the row whose rank among the address's rows is a multiple of ``hot_rows``, or
    at the first row of its second (of its instant, in seconds that exceed a block on their own).
    """
    def block(rank: Column) -> Column:
        return F.floor(rank / hot_rows)

    def ranked(counts: DataFrame, by: str, *part: str) -> DataFrame:
        before = W.partitionBy(*part).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
        return counts.withColumn("_rank", F.col("_rank") + F.coalesce(F.sum("n").over(before), F.lit(0)))

    one, slot, second = F.count(F.lit(1)).alias("n"), F.floor(F.col("_at") / SLOT), F.floor(F.col("_at") / MICROS)
    timed = times.withColumns({"_slot": slot, "_second": second})
    hours = timed.groupBy("_key", "_slot").agg(one)
    following = hours.select("_key", (F.col("_slot") + 1).alias("_slot"), F.lit(0).alias("n"))
    slots = hours.unionByName(following).groupBy("_key", "_slot").agg(F.sum("n").alias("n"))
    slots = durable(ranked(slots.withColumn("_rank", F.lit(0)), "_slot", "_key"), "hot-slots")
    # The hours, then the seconds, within which a block ends.
    cut = slots.filter(block(F.col("_rank") + F.col("n") - 1) > block(F.col("_rank"))).drop("n")
    seconds = timed.join(cut, ["_key", "_slot"]).groupBy("_key", "_slot", "_second", "_rank").agg(one)
    seconds = durable(ranked(seconds, "_second", "_key", "_slot"), "hot-seconds")
    full = seconds.filter(F.col("n") > hot_rows).drop("n", "_slot")
    instants = timed.join(full, ["_key", "_second"]).groupBy("_key", "_slot", "_second", "_at", "_rank").agg(one)
    starts = seconds.select("_key", "_slot", (F.col("_second") * MICROS).alias("start"), block(F.col("_rank")).alias("block"))
    starts = starts.unionByName(ranked(instants, "_at", "_key", "_second").select(
        "_key", "_slot", F.col("_at").alias("start"), block(F.col("_rank")).alias("block")))
    starts = starts.groupBy("_key", "_slot", "block").agg(F.min("start").alias("start"))
    listed = starts.groupBy("_key", "_slot").agg(
        F.sort_array(F.collect_list(F.struct("start", "block"))).alias("_later"))
    first = F.array(F.struct((F.col("_slot") * SLOT).alias("start"), block(F.col("_rank")).alias("block")))
    own = slots.join(listed, ["_key", "_slot"], "left").withColumn(
        "_own", F.concat(first, F.coalesce("_later", F.array().cast("array<struct<start:bigint,block:bigint>>"))))
    after = F.lead("_own").over(W.partitionBy("_key").orderBy("_slot"))
    return own.select("_key", "_slot", "n", F.when(F.col("n") > 0, F.concat("_own", after)).alias("_cuts")).filter(
        "n > 0").drop("n")


def block_at(time: Column) -> Column:
    """The block of a time that lies in the row's hour or in the next one."""
    started = F.size(F.filter("_cuts", lambda c: c["start"] <= time))
    return F.get("_cuts", started - 1)["block"]


def in_blocks(hot: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows with their own block and those in which they leave the frames."""
    placed = hot.withColumn("_slot", F.floor(F.col("_at") / SLOT)).join(cuts, ["_key", "_slot"])
    leaves = {f"_leaves{s}": block_at(F.col("_at") + s * MICROS) for s in WIDTHS}
    return placed.withColumns({"_block": block_at(F.col("_at")), **leaves}).drop("_slot", "_cuts")


def _flagged(blocked: DataFrame, run_flags: Callable[..., DataFrame]) -> DataFrame:
    origin = F.col("_origin")
    united = blocked.withColumn("_origin", F.lit("row"))
    narrow = blocked.select("_key", "_block", "_at", "row_id", "_num", "base_url", "session_id")
    for extra, compared, step in [
        (["base_url"], "url", 1), (["base_url"], "url", -1), (["session_id"], "session", 1), ([], "key", 1),
    ]:
        boundary = _boundary_rows(narrow, ["_key", *extra], step).withColumn("_origin", F.lit(compared))
        united = united.unionByName(boundary, allowMissingColumns=True)

    def only(compared: str) -> tuple[Column, ...]:
        # Boundary rows of other comparisons are kept apart.
        return (origin.isin("row", compared),)

    flagged = run_flags(
        united.repartition("_key", "_block"), "_key", "_block",
        only_url=only("url"), only_session=only("session"), only_key=only("key"))
    return flagged.filter(origin == "row").drop("_origin")


def _boundary_rows(rows: DataFrame, group: list[str], step: int) -> DataFrame:
    """Last row per group and block for the next block (``step=1``); first for the previous (-1)."""
    pick = F.max if step > 0 else F.min
    edge = rows.groupBy(*group, "_block").agg(pick(F.struct("_at", "row_id", "_num")).alias("_edge"))
    target = F.lead("_block", step).over(W.partitionBy(*group).orderBy("_block"))
    return (edge.withColumn("_block", target).filter(F.col("_block").isNotNull())
            .select(*group, "_block", "_edge.*"))


def _amount(name: str, value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("decimal(38,0)" if name == "_size3600" else "long")


def _leaving(block: Column) -> dict[str, Column]:
    """What a row takes along in ``block``."""
    return {
        f"{name}_out": _amount(name, F.when(F.col(f"_leaves{seconds}") == block, F.col(leaving)))
        for name, (seconds, _, leaving) in TOTALS.items()}


def _trailing_totals(flagged: DataFrame) -> DataFrame:
    flagged = flagged.withColumn("_one", F.lit(1))
    own = flagged.withColumns({
        **{f"{name}_in": _amount(name, F.col(entering)) for name, (_, entering, _) in TOTALS.items()},
        **_leaving(F.col("_block"))})
    outs, ins = [f"{name}_out" for name in TOTALS], [f"{name}_in" for name in TOTALS]
    elsewhere = F.array_distinct(F.filter(
        F.array(*[f"_leaves{s}" for s in WIDTHS]), lambda b: b != F.col("_block")))
    sent = (flagged.withColumn("_target", F.explode(elsewhere)).withColumns(_leaving(F.col("_target")))
            .groupBy("_key", F.col("_target").alias("_block"), "_at").agg(*[F.sum(c).alias(c) for c in outs])
            .withColumns({c: _amount(c.removesuffix("_out"), F.col(c)) for c in outs}))
    # What earlier blocks leave behind, and the variance, on one small row per block.
    earlier = W.partitionBy("_key").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    per_block = (own.select("_key", "_block", *ins, *outs)
                 .unionByName(sent.drop("_at"), allowMissingColumns=True)
                 .groupBy("_key", "_block").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*ins, *outs]]))
    variance = flagged.groupBy("_key").agg(F.var_samp("_gap").alias("_variance"))
    carried = per_block.select("_key", "_block", *[
        F.coalesce(F.sum(F.col(f"{t}_in") - F.col(f"{t}_out")).over(earlier), F.lit(0)).alias(f"{t}_before") for t in TOTALS
    ]).join(variance, "_key")
    united = own.withColumn("_sent", F.lit(False)).unionByName(
        sent.withColumn("_sent", F.lit(True)), allowMissingColumns=True).repartition("_key", "_block")
    ordered = W.partitionBy("_key", "_block").orderBy("_at")
    inside = united.withColumns({
        name: trailing_total(ordered, seconds, f"{name}_in", f"{name}_out") for name, (seconds, _, _) in TOTALS.items()})
    return (inside.filter(~F.col("_sent")).join(carried, ["_key", "_block"])
            .withColumns({name: F.col(name) + F.col(f"{name}_before") for name in TOTALS}))
