"""Sources interleaved to target weights by Pfair scheduling.

The mixture is cut into equal slots. In an ideal mixture every source gives text at the rate of its
weight from the start until it has no more; the others then share what it leaves by their weights.
A source's k-th block is released in the slot where the ideal mixture comes to its first character
and due after the slot where it comes to its last; the earliest deadline among the released blocks
goes next. Such windows can always be met on one line of slots, as the ideal rates add up to one, so
that after any number of slots no source is a whole block ahead of or behind them. While all
sources last that is the weight itself; then follows a tail of what is beyond the weights. No
document is repeated or left out.

The line has about ``slots`` slots at any size of input (their length grows instead), so that
the schedule is a table of fixed size that the driver can make. The documents are never there: a
document's block follows from the text before it in its source, by sums over slices of a source.

Without given weights, each source weighs what it has, so that all last to the end; with a ``temperature`` T it
weighs its size to the power 1/T, so that smaller sources come more often while they last.
``max_share`` below one holds larger sources down to it for as long as the others last. Only
sources that are missing in given weights, or weigh nothing there, are no part of the mixture
(``in_mixture`` false).

At most ``max_sources`` are scheduled by themselves, the largest. All others together are one more
source of the schedule, which weighs what they weigh, and have places side by side within it.

Defined results: a null source is a source of its own. Null and empty texts have size 1, as each
text's size is its code points and one. The order within a source is that of a hash, doc_id and
position. Rows that repeat have places of their own. An empty table gives an empty result. Other
columns are never read.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import AT, FILE, identified, running_totals, saved


def schedule(blocks: list[int], weights: Sequence[float] | None = None) -> list[list[tuple[int, int, int]]]:
    """Numbers of blocks by source to (slot, release, deadline) of each block.

    ``weights`` need not add up to one; without them, each source weighs its number of blocks.
    """
    total = sum(blocks)
    exact = [Fraction(w) for w in weights or blocks]
    scale = math.lcm(*(w.denominator for w in exact))
    rates = [int(w * scale) for w in exact]
    # Sources end at n / rate. Between two ends, the ideal mixture has got to ended + time * active.
    times: list[Fraction] = []
    ended, active = [0], [sum(r for n, r in zip(blocks, rates) if n)]
    for time, n, rate in sorted((Fraction(n, r), n, r) for n, r in zip(blocks, rates) if n):
        if not times or time > times[-1]:
            times.append(time)
            ended.append(ended[-1])
            active.append(active[-1])
        ended[-1] += n
        active[-1] -= rate

    def reached(s: int, k: int) -> tuple[int, int]:
        """Where the ideal mixture has given k blocks of the source, rounded down and up."""
        i = bisect_left(times, Fraction(k, rates[s]))
        return ended[i] + active[i] * k // rates[s], ended[i] - (-active[i] * k // rates[s])

    jobs = sorted((reached(s, k)[0], reached(s, k + 1)[1], s, k) for s, n in enumerate(blocks) for k in range(n))
    placed = [[(0, 0, 0)] * n for n in blocks]
    ready: list[tuple[int, int, int, int]] = []
    at = 0
    for slot in range(total):
        while at < len(jobs) and jobs[at][0] <= slot:
            release, deadline, s, k = jobs[at]
            heapq.heappush(ready, (deadline, s, k, release))
            at += 1
        deadline, s, k, release = heapq.heappop(ready)
        placed[s][k] = (slot, release, deadline)
    return placed


def capped_shares(sizes: list[int], max_share: float) -> list[float]:
    """Shares in proportion to ``sizes``, those above ``max_share`` cut to it and the rest raised."""
    limit = max(max_share, 1 / len(sizes))
    capped: set[int] = set()
    while True:
        rest = sum(x for i, x in enumerate(sizes) if i not in capped)
        free = 1 - limit * len(capped)
        shares = [limit if i in capped else free * x / rest for i, x in enumerate(sizes)]
        more = {i for i, share in enumerate(shares) if share > limit + 1e-12}
        if not more:
            return shares
        capped |= more


def placed(
    rows: DataFrame,
    weights: dict[str | None, float] | None = None,
    max_share: float = 1.0,
    slots: int = 10_000,
    max_sources: int = 10_000,
    temperature: float = 1.0,
) -> DataFrame:
    """Rows of ``identified`` to row_file, row_at, doc_id, source, block, slot, release, deadline,
    in_mixture and start (the size of what comes before in the source, or among the pooled ones)."""
    spark = rows.sparkSession
    sizes = saved(
        rows.select(
            FILE,
            AT,
            F.col("doc.doc_id").cast("bigint").alias("doc_id"),
            F.col("doc.source").cast("string").alias("source"),
            (F.char_length(F.coalesce(F.col("doc.text").cast("string"), F.lit(""))).cast("bigint") + 1).alias("size"),
        ),
        "sizes",
    )
    by_source = saved(sizes.groupBy("source").agg(F.sum("size").alias("total")), "sources")
    if weights is not None:
        given = spark.createDataFrame(
            [(s, float(w)) for s, w in weights.items() if w > 0], "given_source string, weight double"
        )
        by_source = by_source.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("given_source"))).drop("given_source")
    else:
        by_source = by_source.withColumn("weight", F.pow(F.col("total").cast("double"), F.lit(1 / temperature)))
    # The largest sources are numbered, at most max_sources rows.
    own = by_source.orderBy(F.desc("total"), F.asc_nulls_last("source")).limit(max_sources).collect()
    lanes = [(r["source"], i) for i, r in enumerate(own)]
    sums = by_source.agg(F.count("*"), F.sum("total"), F.sum("weight")).first()
    totals = [(r["total"], r["weight"]) for r in own]
    pooled = sums[0] > len(own)
    if pooled:
        total, weight = (sum(x) for x in zip(*totals))
        totals.append((sums[1] - total, max(sums[2] - weight, 0.0) or 1e-9))
    plan, block = [], 1
    if totals:
        block = max(1, math.ceil(sum(n for n, _ in totals) / slots))
        blocks = [-(-n // block) for n, _ in totals]
        shares: Sequence[float] = blocks
        if weights is not None or temperature != 1:
            shares = [w for _, w in totals]
        elif max_share < 1:
            shares = capped_shares(blocks, max_share)
        table = schedule(blocks, shares)
        plan = [(lane, k, *window) for lane, windows in enumerate(table) for k, window in enumerate(windows)]
    steps = spark.createDataFrame(
        plan, "plan_lane int, plan_block bigint, slot bigint, release bigint, deadline bigint"
    )
    numbers = spark.createDataFrame(lanes, "lane_source string, lane int")
    lane = F.col("lane")
    if pooled:
        lane = F.coalesce(lane, F.lit(len(own)))
    laned = sizes.join(F.broadcast(numbers), F.col("source").eqNullSafe(F.col("lane_source")), "left")
    if pooled and weights is not None:
        # Sources without a weight are in no lane, not in the common one.
        known = by_source.select(F.col("source").alias("known_source"), F.lit(True).alias("weighs"))
        laned = laned.join(known, F.col("source").eqNullSafe(F.col("known_source")), "left")
        lane = F.when(F.col("weighs"), lane)
    laned = laned.withColumn("lane", lane).select(*sizes.columns, "lane")
    ranked = running_totals(laned, ["lane"], ["doc_id", AT, FILE], F.col("size"), "start").withColumn(
        "block", F.expr(f"start div {block}")
    )
    # About ``slots`` rows and one per source: a bounded table.
    on = (ranked["lane"] == steps["plan_lane"]) & (ranked["block"] == steps["plan_block"])
    return ranked.join(F.broadcast(steps), on, "left").select(
        FILE,
        AT,
        "doc_id",
        "source",
        "block",
        "slot",
        "release",
        "deadline",
        F.col("slot").isNotNull().alias("in_mixture"),
        "start",
        "size",
    )


def mixing(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, start, block, slot, release, deadline, in_mixture.

    The order of the mixture is (slot, start); slot, release and deadline are null outside it.
    """
    return placed(identified(docs), **options).drop(FILE, AT)


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mixture, all columns kept, in its order."""
    rows = identified(docs)
    chosen = placed(rows, **options).filter("in_mixture").select(FILE, AT, "slot", "start")
    return rows.join(chosen, [FILE, AT]).orderBy("slot", "start").select("doc.*")
