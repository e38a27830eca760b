"""Mixing of sources to target weights by entropy balancing.

Every source is to give a target number of words. Of all document rates that do, those nearest to one in relative
entropy are ``exp(multiplier of the source * size of the document)``, at most a given number of copies. The multipliers
solve a convex dual problem; Newton steps for all sources at once, each a distributed aggregation over the counts of
documents by source and size, find them. Rates are then rounded to whole copies, largest documents first, each rounding
making up for what the ones before left over.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.common import forget, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: Copies of a document, and so of a source, at most.
MOST_COPIES = 3
#: Documents of one source and size that are rounded together, on average.
CELL_ROWS = 20_000
#: Newton and bisection steps at most, and the relative error at which a source is done. Bisection alone gets there
#: from any bracket of doubles in about as many steps.
STEPS, CLOSE = 200, 1e-10


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(id, source, size)``, the size in words; null texts have none."""
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), words.alias("size"))


def targets(counts: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``(source, source_size, mean, target)``: each source's share of all words by weight, as far as copies allow.

    Sources are taken in code point order, null last. A target over ``most`` times its source's size stops there, and
    the excess is shared by weight among the others, until none is above.
    """
    per = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last(F.col("source").cast("binary")))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    mean = (F.col("source_size") / F.col("n")).alias("mean")
    per = stored(per.select("source", "source_size", mean, weight.alias("weight")), "sources")
    limit = F.col("source_size") * F.lit(float(most))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        over = F.lit(False) if stopped < 0 else limit < F.lit(level) * F.col("weight")
        held = per.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)), F.count_if(over)
        ).first()
        if held[2] == stopped or not held[1]:
            break
        level, stopped = (total - held[0]) / held[1], held[2]
    return per.select("source", "source_size", "mean", F.least(limit, F.lit(level) * F.col("weight")).alias("target"))


def rate(multiplier: Column, size: Column, mean: Column, most: int) -> Column:
    """The tilted rate of a document, at most ``most``."""
    return F.when(size == 0, 1.0).otherwise(F.least(F.lit(float(most)), F.exp(multiplier * size / mean)))


def balanced(counts: DataFrame, sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """``(source, source_size, mean, target, multiplier)``: the multipliers with which rates meet the targets.

    A step moves along the tangent of the logarithm of the words that a source gives, whose root is that of the dual's
    gradient and which stays near a line where a few very long documents make the gradient itself steep. A step that
    leaves the bracket of the root is replaced by its middle. Sources that give all copies they may, or have no
    words, need no step: their multiplier is infinite, or 0.
    """
    full = F.col("target") >= F.col("source_size") * F.lit(float(most))
    start = F.when(F.col("source_size") == 0, 0.0).when(full, F.lit(float("inf"))).otherwise(0.0)
    state = sources.withColumns(
        {
            "multiplier": start,
            "low": F.lit(float("-inf")),
            "high": F.lit(float("inf")),
            "done": (F.col("source_size") == 0) | full,
        }
    )
    state = stored(state, "multipliers")
    names, inf = state.columns, F.lit(float("inf"))
    for _ in range(STEPS):
        if not state.where(~F.col("done")).limit(1).count():
            break
        now = state.where(~F.col("done")).withColumnRenamed("source", "of")
        pairs = counts.where("size > 0").join(now, F.col("source").eqNullSafe(F.col("of")))
        tilted = rate(F.col("multiplier"), F.col("size"), F.col("mean"), most)
        mass = F.col("n") * F.col("size") * tilted
        slope = F.when(tilted < most, mass * F.col("size") / F.col("mean")).otherwise(0.0)
        given = pairs.groupBy(*[F.col(c) for c in ("of", *names[1:])]).agg(F.sum(mass).alias("mass"), F.sum(slope).alias("slope"))
        at, over = F.col("multiplier"), F.col("mass") >= F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(at), F.when(over, at).otherwise(F.col("high"))
        newton = at + F.when(F.col("slope") > 0, F.log(F.col("target") / F.col("mass")) * F.col("mass") / F.col("slope")).otherwise(F.lit(float("nan")))
        bounded = (low > -inf) & (high < inf)
        outwards = F.when(over, -1 - F.abs(at)).otherwise(1 + F.abs(at)) + at
        rest = F.when(bounded, (low + high) / 2).otherwise(outwards)
        inside = (newton > low) & (newton < high) & ~F.isnan(newton)
        close = (F.abs(F.col("mass") - F.col("target")) <= F.lit(CLOSE) * F.col("target")) | (bounded & (high - low <= F.abs(at) * 1e-15))
        moved = given.select(
            F.col("of").alias("source"), "source_size", "mean", "target",
            F.when(close, at).when(inside, newton).otherwise(rest).alias("multiplier"), low.alias("low"), high.alias("high"), close.alias("done"),
        )
        after = stored(moved.unionByName(state.where("done")), "multipliers")
        forget(state)
        state = after
    return state.select("source", "source_size", "mean", "target", "multiplier")


def best_moves(size: np.ndarray, given: np.ndarray, room: np.ndarray, left: float) -> list[tuple[int, int]]:
    """The one copy more or less of each of two cells (or of one) that comes nearest to ``left`` words; none if no such
    move comes nearer than staying."""
    up, down = np.flatnonzero((given < room) & (size > 0)), np.flatnonzero((given > 0) & (size > 0))
    cell = np.concatenate((up, down, [-1]))
    by = np.concatenate((np.ones(len(up), int), -np.ones(len(down), int), [0]))
    words = np.append(size[cell[:-1]], 0) * by
    order = np.argsort(words, kind="stable")
    cell, by, words = cell[order], by[order], words[order]
    best, found = abs(left), []
    place = np.searchsorted(words, left - words)
    for near in (place - 1, place):
        near = np.clip(near, 0, len(words) - 1)
        error = np.abs(left - words - words[near])
        error[cell == cell[near]] = np.inf
        i = int(np.argmin(error))
        if error[i] < best - 0.5:
            best, found = error[i], [(int(cell[k]), int(by[k])) for k in (i, near[i]) if cell[k] >= 0]
    return found


def settle(cells: pd.DataFrame, most: int) -> pd.DataFrame:
    """Whole copies for the cells of one source: ``more`` of a cell's documents get one copy above ``copies``."""
    cells = cells.sort_values(["size", "block"], ascending=[False, True], ignore_index=True)
    size, n, rates = (cells[c].tolist() for c in ("size", "n", "rate"))
    left, given = 0.0, []
    for c, k, r in zip(size, n, rates, strict=True):
        low, exact = math.floor(r) * k, r * k
        copies = min(max(round(exact + left / c), low), math.ceil(r) * k) if c else k
        left += (exact - copies) * c
        given.append(copies)
    c, k, g = np.array(size), np.array(n), np.array(given)
    while abs(left) >= 1 and (moves := best_moves(c, g, most * k, left)):
        for i, by in moves:
            g[i] += by
            left -= by * size[i]
    cells["copies"], cells["more"] = g // k, g % k
    return cells.drop(columns=["n", "rate"])


def rounded(cells: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """``cells`` (one row for each source, size and block, with ``n`` documents and the source's balance) as ``(source,
    size, block, source_size, target, copies, more)``.

    A source's cells are taken by falling size and rounded up or down. The words that a rounding gives too many or too
    few are carried on to the next cell; what small documents could not make up for in the end goes to one copy more
    or less of two others, as long as that comes nearer. A group holds a source's cells: a source of D different sizes has at
    least D * D / 2 words, so ten billion words make 141,000 at most, and only every ``CELL_ROWS`` documents of one size
    add another.
    """
    tilted = rate(F.col("multiplier"), F.col("size"), F.col("mean"), most).alias("rate")
    rows = cells.select("source", "size", "block", "source_size", "target", "n", tilted)
    schema = "source string, size long, block long, source_size long, target double, copies long, more long"
    return rows.groupBy("source").applyInPandas(lambda part: settle(part, most), schema)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """``(id, source, size, source_size, target, copies, taken)`` of every document, ``taken`` being copies times size.

    Null texts have size 0. Null sources are one source, the last. Documents without words take nothing and count no
    words; they keep one copy. If no document has words, all targets are 0. Copies are picked among documents of equal
    source and size by a hash of the id, so reruns agree; null ids are told apart by their place in the table. Repeated
    rows are documents like any other. Texts are measured whole, extra columns are ignored, and an empty table gives no
    rows.
    """
    found = sizes(docs, id_col, text_col, source_col)
    lot = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.concat(F.lit("null "), F.monotonically_increasing_id())))
    found = stored(found.withColumn("lot", lot), "sizes")
    counts = stored(found.groupBy("source", "size").agg(F.count("*").alias("n")), "counts")
    balance = balanced(counts, targets(counts, weights, most), most)

    same = [F.col("source").eqNullSafe(F.col("of")), F.col("size") == F.col("of_size")]
    blocks = counts.select(F.col("source").alias("of"), F.col("size").alias("of_size"), F.ceil(F.col("n") / CELL_ROWS).alias("blocks"))
    dealt = found.join(blocks, same[0] & same[1]).withColumn("block", F.pmod("lot", "blocks")).drop("of", "of_size", "blocks")
    cells = dealt.groupBy("source", "size", "block").agg(F.count("*").alias("n"))
    cells = cells.join(balance.withColumnRenamed("source", "of"), same[0]).drop("of")
    plan = stored(rounded(cells, most), "copies").withColumnsRenamed({"source": "of", "size": "of_size", "block": "of_block"})

    order = F.row_number().over(Window.partitionBy("source", "size", "block").orderBy("lot", "id"))
    placed = dealt.withColumn("order", order)
    placed = placed.join(plan, same[0] & same[1] & (F.col("block") == F.col("of_block")))
    copies = F.col("copies") + (F.col("order") <= F.col("more")).cast("long")
    return placed.select("id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
