"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell (source x language x topic). Raking then scales the
cells to the target marginals of one dimension after the other until all three
hold within ``TOLERANCE``. A document is kept with the probability that its cell's target asks for,
by the hash of its id, and carries the weight that makes expected weighted tokens
meet the targets where a cell has fewer tokens than asked for. DataFrame
functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import discard, stage

DIMENSIONS = ("source", "lang", "topic")
#: Share of the corpus's tokens to sample, and the power that evens out the shares of a dimension's values.
FRACTION = 0.5
POWER = 0.5
#: Rounds of raking after which the margins are checked, until they are within the tolerance (relative), and at most so many.
ROUNDS = 8
TOLERANCE = 1e-3
MAX_ROUNDS = 504
SEED = 17
#: Cells up to which their table is sent to the tasks (a cell is about 100 bytes); beyond, it is joined by a shuffle.
BROADCAST_CELLS = 100_000


def token_count(text: str = "text") -> Column:
    """Pieces between single spaces; a null or empty text has one."""
    return F.size(F.split(F.coalesce(F.col(text), F.lit("")), " ")).cast("long")


def topic(text: str = "text") -> Column:
    """A coarse genre from marks in the text: the first that fits."""
    value = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(value.contains("|"), "table")
        .when(value.contains("icense"), "legal")
        .when(value.contains("@"), "contact")
        .otherwise("prose")
    )


def smoothed_targets(cells: DataFrame, dimension: str, power: float, total: float) -> DataFrame:
    """Target tokens of each value of a dimension: proportional to its tokens to a power."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("n"))
    share = F.pow("n", F.lit(power))
    norm = sums.agg(F.sum(share).alias("s")).first()["s"] or 1.0
    return sums.select(dimension, (share * F.lit(total / norm)).alias(f"target_{dimension}"))


def margin_error(cells: DataFrame) -> float:
    """The largest relative distance of a dimension's sums of ``w`` from their targets; targets of 0 hold anyway."""
    errors = []
    for d in DIMENSIONS:
        total, target = F.sum("w").over(Window.partitionBy(d)), F.col(f"target_{d}")
        errors.append(F.when(target > 0, F.abs(total / target - 1)).otherwise(0.0))
    return float(cells.select(F.greatest(*errors).alias("e")).agg(F.max("e").alias("e")).first()["e"] or 0.0)


def rake(cells: DataFrame, rounds: int) -> DataFrame:
    """``cells`` with ``w``, tokens scaled to ``target_<dimension>`` of every dimension in turn.

    Rounds run in one job for each ``rounds`` of them, after which the sums are
    checked: it ends when every sum is within ``TOLERANCE`` of its target. A
    ``ValueError`` after ``MAX_ROUNDS``, as for targets that no weights of the
    given cells meet together.
    """
    cells = cells.withColumn("w", F.col("tokens").cast("double"))
    done = 0
    while True:
        before = cells
        for d in DIMENSIONS * rounds:
            total = F.sum("w").over(Window.partitionBy(d))
            cells = cells.withColumn("w", F.when(total > 0, F.col("w") * F.col(f"target_{d}") / total).otherwise(0.0))
        cells, done = stage(cells, "mix-rounds"), done + rounds
        if done > rounds:
            discard(before)
        if (error := margin_error(cells)) <= TOLERANCE:
            return cells
        if done >= MAX_ROUNDS:
            raise ValueError(f"margins are still {error:.3g} off their targets after {done} rounds of raking")


def mixed_cells(docs: DataFrame, fraction: float, power: float, rounds: int, targets: dict[str, DataFrame] | None) -> DataFrame:
    """One row per cell: its tokens, sampling ``probability`` and ``weight``."""
    cells = stage(docs.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    total = float(cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0) * fraction
    for d in DIMENSIONS:
        given = (targets or {}).get(d)
        if given is None:
            wanted = smoothed_targets(cells, d, power, total)
        else:
            norm = float(given.agg(F.sum("share").alias("s")).first()["s"] or 1.0)
            wanted = given.select(d, (F.col("share") * F.lit(total / norm)).alias(f"target_{d}"))
        match = cells[d].eqNullSafe(wanted[d])
        cells = cells.join(wanted, match, "left").drop(wanted[d]).na.fill(0.0, [f"target_{d}"])
    raked = rake(stage(cells, "mix-targets"), rounds)
    ratio = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0)
    return raked.select(
        *DIMENSIONS, "tokens", F.least(F.lit(1.0), ratio).alias("probability"), F.greatest(F.lit(1.0), ratio).alias("weight")
    )


def draw(id_column: str, seed: int) -> Column:
    """A number in [0, 1) from the MD5 of seed and id; equal ids (null is one) draw alike."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix_sources(
    docs: DataFrame,
    fraction: float = FRACTION,
    power: float = POWER,
    rounds: int = ROUNDS,
    seed: int = SEED,
    targets: dict[str, DataFrame] | None = None,
    id_column: str = "doc_id",
) -> DataFrame:
    """The sampled rows of ``docs`` with ``topic, n_tokens, probability, weight`` appended (columns so named are replaced).

    ``targets`` may give ``(<dimension>, share)`` tables; a dimension without one
    aims at its token shares to the ``power``, and a value that a given table
    leaves out is not sampled. Together the targets ask for ``fraction`` of all
    tokens; targets that cannot be met together are an error. Null source or language is a value of its own; a null text has one
    token. Rows that share an id are drawn alike, a null id as one. An empty
    table gives no rows.
    """
    own = ("topic", "n_tokens", "probability", "weight", "tokens", "w")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in own])
    rows = docs.withColumn("topic", topic()).withColumn("n_tokens", token_count())
    cells = stage(mixed_cells(rows.select(*DIMENSIONS, "n_tokens"), fraction, power, rounds, targets), "mix-weights")
    few = cells.count() <= BROADCAST_CELLS
    lookup = cells.drop("tokens").select(*(F.col(d).alias(f"__{d}") for d in DIMENSIONS), "probability", "weight")
    match = reduce(lambda a, b: a & b, (F.col(d).eqNullSafe(F.col(f"__{d}")) for d in DIMENSIONS))
    joined = rows.join(F.broadcast(lookup) if few else lookup, match)
    return joined.where(draw(id_column, seed) < F.col("probability")).drop(*(f"__{d}" for d in DIMENSIONS))
