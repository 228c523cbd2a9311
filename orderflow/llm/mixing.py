"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Tokens are summed up by cell (source, language, topic). The cell weights are raked: scaled so that the sums by source
meet their targets, then by language, then by topic, and again until all three hold. A document of cell c is kept with
probability weight[c] / tokens[c]. With ``share``, the expected part of all tokens in the sample, targets are scaled to it and
no weight goes above its cell's tokens: such cells have probability 1 and the others are raked to what is left. A value whose
cells are all used up stays under its target; ``unmet`` has these and margins that the rounds didn't bring to their targets,
and they are logged. With targets but no ``share`` ratios are divided by the largest, so the expected token shares are exactly the fitted
ones but one rare cell sets the size of the sample. Who is kept depends on a hash of doc_id, text and the seed alone, so rows without an id are drawn by their texts.

Everything is done on the table of cells, which stays in Spark; factors are joined by key. Cell probabilities are
broadcast only if their counted number is at most BROADCAST_CELLS, else joined by shuffle.

Defined results: a null source or language counts as the value ``(none)``. Tokens are words between white space; null and empty texts
have none and take their cell's probability, 0 if nothing in the cell has tokens. Targets are shares by value; values that don't
occur are left out, values without a target keep their present share, and the rest is scaled to sum 1. Without targets each share is the present one
to the power TEMPER, scaled to sum 1. Repeated rows are decided alike. All columns are kept, of equal names the made one stays.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import keep_names, or_empty
from orderflow.session import pin, unpin

TEMPER, ROUNDS, TOLERANCE, BROADCAST_CELLS = 0.9, 200, 1e-4, 20_000
#: Expected part of the tokens in the sample of the query and the pipeline; values reported of unmet targets.
SHARE, REPORTED = 0.6, 20
LOG = logging.getLogger(__name__)
NONE = "(none)"
#: Topic of a text: the first whose mark occurs in it, else OTHER.
TOPIC_MARKS = [
    ("licence", ["icense", "opyright", "All rights reserved"]),
    ("web", ["http://", "https://", "www."]),
    ("contact", ["@"]),
    ("symbols", ["%%%", "***", "$$$", "###", "&&&"]),
]
OTHER = "prose"


def topic_of(text: Column) -> Column:
    out = F.lit(OTHER)
    for name, marks in reversed(TOPIC_MARKS):
        has = F.lit(False)
        for mark in marks:
            has = has | F.contains(text, F.lit(mark))
        out = F.when(has, name).otherwise(out)
    return out


def target_shares(cells: DataFrame, dim: str, target: Mapping[str, float] | None, temper: float) -> DataFrame:
    """(dim, target): wanted tokens by value, in sum those that are there."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    total = sums.agg(F.sum("tokens").alias("all_tokens"))
    shares = sums.withColumn("share", F.col("tokens") / total.select("all_tokens").scalar())
    if target is None:
        wanted = shares.withColumn("wanted", F.pow("share", F.lit(temper)))
    else:
        given = [F.when(F.col(dim) == value, F.lit(float(share))) for value, share in target.items()]
        wanted = shares.withColumn("wanted", F.coalesce(*given, F.col("share")))
    wanted = pin(wanted)
    sums = wanted.agg(F.sum("wanted").alias("wanted"), F.sum("tokens").alias("tokens"))
    scale = sums.select(F.col("tokens") / F.col("wanted")).scalar()
    return pin(wanted.select(dim, (F.col("wanted") * scale).alias("target")))


def margins(cells: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """(dim, value, target, reached, off, full): fitted tokens of each value, and whether its cells are all used up."""
    every = None
    for dim, target in targets.items():
        sums = cells.groupBy(dim).agg(F.sum("weight").alias("reached"), F.sum("tokens").alias("all")).join(target, dim)
        off = F.abs(F.col("reached") / F.col("target") - 1).alias("off")
        full = ((F.col("reached") < F.col("target")) & (F.col("reached") >= F.col("all") * (1 - 1e-9))).alias("full")
        some = sums.select(F.lit(dim).alias("dim"), F.col(dim).alias("value"), "target", "reached", off, full)
        every = some if every is None else every.unionByName(some)
    return every


def rake(
    cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE, bounded: bool = False
) -> DataFrame:
    """Cells (dims, tokens) with the fitted ``weight``; cells without tokens have weight 0. Bounded: no weight is above its
    tokens, and values whose cells are all used up are not waited for.

    A round scales the cells to each dimension in turn and is one job. Targets travel as columns of the cells, so a factor is
    one aggregation by value, and the largest correction of a round (``_moved``) is read from what the round itself wrote.
    Where margins contradict each other weights return to the same values after each round (``_drift``): then too it ends."""
    tokens = F.col("tokens").cast("double")
    now = cells
    for dim, target in targets.items():
        now = now.join(target.withColumnRenamed("target", f"_to{dim}"), dim, "left")
    now = pin(now.withColumns({"weight": tokens, "_moved": F.lit(0.0), "_drift": F.lit(0.0)}))
    for _ in range(rounds):
        later = now.drop("_drift").withColumns({"_moved": F.lit(0.0), "_was": F.col("weight")})
        for dim in targets:
            sums = later.groupBy(dim).agg(
                F.sum("weight").alias("_sum"), F.sum(tokens).alias("_all"), F.first(f"_to{dim}").alias("_target")
            )
            factor = F.coalesce(F.try_divide(F.col("_target"), F.col("_sum")), F.lit(0.0))
            full = (factor > 1) & (F.col("_sum") >= F.col("_all") * (1 - 1e-9)) if bounded else F.lit(False)
            off = F.when(full | F.col("_target").isNull(), 0.0).otherwise(F.abs(factor - 1))
            later = later.join(sums.select(dim, factor.alias("_factor"), off.alias("_off")), dim)
            weight = F.col("weight") * F.col("_factor")
            later = later.withColumns(
                {"weight": F.least(weight, tokens) if bounded else weight, "_moved": F.greatest("_moved", "_off")}
            ).drop("_factor", "_off")
        drift = F.coalesce(F.abs(F.try_divide("weight", "_was") - 1), F.lit(0.0))
        before, now = now, pin(later.withColumn("_drift", drift).drop("_was"))
        unpin(before)
        worst, drifted = now.agg(F.max("_moved"), F.max("_drift")).first()
        if worst is None or worst <= tolerance or drifted <= tolerance / 10:
            break
    return now.select(*cells.columns, "weight")


def unmet(cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = TOLERANCE) -> DataFrame:
    """The rows of ``margins`` further from their targets than the tolerance; where not full, the margins contradict each other
    or rounds ran out."""
    return margins(cells, targets).where(F.col("off") > tolerance)


def with_probabilities(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    temper: float = TEMPER,
    seed: int = 8,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: Column | None = None,
    rounds: int = ROUNDS,
    share: float | None = None,
) -> DataFrame:
    """Adds topic, tokens, probability, sampled and settled to every row; ``settled`` is false if margins that aren't
    used up missed their targets: because they contradict each other, or because ``rounds`` ran out. ``share``: expected part of all tokens in the sample,
    SHARE if neither it nor targets are given; with given targets and no share, token shares are exact and the size is free."""
    share = SHARE if share is None and targets is None else share
    if share is not None and not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    body = or_empty(text)
    dims = {
        "_source": F.coalesce(F.col(source).cast("string"), F.lit(NONE)),
        "_lang": F.coalesce(F.col(lang).cast("string"), F.lit(NONE)),
        "_topic": topic_of(body) if topic is None else F.coalesce(topic.cast("string"), F.lit(NONE)),
    }
    named = docs.withColumns(dims).withColumn("_tokens", F.regexp_count(body, F.lit(r"\S+")).cast("long"))
    cells = pin(named.groupBy(*dims).agg(F.sum("_tokens").alias("tokens")))
    given = targets or {}
    wanted = {d: target_shares(cells, d, given.get(d[1:]), temper) for d in dims}
    if share is not None:
        wanted = {d: w.withColumn("target", F.col("target") * F.lit(share)) for d, w in wanted.items()}
    fitted = rake(cells, wanted, rounds, bounded=share is not None)
    off = unmet(fitted, wanted)
    settled = off.where("NOT full").isEmpty()
    for r in off.orderBy(F.desc("off"), "dim", "value").limit(REPORTED).collect():
        why = "all its documents are kept" if r["full"] else "the margins contradict each other, or rounds ran out"
        LOG.warning("mixing: %s %s has %.1f of %.1f target tokens: %s", r["dim"][1:], r["value"], r["reached"], r["target"], why)
    ratios = fitted.select(*dims, F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0).alias("ratio"))
    largest = 1.0 if share is not None else ratios.agg(F.max("ratio")).first()[0] or 1.0
    chances = ratios.select(*dims, F.least(F.col("ratio") / F.lit(largest), F.lit(1.0)).alias("probability"))
    if fitted.count() <= BROADCAST_CELLS:
        chances = F.broadcast(chances)
    # 53 bits of the hash as a number in [0, 1).
    draw = F.shiftrightunsigned(F.xxhash64(F.col(doc_id).cast("string"), body, F.lit(seed)), 11) / F.lit(float(1 << 53))
    made = ("topic", "tokens", "probability", "sampled", "settled")
    return named.join(chances, list(dims)).select(
        *keep_names(docs, *made),
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("tokens"),
        "probability",
        (draw < F.col("probability")).alias("sampled"),
        F.lit(settled).alias("settled"),
    )
