"""Mixing sources to target weights by iterative proportional fitting under upper bounds.

Documents fall into cells of source, language and topic. The cells' token counts are raked until their marginals are
the targets while no cell gives more than it has; a document is then kept with its cell's calibrated probability, by a
hash of its id and text. Expected token shares of the sample are the targets, since the bounds are part of the raking.

A target that a category can't supply for the budget (fraction of all tokens) is lowered to all that it has, and the
axis' others are scaled up. Where targets of different axes still contradict each other under the bounds, all axes move
from their targets towards the observed shares, by as little as a bisection of `STEPS` steps finds; `strength` says how
much of the way from observed to target shares is kept (1: the targets themselves).

Everything but the small raking loop is DataFrame code. Cells are raked in numpy while there are at most `local_cells`
(a checked bound); a larger table is raked by the same steps, to the same limits, as joins of the cell table with its
marginals.

Defined results: a null source or language is a category of its own; null text has no tokens and topic `empty`, and is
kept with probability 1 if its cell has no tokens at all. Repeated rows share one fate. Targets for categories without
tokens are left out and the rest rescaled. Very long texts count with all their words. Empty tables give empty results.
Further columns are ignored, whatever their names; a topic of one's own is named by `topic`.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import checkpoint

#: Powers of the observed shares that serve as targets unless shares are given: under 1 they lift small categories.
POWERS = {"source": 0.5, "lang": 0.5, "topic": 0.7}
FRACTION = 0.5
AXES = ("source", "lang", "topic")
LOCAL_CELLS = 200_000


def topic_of(text: Column) -> Column:
    """A coarse kind of text: empty, table, symbols, numeric or prose."""
    return (
        F.when(F.coalesce(F.length(F.trim(text)), F.lit(0)) == 0, "empty").when(F.contains(text, F.lit(" | ")), "table")
        .when(text.rlike(r"[#$%&*]{3}"), "symbols").when(text.rlike("[0-9]"), "numeric").otherwise("prose")
    )


#: Of the raking, wherever the cells are: rounds and the largest deviation of a marginal that ends it, and the steps of the
#: bisection for targets that contradict each other.
ROUNDS, TOLERANCE, STEPS = 2000, 1e-9, 5


def n_tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform_of(seed: int, *columns: str) -> Column:
    """A number in [0, 1) from a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def rake(base: np.ndarray, bounds: np.ndarray, index: list[np.ndarray], targets: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """(masses whose marginals are the targets, none over its bound; the largest deviation left).

    Masses are base times a factor for each category, cut at the bounds. In turn, each axis' factors are scaled by what
    the cells under their bounds must give (Newton's step), or by the whole category's ratio where that step is none.
    Ends when no marginal is off by more than TOLERANCE, or after ROUNDS.
    """
    z, off = base / base.sum(), np.inf
    for _ in range(ROUNDS):
        off = 0.0
        for place, target in zip(index, targets):
            full = z >= bounds
            held, free = np.bincount(place, np.where(full, bounds, 0.0), len(target)), np.bincount(place, np.where(full, 0.0, z), len(target))
            have = held + free
            off = max(off, float(np.abs(have - target).max()))
            newton = (free > 0) & (target > held)
            scale = np.where(newton, (target - held) / np.where(newton, free, 1.0), target / np.where(have > 0, have, 1.0))
            z = z * scale[place]
        if off < TOLERANCE:
            break
    return np.minimum(z, bounds), off


def _warn(strength: float) -> None:
    warnings.warn(f"targets of the axes contradict each other under the bounds of the cells; the mix goes {strength:.3f} of the way to them", RuntimeWarning, stacklevel=3)


def supplied(scale_of, limit: int = 200) -> float:
    """The factor s with which min(bound, s * wanted) adds up to 1: the least fixed point, from below."""
    s = 1.0
    for _ in range(limit):
        full, free = scale_of(s)
        better = max(0.0, 1.0 - full) / free if free > 0 else s
        if better <= s * (1 + 1e-13):
            break
        s = better
    return s


def reachable(wanted: np.ndarray, mass: np.ndarray, fraction: float) -> np.ndarray:
    """Shares nearest to those wanted that categories of the given mass can supply to a sample of fraction of all tokens."""
    bound = mass / fraction
    s = supplied(lambda s: (bound[s * wanted > bound].sum(), wanted[s * wanted <= bound].sum()))
    return np.minimum(bound, s * wanted)


def wanted_shares(names: list[str], mass: np.ndarray, power: float, given: dict[str, float] | None) -> np.ndarray:
    base = np.array([given.get(n, 0.0) for n in names]) if given else mass**power
    base = np.where(mass > 0, base, 0.0)
    return base / base.sum() if base.sum() else mass


def _strongest(attempt) -> tuple[float, object]:
    """(strength, result) of the largest strength found for which attempt(strength) gives a result; 0 always does."""
    found = attempt(1.0)
    if found is not None:
        return 1.0, found
    low, high, best = 0.0, 1.0, None
    for _ in range(STEPS):
        mid = (low + high) / 2
        got = attempt(mid)
        if got is None:
            high = mid
        else:
            low, best = mid, got
    _warn(low)
    return low, best if best is not None else attempt(0.0)


CALIBRATED = "source string, lang string, topic string, share double, probability double, strength double"


def calibrate(cells: DataFrame, fraction: float, powers: dict[str, float], given: dict[str, dict[str, float]] | None = None, local_cells: int = LOCAL_CELLS) -> DataFrame:
    """cells (source, lang, topic, tokens) -> with share (of the sample's expected tokens), probability and strength."""
    given = given or {}
    if cells.limit(local_cells + 1).count() > local_cells:
        return _calibrate_distributed(cells, fraction, powers, given)
    got = cells.orderBy(*AXES).toPandas()
    spark = cells.sparkSession
    some = got["tokens"].to_numpy(float) > 0
    if not some.any():
        return cells.select(*AXES, F.lit(0.0).alias("share"), F.lit(1.0).alias("probability"), F.lit(1.0).alias("strength"))
    tokens = got["tokens"].to_numpy(float)[some]
    base = tokens / tokens.sum()
    index, masses, wanted = [], [], []
    for axis in AXES:
        names, place = np.unique(got[axis].to_numpy(str)[some], return_inverse=True)
        index.append(place)
        masses.append(np.bincount(place, base, len(names)))
        wanted.append(wanted_shares(names.tolist(), masses[-1], powers[axis], given.get(axis)))
    # what categories with a target can supply at all bounds the sample
    fraction = min(fraction, *(float(m[w > 0].sum()) for m, w in zip(masses, wanted)))
    targets = [reachable(w, m, fraction) for w, m in zip(wanted, masses)]

    def attempt(strength: float) -> np.ndarray | None:
        w, off = rake(base, base / fraction, index, [m + strength * (t - m) for m, t in zip(masses, targets)])
        return w if off < TOLERANCE else None

    strength, share = _strongest(attempt)
    got["share"], got["probability"], got["strength"] = 0.0, 1.0, strength
    got.loc[some, "share"], got.loc[some, "probability"] = share, np.clip(share * fraction / base, 0.0, 1.0)
    return spark.createDataFrame(list(got[[*AXES, "share", "probability", "strength"]].itertuples(index=False, name=None)), CALIBRATED)


def _calibrate_distributed(cells: DataFrame, fraction: float, powers: dict[str, float], given: dict[str, dict[str, float]]) -> DataFrame:
    """The same raking with the cell table kept distributed; only totals reach the driver."""
    total = float(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0])
    if not total:
        return cells.select(*AXES, F.lit(0.0).alias("share"), F.lit(1.0).alias("probability"), F.lit(1.0).alias("strength"))
    now = cells.where("tokens > 0").withColumn("base", F.col("tokens") / F.lit(total))
    axes = {}
    for axis in AXES:
        mass = now.groupBy(axis).agg(F.sum("base").alias("mass"))
        if axis in given:
            pairs = F.create_map(*[F.lit(x) for kv in given[axis].items() for x in kv])
            mass = mass.withColumn("raw", F.coalesce(F.element_at(pairs, F.col(axis)), F.lit(0.0)))
        else:
            mass = mass.withColumn("raw", F.pow("mass", F.lit(powers[axis])))
        whole = mass.agg(F.sum("raw")).first()[0]
        axes[axis] = checkpoint(mass.withColumn("wanted", F.col("raw") / F.lit(whole) if whole else F.col("mass")))
        fraction = min(fraction, float(axes[axis].agg(F.sum(F.when(F.col("wanted") > 0, F.col("mass")))).first()[0]))
    for axis, mass in axes.items():
        bound = F.col("mass") / F.lit(fraction)

        def scale_of(s: float, mass: DataFrame = mass, bound=bound) -> tuple[float, float]:
            over = F.lit(s) * F.col("wanted") > bound
            row = mass.agg(F.coalesce(F.sum(F.when(over, bound)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("wanted"))), F.lit(0.0))).first()
            return float(row[0]), float(row[1])

        target = F.least(bound, F.lit(supplied(scale_of)) * F.col("wanted"))
        now = now.join(mass.select(axis, F.col("mass").alias(f"mass_{axis}"), target.alias(f"target_{axis}")), axis)
    start = checkpoint(now.withColumn("bound", F.col("base") / F.lit(fraction)))

    def attempt(strength: float) -> DataFrame | None:
        z = start.withColumn("z", F.col("base"))
        for _ in range(ROUNDS):
            off = 0.0
            for axis in AXES:
                target = F.col(f"mass_{axis}") + F.lit(strength) * (F.col(f"target_{axis}") - F.col(f"mass_{axis}"))
                full = F.col("z") >= F.col("bound")
                sums = z.groupBy(axis).agg(F.sum(F.when(full, F.col("bound")).otherwise(0.0)).alias("held"), F.sum(F.when(full, 0.0).otherwise(F.col("z"))).alias("free"))
                have = F.col("held") + F.col("free")
                factor = F.when((F.col("free") > 0) & (target > F.col("held")), (target - F.col("held")) / F.col("free")).when(have > 0, target / have).otherwise(target)
                z = checkpoint(z.join(sums, axis).withColumn("z", F.col("z") * factor).withColumn("off", F.abs(have - target)).drop("held", "free"))
                off = max(off, z.agg(F.max("off")).first()[0])
                z = z.drop("off")
            if off < TOLERANCE:
                return z.withColumn("share", F.least("z", "bound"))
        return None

    strength, raked = _strongest(attempt)
    found = raked.select(*AXES, "share", F.least(F.lit(1.0), F.col("share") / F.col("bound")).alias("probability"), F.lit(strength).alias("strength"))
    return found.unionByName(cells.where("tokens <= 0").select(*AXES, F.lit(0.0).alias("share"), F.lit(1.0).alias("probability"), F.lit(strength).alias("strength")))


def _category(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("\u0000"))


def cell_columns(seed: int, topic: Column | None = None) -> list[Column]:
    topic = topic_of(F.col("text")) if topic is None else topic.cast("string")
    return [_category("source").alias("source"), _category("lang").alias("lang"), F.coalesce(topic, F.lit("\u0000")).alias("topic"), n_tokens_of(F.col("text")).alias("n_tokens"), uniform_of(seed, "doc_id", "text").alias("u")]


def decide(marked: DataFrame, fraction: float, powers: dict[str, float], given: dict[str, dict[str, float]] | None) -> DataFrame:
    """marked: has source, lang, topic, n_tokens, u. Adds probability and sampled."""
    cells = checkpoint(marked.groupBy(*AXES).agg(F.sum("n_tokens").alias("tokens")))
    odds = calibrate(cells, fraction, powers, given)
    if cells.count() <= LOCAL_CELLS:
        odds = F.broadcast(odds)  # at most LOCAL_CELLS rows
    return marked.join(odds, list(AXES), "left").withColumn("sampled", F.col("u") < F.col("probability"))


def op9(docs: DataFrame, fraction: float = FRACTION, powers: dict[str, float] | None = None, given: dict[str, dict[str, float]] | None = None, seed: int = 11, topic: Column | None = None) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, share (of the cell, of the expected sample), probability, strength, sampled for every row."""
    marked = checkpoint(docs.select("doc_id", *cell_columns(seed, topic)))
    real = lambda c: F.when(F.col(c) != "\u0000", F.col(c)).alias(c)
    return decide(marked, fraction, powers or POWERS, given).select("doc_id", real("source"), real("lang"), "topic", "n_tokens", F.round("share", 12).alias("share"), F.round("probability", 9).alias("probability"), F.round("strength", 9).alias("strength"), "sampled")


def sample(docs: DataFrame, fraction: float = FRACTION, powers: dict[str, float] | None = None, given: dict[str, dict[str, float]] | None = None, seed: int = 11, topic: Column | None = None) -> DataFrame:
    """The sampled rows of docs, all columns."""
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *cell_columns(seed, topic))
    return decide(marked, fraction, powers or POWERS, given).where("sampled").select("row.*")
