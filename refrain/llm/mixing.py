"""Mixing sources to target weights by entropy balancing.

Sizes are words. Sources in code-point order, null last, weigh ``weights`` in turn and share ``budget`` times
all words; a target stops at ``most`` times its source's size and the excess is shared again by weight until
none is above, which is the water level solved here in closed form.

Rates. Among all document rates between 0 and ``most`` that give every source its target, the ones nearest to
one copy each in relative entropy are ``min(most, exp(lambda * x))``, tilted by ``x``, the size over the mean
size of the source. The convex dual has one ``lambda`` per source; Newton steps, kept inside a bracket, solve
it. Documents of equal source and size have equal rates, so the steps run on counts per source and size: two
small aggregates per step, however long the texts. Sums are decimals, so they do not depend on the order of
rows and reruns agree.

Copies. Documents are sorted by source, size and hash in one range sort that splits a frequent source over many
tasks; running sums of rates (long integers) are rounded, which makes each source miss its target by about one
document. A few more passes turn single documents up or down to come nearer.

Edge cases: a null text has size 0 and takes nothing; a source without words has target 0; a null source is a
source of its own; documents with null or equal ids are rows of their own; an empty table stays empty. Columns
outside ``keep``, the source and the text are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refrain.llm.store import stored

SPACES = " \t\n\x0b\f\r"
UNIT = 1 << 20
STEPS, AT_ONCE = 60, 3


def with_size(docs: DataFrame, text: str, name: str = "size") -> DataFrame:
    """The number of words of every text."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACES))
    size = F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, "[ \t-\r]+")))
    return docs.withColumn(name, size.cast("long"))


def targets(sizes: DataFrame, weights: Sequence[int], budget: float, most: int) -> DataFrame:
    """Source, source_size and target of each source; ``sizes`` has one row per source, so it is small."""
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    shares = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", (most * F.col("source_size")).cast("double"))
    by_level = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumns(
        {
            "all_words": F.sum("source_size").over(everything),
            "full_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    level = (budget * F.col("all_words") - F.col("full_before")) / F.col("weight_left")
    # The level at the first source that is not filled up holds for all that follow.
    first = F.when(level * F.col("weight") <= F.col("cap"), F.struct(F.row_number().over(by_level), level.alias("level")))
    shares = shares.withColumn("first", first)
    open_level = F.min("first").over(everything)["level"]
    target = F.least(F.col("cap"), F.coalesce(open_level * F.col("weight"), F.col("cap")))
    return shares.withColumn("target", target).select("source", "source_size", "target")


def _decimal(column):
    return F.sum(column.cast("decimal(38,9)"))


def _newton(cells: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """One step of every source that is not done: Newton inside the bracket, else bisection."""
    x = F.col("c.size") / F.col("t.mean")
    words, top = F.col("c.n") * F.col("c.size"), F.log(F.lit(cap))
    rate = F.exp(F.least(top, F.col("t.lam") * x))
    open_cells = cells.alias("c").join(
        state.filter("not done").alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))
    )
    sums = open_cells.groupBy("c.source").agg(
        _decimal(words * rate).alias("got"),
        _decimal(F.when(F.col("t.lam") * x < top, words * rate * x).otherwise(0.0)).alias("slope"),
    )
    got, slope, lam = F.col("s.got").cast("double"), F.col("s.slope").cast("double"), F.col("t.lam")
    low = F.when(got > F.col("t.target"), F.col("t.low")).otherwise(lam)
    high = F.when(got > F.col("t.target"), lam).otherwise(F.col("t.high"))
    newton = lam - (got - F.col("t.target")) / slope
    inside = (slope > 0) & (newton > low) & (newton < high)
    near = F.abs(got - F.col("t.target")) <= 1e-6 * F.col("t.target") + 1e-6
    done = F.col("t.done") | F.coalesce(near, F.lit(True))
    return state.alias("t").join(sums.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")), "left").select(
        "t.source",
        "t.target",
        "t.mean",
        "t.full",
        F.when(done, lam).when(inside, newton).otherwise((low + high) / 2).alias("lam"),
        F.when(done, F.col("t.low")).otherwise(low).alias("low"),
        F.when(done, F.col("t.high")).otherwise(high).alias("high"),
        done.alias("done"),
    )


def solve_rates(cells: DataFrame, goals: DataFrame, most: int) -> DataFrame:
    """Rate (in units of 2^-20) per cell of source and size.

    ``cells``: source, size, n; ``goals``: source, source_size, target. A few steps are chained before their
    state, one row per source, is written.
    """
    cap = float(most)
    cells = cells.filter("size > 0")
    docs = cells.groupBy("source").agg(F.sum("n").alias("docs"))
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = stored(
        goals.alias("g")
        .join(docs.alias("s"), F.col("g.source").eqNullSafe(F.col("s.source")))
        .select(
            "g.source",
            "target",
            (F.col("source_size") / F.col("docs")).alias("mean"),
            full.alias("full"),
            F.lit(0.0).alias("lam"),
            F.lit(-1e4).alias("low"),
            F.lit(1e4).alias("high"),
            full.alias("done"),
        ),
        "mix-state",
    )
    for _ in range(STEPS // AT_ONCE):
        for _ in range(AT_ONCE):
            state = _newton(cells, state, cap)
        state = stored(state, "mix-state")
        if state.filter("not done").isEmpty():
            break
    tilt = F.exp(F.least(F.log(F.lit(cap)), F.col("t.lam") * F.col("c.size") / F.col("t.mean")))
    rate = F.when(F.col("t.full"), F.lit(cap)).otherwise(tilt)
    return cells.alias("c").join(state.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select(
        "c.source", "c.size", F.round(rate * UNIT).cast("long").alias("rate")
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    keep: Sequence[str] = (),
    weights: Sequence[int] = (5, 2, 1),
    budget: float = 1.5,
    most: int = 2,
    turns: int = 8,
) -> DataFrame:
    """``keep`` with row, size, source_size, target and copies (0 to ``most``) of every document.

    ``keep`` rides through two shuffles; leave long texts out and join them by ``key``. Columns of ``keep`` come
    back under their names, the operator's own columns are row, source, size, source_size, target and copies.
    """
    slim = with_size(
        docs.select(
            *[F.col(c).alias(f"keep_{c}") for c in keep],
            F.col(source).cast("string").alias("source"),
            F.xxhash64(F.col(key).cast("string")).alias("h"),
            F.col(text).alias("text"),
        ),
        "text",
    ).drop("text")
    slim = stored(slim, "mix-sizes")
    cells = stored(slim.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-cells")
    sizes = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goals = stored(targets(sizes, weights, budget, most), "mix-goals")
    rates = solve_rates(cells, goals, most)
    cell_rates = stored(
        cells.alias("c")
        .join(rates.alias("r"), F.col("c.source").eqNullSafe(F.col("r.source")) & (F.col("c.size") == F.col("r.size")), "left")
        .join(goals.alias("g"), F.col("c.source").eqNullSafe(F.col("g.source")))
        .select("c.source", "c.size", F.coalesce("r.rate", F.lit(0)).alias("rate"), "g.source_size", "g.target"),
        "mix-rates",
    )
    rated = (
        slim.alias("d")
        .join(cell_rates.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d.size") == F.col("r.size")))
        .select("d.*", "r.rate", "r.source_size", "r.target")
    )
    ranged = stored(rated.repartitionByRange("source", "size", "h").withColumn("part", F.spark_partition_id()), "mix-sorted")
    sums = ranged.groupBy("source", "part").agg(F.sum("rate").alias("sum"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"))
    running = Window.partitionBy("part", "source").orderBy("size", "h").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranged.withColumn("sum", F.sum("rate").over(running))
        .alias("d")
        .join(starts.alias("s"), (F.col("d.part") == F.col("s.part")) & F.col("d.source").eqNullSafe(F.col("s.source")))
        .withColumn("sum", F.col("d.sum") + F.col("s.start") + UNIT // 2)
    )
    placed = placed.select(
        *[f"d.keep_{c}" for c in keep], "d.source", "d.size", "d.h", "d.source_size", "d.target",
        (F.floor(F.col("sum") / UNIT) - F.floor((F.col("sum") - F.col("d.rate")) / UNIT)).cast("int").alias("copies"),
    )
    placed = stored(placed.withColumn("row", F.monotonically_increasing_id()), "mix-copies")
    counts = stored(placed.groupBy("source", "size", "copies", "target").agg(F.min(F.struct("h", "row"))["row"].alias("row"), F.count("*").alias("n")), "mix-counts")
    turned = _turned(counts, most, turns)
    return placed.join(turned, "row", "left").select(
        "row",
        *[F.col(f"keep_{c}").alias(c) for c in keep],
        "source",
        "size",
        "source_size",
        "target",
        (F.col("copies") + F.coalesce("change", F.lit(0))).alias("copies"),
    )


def _turned(counts: DataFrame, most: int, turns: int) -> DataFrame:
    """Row and change (1 or -1) of the documents that bring each source nearer to its target.

    ``counts`` has one row per source, size and number of copies with the row of least hash of each; a pass
    takes the largest document that fits into what is missing or over, and never the same cell twice.
    """
    change = None
    miss = counts.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("n") * F.col("size") * F.col("copies")).alias("got"))
    miss = stored(miss.select("source", (F.col("target") - F.col("got")).alias("miss")), "mix-miss")
    for _ in range(turns):
        rest = counts if change is None else counts.join(change.select("row"), "row", "left_anti")
        fits = rest.alias("c").join(miss.alias("m"), F.col("c.source").eqNullSafe(F.col("m.source")))
        up = (F.col("m.miss") > 0) & (F.col("c.copies") < most) & (F.col("c.size") <= F.col("m.miss"))
        down = (F.col("m.miss") < 0) & (F.col("c.copies") > 0) & (F.col("c.size") <= -F.col("m.miss"))
        one = fits.filter((F.col("c.size") > 0) & (up | down)).groupBy("c.source").agg(
            F.max(F.struct("c.size", "c.copies", "c.row", F.signum("m.miss").cast("int").alias("change"))).alias("best")
        )
        one = stored(one.select("source", "best.*"), "mix-turn")
        if one.isEmpty():
            break
        miss = stored(
            miss.alias("m")
            .join(one.alias("o"), F.col("m.source").eqNullSafe(F.col("o.source")), "left")
            .select("m.source", (F.col("miss") - F.coalesce(F.col("o.size") * F.col("change"), F.lit(0))).alias("miss")),
            "mix-miss",
        )
        one = one.select("row", "change")
        change = one if change is None else stored(change.union(one), "mix-change")
    return change if change is not None else counts.sparkSession.createDataFrame([], "row long, change int")
