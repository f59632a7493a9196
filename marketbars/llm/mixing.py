"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies each of its documents
should have; the whole part is given to all, the fraction is rounded. Pivotal
rounding pairs two fractional documents and moves mass (fraction times size)
from one to the other, at random but fair in expectation, until one of them is
whole; the other goes on to the next pair. So every source keeps its mass to
the last pair. The pairs form a reduction tree: documents of a source, in order
of size, are folded in groups of ``FAN``, what each group leaves over is folded
again, until one fraction is left per source, which goes to the nearer side.
The document left is the largest as a rule, and half of it may be much for a
small source. So the source's smallest documents that were rounded the other way
are turned until they make up for it, or there are no more that would help.
Only built-in functions run; no task sees more than ``FAN`` documents of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.common import kept, let, n_words, ranked, unused

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all sizes
MOST = 2  # copies
FAN = 256
SEED = 42
UNIT = ("rank", "row", "doc_id", "size")
FEW_SOURCES = 50_000  # as many may be broadcast: some 40 bytes each


def _nearer(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= FEW_SOURCES else df


def source_targets(placed: DataFrame) -> tuple[DataFrame, int, int]:
    """Per source: size, first rank, target; the number of sources; the most rows of one.

    Targets share SHARE of all sizes by weight; one that would pass MOST times
    its source's size stops there, and what it leaves is shared again.
    """
    sources = placed.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.count(F.lit(1)).alias("n"),
        F.min("rank").alias("first"),
    )
    order = ranked(sources, F.col("source").asc_nulls_last(), name="place")
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), F.pmod("place", F.lit(len(WEIGHTS))).cast("int") + 1
    ).cast("double")
    weighed = kept(
        order.withColumns({"weight": weight, "cap": F.col("source_size") * float(MOST)})
    )
    total = weighed.agg(
        F.sum("source_size").alias("size"),
        F.sum("weight").alias("weight"),
        F.count(F.lit(1)).alias("n"),
        F.max("n").alias("most"),
    ).first()
    if not total["n"]:
        return weighed.withColumn("target", F.lit(0.0)), 0, 0
    goal, level, capped = SHARE * total["size"], SHARE * total["size"] / total["weight"], -1
    while True:  # each round caps one source more at least
        above = F.col("cap") <= F.col("weight") * level
        state = weighed.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, F.col("cap")).otherwise(0.0)).alias("full"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if state["n"] == capped or not state["open"]:
            break
        capped, level = state["n"], (goal - state["full"]) / state["open"]
    target = F.least(F.col("cap"), F.col("weight") * level)
    return weighed.withColumn("target", target), total["n"], total["most"]


def _chance(a: Column, b: Column) -> Column:
    low = F.xxhash64(F.lit(SEED), a["rank"], b["rank"]).bitwiseAND(F.lit((1 << 53) - 1))
    return low / float(1 << 53)


def _with_p(unit: Column, p: Column) -> Column:
    return F.struct(*(unit[name].alias(name) for name in UNIT), p.alias("p"))


def _pair(state: Column, b: Column) -> Column:
    """One step: of the unit carried and the next one, one becomes whole."""
    a, one = state["carried"], F.lit(1.0)

    def moved(v: Column) -> Column:
        pa, pb, ratio = a["p"], b["p"], v["ratio"]
        up, whole = v["up"], v["whole"]
        new_a = F.when(up, F.when(whole, one).otherwise(pa + pb * ratio)).otherwise(
            F.when(whole, 0.0).otherwise(pa - (one - pb) * ratio)
        )
        new_b = F.when(up, F.when(whole, pb - (one - pa) / ratio).otherwise(0.0)).otherwise(
            F.when(whole, pb + pa / ratio).otherwise(one)
        )
        return F.struct(whole.alias("whole"), _with_p(a, new_a).alias("a"),
                        _with_p(b, new_b).alias("b"))

    def choice(r: Column) -> Column:
        rise = F.least(one - a["p"], b["p"] * r)
        fall = F.least(a["p"], (one - b["p"]) * r)
        up = _chance(a, b) * (rise + fall) < fall
        whole = F.when(up, one - a["p"] <= b["p"] * r).otherwise(a["p"] <= (one - b["p"]) * r)
        return F.struct(r.alias("ratio"), up.alias("up"), whole.alias("whole"))

    ratio = b["size"] / a["size"]
    return let(
        let(let(ratio, choice), moved),
        lambda m: F.struct(
            F.when(m["whole"], m["b"]).otherwise(m["a"]).alias("carried"),
            F.concat(
                state["done"], F.array(F.when(m["whole"], m["a"]).otherwise(m["b"]))
            ).alias("done"),
        ),
    )


def _fold(units: Column) -> Column:
    """Units of a group -> struct of the one carried on and those done."""
    first = units[0]
    return F.aggregate(
        F.slice(units, 2, F.size(units)),
        F.struct(first.alias("carried"), F.slice(units, 1, 0).alias("done")),
        _pair,
    )


SOURCE = ["source", "source_size", "target", "base"]


def _absorbed(whole: DataFrame, n_sources: int) -> DataFrame:
    """Rows with what their source misses made up by turning its smallest documents.

    Sizes are counted per source, so the running sum sees a source's distinct
    sizes, not its rows. All documents below a size turn, and of that size as
    many as come nearest; those are found by place in a hashed order.
    """
    missing = whole.groupBy("source", "target").agg(
        F.sum((F.col("base") + F.col("p")) * F.col("size")).alias("taken")
    )
    missing = kept(missing.select("source", (F.col("target") - F.col("taken")).alias("miss")))
    # Turning a document of more than twice what is missing would miss by more.
    helps = (
        F.col("free")
        & (F.col("p") == F.when(F.col("miss") > 0, 0.0).otherwise(1.0))
        & (F.col("size") < 2 * F.abs("miss"))
    )

    def beside(rows: DataFrame, stats: DataFrame) -> DataFrame:
        stats = stats.withColumnRenamed("source", "_source")
        same = F.col("source").eqNullSafe(F.col("_source"))
        return rows.join(_nearer(stats, n_sources), same, "left").drop("_source")

    sizes = beside(whole, missing).where(helps).groupBy("source", "size", "miss").count()
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum(F.col("count") * F.col("size")).over(smaller), F.lit(0))
    wanted = F.round((F.abs("miss") - before) / F.col("size"))
    turns = sizes.withColumn("turns", F.least(F.col("count"), wanted)).where("turns > 0")
    plan = turns.groupBy("source").agg(
        F.max(F.when(F.col("turns") == F.col("count"), F.col("size"))).alias("all_to"),
        F.max(F.when(F.col("turns") < F.col("count"), F.struct("size", "turns"))).alias("some"),
    )
    plan = kept(beside(missing, plan))
    planned = beside(whole, plan).withColumn("helps", F.coalesce(helps, F.lit(False)))
    edge = F.col("helps") & F.coalesce(F.col("size") == F.col("some.size"), F.lit(False))
    places = ranked(
        planned.where(edge),
        F.col("source").asc_nulls_last(),
        F.xxhash64(F.lit(SEED), "rank"),
        F.col("rank"),
        name="place",
    )
    first = places.groupBy("source").agg(F.min("place").alias("first_place"))
    some = beside(places, first).withColumn(
        "turn", F.col("place") - F.col("first_place") < F.col("some.turns")
    )
    others = planned.where(~edge).withColumn(
        "turn", F.col("helps") & F.coalesce(F.col("size") <= F.col("all_to"), F.lit(False))
    )
    turned = F.when(F.col("turn"), 1 - F.col("p")).otherwise(F.col("p")).alias("p")
    columns = [c for c in whole.columns if c != "p"]
    return others.select(*columns, turned).union(some.select(*columns, turned))


def mix(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Every row's share: doc_id, size, source_size, target, taken, copies.

    With ``row``, a column of fixed long numbers, the result has that column too.

    ``docs`` has doc_id, source and text; null text has size 0, a null source is
    one of its own and comes last. Rows that repeat are rounded each. Documents
    without words take no part and get 0. An empty table gives no rows. Chances
    are hashes of places in the order (source, size, doc_id), so reruns agree.
    """
    number = F.col(row) if row else F.lit(None).cast("long")
    rows = kept(
        docs.select("doc_id", number.alias("row"), "source", n_words(F.col("text")).alias("size"))
    )
    placed = ranked(rows, F.col("source").asc_nulls_last(), F.desc("size"), F.col("doc_id"), F.col("row"))
    targets, n_sources, most = source_targets(placed)
    stats = targets.select(F.col("source").alias("_source"), "source_size", "first", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = (
        placed.join(
            _nearer(stats, n_sources), F.col("source").eqNullSafe(F.col("_source"))
        )
        .withColumn("base", F.floor(rate))
        .withColumn("p", rate - F.col("base"))
        .withColumn("chunk", F.floor((F.col("rank") - F.col("first")) / FAN))
        .select(*UNIT, "p", "chunk", *SOURCE)
    )
    fractional = (F.col("p") > 0) & (F.col("size") > 0)
    done = [
        units.where(~fractional).select(
            *UNIT, *SOURCE, F.lit(False).alias("free"), F.lit(0.0).alias("p")
        )
    ]
    free = F.lit(True).alias("free")
    left, groups = units.where(fractional), -(-most // FAN)
    while True:
        unit = F.struct(*UNIT, "p")
        folded = kept(
            left.groupBy(*SOURCE, "chunk")
            .agg(F.sort_array(F.collect_list(unit)).alias("units"))
            .select(*SOURCE, "chunk", _fold(F.col("units")).alias("f"))
        )
        done.append(
            folded.select(*SOURCE, F.explode("f.done").alias("u")).select(
                *(f"u.{name}" for name in UNIT), *SOURCE, free, "u.p"
            )
        )
        left = folded.select(
            "f.carried.*", F.floor(F.col("chunk") / FAN).alias("chunk"), *SOURCE
        )
        if groups <= 1:
            break
        groups = -(-groups // FAN)
    done.append(left.select(*UNIT, *SOURCE, free, "p"))
    whole = done[0]
    for part in done[1:]:
        whole = whole.union(part)
    whole = kept(whole.withColumn("p", F.round("p")))
    copies = (F.col("base") + F.col("p")).cast("long")
    return _absorbed(whole, n_sources).select(
        *([F.col("row").alias(row)] if row else []),
        "doc_id",
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).alias("taken"),
        copies.alias("copies"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns.

    Documents without words stay as they are. Every row has copies of its own,
    also one without an id or with another's: rows are numbered for that, and
    kept with their numbers until the copies are made.
    """
    row, own, copies, copy = (unused(docs, name) for name in ("_row", "_own", "_copies", "_copy"))
    numbered = kept(docs.withColumn(row, F.monotonically_increasing_id()))
    shares = (
        mix(numbered, row)
        .select(
            F.col(row).alias(own),
            F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).alias(copies),
        )
        .where(F.col(copies) > 0)
    )
    return (
        numbered.join(shares, F.col(row) == F.col(own))
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
        .select(*docs.columns)
    )
