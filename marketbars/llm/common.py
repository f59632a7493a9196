"""What several operators share: words, ranks over sorted rows, components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.workspace import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
# A run of several blanks, or one that is not a plain space: what must become one space.
BLANKS = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
# monotonically_increasing_id() keeps a row's place in its partition in the low 33 bits.
PLACE_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame) -> DataFrame:
    """The rows written to the folder of ``spark.checkpoint.dir``: cuts lineage and fixes ids."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def unused(df: DataFrame, name: str) -> str:
    """``name`` behind as many underscores as make it the name of no column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas in it use it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def one_space(text: Column) -> Column:
    """Null as empty, each run of blanks as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Rows with their place, from 0, in the order given; no task sees more than its range.

    Splitters sampled over the data deal the rows out, each partition sorts its
    own, and the places follow from the partitions' counts, of which the driver
    sees one number per partition. ``order`` has to settle all ties that matter.
    The result is checkpointed, so places stay when executors are lost.
    """
    spark = df.sparkSession
    sorted_rows = df.repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order)
    placed = kept(sorted_rows.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    start, offsets = 0, []
    for row in counts:
        offsets.append((row["_part"], start))
        start += row["count"]
    starts = spark.createDataFrame(offsets, "_start_part long, _start long")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), F.col("_part") == F.col("_start_part"))
        .withColumn(name, F.col("_start") + F.col("_id").bitwiseAND((1 << PLACE_BITS) - 1))
        .drop("_id", "_part", "_start_part", "_start")
    )


def _stars(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Each node's higher (both_ways) or all neighbours tied to the least node around it."""
    around = edges
    if both_ways:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    pulled = around.join(least, "a")
    if both_ways:
        return pulled.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return pulled.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(
        least.select("a", F.col("low").alias("b"))
    )


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) links between long ids -> (id, root), root the least id reachable from id.

    Alternates large and small stars: neighbours above a node, then all below
    it, move to the least one, until every node hangs on its root. Nodes without
    a link do not appear. A null end makes no link; repeated links and loops do
    no harm. Each round is a grouped minimum, which combines before the shuffle,
    and a join that adaptive execution splits where one node has many links.
    """
    edges = kept(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    for _ in range(rounds):
        large = _stars(edges, both_ways=True).distinct()
        edges = kept(_stars(large, both_ways=False).distinct())
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen or not state[0]:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    )
