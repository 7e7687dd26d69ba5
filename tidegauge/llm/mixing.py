"""Mixing sources to target sizes by entropy balancing.

Each source has a target number of words. Of all rates between 0 and the largest
number of copies that meet the targets, the ones closest to "take every document
once" in relative entropy are an exponential tilt, min(limit, exp(a * size)),
with one multiplier ``a`` per source. The multipliers solve a convex dual by Newton
steps, kept inside a bracket, over counts of (source, size), which are summed up
once; a step is one pass over these counts. Rates become copies by systematic
rounding along each source in order of size: the copies of any stretch differ from
its rates by less than one, so a source's words differ from its target by less
than its largest document.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import shuffle_partitions, text_mark
from tidegauge.plans.shared import files_for, in_fewer_tasks, stored

#: Source weights in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
LIMIT = 2
STEPS = 40
_CLOSE = 1e-9
_SALTS = 256
_SHIFTS = 32
#: Counts are a small part of what they count, so a file takes those of some partitions.
_PARTITIONS_PER_FILE = 16
_STEEPEST = 700.0


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; null has none."""
    return F.coalesce(
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)
    ).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place in code point order, null last; no task holds them all."""
    parts = shuffle_partitions(sources.sparkSession)
    order = [F.col("source").isNull(), F.col("source")]
    placed = stored(
        sources.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    )
    before, offsets = 0, []
    counts = placed.groupBy("part").count().collect()  # one row per partition
    for row in sorted(counts, key=lambda r: r["part"]):
        offsets.append({"part": row["part"], "before": before})
        before += row["count"]
    # From Arrow: a list of rows would pass through Python processes of its own on the executors.
    kinds = pa.schema([("part", pa.int32()), ("before", pa.int64())])
    known = sources.sparkSession.createDataFrame(pa.Table.from_pylist(offsets, kinds))
    inside = Window.partitionBy("part").orderBy(*order)
    return (
        placed.join(F.broadcast(known), "part")
        .withColumn("place", F.col("before") + F.row_number().over(inside) - 1)
        .drop("part", "before")
    )


def targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of ``source`` and ``size``.

    ``share`` of all sizes is split by weight; what a source would get beyond
    ``limit`` times its size is shared anew among the others by weight, until none
    is above. Each round is one sum over the sources.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(sums)
    turn = F.col("place") % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = stored(
        ranked.withColumn("weight", weight).withColumn(
            "most", F.col("source_size") * F.lit(float(limit))
        )
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words per unit of weight of a source below its limit
    while True:
        row = ranked.agg(
            F.sum(F.when(F.col("most") < F.col("weight") * level, F.col("most"))).alias("full"),
            F.sum(F.when(F.col("most") >= F.col("weight") * level, F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break
        found = (share * total - (row["full"] or 0.0)) / row["open"]
        if found <= level * (1 + 1e-12):
            break
        level = found
    return ranked.select(
        "source", "source_size", F.least("most", F.col("weight") * F.lit(level)).alias("target")
    )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _exact(value: Column) -> Column:
    """A decimal, of which sums do not depend on the order: reruns agree."""
    return value.cast("decimal(38,9)")


def _solved(counts: DataFrame, aims: DataFrame, limit: float) -> DataFrame:
    """The multiplier ``tilt`` of every source; null means that every document takes the limit.

    target = sum of size * min(limit, exp(tilt * z)), where ``z`` is the size as a
    share of the source's mean size, so that multipliers have one scale.
    """
    pairs = counts.where("size > 0").withColumnRenamed("source", "c_source")
    total = F.sum(F.col("size") * F.col("n"))
    means = pairs.groupBy("c_source").agg((total / F.sum("n")).alias("mean"))
    files = files_for(counts.count())
    state = stored(
        aims.join(means, _same("source", "c_source"))
        .drop("c_source")
        .withColumn("full", F.col("target") >= F.col("source_size") * (limit * (1 - 1e-12)))
        .withColumns({"tilt": F.lit(0.0), "low": F.lit(-_STEEPEST), "high": F.lit(_STEEPEST)})
        .withColumn("open", ~F.col("full")),
        files,
    )
    power = F.col("tilt") * F.col("size") / F.col("mean")
    free = power < F.log(F.lit(float(limit)))
    words = F.col("n") * F.col("size") * F.when(free, F.exp(power)).otherwise(F.lit(float(limit)))
    slope = F.when(free, words * F.col("size") / F.col("mean")).otherwise(F.lit(0.0))
    for _ in range(STEPS):
        tried = state.where("open").select("source", "mean", "tilt")
        sums = (
            pairs.join(tried, _same("c_source", "source"))
            .groupBy("c_source")
            .agg(F.sum(_exact(words)).alias("got"), F.sum(_exact(slope)).alias("slope"))
        )
        step = (
            state.join(sums, _same("source", "c_source"), "left")
            .withColumn("miss", F.coalesce(F.col("got").cast("double") - F.col("target"), F.lit(0.0)))
            .withColumn("on", F.col("open") & (F.abs("miss") > F.col("target") * _CLOSE))
            .withColumn("low", F.when(F.col("miss") < 0, F.col("tilt")).otherwise(F.col("low")))
            .withColumn("high", F.when(F.col("miss") > 0, F.col("tilt")).otherwise(F.col("high")))
            .withColumn(
                "newton",
                F.col("tilt") - F.try_divide(F.col("miss"), F.col("slope").cast("double")),
            )
        )
        inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        after = F.when(inside, F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2)
        state = stored(
            step.select(
                *["source", "source_size", "target", "mean", "full", "low", "high"],
                F.when(F.col("on"), after).otherwise(F.col("tilt")).alias("tilt"),
                F.col("on").alias("open"),
            ),
            files,
        )
        if state.where("open").isEmpty():
            break
    return state.select("source", "mean", F.when(~F.col("full"), F.col("tilt")).alias("tilt"))


def _shifts(rated: DataFrame, aims: DataFrame) -> DataFrame:
    """Sources with the start of the rounding, out of a few, that comes nearest the target."""
    tried = F.array(*[F.lit((i + 0.5) / _SHIFTS) for i in range(_SHIFTS)])
    begin = F.col("before") + F.col("shift")
    copies = F.floor(begin + F.col("rate") * F.col("n")) - F.floor(begin)
    words = (
        rated.withColumn("shift", F.explode(tried))
        .groupBy("r_source", "shift")
        .agg(F.sum(copies * F.col("r_size")).alias("words"))
    )
    aims = aims.withColumnRenamed("source", "a_source")
    off = F.abs(F.col("words") - F.col("target"))
    return (
        words.join(aims, _same("r_source", "a_source"))
        .groupBy("a_source", "source_size", "target")
        .agg(F.min(F.struct(off.alias("off"), "shift"))["shift"].alias("shift"))
    )


def _decided(
    rows: DataFrame, weights: tuple[float, ...], share: float, limit: int
) -> DataFrame:
    """Rows with key, mark, source and size get source_size, target, rate and copies."""
    salt = F.pmod(F.xxhash64("key", "mark"), F.lit(_SALTS)).cast("int")
    rows = rows.withColumn("salt", salt)
    few = max(1, shuffle_partitions(rows.sparkSession) // _PARTITIONS_PER_FILE)
    cells = stored(rows.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n")), few)
    files = files_for(cells.count())
    counts = stored(cells.groupBy("source", "size").agg(F.sum("n").alias("n")), files)
    aims = targets(
        counts.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, limit
    )
    aims = stored(aims)
    solved = _solved(counts, aims, float(limit)).withColumnRenamed("source", "s_source")
    power = F.col("tilt") * F.col("size") / F.col("mean")
    rate = F.when(power < F.log(F.lit(float(limit))), F.exp(power)).otherwise(F.lit(float(limit)))
    by_size = Window.partitionBy("source").orderBy("size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    by_salt = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rated = stored(
        counts.join(solved, _same("source", "s_source"), "left")
        .withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(F.lit(0.0)))
        .withColumn("owed", F.col("rate") * F.col("n"))
        .withColumn("before", F.sum("owed").over(by_size) - F.col("owed"))
        .select(
            F.col("source").alias("r_source"),
            F.col("size").alias("r_size"),
            *["n", "rate", "before"],
        ),
        files,
    )
    shifted = _shifts(rated, aims)
    inner = F.col("rate") * (F.sum("n").over(by_salt) - F.col("n"))
    placed = stored(
        cells.join(
            rated.drop("n"), _same("source", "r_source") & (F.col("size") == F.col("r_size"))
        )
        .withColumn("inner", inner)
        .join(shifted, _same("source", "a_source"))
        .withColumn("before", F.col("before") + F.col("shift") + F.col("inner"))
        .select(
            F.col("source").alias("p_source"),
            F.col("size").alias("p_size"),
            F.col("salt").alias("p_salt"),
            *["rate", "before", "source_size", "target"],
        ),
        files,
    )
    own = Window.partitionBy("source", "size", "salt").orderBy("key", "mark")
    start = F.col("before") + F.col("rate") * (F.row_number().over(own) - 1)
    copies = F.floor(F.col("start") + F.col("rate")) - F.floor("start")
    total = cells.agg(F.sum("n")).first()[0] or 0
    return in_fewer_tasks(
        rows.join(
            placed,
            _same("source", "p_source")
            & (F.col("size") == F.col("p_size"))
            & (F.col("salt") == F.col("p_salt")),
        )
        .withColumn("start", start)
        .withColumn("copies", F.least(copies, F.lit(limit)).cast("int"))
        .drop("p_source", "p_size", "p_salt", "salt", "start", "before", "mark"),
        total,
    )


def mix_report(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
) -> DataFrame:
    """What the mix takes of every document.

    Returns doc_id, size, source_size, target (of the source), rate, copies and
    taken. A null text has no words; a document without words gets no copies, and
    a source without words has target 0. A null source is a source of its own,
    last in order. Rows with equal or null ids count one by one, in order of a hash of
    their texts. Empty tables give no rows; other columns are ignored. Copies depend
    on the table's rows only, so reruns agree.
    """
    rows = documents.select(
        F.col(key).alias("key"),
        text_mark(F.col(text)).alias("mark"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    return _decided(rows, weights, share, limit).select(
        F.col("key").alias("doc_id"),
        *["size", "source_size", "target", "rate", "copies"],
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Cases are those of ``mix_report``; documents without copies are left out.
    """
    names = documents.columns
    inner = documents.toDF(*[f"c{i}" for i in range(len(names))])
    place = {n.lower(): f"c{i}" for i, n in enumerate(names)}
    rows = inner.select(
        "*",
        F.col(place[key.lower()]).alias("key"),
        text_mark(F.col(place[text.lower()])).alias("mark"),
        F.col(place[source.lower()]).alias("source"),
        word_count(F.col(place[text.lower()])).alias("size"),
    )
    decided = _decided(rows, weights, share, limit).where("copies > 0")
    repeated = decided.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
