"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapline.llm.common import cut, partitions_for


def _src(c: str = "source") -> Column:
    """A source's name as a join key; the null source gets one too."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def flattened_weights(docs: DataFrame, *, power: float = 0.7, parts: int = 1000) -> DataFrame:
    """Target weights from the sources' sizes raised to ``power``: (source, weight), where the
    weights are whole numbers of at least 1 near ``parts`` in total. Small sources get more than
    their share of rows and large ones less. The table has one row per source."""
    n = cut(docs.groupBy("source").agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(power)).alias("w")),
            "mix-weights")
    total = n.agg(F.sum("w")).first()[0] or 1.0
    return n.select("source", F.greatest(F.round(F.col("w") / total * parts), F.lit(1)).cast("int")
                    .alias("weight"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (a lambda's argument is not expanded again)."""
    return F.transform(F.array(value), body)[0]


def edf_slots(classes: Column, chunk: int = 128) -> Column:
    """One period of the schedule: (i, k) for each slot, i the class and k its running number.

    ``classes`` is an array of (weight, members): so many sources of that weight. Job j of a
    source with weight w out of Q is released at floor(j * Q / w) and due at
    ceil((j + 1) * Q / w). Each of the Q slots takes the released job with the earliest deadline
    (ties: the first class). All deadlines are met, so at every slot each source is less than one
    block away from its share. Members of a class have the same windows and take turns: running
    number k is job k div members of member k mod members. A step looks at every class once, and
    classes are few: weights that differ number at most the root of twice their sum. Slots are
    gathered in pieces of ``chunk``, so that no step copies all slots before it.
    """
    whole = lambda c: c.cast("long")

    def job(c: Column, k: Column, q: Column) -> Column:
        return _let(F.floor(k / c["members"]), lambda j: F.struct(
            F.floor(j * q / c["weight"]).alias("released"),
            F.ceil((j + 1) * q / c["weight"]).alias("due"), whole(k).alias("k")))

    def period(q: Column) -> Column:
        def step(state: Column, t: Column) -> Column:
            first = F.array_min(F.transform(state["jobs"], lambda x, i: F.when(
                x["released"] <= t, F.struct(x["due"].alias("due"), i.alias("i")))))["i"]
            return _let(first, lambda at: F.struct(
                F.transform(state["jobs"], lambda x, i: F.when(
                    i == at, job(F.get(classes, i), x["k"] + 1, q)).otherwise(x)).alias("jobs"),
                F.concat(state["slots"], F.array(F.struct(
                    at.alias("i"), F.get(state["jobs"], at)["k"].alias("k")))).alias("slots")))

        none = F.array().cast("array<struct<i:int,k:bigint>>")

        def piece(state: Column, t: Column) -> Column:
            steps = F.aggregate(F.sequence(t, F.least(t + chunk, q) - 1),
                                F.struct(state["jobs"].alias("jobs"), none.alias("slots")), step)
            return _let(steps, lambda s: F.struct(
                s["jobs"].alias("jobs"), F.concat(state["done"], F.array(s["slots"])).alias("done")))

        start = F.struct(F.transform(classes, lambda c: job(c, whole(F.lit(0)), q)).alias("jobs"),
                         F.array().cast("array<array<struct<i:int,k:bigint>>>").alias("done"))
        return F.aggregate(F.sequence(whole(F.lit(0)), q - 1, whole(F.lit(chunk))), start, piece,
                           lambda s: F.flatten(s["done"]))

    return _let(F.aggregate(classes, whole(F.lit(0)), lambda a, c: a + c["weight"] * c["members"]), period)


def edf_period(weights: Column) -> Column:
    """One period for integer ``weights``, one source each: the index of the source in each slot."""
    alone = F.transform(weights, lambda w: F.struct(
        w.cast("long").alias("weight"), F.lit(1).cast("long").alias("members")))
    return F.transform(_let(alone, lambda c: edf_slots(c)), lambda s: s["i"])


def ranked(sized: DataFrame) -> DataFrame:
    """``sized`` (_src, weight, n_blocks) with _until, the period in which the source has ended,
    and _member, its place among the sources of its weight, those that last longest first: while
    m sources of a weight still run, they are the members below m."""
    runs = sized.withColumn("_until", F.ceil(F.col("n_blocks") / F.col("weight")))
    return runs.withColumn("_member", F.row_number().over(
        Window.partitionBy("weight").orderBy(F.desc("_until"), "_src")).cast("long") - 1)


def schedule(runs: DataFrame) -> DataFrame:
    """Where blocks go: (_phase, _weight, _member, _job, slot), of the sources of :func:`ranked`.

    A period gives each source still running as many slots as its weight. A source with b blocks
    runs for ceil(b / weight) periods; where one ends, a new phase begins with the weights of the
    sources left, so the proportions of the rest stay on target. Phases are numbered by their
    ends, which are the distinct _until. A phase is one row until its slots are told apart: its
    weights and how many sources of each still run. A phase lasts a period or more, so there are
    no more slots here than blocks to mix, besides those of blocks that a last period lacks.
    """
    ends = runs.agg(F.sort_array(F.collect_set("_until")).alias("e"))
    phases = ends.select(F.posexplode("e").alias("_phase", "_until"))
    steps = (runs.groupBy("weight", "_until").agg((F.max("_member") + 1).alias("members"))
             .join(phases, "_until"))
    before = F.lag("_phase").over(Window.partitionBy("weight").orderBy("_phase"))
    classes = (steps.withColumn("_from", F.coalesce(before + 1, F.lit(0)))
               .select(F.explode(F.sequence("_from", "_phase")).alias("_phase"),
                       F.struct(F.col("weight").cast("long").alias("weight"), "members").alias("c"))
               .groupBy("_phase").agg(F.sort_array(F.collect_list("c")).alias("s")))
    slots = classes.select("_phase", "s", F.posexplode(edf_slots(F.col("s"))).alias("slot", "x"))
    c = F.get("s", F.col("x.i"))
    return slots.select("_phase", c["weight"].alias("_weight"), F.col("x.k") % c["members"],
                        F.floor(F.col("x.k") / c["members"]), "slot"
                        ).toDF("_phase", "_weight", "_member", "_job", "slot")


def phase_of(period: Column, ends: list[int]) -> Column:
    """Number of the phase a period lies in: how many of the sorted ``ends`` are at most it,
    looked up in two steps of about the root of their number."""
    size = max(1, int(len(ends) ** 0.5))
    groups = [ends[i:i + size] for i in range(0, len(ends), size)]
    longs = F.from_json(F.lit(str(groups)), "array<array<bigint>>")     # folded to a constant
    passed = lambda a: F.size(F.filter(a, lambda e: e <= period))
    lasts = F.from_json(F.lit(str([g[-1] for g in groups])), "array<bigint>")
    return _let(passed(lasts), lambda g: g * size + passed(F.get(longs, g)))


def number_in_source(docs: DataFrame, key: list[str], rows_per_bucket: int) -> DataFrame:
    """Add ``_n``, the row's place in its source (from 0) in a fixed pseudo-random order.

    A source is cut into buckets by a hash of the key, rows are numbered inside (source, bucket),
    and each bucket starts where the counts of the ones before it end. No task holds a source.
    """
    buckets = partitions_for(docs.count(), rows_per_bucket)
    h = F.xxhash64(*key)
    d = docs.withColumns({"_hash": h, "_bucket": F.pmod(F.shiftrightunsigned(h, 20), F.lit(buckets))})
    inside = Window.partitionBy("_src", "_bucket").orderBy("_hash", *key)
    counts = d.groupBy("_src", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_src", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (d.withColumn("_in", F.row_number().over(inside) - 1).join(starts, ["_src", "_bucket"])
            .withColumn("_n", F.col("_start") + F.col("_in")).drop("_start", "_in", "_bucket", "_hash"))


MIX = ("block", "period", "slot", "place")


def mix(docs: DataFrame, weights: DataFrame | None = None, *, key: list[str] | None = None,
        block_rows: int = 64, rows_per_bucket: int = 500) -> DataFrame:
    """``docs`` with the place of every row in the mix: ordered by (period, slot, place), the
    sources interleave so that at every block boundary each running source is less than one block
    from its target share.

    A source's rows are put in a fixed pseudo-random order and cut into blocks of
    ``block_rows``; blocks take the slots of :func:`schedule`. ``weights`` holds (source, weight)
    with whole-number weights; by default :func:`flattened_weights`. Rows of a source that
    ``weights`` leaves out get weight 1, so no row is lost; when a source ends, the others go on
    in their proportions.

    A null source is a source. Repeated rows are ordered by ``key`` (default: doc_id, then all
    columns of simple type) and each gets a place of its own. Existing columns named block,
    period, slot or place are replaced. No rows, no result.
    """
    simple = [c for c, t in docs.dtypes if not t.startswith(("map", "variant"))]
    key = key or (["doc_id"] if "doc_id" in simple else simple)
    docs = docs.drop(*MIX).withColumn("_src", _src())
    sized = docs.groupBy("_src").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("n_blocks"))
    given = flattened_weights(docs) if weights is None else weights
    given = (given.where("weight > 0").groupBy(_src().alias("_src"))
             .agg(F.max("weight").cast("int").alias("weight")))
    runs = cut(ranked(sized.join(given, "_src", "left").select(
        "_src", "n_blocks", F.coalesce("weight", F.lit(1)).alias("weight"))), "mix-sources")
    plan = cut(schedule(runs), "mix-plan")
    ends = [r[0] for r in runs.select("_until").distinct().orderBy("_until").collect()]  # of sources, not rows
    if not ends:
        return docs.drop("_src").select("*", *(F.lit(None).cast(t).alias(c) for c, t in zip(
            MIX, ("long", "long", "int", "long")))).limit(0)
    few = F.broadcast if runs.count() <= 20_000 else (lambda d: d)      # a few MB: may be broadcast
    small = F.broadcast if plan.count() <= 100_000 else (lambda d: d)
    rows = (number_in_source(docs, key, rows_per_bucket)
            .withColumn("block", F.floor(F.col("_n") / block_rows))
            .join(few(runs.select("_src", F.col("weight").cast("long").alias("_weight"), "_member")), "_src")
            .withColumns({"period": F.floor(F.col("block") / F.col("_weight")),
                          "_job": F.col("block") % F.col("_weight")})
            .withColumn("_phase", phase_of(F.col("period"), ends)))
    return (rows.join(small(plan), ["_phase", "_weight", "_member", "_job"])
            .withColumn("place", F.pmod("_n", F.lit(block_rows)))
            .drop("_src", "_job", "_phase", "_member", "_weight", "_n"))
