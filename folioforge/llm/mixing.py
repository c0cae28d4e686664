"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL functions only.

Each source is cut into blocks of documents. With a target weight w, its j-th block (from 0) is released at slot
floor(j / w) and due before slot ceil((j + 1) / w). At each slot the released block with the earliest deadline runs.
Weights sum to 1, so no slot stays empty, every deadline is met, and every source stays within less than one block of
its weight's share at every slot, however many there are. Weights are exact fractions: whole numbers out of their sum,
about SCALE, so windows are computed in integers and nothing drifts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch

#: Documents of a block. SLOTS slots are given at a time, and so many are sent to all executors. Without a block's size
#: a schedule has at most SLOTS slots, so blocks of tables of over BLOCK * SLOTS rows are larger.
BLOCK, SLOTS = 16, 1 << 18
#: Weights are whole numbers that sum to about this.
SCALE = 1 << 32
#: Default target weights: the number of a source's documents to this power.
TEMPER = 0.5
#: More sources than this aren't sent to all executors (each is a short row).
SEND_SOURCES = 20_000
#: Rows of (id, slot, source, place) that are sent to all executors; more are joined by id.
SEND_ROWS = 500_000


def weighted(counts: DataFrame, weights: DataFrame | None, temper: float = TEMPER) -> DataFrame:
    """(source, n_docs, w): target weights as whole numbers. Sources that `weights` doesn't name, or not above 0, have 0;
    if that is all of them, all weigh the same."""
    if weights is None:
        sized = counts.withColumn("weight", F.pow("n_docs", F.lit(temper)))
    else:
        sized = counts.join(weights.select("source", "weight").where("weight > 0").groupBy("source").agg(F.max("weight").cast("double").alias("weight")), "source", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    total = sized.agg(F.sum("weight")).first()[0] or 0.0
    share = F.col("weight") / F.lit(total) if total else F.lit(1.0) / F.lit(max(1, sized.count()))
    return sized.withColumn("w", F.when(F.col("weight") > 0, F.greatest(F.lit(1), F.round(share * SCALE))).otherwise(0 if total else F.greatest(F.lit(1), F.round(share * SCALE))).cast("long")).select("source", "n_docs", "w")


def chunk_of(sources: int) -> int:
    """Slots of a chunk of the schedule's fold."""
    return max(64, 6 * math.isqrt(sources))


def schedule(plan: DataFrame, slots: int, total: int, sources: int, start: int = 0) -> DataFrame:
    """(source, j, slot, real) of the slots from start, a multiple of chunk_of, up to slots, of a plan (source, w, blocks):
    earliest deadline first among released blocks. real: the source has this block. From a start above 0 the plan's `done`
    is each source's number of blocks before it.

    A block takes the first free slot from its release on that no block with an earlier deadline takes, which is what
    running slot by slot gives. One fold over chunks of slots does it; in each, only the blocks that can run there are
    ranked: of those released before as many as there are slots, and those released in it. So its time goes with
    slots * chunk + chunks * sources, and its state is a short row a source.
    """
    chunk = chunk_of(sources)
    done = F.col("done") if start else F.lit(0)
    one = plan.where("w > 0").agg(F.array_sort(F.collect_list(F.struct("source", "w", "blocks", done.cast("long").alias("done")))).alias("s"))
    release, due = f"j * {total}L div x.w", f"((j + 1) * {total}L + x.w - 1) div x.w"
    block = f"named_struct('d', {due}, 'i', i, 'j', j, 'r', greatest(c, {release}))"
    last = f"((c + {chunk}L) * x.w + {total - 1}L) div {total}L - 1"
    # of blocks released up to the chunk's start only a source's next one can run before another of its own
    old = f"slice(array_sort(flatten(transform(s, (x, i) -> transform(filter(array(acc.done[i]), j -> {release} <= c), j -> {block})))), 1, {chunk})"
    new = f"flatten(transform(s, (x, i) -> transform(filter(sequence(acc.done[i], greatest(acc.done[i], {last})), j -> {release} < c + {chunk} and (j > acc.done[i] or {release} > c)), j -> {block})))"
    given = f"""aggregate(
        array_sort(concat({old}, {new})),
        named_struct('free', transform(sequence(0, {chunk - 1}), k -> c + k), 'got', cast(array() as array<struct<slot: bigint, i: int, j: bigint>>)),
        (a, y) -> transform(array(filter(a.free, f -> f >= y.r)), g -> if(size(g) = 0, a, named_struct(
            'free', array_remove(a.free, get(g, 0)), 'got', concat(a.got, array(named_struct('slot', get(g, 0), 'i', y.i, 'j', y.j))))))[0],
        a -> array_sort(a.got))"""
    # the next block of each source: the greatest of what it was and what follows its blocks given here
    after = "array_sort(concat(transform(acc.done, (v, i) -> named_struct('i', i, 'v', v)), transform(got, g -> named_struct('i', g.i, 'v', g.j + 1))))"
    done = f"transform(array({after}), u -> transform(filter(u, (x, k) -> k = size(u) - 1 or get(u, k + 1).i <> x.i), x -> x.v))[0]"
    step = f"transform(array(q * {chunk}L), c -> transform(array({given}), got -> named_struct('done', {done}, 'picks', concat(acc.picks, array(got))))[0])[0]"
    fold = f"""aggregate(sequence({start // chunk}, {max(start // chunk, -(-slots // chunk) - 1)}),
        named_struct('done', transform(s, x -> x.done), 'picks', cast(array() as array<array<struct<slot: bigint, i: int, j: bigint>>>)),
        (acc, q) -> {step}, acc -> flatten(acc.picks))"""
    named = f"transform({fold}, p -> named_struct('source', s[p.i].source, 'j', p.j, 'slot', p.slot, 'real', p.j < s[p.i].blocks))"
    return one.where("size(s) > 0").select(F.explode(F.expr(named)).alias("p")).select("p.*").where(F.col("slot") < slots)


def planned(scratch: Scratch, counts: DataFrame, weights: DataFrame | None, temper: float, block: int | None) -> tuple[DataFrame, DataFrame, int, int, int, int]:
    """Of (source, n_docs): the plan (source, n_docs, w, blocks), the slots given (source, block, slot) before the first one
    that some source can't fill, the documents of a block, the weights' sum, the number of sources, and that first slot."""
    if block is None:
        block = max(BLOCK, -(-(counts.agg(F.sum("n_docs")).first()[0] or 0) // SLOTS))
    plan = scratch.table(weighted(counts, weights, temper).withColumn("blocks", F.expr(f"n_docs div {block}")))
    whole = plan.agg(F.sum("w").alias("total"), F.count("*").alias("sources")).first()
    total = whole.total or 1
    # by then a source has run out: one of the blocks past its last whole one is due, or there are more slots than blocks
    ends = plan.where("w > 0").agg(F.min(F.expr(f"((blocks + 1) * {total}L + w - 1) div w")).alias("due"), (F.sum("blocks") + 1).alias("all")).first()
    slots = min(ends.due or 0, ends.all or 0)
    # so many slots at a time, each lot from the blocks that were given before it, up to the first that can't be filled
    lot = chunk_of(whole.sources) * max(1, SLOTS // chunk_of(whole.sources))
    given = horizon = None
    for start in range(0, max(1, slots), lot):
        begun = plan
        if start:
            begun = plan.join(given.groupBy("source").agg(F.count("*").alias("done")), "source", "left").withColumn("done", F.coalesce("done", F.lit(0)))
        now = scratch.table(schedule(begun, min(slots, start + lot), total, whole.sources, start))
        given = now if given is None else given.unionByName(now)
        horizon = now.where("not real").agg(F.min("slot")).first()[0]
        if horizon is not None:
            break
    horizon = horizon or 0
    given = given.where(F.col("real") & (F.col("slot") < horizon)).select("source", F.col("j").alias("block"), "slot")
    return plan, given, block, total, whole.sources, horizon


def mixed_rows(docs: DataFrame, weights: DataFrame | None = None, source_col: str = "source", block: int | None = None, temper: float = TEMPER) -> int:
    """How many rows of mix(docs) are in_mix: from the sources' counts alone, without the rows' order. All blocks there are whole."""
    key = F.coalesce(F.col(source_col).cast("string"), F.lit("\u0000"))
    scratch = Scratch(docs.sparkSession, "mixed-rows")
    counts = scratch.table(docs.select(key.alias("source")).groupBy("source").agg(F.count("*").alias("n_docs")))
    _, given, block, *_ = planned(scratch, counts, weights, temper, block)
    return given.count() * block


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", block: int | None = None, temper: float = TEMPER) -> DataFrame:
    """(doc_id, source, block, slot, place, in_mix, weight), a row for every row of docs.

    block: documents of a block; None: BLOCK, or more for tables of over BLOCK * SLOTS rows. weights: (source, weight); a
    source that it doesn't name comes after the mix; None: by TEMPER. weight is the target,
    as scheduled. Within a source, documents come in the order of a hash of their id. slot is the block's slot, place the
    document's place in it; the order of the mix is (slot, place). in_mix tells whether the slot comes before the first
    one that its source can't fill for want of documents: up to there all shares hold within one block. Later rows
    aren't dropped, they follow in the order of (slot, source, place), by deadlines; there sources may share a slot.

    A source with a third of all rows is sorted over many partitions and numbered from their counts, so no task takes
    a whole source. A null source is a source of its own (in the result: null); null ids come last in their source;
    repeated rows are each given a place, ties in arbitrary order. An empty table gives an empty result. Texts are not
    read; other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    key = F.coalesce(F.col(source_col).cast("string"), F.lit("\u0000"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("source"), F.md5(F.col(id_col).cast("long").cast("string").cast("binary")).alias("h"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartitionByRange(n, "source", "h", "doc_id").sortWithinPartitions("source", F.isnull("doc_id"), "h", "doc_id")
    sorted_ = scratch.table(sorted_.select("doc_id", "source", F.monotonically_increasing_id().alias("m")).withColumn("part", F.shiftright("m", 33)))
    # the place within the source: rows of earlier partitions, then the distance from the partition's first
    parts = sorted_.groupBy("source", "part").agg(F.count("*").alias("n"), F.min("m").alias("first"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = scratch.table(parts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))))
    counts = scratch.table(parts.groupBy("source").agg(F.sum("n").alias("n_docs")))
    plan, given, block, total, sources, horizon = planned(scratch, counts, weights, temper, block)
    starts = parts.select("source", "part", "first", "ahead")
    placed = sorted_.join(F.broadcast(starts) if parts.count() <= 10 * SEND_SOURCES else starts, ["source", "part"])
    targets = plan.select("source", "w")
    placed = placed.join(F.broadcast(targets) if sources <= SEND_SOURCES else targets, "source").withColumn("k", F.col("ahead") + F.col("m") - F.col("first"))
    placed = placed.withColumn("block", F.expr(f"k div {block}")).withColumn("place", F.col("k") % block)
    out = placed.join(F.broadcast(given) if horizon <= SLOTS else given, ["source", "block"], "left")
    late = F.expr(f"{horizon}L + ((block + 1) * {total}L + greatest(w, 1L) - 1) div greatest(w, 1L)")
    return out.select("doc_id", F.nullif("source", F.lit("\u0000")).alias("source"), "block", F.coalesce("slot", late).alias("slot"), "place", F.col("slot").isNotNull().alias("in_mix"), (F.col("w") / F.lit(float(total))).alias("weight"))


def in_order(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", block: int | None = None, temper: float = TEMPER) -> DataFrame:
    """Rows of docs, columns untouched, dealt by ranges of the mix's order and sorted within each, so that written
    files, read one after another, are the mixed stream. Rows that share an id come at the first one's place; no row is
    dropped. Nulls and empty tables as in mix; whole texts are moved as they are."""
    scratch = Scratch(docs.sparkSession, "mixed")
    at = F.min(F.struct("slot", F.coalesce("source", F.lit("\u0000")).alias("source"), "place")).alias("at")
    order = scratch.table(mix(docs, weights, id_col, source_col, block, temper).groupBy("doc_id").agg(at).select(F.col("doc_id").alias("_mix_id"), F.expr("at.slot").alias("_slot"), F.expr("at.source").alias("_from"), F.expr("at.place").alias("_place")))
    few = order.count() <= SEND_ROWS
    joined = docs.join(F.broadcast(order) if few else order, docs[id_col].cast("long").eqNullSafe(order["_mix_id"]))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = order["_slot"], order["_from"], order["_place"]
    return joined.repartitionByRange(n, *at).sortWithinPartitions(*at).select(*(docs[c] for c in docs.columns))
