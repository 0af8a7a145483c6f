"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source is put in a fixed shuffled order and cut into blocks of equally many words.
Slot t of the mix draws the golden-ratio point frac((t + 1) / phi), which falls into the
interval of one source among the cumulated shares. The slots of a source are ranked, and
rank k is joined to the source's k-th block, starting over when the blocks are used up.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.llm.common import pick, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_TIMES = 3
BLOCK = 1024
#: Cells of the unit interval in which points and sources meet, points per run of slots.
GRID, RUN = 4096, 1 << 14
GOLDEN = (math.sqrt(5) - 1) / 2
STEP = 1 << 20


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None
) -> DataFrame:
    """(row, doc_id, print, source, size): words of each row; a null text has none, a null source is a source.

    row tells rows of one id apart, and holds once the table is written: ``row_col``, or a
    number. print is a hash of the text, by which rows of one id are put in a fixed order.
    """
    row = {"row": row_col} if row_col else {}
    source = pick(docs, doc_id=id_col, text=text_col, source=source_col, **row)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    number = F.col("row") if row_col else F.monotonically_increasing_id()
    return source.select(number.alias("row"), "doc_id", F.xxhash64("text").alias("print"), F.col("source").cast("string").alias("source"), size.alias("size"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """(source, number, source_size, target): words wanted of each source, one row for each.

    Sources in order of code points, null last, take the weights in turn and share all words.
    A target stops at ``most_times`` the source's words; the excess goes to the others by weight.
    With sources in order of cap / weight, the common level is the largest of
    (words - caps before) / (weights from here on).
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    own = total.withColumn("number", F.row_number().over(order) - 1).withColumn("weight", weight).withColumn("cap", F.lit(float(most_times)) * F.col("source_size"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "number")
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    everything = W.partitionBy()
    level = F.max((F.col("words") - F.col("before")) / F.col("rest")).over(everything)
    steps = own.select("*", before.alias("before"), rest.alias("rest"), F.sum("source_size").over(everything).alias("words"))
    return steps.select("source", "number", "source_size", F.least(F.col("weight") * level, F.col("cap")).alias("target"))


def queues(sizes: DataFrame, seed: int) -> DataFrame:
    """Adds each row's first word's place in the shuffled order of its source; runs jobs.

    Sampled ranges of all sources' orders are sorted on their own; places add up inside a
    range and over the ranges before it, so that no source and no id is in one task.
    """
    order = ["number", "key", "doc_id", "size", "print", "row"]
    spread = sizes.withColumn("key", F.xxhash64("doc_id", F.lit(seed))).repartitionByRange(*order).sortWithinPartitions(*order)
    spread = written(spread.drop("key", "print").withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "queues")
    totals = spread.groupBy("number", "part").agg(F.sum("size").alias("words"))
    ahead = W.partitionBy("number").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = written(totals.select("number", "part", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base")), "bases")
    inside = W.partitionBy("number", "part").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    placed = spread.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(base, ["number", "part"]).withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside", "at", "part")


def draws_of(ids: DataFrame, plan: DataFrame, total: int) -> DataFrame:
    """(number, rank) of ids below ``total``, the sum of all draws: the draws of all sources one after the other, source by source."""
    after = F.sum("draws").over(W.orderBy("number"))
    stretch = plan.where("draws > 0").select("number", (after - F.col("draws")).alias("first"), after.alias("after"))
    cell = lambda place: F.floor(place / (total / GRID))
    stretch = stretch.withColumn("cell", F.explode(F.sequence(cell(F.col("first")), cell(F.col("after") - 1))))
    met = ids.withColumn("cell", cell(F.col("id"))).join(stretch, "cell").where("id >= first and id < after")
    return met.select("number", (F.col("id") - F.col("first")).alias("rank"))


def schedule(plan: DataFrame, spark) -> DataFrame:
    """(number, rank, slot): which source each slot of the mix draws, and which of its draws this is; runs a job.

    plan: (number, draws), a row for each source. A source has all its draws: points that fall
    to a source that has none left are skipped, and draws that got no point come last, in
    order of their rank. Slots and draws are made in ranges, many tasks to a source.
    """
    ahead = W.orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    total = plan.agg(F.sum("draws")).first()[0] or 0
    low = F.coalesce(F.sum("draws").over(ahead), F.lit(0)) / F.sum("draws").over(everything)
    high = F.sum("draws").over(ahead.rowsBetween(W.unboundedPreceding, 0)) / F.sum("draws").over(everything)
    parts = plan.where("draws > 0").select("number", low.alias("low"), high.alias("high"))
    cells = F.sequence(F.floor(F.col("low") * GRID), F.least(F.floor(F.col("high") * GRID), F.lit(GRID - 1)))
    parts = parts.withColumn("cell", F.explode(cells))
    t = F.col("id") + 1
    turned = F.floor(t / STEP) * ((STEP * GOLDEN) % 1) + (t % STEP) * GOLDEN
    points = spark.range(total).select(F.col("id").alias("slot"), (turned - F.floor(turned)).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * GRID)).withColumn("run", F.floor(F.col("slot") / RUN))
    drawn = points.join(parts, "cell").where("point >= low and point < high").select("slot", "run", "number")
    runs = drawn.groupBy("number", "run").agg(F.count("*").alias("n"))
    base = runs.select("number", "run", F.coalesce(F.sum("n").over(W.partitionBy("number").orderBy("run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.row_number().over(W.partitionBy("number", "run").orderBy("slot")) - 1
    ranked = drawn.withColumn("inside", inside).join(base, ["number", "run"]).select("number", (F.col("base") + F.col("inside")).alias("rank"), "slot")
    wanted = draws_of(spark.range(total), plan, max(1, total))
    return wanted.join(ranked, ["number", "rank"], "left").select("number", "rank", F.coalesce("slot", F.col("rank") + total).alias("slot"))


def mix(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_times: int = MOST_TIMES, block: int = BLOCK, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(pieces, sources) of the mix of all rows in ``sizes``, as ``word_counts`` gives them; runs jobs.

    pieces: (row, doc_id, slot, epoch, word_from, word_to): the words of the row that the
    slot's block holds, in the epoch-th use of the source. sources: as ``targets``. The last
    block of a source's last use is cut so that the source gives its target, rounded. Equal
    inputs give equal mixes. Rows of one id are documents of their own, in order of size and
    print; which of two rows alike in all of this comes first makes no difference. Rows
    without words are in no piece, and an empty table has no pieces.
    """
    spark = sizes.sparkSession
    sizes = sizes if hasattr(sizes, "written_to") else written(sizes, "sizes")
    sources = written(targets(sizes, weights, most_times), "targets")
    own = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select("row", "doc_id", "print", "size", "number")
    placed = queues(own.where("size > 0"), seed)
    blocks = F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))
    spans = placed.select("row", "doc_id", "number", "start", "size", F.explode(blocks).alias("block"))
    counted = sources.select("number", "source_size", F.round("target").cast("long").alias("want"), F.ceil(F.col("source_size") / block).alias("blocks"))
    counted = counted.select("*", F.expr("case when source_size > 0 then want div source_size else 0 end").alias("full")).withColumn("rest", F.col("want") - F.col("full") * F.col("source_size"))
    plan = counted.select("*", (F.col("full") * F.col("blocks") + F.ceil(F.col("rest") / block)).alias("draws"))
    drawn = schedule(plan.select("number", "draws"), spark).join(plan.where("draws > 0"), "number")
    drawn = drawn.select(
        "number",
        "slot",
        F.expr("rank div blocks").alias("epoch"),
        F.expr("rank % blocks").alias("block"),
        F.expr("case when rank div blocks = full then rest else source_size end").alias("until"),
    )
    pieces = spans.join(drawn, ["number", "block"])
    first = F.greatest(F.col("start"), F.col("block") * block)
    last = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block, F.col("until"))
    pieces = pieces.select("row", "doc_id", "slot", "epoch", (first - F.col("start")).alias("word_from"), (last - F.col("start")).alias("word_to"))
    return pieces.where("word_to > word_from"), sources


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row with an id; runs jobs.

    Rows without words, null texts among them, are never taken. Repeated rows and rows of
    one id are documents of their own; ``taken`` is what the mix takes of that row.
    """
    sizes = written(word_counts(docs), "sizes")
    pieces, sources = mix(sizes)
    taken = pieces.groupBy("row").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    told = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select("row", "doc_id", "size", "source_size", "target")
    return told.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, all columns: a row for each use of a document, cut to the words taken; runs jobs.

    A whole use keeps the text as it is; a cut one has its words joined by blanks, and
    ``n_chars``, where there is one, counts its characters. Rows without an id or without
    words are not in the mix. Rows of one id are documents of their own: where an id repeats,
    the table is written once with a number for each row.
    """
    columns, key = docs.columns, "doc_id"
    sizes = written(word_counts(docs), "sizes")
    if not sizes.groupBy("doc_id").count().where("count > 1").isEmpty():
        docs, key = written(docs.withColumn("__row", F.monotonically_increasing_id()), "rows"), "__row"
        sizes = written(word_counts(docs, row_col=key), "sizes")
    pieces, _ = mix(sizes)
    uses = pieces.withColumn("__row", F.col("row")).groupBy(F.col(key).alias("__key"), "epoch")
    uses = uses.agg(F.min("word_from").alias("__from"), F.max("word_to").alias("__to")).drop("epoch")
    joined = docs.join(uses, docs[key] == uses["__key"])
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = (F.col("__from") > 0) | (F.col("__to") < F.regexp_count("text", F.lit(WORD)))
    text = F.when(cut, F.array_join(F.slice(words, (F.col("__from") + 1).cast("int"), (F.col("__to") - F.col("__from")).cast("int")), " ")).otherwise(F.col("text"))
    out = joined.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)
