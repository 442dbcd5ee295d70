"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the number of times that the mix takes it, bounded by `most`. Among all rates whose tokens
meet the targets of the sources, those nearest to one (in the relative entropy of rates within 0 and `most`) are an
exponential tilt: `r / (most - r) = e^(l * size / scale) / (most - 1)`, with one multiplier `l` for each source. The
multipliers solve a smooth convex dual; Newton steps, kept within a bracket, find them over the counts of
(source, size). Rates are then rounded to copies so that the tokens of a source come near its target.

DataFrame functions only. What comes to the driver are totals: the sum of sizes, and the number of sources not yet solved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from pairwright.llm.common import WORD, cut, fresh, plain, row_hashes, running_start

#: Sizes up to this are rounded after the larger ones and take up their rest; a source has so many entries at most.
SMALL = 1024
#: Documents of one source and size are dealt to so many groups before they are ranked.
GROUPS = 256
#: Copies of one row that are written out by one task.
PILE = 100_000


def sized(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", *more: Column) -> DataFrame:
    """(doc_id, source, size) and `more`: the number of words, zero for a null text."""
    return docs.select(
        plain(id).alias("doc_id"), plain(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(plain(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *more,
    )


def _key() -> Column:
    """The source as a key that is never null and sorts null last."""
    return F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit("")))


def targets(sources: DataFrame, most: int, weights: tuple[float, ...]) -> DataFrame:
    """(key, source_size, target) from (key, source_size).

    Sources in order of their key have the weights in turn and share the sum of all sizes. A target stops at `most` times
    the size of its source, and what is over is shared again by weight until none is above: the share of one unit of
    weight rises as long as it stops further sources.
    """
    turn = F.array(*[F.lit(float(w)) for w in weights])
    table = cut(
        running_start(sources.withColumn("one", F.lit(1).cast("long")), ["key"], "one", "place")
        .withColumn("weight", F.element_at(turn, (F.pmod("place", F.lit(len(weights))) + 1).cast("int")))
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    )
    total, share = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    level, stopped = (total / share if share else 0.0), -1
    while True:
        stops = F.col("cap") <= F.col("weight") * F.lit(level)
        count, caps, left = table.agg(
            F.count(F.when(stops, 1)), F.coalesce(F.sum(F.when(stops, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0.0)),
        ).first()
        if count == stopped or not left:
            break
        stopped, level = count, (total - caps) / left
    return table.select("key", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def _rate(most: int) -> Column:
    tilt = F.exp(-F.col("multiplier") * F.col("size") / F.col("scale"))
    return F.when(F.col("full"), F.lit(float(most))).otherwise(F.lit(float(most)) / (1 + F.lit(most - 1.0) * tilt))


def solve(cells: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """(key, target, source_size, multiplier, scale, full): the multiplier of each source, by Newton steps.

    A step is one aggregation of the cells (key, size, count) by source, combined before its shuffle, and its result is
    written. A source stops when its tokens are within half a word or a millionth of the target, or when its bracket,
    which every step that is no Newton step halves, has no number left inside; steps go on until all sources have stopped.
    """
    documents = cells.where("size > 0").groupBy("key").agg(F.sum("count").alias("documents"))
    state = cut(
        wanted.join(documents, "key", "left")
        .withColumn("scale", F.greatest(F.lit(1.0), F.col("source_size") / F.col("documents")))
        .withColumn("full", (F.col("target") >= F.lit(float(most)) * F.col("source_size")) & (F.col("source_size") > 0))
        .select("key", "source_size", "target", "scale", "full", F.lit(0.0).alias("multiplier"), F.lit(-1e6).alias("low"),
                F.lit(1e6).alias("high"), (F.col("full") | (F.col("source_size") == 0)).alias("solved"))
    )
    rate = _rate(most)
    while state.where("not solved").limit(1).count():
        sums = (
            cells.join(state.where("not solved"), "key").withColumn("rate", rate)
            .groupBy("key").agg(
                F.sum(F.col("count") * F.col("size") * F.col("rate")).alias("tokens"),
                F.sum(F.col("count") * F.col("size") * F.col("size") * F.col("rate") * (1 - F.col("rate") / most) / F.col("scale")).alias("slope"),
            )
        )
        over = F.col("tokens") > F.col("target")
        near = F.abs(F.col("tokens") - F.col("target")) <= F.greatest(F.lit(0.5), F.col("target") * 1e-6)
        near = near | (F.col("high") - F.col("low") <= 1e-14 * F.greatest(F.abs("high"), F.abs("low")))
        low = F.when(over, F.col("low")).otherwise(F.col("multiplier"))
        high = F.when(over, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") + (F.col("target") - F.col("tokens")) / F.col("slope")
        outward = F.when(F.col("high") >= 1e6, F.greatest(F.lit(1.0), 4 * F.col("low"))).when(
            F.col("low") <= -1e6, F.least(F.lit(-1.0), 4 * F.col("high"))).otherwise((F.col("low") + F.col("high")) / 2)
        moved = (
            state.join(sums, "key", "left")
            .withColumn("solved", F.col("solved") | F.coalesce(near, F.lit(False)))
            .withColumn("low", F.when(F.col("solved"), F.col("low")).otherwise(low))
            .withColumn("high", F.when(F.col("solved"), F.col("high")).otherwise(high))
            .withColumn("multiplier", F.when(F.col("solved"), F.col("multiplier")).when(
                (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high")) & (F.abs(newton - F.col("multiplier")) <= 4), newton
            ).otherwise(outward))
        )
        state = cut(moved.select(*state.columns))
    return state


def round_cells(cells: DataFrame, solved: DataFrame, most: int) -> DataFrame:
    """(key, size, count, copies): how many copies the documents of a source and size get together.

    Large sizes first: in order of size, wanted copies are added up and the sums rounded. What the words then miss or
    exceed is spread over the wanted copies of the sizes up to SMALL, and these are rounded from the largest to the
    smallest, each taking up the rest of those before it, so the words of a source end within its smallest sizes.
    """
    cells = cells.join(solved.select("key", "target", "multiplier", "scale", "full"), "key").withColumn("rate", _rate(most))
    cells = cells.withColumn("wanted", F.col("count") * F.col("rate")).withColumn("most", F.lit(most) * F.col("count"))
    upto = Window.partitionBy("key").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = F.sum("wanted").over(upto)
    large = (
        cells.where(F.col("size") > SMALL)
        .withColumn("copies", F.floor(sums + 0.5) - F.floor(sums - F.col("wanted") + 0.5))
        .withColumn("copies", F.greatest(F.lit(0), F.least("copies", "most")).cast("long"))
    )
    rest = large.groupBy("key").agg(F.sum((F.col("wanted") - F.col("copies")) * F.col("size")).alias("rest"))
    small = (
        cells.where((F.col("size") <= SMALL) & (F.col("size") > 0))
        .groupBy("key").agg(
            F.sort_array(F.collect_list(F.struct("size", "count", "wanted", "most")), asc=False).alias("cells"),
            F.sum(F.col("wanted") * F.col("size")).alias("words"))
        .join(rest, "key", "left").withColumn("grow", F.greatest(F.lit(0.0), 1 + F.coalesce("rest", F.lit(0.0)) / F.col("words")))
    )
    zero = F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<struct<size:bigint,count:bigint,copies:bigint>>").alias("done"))

    def step(acc: Column, cell: Column) -> Column:
        words = cell["wanted"] * F.col("grow") * cell["size"] + acc["carry"]
        copies = F.greatest(F.lit(0), F.least(F.round(words / cell["size"]).cast("long"), cell["most"])).cast("long")
        return F.struct(
            (words - copies * cell["size"]).cast("double").alias("carry"),
            F.concat(acc["done"], F.array(F.struct(cell["size"].alias("size"), cell["count"].alias("count"), copies.alias("copies")))).alias("done"),
        )

    rounded = small.select("key", F.explode(F.aggregate("cells", zero, step)["done"]).alias("c")).select("key", "c.size", "c.count", "c.copies")
    none = cells.where("size = 0").select("key", "size", "count", F.col("count").alias("copies"))
    return large.select("key", "size", "count", "copies").union(rounded).union(none)


def mix(docs: DataFrame, most: int = 3, weights: tuple[float, ...] = (1, 2, 3), id: str = "doc_id", source: str = "source",
        text: str = "text") -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken for every row.

    Null sources are one source, the last; null and empty texts have size zero, take no words and stay once. A source of
    no words has target zero. Very long texts are counted whole; repeated rows count as often as they come; which of
    several documents of one source and size gets a copy more goes by a hash of the id. Reruns agree. An empty table
    gives an empty table, and further columns are ignored. One source or size may hold most rows: documents are ranked
    within GROUPS groups of a source and size, and the groups get their shares from their counts.
    """
    return _mix(sized(docs, id, source, text), most, weights)


def _mix(sizes: DataFrame, most: int, weights: tuple[float, ...]) -> DataFrame:
    """`mix` of a table of (doc_id, source, size); further columns stay."""
    more = [c for c in sizes.columns if c not in ("doc_id", "source", "size")]
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64(*more) if more else F.lit(0)).otherwise(F.xxhash64("doc_id"))
    rows = cut(sizes.withColumn("key", _key()).withColumn("group", F.pmod(spread, F.lit(GROUPS)).cast("int")))
    grouped = cut(rows.groupBy("key", "size", "group").agg(F.count(F.lit(1)).alias("n")))
    cells = cut(grouped.groupBy("key", "size").agg(F.sum("n").alias("count")))
    wanted = cut(targets(cells.groupBy("key").agg(F.sum(F.col("size") * F.col("count")).alias("source_size")), most, weights))
    solved = solve(cells, wanted, most)
    copies = cut(round_cells(cells, solved, most))
    upto = Window.partitionBy("key", "size").orderBy("group").rowsBetween(Window.unboundedPreceding, 0)
    sums = F.sum("n").over(upto)
    part = F.col("more") / F.col("count")
    shares = (
        grouped.join(copies, ["key", "size"])
        .withColumn("base", F.floor(F.col("copies") / F.col("count")))
        .withColumn("more", F.col("copies") - F.col("base") * F.col("count"))
        .withColumn("in_group", (F.floor(sums * part + 0.5) - F.floor((sums - F.col("n")) * part + 0.5)))
        .join(wanted.select("key", "source_size", "target"), "key")
        .select("key", "size", "group", "base", "in_group", "source_size", "target")
    )
    rank = F.row_number().over(Window.partitionBy("key", "size", "group").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id", *more))
    return (
        rows.withColumn("rank", rank).join(shares, ["key", "size", "group"])
        .withColumn("copies", (F.col("base") + F.when(F.col("rank") <= F.col("in_group"), 1).otherwise(0)).cast("long"))
        .select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *more)
    )


def mixed_rows(docs: DataFrame, most: int = 3, weights: tuple[float, ...] = (1, 2, 3), id: str = "doc_id", source: str = "source",
               text: str = "text") -> DataFrame:
    """The rows of `docs`, each as often as `mix` takes it, all columns as they are.

    Rows go by hashes of all their columns (maps aside), not by their id: rows that share an id, null ones too, each have
    copies of their own, and rows equal in every column come together as often as they are taken together. Null and empty
    texts stay once; an empty table stays empty; column names may clash with none used here. Only (hashes, id, source,
    size) are ranked; texts pass one shuffle, repeats merged before it, and many copies of a row are written out in piles.
    """
    first, second = row_hashes(docs)
    sizes = sized(docs, id, source, text, first.alias("first"), second.alias("second"))
    taken = _mix(sizes, most, weights).groupBy("first", "second").agg(F.sum("copies").alias("copies")).where("copies > 0")
    piles = taken.withColumn("pile", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {PILE}"))))
    wanted = cut(piles.select("first", "second", F.least(F.col("copies") - F.col("pile") * PILE, F.lit(PILE)).cast("int").alias("copies")))
    columns = docs.columns
    at, other, copy = (fresh(columns, c) for c in ("_first", "_second", "_copy"))
    hashed = docs.withColumns({at: first, other: second}).dropDuplicates([at, other])
    joined = hashed.join(wanted, (hashed[at] == wanted["first"]) & (hashed[other] == wanted["second"]))
    each = F.explode(F.sequence(F.lit(1), wanted["copies"])).alias(copy)
    return joined.select(*[hashed[f"`{c}`"] for c in columns], each).drop(copy)
