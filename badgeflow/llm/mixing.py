"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

1. Targets: the sources share all words by weight; none gets more than ``cap`` times
   its own size, and what it cannot take is shared by weight among the others.
2. Draws: a source's documents stand in one seeded permutation. The source is read
   through as often as its target holds its size, then up to the words that remain.
   A block is one document; only the last one of a source may be cut.
3. Shards: the exact draw counts of all sources are split down a binary tree over the
   output shards. Each node deals its counts to its two halves by a multivariate
   hypergeometric draw, so every shard is a fair sample and all sums are exact.
4. Each shard owns disjoint ranges of the permutations and is shuffled by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from badgeflow.llm.common import DOCUMENT_COLUMNS, let, stored, table, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
SHARDS = 8
SEED = 20240229


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, ...) with ``target``: one row per source.

    Sources at their cap are those with the least size per weight. In that order, a
    source is capped if the share left for it and all later ones exceeds its cap.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(w) for w in weights])
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    weighed = (
        sizes.withColumn("weight", cycle[(F.row_number().over(order) - 1) % len(weights)].cast("double"))
        .withColumn("limit", F.lit(float(cap)) * F.col("source_size"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("words", F.sum("source_size").over(everything).cast("double"))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0)))
        .withColumn("words_left", F.col("words") - F.coalesce(F.sum("limit").over(by_ratio), F.lit(0.0)))
        .withColumn("capped", F.col("words_left") / F.col("weight_left") > F.col("ratio"))
    )
    # The share per weight of those under their cap: the first of them sees what all capped ones left.
    first = F.struct((-F.col("ratio")).alias("order"), (F.col("words_left") / F.col("weight_left")).alias("share"))
    share = F.max(F.when(~F.col("capped"), first)).over(everything)
    return weighed.withColumn("share", share["share"]).select(
        *sizes.columns,
        F.when(F.col("capped"), F.col("limit"))
        .otherwise(F.least(F.col("limit"), F.col("weight") * F.col("share")))
        .alias("target"),
    )


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``marked`` among ``total`` are in ``drawn``: the inverse of the
    distribution at u in (0, 1), from ratios of neighbouring probabilities.

    Terms over 12 standard deviations from the mode are below 1e-30 and left out.
    """

    def solve(a: Column) -> Column:
        n, k, d = a["n"], a["k"], a["d"]
        lowest = F.greatest(F.lit(0), d + k - n)
        highest = F.least(k, d)
        mode = F.floor((k + 1).cast("double") * (d + 1).cast("double") / (n + 2).cast("double")).cast("long")
        share = F.when(n > 0, k.cast("double") / n.cast("double")).otherwise(F.lit(0.0))
        span = F.ceil(F.lit(12.0) * F.sqrt(d.cast("double") * share * (F.lit(1.0) - share))).cast("long") + 20
        return let(
            F.struct(
                n.alias("n"),
                k.alias("k"),
                d.alias("d"),
                F.greatest(lowest, mode - span).alias("first"),
                F.least(highest, mode + span).alias("last"),
            ),
            invert,
        )

    def invert(a: Column) -> Column:
        steps = F.when(a["last"] > a["first"], F.sequence(a["first"] + 1, a["last"])).otherwise(F.array().cast("array<bigint>"))

        def log_ratio(x: Column) -> Column:
            up = (a["k"] - x + 1).cast("double") * (a["d"] - x + 1).cast("double")
            down = x.cast("double") * (a["n"] - a["k"] - a["d"] + x).cast("double")
            return F.ln(up) - F.ln(down)

        def weigh(acc: Column, x: Column) -> Column:
            def put(log: Column) -> Column:
                top = F.greatest(acc["top"], log)
                return F.struct(
                    log.alias("log"),
                    top.alias("top"),
                    (acc["sum"] * F.exp(acc["top"] - top) + F.exp(log - top)).alias("sum"),
                )

            return let(acc["log"] + log_ratio(x), put)

        def search(norm: Column) -> Column:
            goal = u * norm["sum"]

            def step(acc: Column, x: Column) -> Column:
                def put(log: Column) -> Column:
                    reached = acc["cum"] + F.exp(log - norm["top"])
                    return F.struct(
                        log.alias("log"),
                        reached.alias("cum"),
                        F.coalesce(acc["x"], F.when(reached >= goal, x)).alias("x"),
                    )

                return F.when(acc["x"].isNotNull(), acc).otherwise(let(acc["log"] + log_ratio(x), put))

            first = F.exp(-norm["top"])
            start = F.struct(
                F.lit(0.0).alias("log"), first.alias("cum"), F.when(first >= goal, a["first"]).alias("x")
            )
            return F.aggregate(steps, start, step, lambda acc: F.coalesce(acc["x"], a["last"]))

        zero = F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("top"), F.lit(1.0).alias("sum"))
        return let(F.aggregate(steps, zero, weigh), search)

    return let(F.struct(total.alias("n"), marked.alias("k"), drawn.alias("d")), solve)


def uniform(*parts: Column | int) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    bits = F.shiftrightunsigned(F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), 12)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(source, quota) to (source, shard_quotas): exact counts per output shard.

    One row holds all quotas (a row per source; sources are few), and each level of
    the tree doubles the rows. Shard sizes differ by one at most.
    """
    key = F.struct(F.col("source").isNull().alias("absent"), F.col("source").alias("source"), F.col("quota").alias("q"))
    nodes = quotas.groupBy().agg(F.sort_array(F.collect_list(key)).alias("cells")).select(
        F.transform("cells", lambda c: c["source"]).alias("sources"),
        F.transform("cells", lambda c: c["q"]).alias("counts"),
        F.coalesce(F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + c["q"]), F.lit(0)).alias("all"),
        F.lit(0).alias("lo"),
        F.lit(shards).alias("hi"),
    )

    def capacity(upto: Column) -> Column:
        """Draws of the shards before ``upto``."""
        return upto * F.floor(F.col("all") / F.lit(shards)) + F.least(upto.cast("long"), F.col("all") % shards)

    width = 1
    while width < shards:
        width *= 2
        middle = F.expr("(lo + hi) div 2").cast("int")

        def deal(acc: Column, k: Column) -> Column:
            def put(x: Column) -> Column:
                return F.struct(
                    (acc["n"] - k).alias("n"), (acc["d"] - x).alias("d"), F.concat(acc["out"], F.array(x)).alias("out")
                )

            return let(hypergeometric(acc["n"], k, acc["d"], uniform(seed, F.col("lo"), F.col("hi"), F.size(acc["out"]))), put)

        start = F.struct(
            (capacity(F.col("hi")) - capacity(F.col("lo"))).cast("long").alias("n"),
            (capacity(middle) - capacity(F.col("lo"))).cast("long").alias("d"),
            F.array().cast("array<bigint>").alias("out"),
        )
        left = F.aggregate("counts", start, deal, lambda acc: acc["out"])
        halves = F.when(
            F.col("hi") - F.col("lo") > 1,
            F.array(
                F.struct(F.col("lo").alias("lo"), middle.alias("hi"), F.col("left").alias("counts")),
                F.struct(
                    middle.alias("lo"),
                    F.col("hi").alias("hi"),
                    F.zip_with("counts", "left", lambda a, b: a - b).alias("counts"),
                ),
            ),
        ).otherwise(F.array(F.struct("lo", "hi", "counts")))
        nodes = (
            nodes.withColumn("left", left)
            .select("sources", "all", F.explode(halves).alias("half"))
            .select("sources", "all", "half.lo", "half.hi", "half.counts")
        )
    cells = nodes.select(F.col("lo").alias("shard"), F.explode(F.arrays_zip("sources", "counts")).alias("cell"))
    return cells.groupBy(F.col("cell.sources").alias("source")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("shard", F.col("cell.counts").alias("q")))), lambda c: c["q"]).alias("shard_quotas")
    )


def draws(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    shards: int = SHARDS,
    seed: int = SEED,
    buckets: int = 1024,
) -> DataFrame:
    """What the mix takes of every document (doc_id, source, text_key, size).

    Adds source_size, target, passes (whole readings), part (words of a last, partial
    one), and ``copies``: an array of (shard, place, words), one for each block that falls
    into the quota of a shard. ``taken`` is the sum of these blocks' words.
    Positions in a source's permutation come from counted hash buckets, so a source
    with a third of all rows is spread over ``buckets`` groups.

    NULL source is a source of its own, the last one. Documents without words take
    part with size 0. Rows with one doc_id, text and source are drawn each by itself.
    """
    rows = docs.withColumn("hash", F.xxhash64(F.lit(seed), "doc_id", "text_key", "size")).withColumn(
        "bucket", F.pmod("hash", F.lit(buckets)).cast("int")
    )
    counted = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        "source",
        "bucket",
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    )
    sources = targets(
        counted.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("rows").alias("source_rows")), weights, cap
    ).withColumns(
        {
            "passes": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
        }
    ).withColumn("rest", F.floor(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))

    inside = Window.partitionBy("source", "bucket").orderBy("hash", "doc_id", "text_key", "size")
    left, right = rows.alias("l"), offsets.alias("r")
    placed = (
        left.join(right, F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.bucket") == F.col("r.bucket")))
        .select("l.*", "words_before", "rows_before")
        .withColumn("rank", F.col("rows_before") + F.row_number().over(inside) - 1)
        .withColumn(
            "start",
            F.col("words_before")
            + F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
    )
    left, right = placed.alias("l"), sources.withColumnRenamed("source", "of").alias("r")
    ranked = stored(
        left.join(right, F.col("l.source").eqNullSafe(F.col("r.of")))
        .select("doc_id", "source", "text_key", "size", "rank", "source_size", "source_rows", "target", "passes",
                F.least(F.col("size"), F.greatest(F.lit(0), F.col("rest") - F.col("start"))).alias("part")),
        "mix",
    )
    # Copies are numbered pass by pass; the partial pass takes a run of the permutation.
    quotas = ranked.groupBy("source", "source_rows", "passes").agg(F.count_if(F.col("part") > 0).alias("partial"), F.max(F.when(F.col("part") > 0, F.col("rank"))).alias("last"))
    quotas = quotas.select("source", (F.col("passes") * F.col("source_rows") + F.coalesce(F.col("last") + 1, F.lit(0))).alias("quota"))
    bounds = split_quotas(quotas, shards, seed).select(
        F.col("source").alias("of"),
        F.transform(
            F.sequence(F.lit(1), F.lit(shards)),
            lambda i: F.aggregate(F.slice("shard_quotas", 1, i), F.lit(0).cast("long"), lambda a, x: a + x),
        ).alias("ends"),
    )
    position = lambda i: i * F.col("source_rows") + F.col("rank")
    # A block is the shard's in whose range of its source's permutation it lies; blocks
    # after the last range are not drawn.
    copies = F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(cap).cast("long")),
        lambda i: F.struct(
            F.size(F.filter("ends", lambda e: e <= position(i))).alias("shard"),
            F.xxhash64(F.lit(seed), position(i), "source").alias("place"),
            F.when(i < F.col("passes"), F.col("size")).otherwise(F.col("part")).alias("words"),
        ),
    )
    drawn = F.filter(copies, lambda c: c["shard"] < shards)
    words = F.aggregate("copies", F.lit(0).cast("long"), lambda sum_, c: sum_ + c["words"])
    return (
        ranked.join(bounds, ranked["source"].eqNullSafe(bounds["of"]))
        .withColumn("copies", drawn)
        .withColumn("taken", words)
        .select("doc_id", "source", "text_key", "size", "source_size", "target", "passes", "part", "taken", "copies")
    )


def sized(docs: DataFrame) -> DataFrame:
    """The columns that ``draws`` reads."""
    return docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), word_count(F.col("text")).alias("size"))


def row_key() -> Column:
    """A digest of (doc_id, source, text_key) in 16 bytes: equal keys are equal rows."""
    absent = F.concat(F.col("doc_id").isNull().cast("string"), F.col("source").isNull().cast("string"))
    name = F.concat_ws("|", absent, F.col("doc_id").cast("string"), F.col("text_key").cast("string"), "source")
    return F.unhex(F.left(F.sha2(F.encode(name, "UTF-8"), 256), F.lit(32)))


# Tasks among which the copies of one shard are dealt, by their place there.
SLICE_BITS = 6


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: the columns of documents, a row for every drawn copy.

    Documents stay whole: the cut one of each source is taken if at least half of it
    was drawn. ``shard`` and ``place`` give a copy's shard and its order there, and the
    rows are dealt out and ordered so. Texts move twice: to their copies, by one key, and
    with them to their shards.
    """
    mixed = draws(sized(docs), **options)
    whole = F.col("passes") + F.when((F.col("part") > 0) & (F.col("part") * 2 >= F.col("size")), 1).otherwise(0)
    copies = mixed.select(row_key().alias("row_key"), F.explode(F.slice("copies", 1, whole.cast("int"))).alias("copy"))
    # Rows repeated as they are were drawn one by one above, so here each stands once.
    plain = (
        docs.select(*DOCUMENT_COLUMNS)
        .withColumn("text_key", F.xxhash64("text"))
        .withColumn("row_key", row_key())
        .repartition("row_key")
        .dropDuplicates(["row_key"])
    )
    found = plain.join(copies, "row_key").select(*DOCUMENT_COLUMNS, "copy.shard", "copy.place")
    part = F.shiftrightunsigned("place", 64 - SLICE_BITS)
    # Signed places in their order as unsigned ones, so that a shard's slices follow each other.
    return found.repartition("shard", part).sortWithinPartitions("shard", part, "place")


def op3_mix(spark, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document, and the shards they go to."""
    mixed = draws(sized(table(spark, sf_dir, "documents")))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", F.transform("copies", lambda c: c["shard"]).alias("shards")
    )
