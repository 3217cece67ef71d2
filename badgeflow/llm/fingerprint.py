"""Order MinHash: fingerprints whose likeness follows the edit distance of texts.

Marcais et al., "Locality-sensitive hashing for the edit distance". The k-mers of a
text are numbered by occurrence, so that repeats count. Each tuple has an order of all
numbered k-mers, the two least ones of the text under it are selected, put back into
their order in the text, and hashed together. Two texts agree in a tuple if they share
its k-mers in one order.

A k-mer is K words in a row (white space separates words). All numbered k-mers are hashed
once, to 64 bits, and the order of a tuple is that of the hashes from a point of its own
upwards, around the end to the beginning; the points are evenly spread, which is one
permutation hashing with rotation (Shrivastava and Li). So the hashes of a text are sorted
once, and a tuple's members are the first two from its point on, found by halving.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from badgeflow.llm.common import let, stored, table

K = 2
TUPLES = 32
# Neighbours are found within runs of 2**6 ids, the ends of runs in a tree of runs of 2**12.
RUN_BITS = 6
TREE_BITS = 12


def placed(hash_: Column, position: Column) -> Column:
    return F.struct(hash_.alias("h"), position.alias("p"))


def numbered_kmers(text: Column, k: int = K) -> Column:
    """The numbered k-mers of a text, as (hash, position) in order of hash.

    Sorting by (hash, position) puts the occurrences of a k-mer side by side, in text
    order; each after the first is hashed again with its number. Fewer than k words are
    one k-mer; a text without words has none.
    """
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")

    def kmers(w: Column) -> Column:
        last = F.greatest(F.size(w) - k, F.lit(0))
        # Positions before the end are full; slice() takes what there is for short texts.
        each = F.transform(F.sequence(F.lit(0), last), lambda i: placed(F.xxhash64(F.slice(w, i + 1, k)), i))
        return F.sort_array(F.when(F.size(w) > 0, each).otherwise(F.slice(each, 1, 0)))

    def occurrences(s: Column) -> Column:
        first = lambda i: (i == 0) | (s[i]["h"] != s[F.greatest(i - 1, F.lit(0))]["h"])
        firsts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0))), first)

        def number(f: Column) -> Column:
            def group(at: Column, j: Column) -> Column:
                own = F.slice(s, at + 1, F.coalesce(F.get(f, j + 1), F.size(s)) - at)
                return F.transform(own, lambda x, nth: placed(F.when(nth == 0, x["h"]).otherwise(F.xxhash64(x["h"], nth)), x["p"]))

            return F.sort_array(F.flatten(F.transform(f, group)))

        # Most texts repeat no k-mer, and are in order already.
        return let(firsts, lambda f: F.when(F.size(f) >= F.size(s), s).otherwise(number(f)))

    return let(let(words, kmers), occurrences)


def signature(kmers: Column, tuples: int = TUPLES) -> Column:
    """For each tuple its two members in text order, hashed to 32 bits; 0 without k-mers."""
    width = (1 << 64) // tuples
    points = [F.lit(i * width - (1 << 63)) for i in range(tuples)]

    def members(s: Column, point: Column) -> Column:
        def halve(at: Column, _: Column) -> Column:
            middle = F.shiftright(at["lo"] + at["hi"], 1)
            below = (at["lo"] < at["hi"]) & (F.get(s, middle)["h"] < point)
            lo = F.when(below, middle + 1).otherwise(at["lo"])
            hi = F.when((at["lo"] < at["hi"]) & ~below, middle).otherwise(at["hi"])
            return F.struct(lo.alias("lo"), hi.alias("hi"))

        steps = F.sequence(F.lit(0), F.length(F.bin(F.size(s))))
        start = F.struct(F.lit(0).alias("lo"), F.size(s).alias("hi"))
        first = F.aggregate(steps, start, halve, lambda at: at["lo"])
        pair = lambda i: F.struct(
            F.get(s, F.pmod(i, F.size(s))).alias("a"), F.get(s, F.pmod(i + 1, F.size(s))).alias("b")
        )
        in_order = lambda x: F.when(x["a"]["p"] <= x["b"]["p"], F.hash(x["a"]["h"], x["b"]["h"])).otherwise(
            F.hash(x["b"]["h"], x["a"]["h"])
        )
        return let(let(first, pair), in_order)

    def tuple_hashes(s: Column) -> Column:
        found = F.transform(F.array(*points), lambda point: members(s, point))
        return F.when(F.size(s) > 0, found).otherwise(F.array_repeat(F.lit(0), tuples))

    return let(kmers, tuple_hashes)


def fingerprint_text(hashes: Column) -> Column:
    """Eight hexadecimal digits a tuple."""
    digits = F.transform(hashes, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column, tuples: int = TUPLES) -> Column:
    """Share of equal tuples, 0 to 1."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(tuples))


def _next_runs(ids: DataFrame) -> DataFrame:
    """(run, next_run): for every run of ids, the one that follows in descending order.

    Runs are leaves of a tree of fan-out 2**12 over all ids. At each level a node's
    last leaf is followed by the first leaf of its right neighbour under one parent;
    the very last is followed by the very first. No group is larger than the fan-out.
    """
    leaves = stored(ids.select(F.shiftright("doc_id", RUN_BITS).alias("node")).where("node IS NOT NULL").distinct(), "id-runs")
    nodes = leaves.select("node", F.col("node").alias("first"), F.col("node").alias("last"))
    edges, bits = None, 64 - RUN_BITS
    while True:
        parent = F.shiftright("node", TREE_BITS) if bits > TREE_BITS else F.lit(0).cast("long")
        nodes = nodes.withColumn("parent", parent)
        order = Window.partitionBy("parent").orderBy(F.col("node").desc())
        found = nodes.select(F.col("last").alias("run"), F.lead("first").over(order).alias("next_run")).where("next_run IS NOT NULL")
        edges = found if edges is None else edges.unionByName(found)
        nodes = nodes.groupBy("parent").agg(F.max("first").alias("first"), F.min("last").alias("last"))
        if bits <= TREE_BITS:
            wrap = nodes.select(F.col("last").alias("run"), F.col("first").alias("next_run"))
            return edges.unionByName(wrap)
        nodes = nodes.withColumnRenamed("parent", "node")
        bits -= TREE_BITS


def with_next(docs: DataFrame) -> DataFrame:
    """(run, number, doc_id, text, next_text, last_of_run): all documents, each with the
    text that follows in descending doc_id; after the last comes the first.

    One shuffle of the texts, by runs of 64 ids; across runs only the first text of
    each moves. Rows with one doc_id follow each other by text; rows without a doc_id
    stand by themselves, spread by their text, and nothing follows them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # A run of its own kind for rows without an id: odd runs are theirs.
    run = F.when(F.col("doc_id").isNotNull(), F.shiftleft(F.shiftright("doc_id", RUN_BITS), 1)).otherwise(
        F.shiftleft(F.pmod(F.xxhash64("text"), F.lit(4096)), 1) + 1
    )
    order = Window.partitionBy("run").orderBy(F.col("doc_id").desc(), F.xxhash64("text"), "text")
    placed = rows.withColumn("run", run).select(
        "run",
        F.row_number().over(order).alias("number"),
        "doc_id",
        "text",
        F.lead("text").over(order).alias("inside"),
    )
    ends = _next_runs(rows.select("doc_id")).select(
        F.shiftleft("run", 1).alias("run"), F.shiftleft("next_run", 1).alias("next_run")
    )
    firsts = placed.where("number = 1 AND doc_id IS NOT NULL").select(F.col("run").alias("next_run"), F.col("text").alias("outside"))
    crossing = ends.join(firsts, "next_run").select("run", "outside")
    return placed.join(crossing, "run", "left").select(
        "run",
        "number",
        "doc_id",
        "text",
        F.when(F.col("doc_id").isNull(), F.lit("")).otherwise(F.coalesce("inside", "outside")).alias("next_text"),
        (F.col("inside").isNull()).alias("last_of_run"),
    )


def fingerprints(docs: DataFrame, k: int = K, tuples: int = TUPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    NULL texts count as empty; texts without words share one fingerprint, and texts of any
    length are hashed whole, a text in the memory of its task. Equal hashes of different
    k-mers (ties) are taken in text order. Of rows without a doc_id the edit only cuts, and
    near_next is 0; rows that repeat a doc_id follow each other. Other columns are not
    read, and an empty table gives an empty one. Everything after the one shuffle by runs
    stays in its partition: the k-mers, their hashes, and the look at the next document;
    where that is in another run, its text is hashed here as well.
    """
    n = F.length("text")
    cut = F.floor(n / F.lit(3)).cast("int")
    edited = F.concat(F.expr("left(text, n - cut)"), F.expr("left(next_text, cut)"))
    rows = with_next(docs).withColumn("n", n).withColumn("cut", cut).withColumn("edited", edited)
    hashes = lambda text: signature(numbered_kmers(F.col(text), k), tuples)
    signed = rows.select(
        "run",
        "number",
        "doc_id",
        "n",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        hashes("text").alias("own"),
        hashes("edited").alias("changed"),
        F.when(F.col("last_of_run"), hashes("next_text")).alias("outside"),
    )
    order = Window.partitionBy("run").orderBy("number")
    following = signed.withColumn("following", F.coalesce(F.lead("own").over(order), F.col("outside")))
    return following.select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        fingerprint_text(F.col("own")).alias("fingerprint"),
        fingerprint_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), tuples).alias("near_edited"),
        F.when(F.col("doc_id").isNull(), F.lit(0.0)).otherwise(likeness(F.col("own"), F.col("following"), tuples)).alias("near_next"),
    )


def op1_order_minhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents"))
