"""Mixing sources to target weights by a splitting tree, in DataFrame operations only.

1. *Targets.* Sources in code-point order, null last, weigh 1, 2, 3 and so on, repeating. They share
   all words of the corpus by weight; a source gets at most ``MOST_REPEATS`` times its own words,
   and what it cannot take is shared again among the others by weight.
2. *Quotas.* The documents of a source fall into blocks by a hash, about as many words each in
   every source. A source's quota is a number of block draws: whole passes over its blocks, then
   the first blocks of one more permutation, then one last draw of single documents that fills
   what is missing of its target.
3. *Splitting tree.* The root holds the quotas of all sources. A node gives its left child half of
   its draws, by a multivariate hypergeometric draw over the sources, and the rest to its right
   child, so quotas stay exact down to the shards, which are the leaves.
4. *Draws.* Shard after shard takes the next blocks of each source's permutation. No draw is taken
   twice, so shards are disjoint within a pass. Documents are then shuffled within their shard.

There are about ``most_blocks`` blocks, however large the corpus is; tables of blocks and of sources
are all that is ever gathered, and those of documents are never sorted or grouped by source.
Everything random is a hash of ids, so reruns agree.

Defined cases: a null text has no words; documents without words are drawn like others and take
none; null sources are one source; the words of very long texts are counted as a whole; a source without words has target 0; rows with equal ids go
the same way; an empty table gives an empty result. Other columns are kept; ``draws``, ``shard``,
``pass`` and the columns of :func:`drawn` replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import let, small, written

SHARDS = 64
MOST_BLOCKS = 16_384
LEAST_BLOCK_WORDS = 1_024
MOST_REPEATS = 3
PART_WORDS = 4_000_000  # of a shard, sorted together
MOST_SMALL = 100_000

WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(*of: Column) -> Column:
    """Between 0 and 1, from a hash."""
    bits = 2**52
    return (F.pmod(F.xxhash64(*of), F.lit(bits)) + 0.5) / bits


def _hypergeometric(total: Column, marked: Column, n: Column, u: Column) -> Column:
    """How many of ``n`` draws out of ``total`` hit one of ``marked``, for a uniform ``u``.

    The distribution is added up from 12 standard deviations below its mode to 12 above.
    """
    total, marked, n = (x.cast("double") for x in (total, marked, n))
    least = F.greatest(F.lit(0.0), n + marked - total)
    most = F.least(n, marked)
    mode = F.floor((n + 1) * (marked + 1) / (total + 2)).cast("double")
    share = marked / F.greatest(total, F.lit(1.0))
    spread = F.sqrt(n * share * (1 - share) * (total - n) / F.greatest(total - 1, F.lit(1.0)))
    reach = F.ceil(12 * spread + 12).cast("double")
    given = F.struct(
        F.greatest(least, mode - reach).cast("long").alias("a"),
        F.least(most, mode + reach).cast("long").alias("b"),
        total.alias("total"), marked.alias("marked"), n.alias("n"), u.alias("u"),
    )

    def next_weight(g: Column, k: Column, weight: Column) -> Column:
        up = (g["marked"] - k) * (g["n"] - k)
        return weight * up / ((k + 1) * (g["total"] - g["marked"] - g["n"] + k + 1))

    def whole(g: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        added = F.aggregate(F.sequence(g["a"], g["b"]), start, lambda s, k: F.struct(
            F.coalesce(next_weight(g, k, s["w"]), F.lit(0.0)).alias("w"),
            (s["sum"] + s["w"]).alias("sum"),
        ))
        return added["sum"]

    def pick(g: Column, mass: Column) -> Column:
        start = F.struct(
            F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("x")
        )
        found = F.aggregate(F.sequence(g["a"], g["b"]), start, lambda s, k: F.struct(
            F.coalesce(next_weight(g, k, s["w"]), F.lit(0.0)).alias("w"),
            (s["sum"] + s["w"]).alias("sum"),
            F.when(s["x"].isNull() & (s["sum"] + s["w"] >= g["u"] * mass), k)
            .otherwise(s["x"]).alias("x"),
        ))
        return F.coalesce(found["x"], g["b"])

    drawn = let(given, lambda g: let(whole(g), lambda mass: pick(g, mass)))
    return F.when(most <= least, least.cast("long")).otherwise(drawn)


def _left_quotas(quotas: Column, n: Column, node: Column, seed: int) -> Column:
    """The multivariate draw of ``n`` out of ``quotas``, one source after the other."""

    def step(left: Column, source: Column) -> Column:
        rest = F.aggregate(F.slice(quotas, source, F.size(quotas)), F.lit(0).cast("long"), lambda a, b: a + b)
        wanted = n - F.aggregate(left, F.lit(0).cast("long"), lambda a, b: a + b)
        x = _hypergeometric(
            rest, F.element_at(quotas, source), wanted, _uniform(F.lit(seed), node, source)
        )
        return F.concat(left, F.array(x))

    return F.aggregate(
        F.sequence(F.lit(1), F.size(quotas)), F.array().cast("array<long>"), step
    )


def split_quotas(root: DataFrame, shards: int, seed: int) -> DataFrame:
    """``shard`` and its ``quotas``, from one row with the ``quotas`` of all sources."""
    nodes = root.select(
        F.lit(1).cast("long").alias("node"), F.lit(0).alias("from"), F.lit(shards).alias("to"), "quotas"
    )
    levels = (shards - 1).bit_length()
    for _ in range(levels):
        middle = F.floor((F.col("from") + F.col("to")) / 2).cast("int")
        whole = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, b: a + b)
        leaf = F.col("to") - F.col("from") <= 1
        half = F.floor(whole * (middle - F.col("from")) / (F.col("to") - F.col("from")))
        left = F.when(leaf, F.col("quotas")).otherwise(
            _left_quotas(F.col("quotas"), half, F.col("node"), seed)
        )
        halves = nodes.withColumns({"middle": middle, "leaf": leaf, "left": left})
        right = F.zip_with("quotas", "left", lambda a, b: a - b)
        end = F.when(F.col("leaf"), F.col("to")).otherwise(F.col("middle"))
        child = lambda node, a, b, q: F.struct(
            node.alias("node"), a.alias("from"), b.alias("to"), q.alias("quotas")
        )
        children = F.array(
            child(F.col("node") * 2, F.col("from"), end, F.col("left")),
            child(F.col("node") * 2 + 1, end, F.col("to"), right),
        )
        nodes = halves.select(F.explode(children).alias("c")).select("c.*").filter(
            F.col("to") > F.col("from")
        )
    return nodes.select(F.col("from").alias("shard"), "quotas")


def source_targets(sizes: DataFrame, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """``source``, ``rank`` from 0, ``source_size`` and ``target``, from ``source`` and ``size``.

    A source is capped when its cap is below its share; with the caps in order of cap per weight,
    the capped ones come first. One row per source is sorted, never one per document.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.asc_nulls_last("source"))
    ranked = sources.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.col("rank") % 3 + 1)
    cap = most_repeats * F.col("source_size")
    ranked = ranked.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left_over = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.withColumn("level", left_over / weights)
    first_free = F.min(F.when(
        F.col("ratio") >= F.col("level"), F.struct("ratio", "rank", "level")
    )).over(everything)
    free = level.withColumn("free", first_free["level"])
    target = F.least(F.col("cap").cast("double"), F.col("free") * F.col("weight"))
    target = F.coalesce(target, F.col("cap").cast("double"))
    return free.select("source", "rank", "source_size", target.alias("target"))


def _order(seed: int, *more: str) -> list[Column]:
    """A permutation of the blocks of a source, which differs from pass to pass."""
    return [*map(F.col, more), _uniform(F.lit(seed), F.col("pass"), F.col("rank"), F.col("block")), F.col("block")]


def _blocks(placed: DataFrame, most_repeats: int, seed: int) -> DataFrame:
    """The blocks of each source, with its whole ``passes`` and whether the last pass takes them.

    ``cut`` tells the blocks that the last pass would have to take in part.
    """
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    blocks = placed.groupBy("rank", "block").agg(
        F.sum("size").alias("words"), F.first("target").alias("target"),
        F.first("source_size").alias("source_size"),
    ).withColumn("passes", F.coalesce(passes, F.lit(0)).cast("long"))
    running = Window.partitionBy("rank").orderBy(*_order(seed))
    until = F.sum("words").over(running.rowsBetween(Window.unboundedPreceding, 0))
    budget = F.col("target") - F.col("passes") * F.col("source_size")
    blocks = blocks.withColumn("pass", F.col("passes")).withColumns({"until": until, "budget": budget})
    open_pass = F.col("passes") < most_repeats
    taken = F.col("until") <= F.col("budget")
    reached = F.col("until") - F.col("words") <= F.col("budget")
    return blocks.drop("pass").withColumns({
        "in_last": open_pass & taken,
        "cut": open_pass & ~taken & reached & (F.col("words") > 0),
    })


def _fillers(placed: DataFrame, blocks: DataFrame, seed: int) -> DataFrame:
    """``rank`` and ``id`` of documents that fill what the blocks leave of each source's target.

    First documents of the block at the cut, while they fit; then the one document, of those that
    the last pass does not take, whose size comes nearest to the rest.
    """
    edge = blocks.filter("cut").groupBy("rank").agg(
        F.min(F.struct("until", "block", "words", "budget")).alias("e")
    )
    missing = F.col("e.budget") - F.col("e.until") + F.col("e.words")
    edge = written(edge.select("rank", F.col("e.block").alias("edge_block"), missing.alias("missing")))
    beside = placed.select("rank", "block", "id", "size").filter("size > 0")
    beside = beside.join(small(edge, MOST_SMALL), "rank")

    by_hash = Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed + 1), F.col("id")), "id")
    running = F.sum("size").over(by_hash.rowsBetween(Window.unboundedPreceding, 0))
    fits = beside.filter(F.col("block") == F.col("edge_block")).withColumn("running", running)
    fits = fits.filter(F.col("running") <= F.col("missing"))
    fits = written(fits.select("rank", "id", "running"))

    filled = fits.groupBy("rank").agg(F.max("running").alias("filled"))
    gap = F.col("missing") - F.coalesce("filled", F.lit(0))
    gaps = edge.join(filled, "rank", "left").select("rank", gap.alias("gap"))
    in_last = blocks.filter("in_last").select("rank", "block")
    spare = beside.drop("missing", "edge_block").join(
        small(in_last, 2 * MOST_SMALL), ["rank", "block"], "left_anti"
    ).join(fits.select("rank", "id"), ["rank", "id"], "left_anti")
    off = F.abs(F.col("size") - F.col("gap"))
    nearest = spare.join(small(gaps, MOST_SMALL), "rank").groupBy("rank", "gap").agg(
        F.min(F.struct(off.alias("off"), "id")).alias("best")
    ).filter(F.col("best.off") < F.abs("gap")).select("rank", F.col("best.id").alias("id"))
    return fits.select("rank", "id").unionByName(nearest).distinct()


def _placements(
    sources: DataFrame, blocks: DataFrame, filler: DataFrame, shards: int, most_repeats: int, seed: int
) -> DataFrame:
    """``draws`` of each block; block -1 of a source stands for its fillers.

    Every draw has a place in its source: pass after pass, each in an order of its own, the fillers
    last. Shard after shard takes as many places as its quota says.
    """
    every = blocks.select(
        "rank", "block", "passes", "in_last", F.explode(F.sequence(F.lit(0), "passes")).alias("pass")
    ).filter((F.col("pass") < F.col("passes")) | F.col("in_last"))
    order = Window.partitionBy("rank").orderBy(*_order(seed, "pass"))
    every = every.select("rank", "block", "pass", (F.row_number().over(order) - 1).alias("place"))
    filled = filler.select("rank").distinct()
    one = filled.select("rank", F.lit(1).cast("long").alias("n"))
    count = every.groupBy("rank").agg(F.count("*").alias("n")).unionByName(one)
    count = count.groupBy("rank").agg(F.sum("n").alias("n"))
    last = filled.join(count, "rank").select(
        "rank", F.lit(-1).cast("long").alias("block"), F.lit(most_repeats).alias("pass"),
        (F.col("n") - 1).cast("int").alias("place"),
    )
    every = written(every.unionByName(last))

    quotas = sources.select("rank").join(count, "rank", "left")
    quotas = quotas.select("rank", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    in_order = F.array_sort(F.collect_list(F.struct("rank", "n")))
    root = quotas.agg(F.transform(in_order, lambda x: x["n"]).alias("quotas"))
    leaves = written(split_quotas(root.filter(F.size("quotas") > 0), shards, seed))
    upto = F.sum("n").over(Window.partitionBy("rank").orderBy("shard"))
    places = F.explode(F.sequence(F.col("upto") - F.col("n"), F.col("upto") - 1))
    parts = leaves.select("shard", F.posexplode("quotas").alias("rank", "n")).withColumn("upto", upto)
    parts = parts.filter("n > 0").select("rank", "shard", places.alias("place"))
    draws = F.array_sort(F.collect_list(F.struct("pass", "shard")))
    return every.join(parts, ["rank", "place"]).groupBy("rank", "block").agg(draws.alias("draws"))


def _drawn(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    shards: int = SHARDS,
    most_blocks: int = MOST_BLOCKS,
    least_block_words: int = LEAST_BLOCK_WORDS,
    most_repeats: int = MOST_REPEATS,
    seed: int = 11,
) -> tuple[DataFrame, int]:
    """``doc`` (the whole row), ``id``, ``size``, ``source_size``, ``target`` and ``draws``; all words."""
    # A new name holds the documents' columns, so that theirs and ours cannot clash.
    rows = documents.select(
        F.struct(*[F.col(f"`{x}`") for x in documents.columns]).alias("doc"),
        F.col(id_column).alias("id"), F.col(source_column).alias("source"),
        size_of(F.col(text_column)).alias("size"),
    )
    narrow = written(rows.select("id", "source", "size"))
    sources = written(source_targets(narrow.select("source", "size"), most_repeats))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    block_words = max(least_block_words, -(-total // most_blocks))
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")
    known = small(sources.withColumn("n_blocks", n_blocks).withColumnRenamed("source", "of"), MOST_SMALL)

    def placed(frame: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.col("n_blocks"))
        found = frame.join(known, F.col("source").eqNullSafe(F.col("of")))
        return found.withColumn("block", block).drop("of", "n_blocks")

    blocks = written(_blocks(placed(narrow), most_repeats, seed))
    filler = written(_fillers(placed(narrow), blocks, seed))
    draws = written(_placements(sources, blocks, filler, shards, most_repeats, seed))

    whole = draws.filter("block >= 0").toDF("of_rank", "of_block", "whole")
    single = filler.join(draws.filter("block < 0"), "rank")
    single = written(single.select("rank", "id", "draws").toDF("single_rank", "single_id", "single"))
    in_block = (F.col("rank") == F.col("of_rank")) & (F.col("block") == F.col("of_block"))
    is_single = (F.col("rank") == F.col("single_rank")) & F.col("id").eqNullSafe(F.col("single_id"))
    found = placed(rows).join(small(whole, 2 * MOST_SMALL), in_block, "left")
    found = found.join(small(single, 2 * MOST_SMALL), is_single, "left")
    nothing = F.array().cast(draws.schema["draws"].dataType)
    both = F.concat(F.coalesce("whole", nothing), F.coalesce("single", nothing))
    return found.select("doc", "id", "size", "source_size", "target", both.alias("draws")), total


def drawn(documents: DataFrame, **options) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target`` and ``draws``.

    ``draws`` is an array of (``pass``, ``shard``): where the mix takes the document.
    """
    ours = ["size", "source_size", "target", "draws"]
    kept = [F.col(f"doc.`{x}`") for x in documents.columns if x not in ours]
    return _drawn(documents, **options)[0].select(*kept, *ours)


def mixed(documents: DataFrame, *, draw_columns: bool = True, seed: int = 11, **options) -> DataFrame:
    """The mix: one row per draw, shuffled within its shard, with ``pass`` and ``shard`` if wanted.

    A shard is as large as its share of the corpus. It is put together from parts of about
    ``PART_WORDS`` words, which its random order tells and which are sorted on their own.
    """
    found, total = _drawn(documents, seed=seed, **options)
    each = found.select("doc", "id", F.explode("draws").alias("draw")).select("doc", "id", "draw.*")
    parts = max(1, -(-total // (options.get("shards", SHARDS) * PART_WORDS)))
    order = F.xxhash64(F.lit(seed), F.col("shard"), F.col("pass"), F.col("id"))
    each = each.withColumn("order", order).withColumn("part", F.pmod("order", F.lit(parts)))
    each = each.repartition("shard", "part").sortWithinPartitions("shard", "part", "order")
    ours = ["pass", "shard"] if draw_columns else []
    return each.select(*[F.col(f"doc.`{x}`") for x in documents.columns if x not in ours], *ours)
