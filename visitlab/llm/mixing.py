"""Mixing sources to target weights with a hypergeometric splitting tree.

Targets: the sources in code-point order (null last) weigh ``WEIGHTS`` in turn
and share ``SHARE`` of all words; none takes more than ``MOST`` times its own
words, the excess goes to the others by weight.

Draws: a source's documents are dealt by hash into blocks of about
``BLOCK_WORDS`` words, and blocks in hash order are a random permutation of the
source. A target takes whole passes over all blocks, then a prefix of the
permutation; only the block that crosses the target is cut: its documents are
taken in order while they fit, then the smallest others, so the words taken miss
the target by half a small document at most where there is one. The
blocks to draw (passes counted) are the source's exact quota. A binary tree over
the output shards splits the quotas of all sources: the left half of a node gets
its share of the node's blocks, divided among the sources by a multivariate
hypergeometric draw, so every shard holds a fair sample of the mixture and the
quotas add up exactly. A shard's blocks of a source are the next ones of the
permutation, disjoint from every other shard's. Inside a shard the documents are
ordered by hash.

The sources of a node are dealt in groups of ``GROUP``, a row each. A node's draw
is divided among its groups first, then inside each group; every row knows the
group totals and draws them with the node's seed, so rows of one node agree
without meeting. Draws are exact at any size of the quotas (:func:`hypergeometric`).

All randomness is seeded, so a rerun gives the same mixture.

Defined results: a null or empty text has no words, belongs to its source and is
drawn with it; a source without words has target 0 and is not drawn; documents
that are equal in doc_id, source and size are drawn together, as often as they
occur; an empty table gives an empty mixture.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 1 << 14
#: Words of an output shard, on average.
SHARD_WORDS = 1 << 20
SEED = 6
#: Levels of the splitting tree that one stage expands.
LEVELS = 8
#: Sources in one row of a tree node.
GROUP = 4096

_PERM_BITS = 40


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def permutation(seed: int = SEED) -> Column:
    """A document's place in its source's permutation, from what names it."""
    return F.pmod(F.xxhash64("doc_id", "source", "size", F.lit(seed)), F.lit(1 << _PERM_BITS))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, rank, source_size, source_docs, target) from rows (source, size)."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
    ranked = _ranked(sums)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    table = materialize(ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * MOST), "source-sizes")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, F.lit(False)
    while total:
        free, taken = table.agg(F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, F.col("most")))).first()
        if not free:
            break
        new = (SHARE * total - (taken or 0)) / free
        now = F.col("weight") * new > F.col("most")
        if table.where(now & ~full).isEmpty():
            level = new
            break
        full = full | now
        level = new
    target = F.when(full, F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(level))
    return materialize(table.select("source", "rank", "source_size", "source_docs", target.alias("target")), "source-targets")


def _ranked(sums: DataFrame) -> DataFrame:
    """Rows with ``rank``, their number in code-point order of ``source``, null
    last: sorted ranges, and the rows in the ranges before."""
    order = F.col("source").asc_nulls_last()
    ranges = sums.repartitionByRange(order).sortWithinPartitions(order)
    number = F.monotonically_increasing_id()  # the partition in the upper bits, the place in the lower 33
    ranges = materialize(ranges.withColumn("n", number), "ranked-sources")
    ranges = ranges.withColumn("range", F.shiftright("n", 33)).withColumn("place", F.col("n").bitwiseAND(F.lit((1 << 33) - 1))).drop("n")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per written partition
    sizes = ranges.groupBy("range").agg(F.count("*").alias("rows"))
    sizes = sizes.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    return ranges.join(sizes, "range").withColumn("rank", (F.col("first") + F.col("place")).cast("long")).drop("range", "place", "first")


def _prefix(rows: DataFrame, by: str, order: str, *values: str) -> DataFrame:
    """``rows`` with <value>_before: the sum over earlier rows of the same group.
    Sums of 1024 neighbouring keys first, so no task holds a whole group."""
    keyed = rows.withColumn("__high", F.shiftright(order, 10))
    over = Window.partitionBy(by).orderBy("__high").rowsBetween(Window.unboundedPreceding, -1)
    high = keyed.groupBy(by, "__high").agg(*[F.sum(v).alias(f"__{v}") for v in values])
    high = high.select(by, "__high", *[F.coalesce(F.sum(f"__{v}").over(over), F.lit(0)).alias(f"__{v}") for v in values])
    inner = Window.partitionBy(by, "__high").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = keyed.join(high, [by, "__high"])
    for v in values:
        out = out.withColumn(f"{v}_before", F.coalesce(F.sum(v).over(inner), F.lit(0)) + F.col(f"__{v}"))
    return out.drop("__high", *[f"__{v}" for v in values])


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` things drawn without replacement are good; exact for
    counts beyond the library's 10^9.

    There each thing is taken by itself with probability n / (good + bad). That is
    a fair choice of as many as came out, about sqrt(n) too many or too few; those
    are given back or added by a fair draw of that smaller size."""
    total = good + bad
    if 2 * n > total:
        return good - hypergeometric(rng, good, bad, total - n)
    if max(good, bad) < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    if n < 64:
        taken = 0
        for i in range(n):
            taken += int(rng.integers(total - i)) < good - taken
        return taken
    some, others = int(rng.binomial(good, n / total)), int(rng.binomial(bad, n / total))
    over = some + others - n
    if over >= 0:
        return some - hypergeometric(rng, some, others, over)
    return some + hypergeometric(rng, good - some, bad - others, -over)


def divide(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """Multivariate hypergeometric draw: how many of each kind are among ``n``."""
    out, rest = np.zeros(len(counts), np.int64), int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        if not n:
            break
        rest -= c
        out[i] = hypergeometric(rng, c, rest, n) if c else 0
        n -= int(out[i])
    return out


def _split(first: int, last: int, group: int, totals: np.ndarray, ranks: np.ndarray, quotas: np.ndarray, begin: np.ndarray, levels: int) -> Iterator[tuple]:
    """Rows (first, last, group, totals, ranks, quotas, begin) of a group ``levels``
    below its node, without sources that have no draws there."""
    used = quotas > 0
    if not used.any():
        return
    ranks, quotas, begin = ranks[used], quotas[used], begin[used]
    if levels == 0 or first == last:
        yield first, last, group, totals, ranks, quotas, begin
        return
    middle = (first + last) // 2
    share = int(totals.sum()) * (middle - first + 1) // (last - first + 1)
    of_groups = divide(np.random.default_rng([SEED, first, last]), totals, share)
    left = divide(np.random.default_rng([SEED, first, last, group + 1]), quotas, int(of_groups[group]))
    yield from _split(first, middle, group, of_groups, ranks, left, begin, levels - 1)
    yield from _split(middle + 1, last, group, totals - of_groups, ranks, quotas - left, begin + left, levels - 1)


_NODE = "first long, last long, group long, totals array<long>, ranks array<long>, quotas array<long>, begin array<long>"


def _expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in _NODE.split(", ")]
    for frame in frames:
        for r in frame.itertuples():
            nodes = _split(r.first, r.last, r.group, *(np.array(x, np.int64) for x in (r.totals, r.ranks, r.quotas, r.begin)), LEVELS)
            yield pd.DataFrame([(*n[:3], *(x.tolist() for x in n[3:])) for n in nodes], columns=names)


def splitting_tree(quotas: DataFrame, shards: int) -> DataFrame:
    """(rank, shard, begin, n): the draws of each source that each shard gets.
    ``quotas`` has rows (rank, quota); draws are numbered from 0 per source."""
    rows = quotas.withColumn("group", F.floor(F.col("rank") / GROUP))
    groups = rows.groupBy("group").agg(F.sum("quota").alias("q")).orderBy("group").collect()  # one number for GROUP sources
    known = rows.sparkSession.createDataFrame([(r["group"], i) for i, r in enumerate(groups)], "group long, at long")
    totals = F.lit([r["q"] for r in groups]).cast("array<long>")
    node = (rows.join(F.broadcast(known), "group").groupBy("at").agg(F.sort_array(F.collect_list(F.struct("rank", "quota"))).alias("q")))
    nodes = node.select(F.lit(0).cast("long").alias("first"), F.lit(shards - 1).cast("long").alias("last"), F.col("at").alias("group"), totals.alias("totals"),
                        F.col("q.rank").alias("ranks"), F.col("q.quota").alias("quotas"), F.transform("q", lambda _: F.lit(0).cast("long")).alias("begin"))
    depth = 0
    while (1 << depth) < shards:
        nodes = nodes.repartition("first", "group").mapInPandas(_expand, _NODE)
        depth += LEVELS
    return (nodes.select("first", F.explode(F.arrays_zip("ranks", "quotas", "begin")).alias("x"))
            .select(F.col("x.ranks").alias("rank"), F.col("first").alias("shard"), "x.begin", F.col("x.quotas").alias("n")).where("n > 0"))


def draw_plan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows (doc_id, source, size, perm), the sources' targets, and the plan:
    one row per drawn block of a source with its draws (pass, shard) and, in a
    pass that ends in the block, what it takes there: the documents up to a perm
    and, after the first that would pass the target, the smallest others."""
    rows = materialize(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"))
                       .withColumn("perm", permutation()), "sizes")
    targets = source_targets(rows)
    passes = F.floor(F.least(F.col("target") / F.col("source_size"), F.lit(MOST)))
    n_blocks = F.ceil((F.col("source_size") + F.col("source_docs")) / BLOCK_WORDS)
    plan = targets.where("source_size > 0").select("source", "rank", "source_size", "target", n_blocks.alias("n_blocks"), passes.alias("passes"),
                                                   (F.col("target") - passes * F.col("source_size")).alias("rest"))
    plan = materialize(plan, "source-plan")
    placed = placed_rows(rows, plan)
    blocks = placed.groupBy("rank", "block").agg(F.sum("size").alias("size"), F.lit(1).cast("long").alias("one"))
    blocks = materialize(_prefix(blocks, "rank", "block", "size", "one").join(plan.select("rank", "passes", "rest"), "rank"), "blocks")
    # the block in which the last pass ends, cut at a document
    ends = blocks.where("size_before <= rest and size_before + size > rest").select("rank", "block", F.col("size_before").alias("base"), "rest")
    inside = placed.join(ends, ["rank", "block"]).groupBy("rank", "block", "base", "rest", "perm").agg(F.sum("size").alias("size"))
    run = lambda *order: F.sum("size").over(Window.partitionBy("rank").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    fits = inside.where("rest > 0").withColumn("fits", F.col("base") + run("perm") <= F.col("rest"))
    small = F.when(F.col("fits"), F.lit(0)).otherwise(F.col("size"))
    cut = (fits.withColumn("mid", F.col("base") + run(~F.col("fits"), small, F.col("perm")) - F.col("size") / 2).where("fits or mid <= rest")
           .groupBy("rank", "block").agg(F.struct(F.max(F.when(F.col("fits"), F.col("perm"))).alias("perm"),
                                                  F.max(F.when(~F.col("fits"), F.struct("size", "perm"))).alias("fill")).alias("cut")))
    blocks = blocks.join(cut, ["rank", "block"], "left")
    whole = F.col("size_before") + F.col("size") <= F.col("rest")
    drawn = whole | F.col("cut").isNotNull()
    per_source = blocks.groupBy("rank").agg(F.sum("one").alias("n"), F.sum(F.when(drawn, 1).otherwise(0)).alias("extra"), F.first("passes").alias("passes"))
    per_source = materialize(per_source.withColumn("quota", F.col("n") * F.col("passes") + F.col("extra")), "quotas")
    words = targets.agg(F.sum("target")).first()[0] or 0
    shards = max(1, round(words / SHARD_WORDS))
    leaves = splitting_tree(per_source.where("quota > 0").select("rank", "quota"), shards)
    owner = leaves.select("rank", "shard", F.explode(F.sequence("begin", F.col("begin") + F.col("n") - 1)).alias("draw"))
    draws = _draws(blocks, per_source, drawn, whole)
    draws = draws.join(owner, ["rank", "draw"])
    per_block = draws.groupBy("rank", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard", "cut"))).alias("draws"))
    return rows, targets, materialize(per_block.join(plan.select("rank", "source", "n_blocks"), "rank"), "draw-plan")


def _draws(blocks: DataFrame, per_source: DataFrame, drawn: Column, whole: Column) -> DataFrame:
    """(rank, block, pass, draw, cut): every drawn block, numbered per source."""
    number = F.col("pass") * F.col("n") + F.col("one_before")
    passes = blocks.withColumn("last", F.when(drawn, F.col("passes")).otherwise(F.col("passes") - 1)).where("last >= 0")
    return (passes.withColumn("pass", F.explode(F.expr("sequence(0L, last)")))
            .join(per_source.select("rank", "n"), "rank")
            .select("rank", "block", "pass", number.alias("draw"),
                    F.when((F.col("pass") == F.col("passes")) & ~whole, F.col("cut")).alias("cut")))


def placed_rows(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` of planned sources with the source's rank and the block."""
    block = F.expr(f"cast(floor(perm * cast(n_blocks as decimal(20,0)) / {1 << _PERM_BITS}) as long)")
    return (rows.join(plan.select(F.col("source").alias("__s"), "rank", "n_blocks"), F.col("source").eqNullSafe(F.col("__s")))
            .withColumn("block", block).drop("__s"))


#: Whether a drawn block's entry d holds the row.
_HOLDS = "(d.cut is null or perm <= d.cut.perm or (size, perm) <= (d.cut.fill.size, d.cut.fill.perm))"


def mix_counts(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target (both of its source),
    n_copies and taken (words the mixture takes from it)."""
    rows, targets, plan = draw_plan(docs)
    sources = plan.select("source", "rank", "n_blocks").distinct()
    copies = F.expr(f"cardinality(filter(draws, d -> coalesce({_HOLDS}, false)))")
    taken = (placed_rows(rows, sources).join(plan.select("rank", "block", "draws"), ["rank", "block"], "left")
             .select("doc_id", "source", "size", F.coalesce(copies, F.lit(0)).cast("long").alias("n_copies")))
    undrawn = rows.join(sources.select(F.col("source").alias("__s")), F.col("source").eqNullSafe(F.col("__s")), "left_anti").select(
        "doc_id", "source", "size", F.lit(0).cast("long").alias("n_copies"))
    t = targets.select(F.col("source").alias("__s"), "source_size", "target")
    return (taken.unionByName(undrawn).join(t, F.col("source").eqNullSafe(F.col("__s")))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"), "n_copies"))


def mixture(docs: DataFrame) -> DataFrame:
    """The mixture: ``docs`` (all columns), each row as often as it is drawn, one
    partition run per output shard and shuffled inside it."""
    _, _, plan = draw_plan(docs)
    sources = plan.select("source", "rank", "n_blocks").distinct()
    held = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").cast("long"), F.col("source").cast("string"),
                       word_count(F.col("text")).alias("size")).withColumn("perm", permutation())
    drawn = (placed_rows(held, sources).join(plan.select("rank", "block", "draws"), ["rank", "block"])
             .select("__row", "doc_id", "size", "perm", F.explode("draws").alias("d")).where(_HOLDS)
             .select("__row", F.col("d.shard").alias("__shard"), F.xxhash64("doc_id", "d.shard", "d.pass", F.lit(SEED + 1)).alias("__order")))
    n = drawn.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return drawn.repartitionByRange(int(n), "__shard", "__order").sortWithinPartitions("__shard", "__order").select("__row.*")
