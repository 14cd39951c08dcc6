"""Mix sources to target weights: equal blocks of words, apportioned by highest quotients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from speechlake.llm.text import SPACE
from speechlake.operators.checkpoints import settle

BLOCK = 64  # words in a block
SHARD = 1 << 20  # words in a shard, about
REPEATS = 3  # a source, and so a document, is taken at most so many times
STRIDE = 2147483647  # a prime above any number of blocks in a shard


def _rows(docs: DataFrame, text: str, doc_id: str, source: str, seed: int) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id)).alias("draw"), F.xxhash64(F.col(text)).alias("tie"),
    )


def capped_targets(sources: DataFrame, weights: tuple[float, ...], repeats: int = REPEATS) -> DataFrame:
    """The columns of ``sources`` and ``target``: shares of all words by weight, none above ``repeats`` times its source.

    Sources come in code point order, null last, and take the weights in turn. With a factor f, a source gets
    the smaller of f times its weight and its cap; f is the one at which the targets add up to all words.
    As caps sorted by cap per weight are reached one after the other, it comes from running sums, without
    rounds: the first k sources are capped for the smallest k whose rest does not reach the next cap.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int") + 1)
    weighed = sources.withColumn("_w", weigh).withColumn("_cap", F.col("source_size") * F.lit(float(repeats)))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    factors = weighed.withColumn("_f", rest / F.sum("_w").over(from_here)).withColumn(
        "_at", F.row_number().over(by_cap))
    # the first source whose share stays below its cap sets the factor; those before it are at their caps
    free = F.when(F.col("_f") * F.col("_w") <= F.col("_cap"), F.struct("_at", "_f"))
    return factors.withColumn("_factor", F.min(free).over(every)["_f"]).select(
        *sources.columns,
        F.least(F.coalesce(F.col("_factor") * F.col("_w"), F.col("_cap")), F.col("_cap")).alias("target"))


def apportion(parties: DataFrame, within: list[str], votes: str, seats: Column, name: str, tie: list[str]) -> DataFrame:
    """Divide ``seats`` among the rows of each group by the highest quotients ``votes / (2 k - 1)``.

    With n parties, V votes and N seats, a party's seats lie between those of the divisors
    ``V / (N - n / 2)`` and ``V / (N + n / 2)``: the first gives at most N seats, the second at least N.
    Only quotients between the two, about 2 n rows, are ranked. Parties without votes get none.
    """
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    p = (parties.withColumn("_v", F.col(votes).cast("double")).withColumn("_n", F.count(F.lit(1)).over(group))
         .withColumn("_all", F.sum("_v").over(group)).withColumn("_seats", seats.cast("double")))

    def at(count: Column) -> Column:
        return F.when(F.col("_all") > 0, F.floor(F.col("_v") * F.greatest(count, F.lit(0.0)) / F.col("_all") + 0.5)
                      ).otherwise(F.lit(0)).cast("long")

    low = at(F.col("_seats") - F.col("_n") / 2 - 1)
    high = F.when(F.col("_v") > 0, at(F.col("_seats") + F.col("_n") / 2 + 1)).otherwise(F.lit(0)).cast("long")
    p = p.withColumn("_low", F.least(low, high)).withColumn("_high", high)
    # one row for the seats a party has for certain (k = low) and one for each seat it may win
    each = p.withColumn("_k", F.explode(F.sequence(F.col("_low"), F.col("_high"))))
    sure = F.col("_k") == F.col("_low")
    rank = F.sum(F.when(sure, 0).otherwise(1)).over(
        Window.partitionBy(*(within or [F.lit(0)])).orderBy(
            sure.desc(), (F.col("_v") / (2 * F.col("_k") - 1)).desc(), *tie, "_k"
        ).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    held = F.sum(F.when(sure, F.col("_low")).otherwise(0)).over(Window.partitionBy(*(within or [F.lit(0)])))
    won = F.when(sure, F.col("_low")).when(F.col("_rank") <= F.col("_seats") - F.col("_held"), 1).otherwise(0)
    return each.withColumn("_rank", rank).withColumn("_held", held).groupBy(*within, *tie).agg(
        F.sum(won).cast("long").alias(name))


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), text: str = "text", doc_id: str = "doc_id",
    source: str = "source", seed: int = 20, block: int = BLOCK, shard: int = SHARD, repeats: int = REPEATS,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``, one row for each document.

    A source's documents are dealt by hash to shards of about ``shard`` words (or documents, if more), where a seeded order
    makes them one run of words, cut into equal blocks. Each source gets blocks by Sainte-Laguë from all words,
    and so does each of its shards from the source's blocks. A shard takes itself whole as often as its quota
    allows; which blocks it takes for the rest is a seeded permutation of block numbers in closed form,
    so nothing is ranked and every document counts its own blocks. A quota beyond ``repeats`` times
    a shard (rounding) is cut there.

    Null texts and texts without words have size 0 and take 0; a null source is a source of its own; rows with
    the same doc_id are documents of their own; an empty table gives an empty one. Column names of ``docs``
    other than the three named are not read. Runs a job: the sizes are written once.
    """
    rows = settle(_rows(docs, text, doc_id, source, seed))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = capped_targets(sums, weights, repeats)
    everything = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    seats = apportion(targets.withColumn("_all_blocks", F.round(everything / block)).withColumn(
        "_null", F.col("source").isNull()), [], "target", F.col("_all_blocks"), "blocks", ["_null", "source"])
    seats = seats.select(F.col("source").alias("_source"), "blocks")
    sources = settle(targets.join(seats, F.col("source").eqNullSafe(F.col("_source"))).select(
        "source", "source_size", "target", "blocks",
        F.ceil(F.greatest("source_size", "n_docs") / shard).cast("long").alias("n_shards")))  # texts may have no words
    near = sources.withColumnRenamed("source", "_source")
    dealt = rows.join(near, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed + 1), "draw", "tie"), F.col("n_shards"))
    ).withColumn("_null", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    shards = dealt.groupBy("_null", "source", "shard").agg(
        F.sum("size").alias("words"), F.first("blocks").alias("blocks"))
    quota = apportion(shards, ["_null", "source"], "words", F.col("blocks"), "quota", ["shard"])
    plan = shards.drop("blocks").join(quota, ["_null", "source", "shard"]).select(
        "_null", "source", "shard", "words", "quota")
    seeded = Window.partitionBy("_null", "source", "shard").orderBy("draw", "doc_id", "tie", "size")
    placed = dealt.withColumn("_end", F.sum("size").over(seeded.rowsBetween(Window.unboundedPreceding, 0)))
    n_blocks = F.greatest(F.ceil(F.col("words") / block), F.lit(1)).cast("long")
    start = F.pmod(F.xxhash64(F.lit(seed + 2), "_null", "source", "shard"), F.col("_m"))
    begin = F.col("_end") - F.col("size")
    numbers = F.sequence(F.floor(begin / block), F.floor((F.col("_end") - 1) / block))
    part = F.aggregate(numbers, F.lit(0).cast("long"), lambda got, k: got + F.when(
        F.pmod(k * F.lit(STRIDE) + F.col("_start"), F.col("_m")) < F.col("_rest"),
        F.least((k + 1) * block, F.col("_end")) - F.greatest(k * block, F.col("_begin"))).otherwise(F.lit(0)).cast("long"))
    whole = F.least(F.floor(F.col("quota") / F.col("_m")), F.lit(repeats))
    taken = F.when(F.col("size") > 0, F.col("size") * F.col("_whole") + F.when(
        (F.col("_rest") > 0) & (F.col("_whole") < repeats), part).otherwise(F.lit(0))).otherwise(F.lit(0))
    return (
        placed.join(plan, ["_null", "source", "shard"]).withColumn("_m", n_blocks).withColumn("_whole", whole)
        .withColumn("_rest", F.col("quota") - F.col("_whole") * F.col("_m")).withColumn("_start", start)
        .withColumn("_begin", begin)
        .select("doc_id", F.when(~F.col("_null"), F.col("source")).alias("source"), "size", "source_size", "target",
                taken.cast("long").alias("taken"), "draw", "tie")
    )
