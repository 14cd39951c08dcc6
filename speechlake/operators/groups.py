"""Group occurrences of the same passage, and pick one clip for each group."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.functions.rounding import round_exact
from speechlake.operators.blocks import order_statistics
from speechlake.operators.checkpoints import discard, settle

MIN_CLIP_SECONDS = 10.0  # fixed value: shorter groups are not worth a clip


def _followed(near: DataFrame) -> DataFrame:
    """``_at, _to`` with every pointer followed to its end, in twice as long steps each time; ``near`` is settled and points to smaller nodes only."""
    while True:
        further = near.select(F.col("_at").alias("_at2"), F.col("_to").alias("_to2"))
        moved = settle(near.join(further, F.col("_to") == F.col("_at2")).select(
            "_at", F.col("_to2").alias("_to"), (F.col("_to") != F.col("_to2")).alias("_moved")))
        discard(near)
        near = moved
        if near.where("_moved").isEmpty():
            return near


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``node, component`` for edges ``src, dst``; a component is named by its smallest node. ``nodes`` (``node``, each once) spares looking for them.

    Each round points every node to its smallest neighbour, if that is smaller, follows the pointers to their ends, and puts the ends in
    place of the nodes: at most half of the nodes are left, and of the edges those between different ends, each once.
    Rounds go on until no edge is left. Each is written to the shared folder and the one before it is
    removed. Runs jobs; the result is settled, so ``discard`` removes it.
    """
    pair = lambda a, b: F.struct(F.col(a).alias("_at"), F.col(b).alias("_to"))
    if nodes is None:
        nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).where("node is not null").distinct()
    labels = settle(nodes.select("node", F.col("node").alias("component")))
    left = settle(edges.select("src", "dst").where(F.col("src") != F.col("dst")))
    while not left.isEmpty():
        both = left.select(F.explode(F.array(pair("src", "dst"), pair("dst", "src"))).alias("_e")).select("_e.*")
        ends = _followed(settle(both.groupBy("_at").agg(F.min("_to").alias("_to")).select("_at", F.least("_at", "_to").alias("_to"))))
        ends_of = lambda side: ends.select(F.col("_at").alias(side), F.col("_to").alias(f"_{side}"))
        lowered = settle(labels.join(ends_of("component"), "component", "left").select(
            "node", F.coalesce("_component", "component").alias("component")))
        fewer = settle(left.join(ends_of("src"), "src").join(ends_of("dst"), "dst").where(F.col("_src") != F.col("_dst")).select(
            F.least("_src", "_dst").alias("src"), F.greatest("_src", "_dst").alias("dst")).distinct())
        for done in (labels, left, ends):
            discard(done)
        labels, left = lowered, fewer
    discard(left)
    return labels


def occurrence_key(file: Column, start: Column, end: Column) -> Column:
    """Name of an occurrence; times that agree to a tenth of a second are the same one."""
    return F.concat_ws("|", file.cast("string"),
                       F.format_string("%.1f", round_exact(start, 1)),
                       F.format_string("%.1f", round_exact(end, 1)))


def _numbered(places: DataFrame, columns: list[str]):
    """The settled places with a 64-bit ``_id`` of their columns, and the function that gives it; the first of its seeds that gives no two one number."""
    for seed in itertools.count():
        number = lambda names, seed=seed: F.xxhash64(F.lit(seed), *names)
        if places.groupBy(number(columns).alias("_id")).count().where("count > 1").isEmpty():
            return places.withColumn("_id", number(columns)), number


def group_occurrences(matches: DataFrame) -> DataFrame:
    """``component, node, file_id, start_s, end_s`` for every occurrence in a match table.

    Places with different times are numbered and linked by numbers; they are named, and those of one name linked, only once each.
    Runs jobs; the result is settled.
    """
    columns = ["file_id", "start_s", "end_s"]
    of = lambda side: [f"file_{side}", f"{side}_start_s", f"{side}_end_s"]
    sides = [F.struct(*[F.col(c).alias(name) for c, name in zip(of(side), columns)]) for side in "ab"]
    places = matches.select(F.explode(F.array(*sides)).alias("o")).select("o.*").distinct()
    places, number = _numbered(settle(places.withColumn("node", occurrence_key(*map(F.col, columns)))), columns)
    links = matches.select(number(of("a")).alias("src"), number(of("b")).alias("dst"))
    named = places.groupBy("node", "file_id").agg(
        F.min(F.struct("start_s", "end_s")).alias("at"), F.min("_id").alias("_id"))
    same = places.join(named.select("node", F.col("_id").alias("_least")), "node").where(
        F.col("_id") != F.col("_least")).select(F.col("_id").alias("src"), F.col("_least").alias("dst"))
    found = connected_components(links.unionByName(same), places.select(F.col("_id").alias("node")))
    nodes = settle(named.join(found.select(F.col("node").alias("_id"), F.col("component").alias("_component")), "_id").select(
        "node", "file_id", "at.start_s", "at.end_s", "_component"))
    discard(found)
    names = nodes.groupBy("_component").agg(F.min("node").alias("component"))
    return settle(nodes.join(names, "_component").select("component", "node", "file_id", "start_s", "end_s"))


def canonical_clips(
    occurrences: DataFrame, min_seconds: float = MIN_CLIP_SECONDS, cell: float = 1.0
) -> DataFrame:
    """Longest occurrence of every group whose upper-median duration is long enough."""
    lengths = occurrences.withColumn("_len", F.col("end_s") - F.col("start_s"))
    typical = order_statistics(
        lengths, ["component"], "_len", {"typical_s": lambda n: F.floor(n / 2) + 1}, cell
    )
    best = F.struct(
        (-F.col("_len")).alias("rank"), "file_id", "start_s", "end_s"
    )
    longest = lengths.groupBy("component").agg(
        F.min(best).alias("b"), F.count(F.lit(1)).alias("n_occurrences")
    )
    return longest.join(typical.where(F.col("typical_s") >= min_seconds), "component").select(
        "component", "b.file_id", "b.start_s", "b.end_s", "n_occurrences", "typical_s"
    )
