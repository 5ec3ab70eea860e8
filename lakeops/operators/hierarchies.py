"""Parent-child tables of any depth, climbed in rounds that double the distance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.sinks import materialize
from .joins import anti, lookup


def _one_parent(links: DataFrame, unit: str, parent: str) -> DataFrame:
    """Each unit once, under its least parent; a unit without one, or without a name, is no link."""
    return links.where(F.col(unit).isNotNull() & F.col(parent).isNotNull()).groupBy(F.col(unit).alias("unit")).agg(
        F.min(parent).alias("parent"))


def repeated_parents(links: DataFrame, unit: str, parent: str) -> DataFrame:
    """Units that are given several parents, of which climbing takes the least."""
    return links.groupBy(F.col(unit).alias("unit")).agg(
        F.countDistinct(parent).alias("n_parents")).where("n_parents > 1")


def on_cycles(links: DataFrame, unit: str = "unit", parent: str = "parent", checkpoints: str | None = None) -> DataFrame:
    """(unit): the units that are their own ancestors.

    Every unit jumps to its parent, then to the jump of its jump. After rounds enough to pass
    every unit, only units whose way never ends still jump, and what they jump to lies on a cycle;
    every unit of a cycle is reached, as each is so many steps above another one. Without cycles it
    ends after as many rounds as the depth has bits.
    """
    jumps = materialize(_one_parent(links, unit, parent).withColumnRenamed("parent", "jump"), checkpoints=checkpoints)
    left, passed = jumps.count(), 1
    units = left
    while left and passed < units:
        jumps = materialize(lookup(jumps, jumps, [("jump", "unit")], [("jump", "next")]).select(
            "unit", F.col("next").alias("jump")).where("jump is not null"), checkpoints=checkpoints)
        left, passed = jumps.count(), 2 * passed
    return jumps.select(F.col("jump").alias("unit")).distinct()


def paths(links: DataFrame, unit: str = "unit", parent: str = "parent", checkpoints: str | None = None) -> DataFrame:
    """(unit, path, depth, top, cyclic): the ancestors of each unit, the nearest first, however many.

    ``top`` is the last of them. A unit whose way up leads into a cycle has the ancestors before
    the cycle, ``cyclic`` true and no top. A way is put together from halves: each round appends to
    a unit's path the path of where it ends, so the rounds are as many as the depth has bits, and
    each moves only units that are not at their top yet. No depth is declared or limited.
    """
    every = _one_parent(links, unit, parent)
    cycle = on_cycles(links, unit, parent, checkpoints)
    # A cycle's units are a way's end, as tops are.
    plain = anti(every, cycle, ["unit"])
    state = materialize(plain.select("unit", F.array("parent").alias("path"), F.col("parent").alias("jump")), checkpoints=checkpoints)
    done = None
    while True:
        met = lookup(state.where("jump is not null"), state, [("jump", "unit")], [("path", "more"), ("jump", "next"), ("unit", "found")])
        longer = met.select("unit", F.when(F.col("found").isNull(), F.col("path")).otherwise(F.concat("path", "more")).alias("path"),
                            F.col("next").alias("jump"))
        ended = state.where("jump is null")
        state = materialize(longer.unionByName(ended), checkpoints=checkpoints)
        if state.where("jump is not null").isEmpty():
            done = state
            break
    last = F.element_at("path", -1)
    ends = done.select("unit", "path", last.alias("last")).unionByName(
        every.join(cycle, "unit", "left_semi").select("unit", F.array().cast(done.schema["path"].dataType).alias("path"), F.col("unit").alias("last")))
    marked = lookup(ends, cycle.withColumn("hit", F.lit(True)), [("last", "unit")], ["hit"])
    cyclic = F.coalesce("hit", F.lit(False))
    before = F.when(cyclic & (F.size("path") > 0), F.slice("path", 1, F.size("path") - 1)).otherwise(F.col("path"))
    return marked.select("unit", before.alias("path"), F.size(before).alias("depth"),
                         F.when(~cyclic, F.col("last")).alias("top"), cyclic.alias("cyclic"))
