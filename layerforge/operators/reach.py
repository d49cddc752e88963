"""Reach of every asset of a lineage graph by labels instead of pairs.

An asset with one way on reaches exactly that next asset and what it reaches.  Such assets hang as trees on the
assets where the ways end or part (``tops``), so a label of three numbers is enough for each of them: its top, the
distance to it, and how many assets hang below.  Only the tops where ways part get pairs (``top_pairs``).

    downstream of a  =  the assets on its way to its top, and what the top reaches
    upstream of a    =  the assets that hang below it, and all that hang on the tops that reach it

Labels are found by pointer doubling: depth d takes about log2(d) rounds, each an equi-join of the assets with
themselves, so a chain of any length stays a table of one row per asset.  An asset on a way that its own top leads
back to reaches the same as the top; it becomes a top with the top's pairs (``alias``).  Of a cycle without any
parting, the smallest asset becomes a top.  Where nearly every asset's ways part, the pairs are those of the whole
graph; so it is read in the direction in which fewer ways part.

``all_pairs`` writes the pairs out.  The assets on a way are put together as lists that double their length, so no
pair is joined, compared or looked for twice, and an asset that all others reach is no key that all pairs share.

A null end of an edge is no asset.  An asset on a cycle reaches itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from layerforge.operators.lineage import pairs_from
from layerforge.session import write_through


@dataclass(frozen=True)
class Labels:
    """``labels``: asset, top, alias, dist, hung (assets on ways through it, itself included), one row per asset;
    ``pairs``: asset (an alias), reached; ``hops[i]``: asset, far for those with a way of 2^i hops before a top ends it;
    ``turned``: made against the edge direction."""

    labels: DataFrame
    pairs: DataFrame
    hops: list[DataFrame]
    turned: bool


def _assets(e: DataFrame) -> DataFrame:
    """(asset, ways, next, back_ways, back, self): of both directions the number of edges and the smallest other end."""
    none = F.lit(None).cast(e.schema["a"].dataType)
    ends = e.select(F.col("a").alias("asset"), F.col("b").alias("next"), none.alias("back"), (F.col("a") == F.col("b")).alias("self")).unionByName(
        e.select(F.col("b").alias("asset"), none.alias("next"), F.col("a").alias("back"), F.lit(False).alias("self")))
    return ends.groupBy("asset").agg(F.count("next").alias("ways"), F.min("next").alias("next"), F.count("back").alias("back_ways"),
                                     F.min("back").alias("back"), F.bool_or("self").alias("self"))


def _counted(df: DataFrame, name: str, condition: Column) -> tuple[DataFrame, int]:
    """``df`` stored, and how many of its rows meet ``condition``, counted while they are written."""
    seen = Observation()
    stored = write_through(df.observe(seen, F.count_if(condition).alias("n")), name)
    return stored, seen.get["n"]


def _doubled(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame], bool]:
    """``nodes`` (asset, next or null at a top) -> (asset, far, dist, hung), the rounds, whether a cycle is left.

    After round i ``far`` is the asset 2^i hops on, or the top if it comes before.  The number of assets with 2^i
    hops before them falls until it is 0; if it stands still, the rest leads into cycles, as an asset d hops from its
    top has one 2^i hops from it on its way.
    """
    state, n = _counted(nodes.select("asset", F.coalesce("next", "asset").alias("far"),
                                     F.col("next").isNotNull().cast("long").alias("dist"), F.lit(1).cast("long").alias("hung")),
                        "reach", F.col("dist") == 1)
    hops, step, before = [], 1, None
    while n and n != before:
        far = state.where(F.col("dist") == step)
        hops.append(far.select("asset", "far"))
        below = far.groupBy(F.col("far").alias("asset")).agg(F.sum("hung").alias("_below"))
        ahead = state.select(F.col("asset").alias("_at"), F.col("far").alias("_far"), F.col("dist").alias("_dist"))
        before = n
        state, n = _counted(
            state.join(below, "asset", "left").join(ahead, (F.col("far") == F.col("_at")) & (F.col("dist") == step), "left")
            .select("asset", F.coalesce("_far", "far").alias("far"), (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist"),
                    (F.col("hung") + F.coalesce("_below", F.lit(0))).alias("hung")), "reach", F.col("dist") == 2 * step)
        step *= 2
    return state, hops, n > 0


def _cycle_tops(nodes: DataFrame) -> DataFrame:
    """(asset): the smallest asset of every cycle that only assets with one way on make up.

    The smallest asset ahead, over twice as many hops each round, until no round lowers it; on a cycle the smallest
    asset meets itself.
    """
    state = write_through(nodes.where("next IS NOT NULL").select("asset", F.col("next").alias("far"), F.col("next").alias("least")), "cycles")
    while True:
        ahead = state.select(F.col("asset").alias("_at"), F.col("far").alias("_far"), F.col("least").alias("_least"))
        state, lowered = _counted(state.join(ahead, state["far"] == ahead["_at"], "left").select(
            "asset", F.col("_far").alias("far"), F.least("least", "_least").alias("least"),
            (F.col("_least") < F.col("least")).alias("lower")), "cycles", F.col("lower"))
        if not lowered:
            return state.where(F.col("least") == F.col("asset")).select("asset")


def reach_labels(edges: DataFrame, turned: bool | None = None) -> Labels:
    """Labels of the graph (src, dst); ``turned`` None: the direction in which fewer ways part."""
    e = write_through(edges.where("src IS NOT NULL AND dst IS NOT NULL").select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct(), "edges")
    known = write_through(_assets(e), "assets")
    if turned is None:
        turned = known.agg(F.expr("count_if(back_ways > 1) < count_if(ways > 1)")).head()[0]
    ways, on = ("back_ways", "back") if turned else ("ways", "next")
    parts = (F.col(ways) > 1) | F.col("self")
    nodes = known.select("asset", F.when((F.col(ways) == 1) & ~F.col("self"), F.col(on)).alias("next"))
    state, hops, cyclic = _doubled(nodes)
    tops = known.where(parts).select("asset")
    if cyclic:
        more = write_through(_cycle_tops(nodes), "tops")
        nodes, tops = _with_tops(nodes, more), tops.unionByName(more)
        state, hops, _ = _doubled(nodes)
    pairs = pairs_from(e.select(F.col("b").alias("a"), F.col("a").alias("b")) if turned else e, tops).select(
        F.col("a").alias("asset"), F.col("b").alias("reached"))
    # An asset that its own top leads back to reaches what the top reaches.
    own = pairs.where("asset <> reached").select(F.col("asset").alias("far"), F.col("reached").alias("asset"))
    aliases, n = _counted(state.select("asset", "far").join(own, ["far", "asset"], "left_semi").select("asset", F.col("far").alias("alias")),
                          "aliases", F.lit(True))
    if not n:
        return Labels(state.select("asset", F.col("far").alias("top"), F.col("far").alias("alias"), "dist", "hung"), pairs, hops, turned)
    state, hops, _ = _doubled(_with_tops(nodes, aliases.select("asset")))
    named = state.join(aliases.withColumnRenamed("asset", "far"), "far", "left")
    labels = named.select("asset", F.col("far").alias("top"), F.coalesce("alias", "far").alias("alias"), "dist", "hung")
    return Labels(write_through(labels, "labels"), pairs, hops, turned)


def _with_tops(nodes: DataFrame, more: DataFrame) -> DataFrame:
    marked = more.select("asset", F.lit(True).alias("_top"))
    return write_through(nodes.join(marked, "asset", "left").select("asset", F.when(F.col("_top").isNull(), F.col("next")).alias("next")), "assets")


def reach_counts(found: Labels) -> DataFrame:
    """(asset, n_downstream, n_upstream) of every asset of the graph, exact, from its labels."""
    labels, pairs = found.labels, found.pairs
    beyond = pairs.groupBy(F.col("asset").alias("alias")).agg(F.count(F.lit(1)).alias("beyond"))
    # A top that reaches itself is counted among what it reaches, not on the way to it.
    looped = pairs.where("asset = reached").select(F.col("asset").alias("alias"), F.lit(1).alias("looped"))
    hanging = labels.where("dist = 0").groupBy("alias").agg(F.sum("hung").alias("hanging"))
    through = (pairs.join(hanging, pairs["asset"] == hanging["alias"])
               .groupBy(F.col("reached").alias("asset")).agg(F.sum("hanging").alias("through")))
    tops = beyond.join(looped, "alias", "left")
    ahead = F.col("dist") - F.when((F.col("dist") > 0) & F.col("looped").isNotNull(), 1).otherwise(0) + F.coalesce("beyond", F.lit(0))
    # What hangs below a top on a cycle reaches it through the top itself, and is in ``through``.
    behind = F.when((F.col("dist") == 0) & F.col("looped").isNotNull(), 0).otherwise(F.col("hung") - 1) + F.coalesce("through", F.lit(0))
    down, up = ("n_upstream", "n_downstream") if found.turned else ("n_downstream", "n_upstream")
    return labels.join(tops, "alias", "left").join(through, "asset", "left").select(
        "asset", ahead.cast("long").alias(down), behind.cast("long").alias(up)).select("asset", "n_downstream", "n_upstream")


#: Assets that a list of the table of ways holds at most; longer ways are several lists.
BLOCK_HOPS = 6
BLOCK = 1 << BLOCK_HOPS


def _blocks(found: Labels) -> DataFrame:
    """(asset, way): the next assets on the way to the top, in order, ``BLOCK`` at most; tops have none.

    A list is continued by the list of its last asset.  Only lists that some other one goes on with are looked up, a
    stored table that gets small where many ways meet, and is then sent to the tasks instead of shuffling all lists.
    """
    ways, done = found.hops[0].select("asset", F.array("far").alias("way")), []
    for i in range(min(BLOCK_HOPS, len(found.hops))):
        full = F.size("way") == (1 << i)
        going = ways.where(full).select("asset", "way", F.element_at("way", -1).alias("_last"))
        met = going.select(F.col("_last").alias("asset")).distinct()
        every = reduce(DataFrame.unionByName, [*done, ways])
        ahead = write_through(every.join(met, "asset", "left_semi").select(F.col("asset").alias("_at"), F.col("way").alias("_way")), "ways-ahead")
        if i:  # at first all lists have one asset
            done.append(ways.where(~full))
        longer = going.join(ahead, F.col("_last") == F.col("_at"), "left")
        ways = write_through(longer.select("asset", F.when(F.col("_way").isNull(), F.col("way")).otherwise(F.concat("way", "_way")).alias("way")), "ways")
    return reduce(DataFrame.unionByName, [*done, ways])


def all_pairs(found: Labels, reverse: bool = False) -> DataFrame:
    """(asset, reached): every pair of the graph once, downstream or (``reverse``) upstream.

    The pairs of an asset are the lists of its way and the pairs of its top.  A list starts at the asset and at every
    ``BLOCK``-th asset after it: these are found by the hops whose lengths make up the multiples of ``BLOCK``.
    """
    labels, pairs = found.labels, found.pairs
    # A top that reaches itself is on the way of what hangs on it.
    beyond = labels.join(pairs.withColumnRenamed("asset", "alias"), "alias").where(
        (F.col("dist") == 0) | (F.col("reached") != F.col("top"))).select("asset", "reached")
    out = beyond
    if found.hops:
        blocks = write_through(_blocks(found), "ways")
        on_way = blocks.select("asset", F.explode("way").alias("reached"))
        starts = None
        for hop in reversed(found.hops[BLOCK_HOPS:]):
            step = hop.select(F.col("asset").alias("at"), F.col("far").alias("_far"))
            first = hop.select("asset", F.col("far").alias("at"))
            starts = first if starts is None else first.unionByName(starts).unionByName(
                starts.join(step, "at").select("asset", F.col("_far").alias("at")))
            starts = write_through(starts, "ways-starts")
        if starts is not None:
            later = starts.join(blocks.select(F.col("asset").alias("at"), "way"), "at")
            on_way = on_way.unionByName(later.select("asset", F.explode("way").alias("reached")))
        out = on_way.unionByName(beyond)
    return out.select(F.col("reached").alias("asset"), F.col("asset").alias("reached")) if reverse != found.turned else out


def reaches(found: Labels, asked: DataFrame) -> DataFrame:
    """The rows of ``asked`` (asset, other), once each, with ``reached``: whether the asset flows into the other.

    On one way the asset is lifted towards its top by the difference of the distances, a stored round a binary digit,
    and must arrive at the other; else its top must have the pair.  Ends that the graph doesn't know reach nothing.
    """
    asked = asked.select("asset", "other").distinct()
    a, b = ("other", "asset") if found.turned else ("asset", "other")
    own = found.labels.select(F.col("asset").alias(a), F.col("top").alias("_top"), F.col("alias").alias("_alias"), F.col("dist").alias("_dist"))
    far = found.labels.select(F.col("asset").alias(b), F.col("top").alias("_top2"), F.col("dist").alias("_dist2"))
    rows = asked.join(own, a, "left").join(far, b, "left")
    gap = F.col("_dist") - F.col("_dist2")
    rows = rows.select("asset", "other", "_alias", F.col(a).alias("_at"), F.when((F.col("_top") == F.col("_top2")) & (gap > 0), gap).alias("_gap"))
    for i, hop in enumerate(found.hops):
        step = hop.select(F.col("asset").alias("_from"), F.col("far").alias("_far"))
        due = F.col("_gap").bitwiseAND(F.lit(1 << i)) != 0
        rows = rows.join(step, (F.col("_at") == F.col("_from")) & due, "left").withColumn("_at", F.coalesce("_far", "_at")).drop("_from", "_far")
    pairs = found.pairs.select(F.col("asset").alias("_alias"), F.col("reached").alias(b), F.lit(True).alias("_pair"))
    return rows.join(pairs, ["_alias", b], "left").select(
        "asset", "other", (F.coalesce((F.col("_at") == F.col(b)) & (F.col("_gap") > 0), F.lit(False)) | F.coalesce("_pair", F.lit(False))).alias("reached"))
