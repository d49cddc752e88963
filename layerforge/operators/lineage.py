"""Lineage as an edge table: closure, reach, paths, impact and report.

Edges are rows (src, dst): data flows from ``src`` into ``dst``.  All pairs of
a graph come from reach labels (``reach.all_pairs``); the others are
computed by semi-naive iteration: each round joins only what the previous
round found (the frontier) and removes what is already known (``left_anti``).
The loop ends when a round finds nothing, so cycles end too, and a node on a
cycle reaches itself.  Every round is written once below the shared checkpoint
folder and never rewritten: what is known is the files of all rounds so far.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.session import scratch_dir, write_through

# Impact risk bands (affected assets, affected transformations).
HIGH_ASSETS, HIGH_TRANSFORMS = 10, 5
MEDIUM_ASSETS, MEDIUM_TRANSFORMS = 5, 2


def edges_from_transformations(transformations: DataFrame) -> DataFrame:
    """(target, source_assets array, type, logic) -> one edge per source."""
    return transformations.select(
        F.explode("source_assets").alias("src"), F.col("target_asset").alias("dst"),
        F.col("transformation_type").alias("type"), F.col("transformation_logic").alias("logic"))


class _Rounds:
    """The rows of all rounds, each round its own folder of Parquet files."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.paths, self.schema = spark, scratch_dir(spark, name), [], None

    def add(self, df: DataFrame) -> DataFrame:
        """Write a round; its rows as stored."""
        path = f"{self.base}/round-{len(self.paths)}"
        df.write.mode("errorifexists").parquet(path)
        self.schema = self.schema or df.schema
        self.paths.append(path)
        return self.spark.read.schema(self.schema).parquet(path)

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.paths)


def _directed(edges: DataFrame, reverse: bool) -> DataFrame:
    a, b = ("dst", "src") if reverse else ("src", "dst")
    # No NULL filter here: a NULL end never joins.
    return write_through(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct(), "edges")


def closure(edges: DataFrame, reverse: bool = False, method: str = "labels",
            start: DataFrame | None = None) -> DataFrame:
    """(asset, reached) pairs: downstream (follow edges) or upstream (``reverse``).

    ``start`` (a column ``asset``) asks for the pairs of those assets alone;
    without it every pair of the graph is made, which can be far more rows
    than edges.  ``labels`` (all pairs): the ways up to where they part are
    written out as lists, and only what lies beyond is searched.
    ``doubling``: round i finds the pairs whose shortest path has length in
    (2^i, 2^(i+1)], so depth d takes about log2(d) + 1 rounds, each of which
    shuffles all pairs so far.  ``linear``, and always with ``start``: the frontier
    joined with the edges, d rounds with the least work per round.
    """
    if method == "labels" and start is None:
        return _closure_by_labels(edges, reverse)
    return pairs_from(_directed(edges, reverse), start, method).select(F.col("a").alias("asset"), F.col("b").alias("reached"))


def _closure_by_labels(edges: DataFrame, reverse: bool) -> DataFrame:
    from layerforge.operators.reach import all_pairs, reach_labels  # reach builds on the search below

    ends = edges.select("src", "dst")
    if ends.where("src IS NULL OR dst IS NULL").isEmpty():
        return all_pairs(reach_labels(ends), reverse)
    # A NULL end reaches and is reached, but leads nowhere: as a source and as a target it is an asset of its own.
    node = lambda c, kind: F.struct(F.when(F.col(c).isNull(), kind).otherwise(0).alias("kind"), F.col(c).alias("id"))
    named = ends.select(node("src", 1).alias("src"), node("dst", 2).alias("dst"))
    return all_pairs(reach_labels(named), reverse).select(F.col("asset.id").alias("asset"), F.col("reached.id").alias("reached"))


def pairs_from(e: DataFrame, start: DataFrame | None, method: str = "linear") -> DataFrame:
    """``closure`` over stored, distinct edges (a, b), as pairs (a, b)."""
    first = e if start is None else e.join(start.select(F.col("asset").alias("a")).distinct(), "a", "left_semi")
    rounds = _Rounds(e.sparkSession, "closure")
    frontier = rounds.add(first)
    while not frontier.isEmpty():
        right = rounds.all() if method == "doubling" and start is None else e
        step = (frontier.alias("f").join(right.alias("e"), F.col("f.b") == F.col("e.a"))
                .select(F.col("f.a").alias("a"), F.col("e.b").alias("b")).distinct())
        frontier = rounds.add(step.join(rounds.all(), ["a", "b"], "left_anti"))
    return rounds.all()


def reached_from(edges: DataFrame, start: DataFrame, reverse: bool = False) -> DataFrame:
    """(reached): every asset that some asset of ``start`` reaches, once; no pairs are made."""
    e = _directed(edges, reverse)
    rounds = _Rounds(edges.sparkSession, "reach")
    step = lambda nodes: (nodes.join(e, nodes["reached"] == e["a"])
                          .select(F.col("b").alias("reached")).distinct())
    frontier = rounds.add(step(start.select(F.col("asset").alias("reached")).distinct()))
    while not frontier.isEmpty():
        frontier = rounds.add(step(frontier).join(rounds.all(), "reached", "left_anti"))
    return rounds.all()


#: Hops that one stored round of the path search goes.
HOPS = 4


def shortest_paths_to(edges: DataFrame, target, hops: int = HOPS) -> DataFrame:
    """For every asset that reaches ``target``: the shortest path, ties -> lexically smallest.

    Breadth-first from the target against the edge direction, ``hops`` levels to a stored round.  A node keeps the
    hop at which it was first reached and the smallest node one hop nearer: the smallest path goes through it, so
    no path is carried along.  What a later level of a round finds again is dropped at its end, and changes nothing
    before: whatever leads to a known node was reached no later than one hop after it.  The paths are put together
    at the end, by joins that double their length.
    """
    spark = edges.sparkSession
    e = write_through(edges.select("src", "dst").distinct(), "edges")
    t = e.schema["dst"].dataType
    rounds = _Rounds(spark, "paths")
    start = rounds.add(spark.range(1).select(F.lit(target).cast(t).alias("node"), F.lit(None).cast(t).alias("next"), F.lit(0).alias("hops")))
    done = 0
    while not start.isEmpty():
        levels = [start]
        for hop in range(done + 1, done + hops + 1):
            nearer = levels[-1].select("node")
            levels.append(nearer.join(e, nearer["node"] == e["dst"]).groupBy(F.col("src").alias("node")).agg(
                F.min("dst").alias("next")).withColumn("hops", F.lit(hop)))
        found = reduce(DataFrame.unionByName, levels[1:]).groupBy("node").agg(F.min(F.struct("hops", "next")).alias("best"))
        new = rounds.add(found.join(rounds.all().select("node"), "node", "left_anti").select("node", "best.next", "best.hops"))
        done += hops
        start = new.where(F.col("hops") == done)
    paths = rounds.all().select("node", "next", F.col("node").cast("string").alias("path"), "hops")
    longest, reach = paths.agg(F.max("hops")).head()[0], 1
    while reach <= longest:
        tails = paths.select(F.col("node").alias("_n"), F.col("next").alias("_next"), F.col("path").alias("_path"))
        paths = paths.join(tails, paths["next"] == tails["_n"], "left").select(
            "node", F.col("_next").alias("next"), F.concat_ws("->", "path", "_path").alias("path"), "hops")
        paths, reach = write_through(paths, "paths"), 2 * reach
    return paths.select(F.col("node").alias("asset"), "path", "hops")


def risk_level(affected: Column, transforms: Column) -> Column:
    return (F.when((affected > HIGH_ASSETS) | (transforms > HIGH_TRANSFORMS), F.lit("HIGH"))
            .when((affected > MEDIUM_ASSETS) | (transforms > MEDIUM_TRANSFORMS), F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def impact(edges: DataFrame, downstream: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Per asset (as the changed one): affected assets, direct transformations, risk band.

    The affected are counted from the pairs ``downstream``, or given by ``counts`` (``reach.reach_counts``), which
    needs no pairs.
    """
    assets = edges.select(F.col("src").alias("asset")).union(edges.select(F.col("dst").alias("asset"))).distinct()
    affected = (downstream.groupBy("asset").agg(F.count(F.lit(1)).cast("long").alias("affected_assets")) if counts is None
                else counts.select("asset", F.col("n_downstream").alias("affected_assets")))
    direct = edges.groupBy(F.col("src").alias("asset")).agg(
        F.count("dst").cast("long").alias("affected_transformations"))  # each edge is one use by one transformation
    out = assets.join(affected, "asset", "left").join(direct, "asset", "left").fillna(
        0, ["affected_assets", "affected_transformations"])
    return out.withColumn("risk_level", risk_level(F.col("affected_assets"), F.col("affected_transformations")))


def impact_of(edges: DataFrame, changed: DataFrame) -> DataFrame:
    """One row for a list of changed assets: assets reached, transformations that read them, risk band."""
    changed = changed.select("asset").distinct()
    parts = {"changed_assets": changed.agg(F.count(F.lit(1)).alias("n")),
             "affected_assets": reached_from(edges, changed).agg(F.count(F.lit(1)).alias("n")),
             "affected_transformations": edges.join(changed, edges["src"] == changed["asset"], "left_semi").agg(F.count("dst").alias("n"))}
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("name"), "n") for name, df in parts.items()])
    out = rows.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in parts])
    return out.withColumn("risk_level", risk_level(F.col("affected_assets"), F.col("affected_transformations")))


def assets_per_layer(assets: DataFrame, layer: str = "schema") -> DataFrame:
    """(layer, n_assets): the head of the lineage report."""
    return assets.groupBy(F.col(layer).alias("layer")).agg(F.count(F.lit(1)).alias("n_assets"))


def dependency_lists(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(asset, depends_on, impacts): sorted lists of the assets of ``start``, for people to read.

    A list is as long as what its asset reaches, so ask for few assets of a large graph.
    """
    lists = lambda up: closure(edges, up, start=start).groupBy("asset").agg(
        F.array_sort(F.collect_set("reached")).alias("depends_on" if up else "impacts"))
    return start.select("asset").distinct().join(lists(True), "asset", "left").join(lists(False), "asset", "left")


def report(edges: DataFrame, downstream: DataFrame | None = None, layer_of: DataFrame | None = None,
           counts: DataFrame | None = None) -> DataFrame:
    """Per asset: its layer, how many assets it depends on and how many it impacts.

    Counted from the pairs ``downstream``, or given by ``counts`` (``reach.reach_counts``), which needs no pairs.
    """
    if counts is not None:
        out = counts.select("asset", "n_upstream", "n_downstream")
        return out.join(layer_of, "asset", "left") if layer_of is not None else out
    assets = edges.select(F.col("src").alias("asset")).union(edges.select(F.col("dst").alias("asset"))).distinct()
    down = downstream.groupBy("asset").agg(F.count(F.lit(1)).cast("long").alias("n_downstream"))
    up = downstream.groupBy(F.col("reached").alias("asset")).agg(F.count(F.lit(1)).cast("long").alias("n_upstream"))
    out = assets.join(up, "asset", "left").join(down, "asset", "left").fillna(0, ["n_upstream", "n_downstream"])
    return out.join(layer_of, "asset", "left") if layer_of is not None else out


# ---------------------------------------------------------------------------
# The warehouse's own lineage (fixed description of the three layers)
# ---------------------------------------------------------------------------

# The 15 assets and 9 transformations of the warehouse.
SOURCE_TABLES = ["crm_cust_info", "crm_prd_info", "crm_sales_details",
                 "erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2"]
GOLD_VIEWS = ["dim_customers", "dim_products", "fact_sales"]
GOLD_SOURCES = [
    (["silver.crm_cust_info", "silver.erp_cust_az12", "silver.erp_loc_a101"], "gold.dim_customers"),
    (["silver.crm_prd_info", "silver.erp_px_cat_g1v2"], "gold.dim_products"),
    (["silver.crm_sales_details", "gold.dim_customers", "gold.dim_products"], "gold.fact_sales"),
]


def warehouse_assets(spark: SparkSession) -> DataFrame:
    """(name, type, schema, description, owner, tags, asset) of the tables and views of the three layers."""
    rows = [(t, "table", layer, f"{layer} rows of feed {t}", f"{layer} load", [layer, t.split("_")[0]])
            for layer in ("bronze", "silver") for t in SOURCE_TABLES]
    rows += [(v, "view", "gold", f"star schema: {v}", "gold load", ["gold", v.split("_")[0]]) for v in GOLD_VIEWS]
    return spark.createDataFrame(
        rows, "name string, type string, schema string, description string, owner string, tags array<string>"
    ).withColumn("asset", F.concat_ws(".", "schema", "name"))


def warehouse_transformations(spark: SparkSession) -> DataFrame:
    rows = [([f"bronze.{t}"], f"silver.{t}", "etl", f"plans.silver rule of {t}", "silver.load_silver")
            for t in SOURCE_TABLES]
    rows += [(src, dst, "view", f"plans.gold.{dst.split('.')[1]}", "gold.load_gold") for src, dst in GOLD_SOURCES]
    return spark.createDataFrame(
        rows, "source_assets array<string>, target_asset string, transformation_type string, "
              "transformation_logic string, created_by string")


def save_lineage(assets: DataFrame, transformations: DataFrame, path: str) -> None:
    """Store the lineage description (assets and transformations) as Parquet."""
    assets.write.mode("overwrite").parquet(f"{path.rstrip('/')}/assets")
    transformations.write.mode("overwrite").parquet(f"{path.rstrip('/')}/transformations")


def load_lineage(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(assets, transformations) written by ``save_lineage``; the edges follow by ``edges_from_transformations``."""
    return (spark.read.parquet(f"{path.rstrip('/')}/assets"),
            spark.read.parquet(f"{path.rstrip('/')}/transformations"))
