"""Symbol graphs as edge lists ``(step, src, dst, weight)``; an absent edge weighs 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.config import GraphConfig
from barloom.operators.pairs import pair_statistics
from barloom.operators.samples import StepPlan, window_totals
from barloom.session import stage

# Weights are rounded before ranking, so that summation order cannot flip a tie.
WEIGHT_DECIMALS = 12


def both_directions(pairs: DataFrame) -> DataFrame:
    """Each unordered pair as two directed rows, with the shares of source and target."""
    def view(src: str, dst: str) -> Column:
        return F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"), *[
            F.col(f"{move}_{side}").alias(f"{move}_{name}") for move in ("up", "down")
            for side, name in ((src, "src"), (dst, "dst"))])
    ends = F.explode(F.array(view("a", "b"), view("b", "a"))).alias("e")
    return pairs.select("step", "corr", "both_up", "both_down", ends) \
        .select("step", "corr", "both_up", "both_down", "e.*")


def pearson_edges(directed: DataFrame, threshold: float) -> DataFrame:
    """Edges whose absolute correlation reaches the threshold."""
    return directed.withColumn("weight", F.round(F.abs("corr"), WEIGHT_DECIMALS)) \
        .filter(F.col("weight") >= threshold).select("step", "src", "dst", "weight")


def association_rules(directed: DataFrame) -> DataFrame:
    """Support, confidence and lift per ordered pair.

    The three measures are maximised over both-up and both-down independently, so
    they may stem from different directions of movement.
    """
    def rule(move: str):
        both = F.col(f"both_{move}")
        src, dst = F.col(f"{move}_src"), F.col(f"{move}_dst")
        return both, both / (src + 1e-8), both / (src * dst + 1e-8)
    up, down = rule("up"), rule("down")
    names = ("support", "confidence", "lift")
    return directed.select("step", "src", "dst", *[
        F.greatest(u, d).alias(n) for u, d, n in zip(up, down, names)])


def association_edges(rules: DataFrame, config: GraphConfig) -> DataFrame:
    """Rules that pass all three limits, weighted by lift over the step's largest lift."""
    kept = rules.filter((F.col("support") >= config.min_support)
                        & (F.col("confidence") >= config.min_confidence)
                        & (F.col("lift") >= config.lift_threshold))
    # One row per step: bounded by the number of test days.
    largest = F.broadcast(kept.groupBy("step").agg(F.max("lift").alias("max_lift")))
    weight = F.round(F.col("lift") / F.col("max_lift"), WEIGHT_DECIMALS)
    return kept.join(largest, "step").select("step", "src", "dst", weight.alias("weight"))


def keep_topk(edges: DataFrame, k: int) -> DataFrame:
    """The k heaviest positive neighbours of each source, mirrored; ties by later symbol.

    The rank limit is applied before the shuffle as well (window group limit), so a
    hub sends k rows per task. Self edges are added by ``with_self_edges``.
    """
    order = Window.partitionBy("step", "src").orderBy(F.desc("weight"), F.desc("dst"))
    top = edges.filter((F.col("weight") > 0) & (F.col("src") != F.col("dst"))) \
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ends = F.explode(F.array(F.struct("src", "dst"),
                             F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    return top.select("step", "weight", ends.alias("e")).groupBy("step", "e.src", "e.dst").agg(
        F.max("weight").alias("weight"))


def merge_graphs(pearson: DataFrame, assoc: DataFrame, assoc_weight: float,
                 topk: int) -> DataFrame:
    """Larger of the Pearson weight and the damped association weight, cut to top k again."""
    damped = assoc.withColumn("weight", F.col("weight") * assoc_weight)
    merged = pearson.unionByName(damped).groupBy("step", "src", "dst").agg(
        F.max("weight").alias("weight"))
    return keep_topk(merged, topk)


def with_self_edges(edges: DataFrame, symbols: DataFrame, n_steps: int) -> DataFrame:
    step = F.explode(F.sequence(F.lit(1), F.lit(n_steps)))
    loops = symbols.select(step.alias("step"), F.col("symbol").alias("src"),
                           F.col("symbol").alias("dst"), F.lit(1.0).alias("weight"))
    return edges.unionByName(loops)


def normalise(edges: DataFrame) -> DataFrame:
    """w / sqrt(degree(src) * degree(dst)), degree including the self edge.

    The edge list is symmetric, so a node's degree is the sum over rows that end in it
    as well as over rows that start in it, and no self join is needed. A node has at
    most one edge per symbol.
    """
    def degree(end: str) -> Column:
        total = F.sum("weight").over(Window.partitionBy("step", end))
        return F.greatest(total, F.lit(1e-8))
    return edges.select(
        "step", "src", "dst", "weight",
        (F.col("weight") / F.sqrt(degree("src") * degree("dst"))).alias("norm_weight"))


def graph_parts(pairs: DataFrame, config: GraphConfig) -> dict[str, DataFrame]:
    """Pearson, association and combined edges (without self edges).

    The surviving pairs feed every part, so they are written once.
    """
    directed = both_directions(stage(pairs, "pairs"))
    pearson = keep_topk(pearson_edges(directed, config.pearson_threshold), config.pearson_topk)
    assoc = keep_topk(association_edges(association_rules(directed), config), config.assoc_topk)
    combined = merge_graphs(pearson, assoc, config.assoc_weight, config.final_topk)
    return {"pearson": pearson, "assoc": assoc, "combined": combined}


def build_graph(panel: DataFrame, symbols: DataFrame, plan: StepPlan,
                config: GraphConfig) -> DataFrame:
    """Combined, normalised graph of every step.

    For the serving snapshot give a plan of one step whose window ends at the last date.
    """
    pairs = pair_statistics(panel, plan, config.recent_days, config, leading=True)
    combined = graph_parts(pairs, config)["combined"]
    return normalise(with_self_edges(combined, symbols, plan.n_steps))


def snapshot_plan(n_dates: int, recent_days: int) -> StepPlan:
    """One step whose training window ends at, and includes, the last common date."""
    return StepPlan(first_test=n_dates, n_steps=1, train_start=max(0, n_dates - recent_days))


def movement_frequencies(panel: DataFrame, steps: DataFrame, recent_days: int) -> DataFrame:
    """Share of up and down days per step and symbol (strictly above or below zero)."""
    start = F.greatest("train_start", F.col("train_end") - recent_days + 1)
    windows = steps.select("step", start.alias("low"), F.col("train_end").alias("high"))
    known = F.when(F.col("ret").isNotNull(), 1)
    counts = window_totals(panel, ["symbol"], windows, "low", "high", {
        "days": known, "up": F.when(F.col("ret") > 0, 1), "down": F.when(F.col("ret") < 0, 1)})
    return counts.filter("days > 0").select("step", "symbol", (F.col("up") / F.col("days")).alias("p_up"),
                                            (F.col("down") / F.col("days")).alias("p_down"))


def mean_frequencies(frequencies: DataFrame) -> DataFrame:
    return frequencies.groupBy("step").agg(F.avg("p_up").alias("avg_p_up"),
                                           F.avg("p_down").alias("avg_p_down"))


def edge_counts(parts: dict[str, DataFrame], steps: DataFrame) -> DataFrame:
    """Directed non-self edges per step and graph; a step without edges counts 0."""
    tagged = None
    for name, edges in parts.items():
        rows = edges.select("step", F.lit(name).alias("part"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    counts = [F.count_if(F.col("part") == name).alias(f"{name}_edges") for name in parts]
    counted = tagged.groupBy("step").agg(*counts)
    return steps.select("step").join(counted, "step", "left").fillna(0)


def mean_edge_counts(counts: DataFrame) -> DataFrame:
    return counts.agg(*[F.avg(c).alias(f"mean_{c}") for c in counts.columns if c != "step"])


def neighbour_sums(edges: DataFrame, nodes: DataFrame, columns: list[str],
                   weight: str = "norm_weight") -> DataFrame:
    """One hop of weighted neighbour aggregation: sum over neighbours of weight x feature.

    ``nodes`` is keyed (step, symbol); apply twice for two hops.
    """
    targets = nodes.select("step", F.col("symbol").alias("dst"), *columns)
    return edges.select("step", "src", "dst", weight).join(targets, ["step", "dst"]) \
        .groupBy("step", F.col("src").alias("symbol")) \
        .agg(*[F.sum(F.col(weight) * F.col(c)).alias(c) for c in columns])
