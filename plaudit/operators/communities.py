"""Community detection by greedy modularity, in rounds.

Vertices decide simultaneously instead of one after the other.  A quarter of them, drawn by hash,
waits in each round, and two single vertices only join towards the smaller name, so vertices do
not chase each other; the best assignment of a level counts.  Only the frontier is scored:
vertices that moved, that could not do so yet, or that have a neighbour that moved.  Whole communities are
contracted to the vertices of the next level.

Then the result is refined (after Traag et al. 2019): inside every community vertices start
alone again and single ones merge along links, in rounds in which half of the communities may be joined
and only the others be left, so every part is connected.  The parts, contracted, start in the community they came
from and rise again, so a part that fits elsewhere can still leave.  The result is a
modularity maximum of the usual kind, not the partition of a sequential run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from plaudit.operators.skew import HotKeys
from plaudit.session import cut_lineage

# A better place has to gain at least this much weight.
LEAST_GAIN = 1e-9
ROUNDS = "phase string, level int, round int, active long, moved long, modularity double"


def _dealt(table: DataFrame) -> DataFrame:
    """A table whose joins deal it out by key: some sixty rounds of broadcasts would all pass through the driver."""
    return table.hint("merge")


def modularity(edges: DataFrame, membership: DataFrame) -> float:
    """Modularity of `membership` (`id`, `community`) on symmetric `src`, `dst`, `w` edges."""
    side = membership.select(F.col("id").alias("src"), F.col("community").alias("c_src"))
    other = membership.select(F.col("id").alias("dst"), F.col("community").alias("c_dst"))
    marked = edges.join(_dealt(side), "src").join(_dealt(other), "dst")
    row = (
        marked.groupBy(F.col("c_src").alias("community"))
        .agg(
            F.sum("w").alias("total"),
            F.sum(F.when(F.col("c_src") == F.col("c_dst"), F.col("w")).otherwise(0.0)).alias("inner"),
        )
        .agg(
            F.sum("total").alias("m2"),
            F.sum("inner").alias("inner"),
            F.sum(F.col("total") * F.col("total")).alias("squares"),
        )
        .first()
    )
    if not row["m2"]:
        return 0.0
    return row["inner"] / row["m2"] - row["squares"] / (row["m2"] * row["m2"])


@dataclass
class Convergence:
    """What happened in every round: vertices scored, vertices moved, modularity before the moves."""

    rounds: list[tuple] = field(default_factory=list)

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rounds, ROUNDS)


def louvain(
    vertices: DataFrame,
    edges: DataFrame,
    levels: int = 10,
    rounds: int = 6,
    tolerance: float = 1e-4,
    round_tolerance: float = 1e-3,
    refinements: int = 1,
    convergence: Convergence | None = None,
    **hot_limits,
) -> DataFrame:
    """`id`, `community` for every vertex; a community is named by one of its members.

    `edges` holds both directions of every undirected edge as `src`, `dst`, `w`.
    Levels go on until one gains less than `tolerance`.  A level ends when no vertex wishes to move, when
    two rounds in a row gain less than `round_tolerance`, as the next one moves whole communities, or
    after `rounds`.  `refinements` says how often the result is refined and rises again.
    `convergence` collects what each round did.
    """
    convergence = convergence or Convergence()
    graph = cut_lineage(edges.groupBy("src", "dst").agg(F.sum("w").alias("w")), "edges")
    limits = (levels, rounds, tolerance, round_tolerance, hot_limits)
    found = _ascend(graph, None, limits, convergence, "rise")
    for turn in range(refinements if found is not None else 0):
        spread = HotKeys.find(graph, "dst", **hot_limits)
        inside = cut_lineage(_inside(graph.filter(F.col("src") != F.col("dst")), found, spread), "inside")
        single = _nodes(graph, None)
        m2 = single.agg(F.sum("k")).first()[0]
        log = (convergence, f"refine {turn}", 0)
        parts, _ = _local_moves(inside, single, spread, m2, rounds // 2, round_tolerance, log, single=True)
        parts = cut_lineage(parts.withColumnRenamed("community", "part").join(_dealt(found), "id"), "parts")
        # All vertices of a part have one community.
        start = parts.groupBy(F.col("part").alias("id")).agg(F.first("community").alias("community"))
        coarse = _contracted(graph, parts.select("id", F.col("part").alias("community")), spread)
        better = _ascend(coarse, cut_lineage(start, "start"), limits, convergence, f"rise {turn}")
        named = better.select(F.col("id").alias("part"), "community")
        found = cut_lineage(parts.select("id", "part").join(_dealt(named), "part").select("id", "community"), "membership")
    own = vertices.select("id", F.col("id").alias("own"))
    if found is None:
        return own.withColumnRenamed("own", "community")
    return cut_lineage(own.join(_dealt(found), "id", "left").select("id", F.coalesce("community", "own").alias("community")), "membership")


def _nodes(graph: DataFrame, start: DataFrame | None) -> DataFrame:
    """Vertices with their weights in the communities of `start`, or alone."""
    loop = F.when(F.col("src") == F.col("dst"), F.col("w")).otherwise(0.0)
    nodes = graph.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k"), F.sum(loop).alias("loop"))
    if start is not None:
        nodes = nodes.join(_dealt(start), "id")
    return cut_lineage(nodes.withColumn("community", F.col("id") if start is None else F.col("community")), "nodes")


def _contracted(graph: DataFrame, groups: DataFrame, spread: HotKeys) -> DataFrame:
    """Edges between the groups (`id`, `community`) that the vertices of `graph` belong to."""
    left = groups.select(F.col("id").alias("src"), F.col("community").alias("c_src"))
    right = groups.select(F.col("id").alias("dst"), F.col("community").alias("c_dst"))
    sources = HotKeys("src", spread.values, spread.fanout)
    placed = spread.join(sources.join(graph, _dealt(left), ["dst"]), _dealt(right), ["src"])
    return cut_lineage(placed.groupBy(F.col("c_src").alias("src"), F.col("c_dst").alias("dst")).agg(F.sum("w").alias("w")), "edges")


def _ascend(graph: DataFrame, start: DataFrame | None, limits, convergence: Convergence, phase: str) -> DataFrame | None:
    """Community of every vertex of `graph` after moving and contracting, from those of `start`; None without edges."""
    levels, rounds, tolerance, round_tolerance, hot_limits = limits
    found = None
    for level in range(levels):
        nodes = _nodes(graph, start)
        m2 = nodes.agg(F.sum("k")).first()[0]
        if not m2:
            return None
        spread = HotKeys.find(graph, "dst", **hot_limits)
        between = graph.filter(F.col("src") != F.col("dst"))
        moved, gained = _local_moves(between, nodes, spread, m2, rounds, round_tolerance, (convergence, phase, level))
        step = moved.select(F.col("id").alias("community"), F.col("community").alias("merged"))
        found = moved if found is None else cut_lineage(
            found.join(_dealt(step), "community").select("id", F.col("merged").alias("community")), "membership"
        )
        if gained < tolerance and start is None:
            break
        graph, start = _contracted(graph, moved, spread), None
    return found


def _inside(between: DataFrame, communities: DataFrame, spread: HotKeys) -> DataFrame:
    """Edges whose ends have one community."""
    left = communities.select(F.col("id").alias("src"), F.col("community").alias("c_src"))
    right = communities.select(F.col("id").alias("dst"), F.col("community").alias("c_dst"))
    sources = HotKeys("src", spread.values, spread.fanout)
    both = spread.join(sources.join(between, _dealt(left), ["dst"]), _dealt(right), ["src"])
    return both.filter(F.col("c_src") == F.col("c_dst")).select("src", "dst", "w")


def _local_moves(
    between: DataFrame, nodes: DataFrame, spread: HotKeys, m2: float, rounds: int, tolerance: float, log, single: bool = False
) -> tuple[DataFrame, float]:
    """Move vertices between neighbouring communities until modularity stops rising.

    Returns the best assignment found and its gain.  A round is one written table, which
    also holds what the modularity of the assignment it started from needs.  With `single` only
    vertices that are alone may move.
    """
    convergence, phase, level = log
    state = nodes.withColumn("home_links", F.lit(None).cast("double")).withColumn("active", F.lit(True))
    best, best_score, first_score, stalled = nodes, None, None, 0
    for turn in range(rounds + 1):
        # Other draws in every round, as contracted communities keep their names.
        draw = len(convergence.rounds)
        seen = Observation()
        moves = _one_round(between, state, spread, m2, draw, single).observe(
            seen,
            F.sum(F.col("home_links") + F.col("loop")).alias("inner"),
            F.sum(F.col("k") * F.col("home_total")).alias("squares"),
            F.sum(F.col("active").cast("long")).alias("active"),
            F.sum((F.col("community") != F.col("home")).cast("long")).alias("moved"),
            F.sum(F.col("wishes").cast("long")).alias("wishes"),
        )
        result, summary = cut_lineage(moves, "nodes"), seen.get
        score = summary["inner"] / m2 - summary["squares"] / (m2 * m2)
        convergence.rounds.append((phase, level, turn, summary["active"], summary["moved"], score))
        if best_score is None:
            first_score = best_score = score
        else:
            stalled = 0 if score > best_score + tolerance else stalled + 1
            if score > best_score:
                best, best_score = state, score
        if not summary["wishes"] or stalled >= 2:
            break
        moved = result.filter(F.col("community") != F.col("home")).select(F.col("id").alias("dst"))
        touched = between.join(_dealt(moved), "dst", "left_semi").select(F.col("src").alias("id")).distinct()
        again = result.join(_dealt(touched.withColumn("touched", F.lit(True))), "id", "left")
        state = again.select(
            "id", "k", "loop", "community", "home_links",
            (F.col("wishes") | (F.col("community") != F.col("home")) | F.coalesce("touched", F.lit(False))).alias("active"),
        )
    return best.select("id", "community"), best_score - first_score


def _one_round(between: DataFrame, state: DataFrame, spread: HotKeys, m2: float, draw: int, single: bool) -> DataFrame:
    """Best community of every vertex of the frontier; those that gain by it and may leave move.

    Totals travel with the neighbours, so they meet the vertices once and the links never.
    """
    totals = state.groupBy("community").agg(F.sum("k").alias("total"), (F.count(F.lit(1)) == 1).alias("lonely"))
    named = state.join(_dealt(totals), "community")
    frontier = named.filter("active").select(
        "id", "k", F.col("community").alias("home"), F.col("total").alias("home_total"), F.col("lonely").alias("alone")
    )
    near = named.select(F.col("id").alias("dst"), "community", "total", "lonely")
    met = spread.join(between.join(_dealt(frontier.select(F.col("id").alias("src"))), "src", "left_semi"), _dealt(near), ["src"])
    # A vertex may stay where it has no neighbour, so its home is always a candidate.
    own = frontier.select(
        F.col("id").alias("src"), F.col("home").alias("community"), F.lit(0.0).alias("w"), F.col("home_total").alias("total"), F.col("alone").alias("lonely")
    )
    candidates = (
        met.select("src", "community", "w", "total", "lonely").unionByName(own)
        .groupBy(F.col("src").alias("id"), "community")
        .agg(F.sum("w").alias("links"), F.first("total").alias("total"), F.first("lonely").alias("lonely"))
    )
    scored = HotKeys("id", spread.values, spread.fanout).join(candidates, _dealt(frontier), ["community"])
    stays = F.col("community") == F.col("home")
    own_part = F.when(stays, F.col("k")).otherwise(0.0)
    chance = lambda name, n: F.pmod(F.xxhash64(name, F.lit(draw)), F.lit(n)) == 0
    if single:
        # Half of the communities are open: they may be joined but not left.
        takes, leaves = chance("community", 2), F.col("alone") & ~chance("home", 2)
    else:
        takes = ~(F.col("alone") & F.col("lonely")) | (F.col("community") < F.col("home"))
        leaves = ~chance("id", 4)
    scored = scored.withColumn("gain", F.col("links") - F.col("k") * (F.col("total") - own_part) / m2)
    gain = lambda which: F.max(F.when(which, F.col("gain")))
    choices = scored.groupBy("id").agg(
        gain(stays).alias("stay_gain"),
        gain(~stays & (F.col("alone") if single else F.lit(True))).alias("best_gain"),
        F.max(F.when(stays, F.col("links"))).alias("links"),
        F.min(F.when(~stays & takes & leaves, F.struct((-F.col("gain")).alias("loss"), "community"))).alias("pick"),
    )
    better = lambda value: F.coalesce(value > F.col("stay_gain") + LEAST_GAIN, F.lit(False))
    decided = choices.select(
        "id", "links", better(F.col("best_gain")).alias("wishes"), F.when(better(-F.col("pick.loss")), F.col("pick.community")).alias("target")
    )
    return named.join(_dealt(decided), "id", "left").select(
        "id", "k", "loop", "active",
        F.col("community").alias("home"), F.col("total").alias("home_total"),
        F.coalesce("links", "home_links").alias("home_links"),
        F.coalesce("wishes", F.lit(False)).alias("wishes"),
        F.coalesce("target", "community").alias("community"),
    )
