"""Parent-child rows of unknown depth to roots, depths, paths and descendants, by tree contraction.

Forward, each round takes away all leaves (rake) and an independent set of nodes with a single child (compress: the
child is hung under the grandparent, with the distance added). The number of rounds is logarithmic in the number of
nodes, also for chains. What is left when nothing hangs below anything else are nodes that are their own parent:
the cores of cycles. Backward, the rounds are replayed from the last to the first; the parent a node had when it was
taken away has been resolved by then, so one join a round gives root and depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from chatmill.plans.ranks import with_position
from chatmill.plans.scratch import Scratch

KEEP, RAKED, SPLICED, CORE = 0, 1, 2, 3


def _nodes(rows: DataFrame, scope: str, node: str, parent: str, no_parent) -> DataFrame:
    named = rows.select(F.col(scope).alias("s"), F.col(node).alias("v"), F.col(parent).alias("p"))
    up = F.when(F.col("p").isin(*no_parent), None).otherwise(F.col("p")) if no_parent else F.col("p")
    return named.where("s is not null and v is not null").withColumn("p", up).groupBy("s", "v").agg(F.min("p").alias("p"))


def _updated(step: DataFrame, with_path: bool) -> DataFrame:
    """Rows that weren't spliced, hung under the grandparent where their parent was."""
    moved = step.where(F.col("act") == SPLICED).select("s", F.col("only").alias("v"), F.col("p").alias("np"), F.col("w").alias("nw"), *([F.concat("via", F.array("v")).alias("nvia")] if with_path else []))
    rest = step.where(F.col("act") != SPLICED).drop("only")
    joined = rest.join(moved, ["s", "v"], "left")
    cols = [F.col("s"), F.col("v"), F.coalesce("np", "p").alias("p"), (F.col("w") + F.coalesce("nw", F.lit(0))).alias("w"), F.col("act")]
    if with_path:
        cols.append(F.when(F.col("nvia").isNull(), F.col("via")).otherwise(F.concat("nvia", "via")).alias("via"))
    return joined.select(*cols)


def _contract(alive: DataFrame, turn: int) -> DataFrame:
    """Each edge with what becomes of its lower node in this round."""
    below = alive.groupBy("s", F.col("p").alias("v")).agg(F.count("*").alias("n"), F.min("v").alias("only"))
    rank = lambda c: F.xxhash64(F.lit(turn), F.col(c))
    act = (
        F.when(F.col("v") == F.col("p"), CORE)
        .when(F.col("n").isNull(), RAKED)
        .when((F.col("n") == 1) & (rank("v") < rank("only")) & (rank("v") < rank("p")), SPLICED)
        .otherwise(KEEP)
    )
    return alive.join(below, ["s", "v"], "left").withColumn("act", act).drop("n")


def resolve_hierarchy(rows: DataFrame, scope: str = "chat_id", node: str = "msg_id", parent: str = "reply_to_id", no_parent: tuple = (0,), with_path: bool = False) -> DataFrame:
    """A row for each node: scope, node, parent, ``root_id``, ``depth``, ``cyclic`` and, if asked for, ``path``.

    ``root_id`` is the topmost ancestor that is in the table; a node without parent, or whose parent is absent, is
    its own root at depth 0. Where following the parents never ends, ``cyclic`` is true, root_id is null and depth
    is -1 (path too is null). Repeated rows of a node count once, with the least of their parents; rows with a null
    scope or node are no nodes; parents in ``no_parent`` or null mean none. Further columns are ignored. Path lists
    the ids from the root to the node; paths are as long as the trees are deep, so ask for them only where needed.

    A parent with any number of children costs no more than others: children are counted with partial aggregation,
    and joins on the parent's side are split by adaptive execution where skewed.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "hierarchy")
    nodes = scratch.save("nodes", _nodes(rows, scope, node, parent, no_parent))
    via = [F.array().cast(f"array<{nodes.schema['v'].dataType.simpleString()}>").alias("via")] if with_path else []
    edges = nodes.where("p is not null").select("s", "v", "p")
    alive = edges.join(nodes.select("s", F.col("v").alias("p")), ["s", "p"], "left_semi").select("s", "v", "p", F.lit(1).cast("long").alias("w"), *via)
    turns = 0
    while True:
        seen = Observation()
        step = _contract(alive, turns).observe(seen, F.count(F.when(F.col("act") == KEEP, 1)).alias("left"), F.count("*").alias("all"))
        step = scratch.save(f"step{turns}", step)
        turns += 1
        if not seen.get["left"]:
            break
        alive = _updated(step, with_path).where(F.col("act").isin(KEEP, CORE)).drop("act")
    # cores stay to the last round, so whatever hangs on one finds it resolved
    kind = nodes.schema["v"].dataType.simpleString()
    cores = scratch.read(f"step{turns - 1}").where(F.col("act") == CORE)
    scratch.save("cores", cores.select("s", "v", F.lit(None).cast(kind).alias("root"), F.lit(-1).cast("long").alias("depth"), F.lit(True).alias("cyclic"), *([F.lit(None).cast(f"array<{kind}>").alias("path")] if with_path else [])))
    resolved = ["cores"]
    for t in reversed(range(turns)):
        step = scratch.read(f"step{t}")
        gone = _updated(step, with_path).where(F.col("act") == RAKED)
        gone = gone.unionByName(step.where(F.col("act") == SPLICED).select(*gone.columns))
        above = scratch.read(*resolved).select("s", F.col("v").alias("p"), F.col("root").alias("aroot"), F.col("depth").alias("adepth"), F.col("cyclic").alias("acyclic"), *([F.col("path").alias("apath")] if with_path else []))
        gone = gone.join(above, ["s", "p"], "left")
        cyclic = F.coalesce("acyclic", F.lit(False))
        done = gone.select(
            "s",
            "v",
            F.when(~cyclic, F.coalesce("aroot", "p")).alias("root"),
            F.when(cyclic, F.lit(-1)).otherwise(F.coalesce("adepth", F.lit(0)) + F.col("w")).cast("long").alias("depth"),
            cyclic.alias("cyclic"),
            *([F.when(~cyclic, F.concat(F.coalesce("apath", F.array("p")), "via", F.array("v"))).alias("path")] if with_path else []),
        )
        scratch.save(f"done{t}", done)
        resolved.append(f"done{t}")
        scratch.drop(f"step{t}")
    found = nodes.join(scratch.read(*resolved), ["s", "v"], "left")
    cyclic = F.coalesce("cyclic", F.lit(False))
    return found.select(
        F.col("s").alias(scope),
        F.col("v").alias(node),
        F.col("p").alias(parent),
        F.when(~cyclic, F.coalesce("root", "v")).alias("root_id"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        cyclic.alias("cyclic"),
        *([F.when(~cyclic, F.coalesce("path", F.array("v"))).alias("path")] if with_path else []),
    )


def descendants(hierarchy: DataFrame, scope: str = "chat_id", node: str = "msg_id") -> DataFrame:
    """A row for each ancestor and node below it, with their distance, from ``resolve_hierarchy(with_path=True)``."""
    pairs = hierarchy.where("path is not null and depth > 0").select(F.col(scope), F.col(node).alias("descendant_id"), F.col("depth"), F.posexplode("path").alias("pos", "ancestor_id"))
    return pairs.where("pos < depth").select(scope, "ancestor_id", "descendant_id", (F.col("depth") - F.col("pos")).alias("distance"))


def intervals(hierarchy: DataFrame, scope: str = "chat_id", node: str = "msg_id") -> DataFrame:
    """Descendants in compact form, a row for each node in no loop: scope, node, ``enter`` and ``leave``.

    Nodes are numbered from 0 in preorder, scope after scope, children by id. What lies below a node has the numbers after its
    ``enter`` up to its ``leave``. Takes what ``resolve_hierarchy(with_path=True)`` gives.
    """
    known = hierarchy.where("path is not null")
    sizes = known.select(scope, F.explode("path").alias(node)).groupBy(scope, node).agg(F.count("*").alias("_size"))
    placed = with_position(known.select(scope, node, "path"), [F.col(scope), F.col("path")], "enter").drop("path")
    return placed.join(sizes, [scope, node]).select(scope, node, "enter", (F.col("enter") + F.col("_size") - 1).alias("leave"))
