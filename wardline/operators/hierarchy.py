"""Hierarchy operators over a parent pointer per node (doctor -> supervisor).

Both operators iterate joins with pointer doubling (rounds grow with the
logarithm of the depth).  Each round is written once to the folder the session
names (``spark.checkpoint.dir``), so a lost executor recomputes at most one
round and the plan does not grow with depth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.session import materialise


class CycleFound(RuntimeError):
    """Raised when a walk comes back to the node it started from."""


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def ancestors(
    nodes: DataFrame,
    node: str | Sequence[str],
    parent: str | Sequence[str],
) -> DataFrame:
    """Every node with each node above it, level 1 (the parent) upward.

    ``nodes`` holds one row per node with its key columns ``node`` and parent
    key columns ``parent`` (NULL for a root).  Output: ``node`` columns renamed
    ``origin_*``, the ancestor key as ``ancestor_*`` and ``level``.  Matches a
    recursive CTE whose base is ``(n, parent(n), 1)`` and whose step follows the
    parent while the current node has one.

    Pointer doubling, so a chain of depth ``d`` takes ``ceil(log2(d)) + 1``
    rounds instead of ``d``: with ``jump`` = each node's ancestor exactly ``m``
    levels up and ``closure`` = all pairs up to level ``m``, one round adds the
    pairs at levels ``m+1 .. 2m`` as ``jump`` joined to ``closure`` on the jump
    target (each pair once), and squares ``jump``.  Jump table and bands are
    written to the checkpoint folder each round; the closure is the union of
    the bands.  A tree of any depth is walked to its end; a node that meets
    itself lies on a cycle, which raises ``CycleFound`` at once.
    """
    nk, pk = _names(node), _names(parent)
    if len(nk) != len(pk):
        raise ValueError("node and parent must have the same number of columns")
    k = len(nk)
    origin = [f"origin_{c}" for c in nk]
    anc = [f"ancestor_{c}" for c in nk]
    has_parent = F.lit(True)
    for c in pk:
        has_parent = has_parent & F.col(c).isNotNull()
    base = nodes.filter(has_parent).select(
        *[F.col(c).alias(o) for c, o in zip(nk, origin)], *[F.col(c).alias(a) for c, a in zip(pk, anc)],
        F.lit(1).alias("level"),
    )
    first = materialise(base)
    itself = F.lit(True)
    for o, a in zip(origin, anc):
        itself = itself & (F.col(o) == F.col(a))
    pieces = [first]  # level bands; their union is the closure (a flat plan)
    closure = first  # levels 1..m
    jump = first.drop("level")  # ancestor exactly m levels up
    new, m = first, 1
    while True:
        n, loops = new.agg(F.count(F.lit(1)), F.count_if(itself)).first()
        if loops:
            raise CycleFound(f"{loops} nodes are above themselves")
        if n == 0:
            break
        # pairs at levels m+1 .. 2m: (a -> b at m) then (b -> c at j <= m)
        step = closure.select(*[F.col(o).alias(f"__b{i}") for i, o in enumerate(origin)],
                              *[F.col(a).alias(f"__c{i}") for i, a in enumerate(anc)], F.col("level").alias("__j"))
        met = jump.join(step, [jump[anc[i]] == step[f"__b{i}"] for i in range(k)], "inner")
        new = materialise(met.select(*origin, *[F.col(f"__c{i}").alias(anc[i]) for i in range(k)], (F.col("__j") + m).alias("level")))
        pieces.append(new)
        closure = pieces[0]
        for p in pieces[1:]:
            closure = closure.unionByName(p)
        m *= 2
        jump = new.filter(F.col("level") == m).drop("level")  # the band's last level is the squared jump
    return closure


PUSHED = 1000  # keys that go into the scan as a list, at most; more are joined


def cycles_through(rows: DataFrame, stored: DataFrame, node: str, parent: str) -> DataFrame:
    """Keys (column ``node``) of ``rows`` whose chain of parents never ends, climbing from these rows only.

    The chain runs through ``rows`` and ``stored``; of several parents of a node
    the smallest counts, and one in ``rows`` before one in ``stored``.  Each
    round looks up the parents of the nodes just reached, all chains at once;
    up to ``PUSHED`` of them go into the scan of ``stored`` as a list, so of
    files sorted by ``node`` only the row groups that hold them are read.  A
    chain that meets a node it stood on before (Brent's mark, which moves up at every
    power of two) never ends; so the rounds follow the depth, not the table.
    """
    edge = lambda df: df.select(F.col(node).alias("at"), F.col(parent).alias("up")).where("at is not null")
    mine = materialise(edge(rows).groupBy("at").agg(F.min("up").alias("up")))
    chains = materialise(mine.where("up is not null").select(F.col("at").alias("start"), F.col("at").alias("mark"), F.col("up").alias("at")))
    endless, steps, power = rows.select(F.col(node).alias("start")).limit(0), 1, 1
    while not chains.isEmpty():
        met = materialise(chains.where("at = mark").select("start"))
        endless = endless.unionByName(met)
        chains = chains.join(met, "start", "left_anti")
        if steps == power:
            chains, steps, power = chains.withColumn("mark", F.col("at")), 0, 2 * power
        reached = materialise(chains.select("at").distinct())
        some = [r[0] for r in reached.limit(PUSHED + 1).collect()]
        old = edge(stored)
        old = old.where(F.col("at").isin(some)) if len(some) <= PUSHED else old.join(reached, "at", "left_semi")
        old = old.join(mine, "at", "left_anti").groupBy("at").agg(F.min("up").alias("up"))
        above = mine.join(reached, "at", "left_semi").unionByName(old).where("up is not null")
        chains = materialise(chains.join(above, "at").select("start", "mark", F.col("up").alias("at")))
        steps += 1
    return endless.select(F.col("start").alias(node))


def find_cycles(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """Nodes whose parent chain never reaches a root, i.e. that lie on a cycle or lead into one.

    Output: ``node``, ``on_cycle`` (the node itself is on the cycle) and
    ``cycle_id`` (the smallest key on the cycle the chain ends in).  Nodes
    that reach a root are not returned.  A node given by several rows is one
    node; with several parents it follows the smallest (repeated keys are the
    key audit's matter), so every node has one way up.

    Pointer doubling: round ``k`` holds, per node, the node ``2**k`` steps up
    and the smallest key among those steps.  Chains that end at a root leave
    the table as soon as they reach it.  When the image of the jump map stops
    shrinking it is the set of nodes on cycles, and once ``2**k`` is at least its
    size every cycle's smallest key has been seen.  Each round is one self-join
    of the nodes that are left, written to the checkpoint folder.
    """
    g = nodes.select(F.col(node).alias("v"), F.col(parent).alias("p")).filter(F.col("v").isNotNull())
    g = materialise(g.groupBy("v").agg(F.min("p").alias("p")))
    # a parent that is not itself a node ends the chain like a root
    state = materialise(g.join(g.select(F.col("v").alias("p")), "p").select("v", F.col("p").alias("jump"), F.col("p").alias("low")))
    image, steps = None, 1
    while True:
        live, now = state.agg(F.count("v"), F.count_distinct("jump")).first()
        if live == 0 or (now == image and steps >= now):
            break
        image = now
        other = state.select(F.col("v").alias("jump"), F.col("jump").alias("jump2"), F.col("low").alias("low2"))
        state = materialise(state.join(other, "jump").select("v", F.col("jump2").alias("jump"), F.least("low", "low2").alias("low")))
        steps *= 2
    # jump(v) is now on v's cycle, and that node's 'low' spans the whole cycle
    on_cycle = state.select(F.col("jump").alias("c")).distinct()
    cycle_min = state.select(F.col("v").alias("jump"), F.col("low").alias("cycle_id"))
    labelled = state.select("v", "jump").join(cycle_min, "jump")
    return labelled.join(on_cycle, labelled["v"] == on_cycle["c"], "left").select(
        F.col("v").alias(node), F.col("c").isNotNull().alias("on_cycle"), "cycle_id"
    )
