"""Connected components of an undirected graph, by hooking and contraction.

Each round every root hooks onto its smallest neighbouring root, the hooks are
compressed by pointer doubling, and the edges are rewritten between roots.
The graph shrinks from round to round; nothing is collected to the driver but
row counts. Each step is checkpointed, so a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import checkpoint


def _compress(hooks: DataFrame) -> DataFrame:
    """(id, root) with root < id: follow the pointers to their ends by doubling."""
    while True:
        up = hooks.select(F.col("id").alias("root"), F.col("root").alias("up"))
        step = checkpoint(
            hooks.join(up, "root", "left").select(
                "id", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")
            )
        )
        moved = step.filter("moved").limit(1).count()
        hooks = step.select("id", "root")
        if not moved:
            return hooks


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(id, component) for every node of an edge; component is the smallest node of its component.

    Self-loops and rows with a null end are ignored; repeated edges count once.
    A node that occurs in self-loops alone is not returned. Raises RuntimeError
    rather than return partial labels if it has not converged in max_rounds.
    """
    a, b = F.col(src), F.col(dst)
    e = checkpoint(
        edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .distinct()
    )
    labels = None
    for _ in range(max_rounds):
        # the smaller neighbour of b is a; a itself may also have a smaller one, as another edge's b
        near = e.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root"))
        hooks = checkpoint(near)
        if not hooks.limit(1).count():
            break
        hooks = _compress(hooks)
        if labels is None:
            nodes = e.select(F.col("a").alias("id")).union(e.select("b")).distinct()
            labels = nodes.join(hooks, "id", "left").select("id", F.coalesce("root", "id").alias("component"))
        else:
            to = hooks.select(F.col("id").alias("component"), F.col("root").alias("to"))
            labels = labels.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        labels = checkpoint(labels)
        # contract
        ha = hooks.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        hb = hooks.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        r = e.join(ha, "a", "left").join(hb, "b", "left").select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
        e = checkpoint(r.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    else:
        raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    if labels is None:
        labels = e.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
