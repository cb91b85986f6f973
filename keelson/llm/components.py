"""Connected components of a link table, by contraction.

Each round hooks every node to its smallest neighbour, follows the hooks to
their ends, and replaces the links by links between those ends. Links inside a
component vanish, so the table shrinks fast; a hub costs one aggregate row a
task. Links that are all hooks need no further round. Nothing is collected but
the row counts that end the rounds, and every
join is a sort-merge join (``by_merge``): the many small joins of the rounds
would else each leave a broadcast table with the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.scratch import stored


def by_merge(right: DataFrame) -> DataFrame:
    """``right`` of a join that goes by shuffles, however small it is.

    The driver builds each broadcast table in pages of some megabytes and keeps
    it until its garbage is collected, mostly after the last round.
    """
    return right.hint("merge")


def _relabel(links: DataFrame, ends: DataFrame) -> DataFrame:
    """Links between the ends of their nodes, each once, none to itself."""
    u = ends.select(F.col("node").alias("u"), F.col("root").alias("ru"))
    v = ends.select(F.col("node").alias("v"), F.col("root").alias("rv"))
    both = links.join(by_merge(u), "u").join(by_merge(v), "v").filter("ru != rv")
    return both.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct()


def _follow(hooks: DataFrame) -> DataFrame:
    """``node, root`` with every root its own root. A step goes three hooks up, and tells by the last if that was enough."""
    while True:
        once = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
        twice = hooks.select(F.col("node").alias("above"), F.col("root").alias("top"))
        up = hooks.join(by_merge(once), "root").join(by_merge(twice), "above")
        jumped = stored(up.select("node", F.col("top").alias("root"), (F.col("top") != F.col("above")).alias("moved")), "hooks")
        hooks = jumped.select("node", "root")
        if not jumped.filter("moved").limit(1).count():
            return hooks


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (u, v)``: the smallest node reachable from it."""
    links = stored(links.filter("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), "links")
    labels = None
    while links.limit(1).count():
        ends = links.select(F.col("u").alias("node"), F.col("v").alias("near")).unionByName(
            links.select(F.col("v").alias("node"), F.col("u").alias("near"))
        )
        hooks = ends.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("root"))
        roots = _follow(hooks)
        if labels is None:
            labels = roots
        else:
            up = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
            labels = stored(
                labels.join(by_merge(up), "root", "left").select("node", F.coalesce("above", "root").alias("root")), "labels"
            )
        # Each node that has a smaller neighbour is the larger end of one hook.
        if roots.filter("node != root").count() == links.distinct().count():
            return labels
        links = stored(_relabel(links, roots), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")) if labels is None else labels
