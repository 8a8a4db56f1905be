"""Connected components of a link table, by hooking to the smallest neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import Scratch


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node of its component.

    Each round a node takes the smallest root among its neighbours and itself, then the root of
    that root, so long chains close in logarithmically many rounds. Rounds are written tables: a
    lost executor costs a re-read, and a node of very many links is an input that skewed joins
    split and partial minima fold. A round's tables are removed when the next one is written; the
    result belongs to ``scratch`` if given. Links may repeat; a link with a null end is left out;
    no links give no rows.
    """
    spark = links.sparkSession
    links = links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    graph, last = Scratch(spark), Scratch(spark)
    both = graph.stage(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct(), "links")
    labels = last.stage(both.groupBy(F.col("a").alias("node"))
                        .agg(F.least(F.min("b"), F.col("node")).alias("root")), "labels")
    while True:
        now = Scratch(spark)
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        hooked = now.stage(labels.join(near, "node")
                           .select("node", F.col("root").alias("old"),
                                   F.least("root", "near").alias("root")), "hooked")
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("further"))
        # A root is a node of its component, so the join loses no row.
        jumped = now.stage(hooked.join(jump, "root")
                           .select("node", "old", F.col("further").alias("root")), "jumped")
        last.clear()
        if jumped.filter("old != root").isEmpty():
            found = (scratch or Scratch(spark)).stage(jumped.select("node", "root"), "roots")
            now.clear()
            graph.clear()
            return found
        labels, last = jumped.select("node", "root"), now
