"""Connected components of a graph given as links, by spreading the smallest id.

Each round a node takes the smallest label among its neighbours, and then the
label of that label, which doubles the distance that labels travel. Both joins
read written tables on both sides, so that Spark can split a node that has very
many links; minima are combined before their shuffle. A round's labels are
written, which cuts lineage; the rounds end when no label changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgauge.sources.scratch import discard, stage


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node and component (its smallest reachable node) for every node of a link.

    Ids are of one type with an order; links may repeat, and go either way.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(
        links.select(F.col(b).alias("node"), F.col(a).alias("other"))
    )
    both = stage(both.where("node <> other").distinct(), "links")
    labels = stage(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels")
    while True:
        of_other = labels.withColumnsRenamed({"node": "other", "component": "near"})
        near = both.join(of_other, "other").groupBy("node").agg(F.min("near").alias("near"))
        moved = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("new"))
        moved = stage(moved, "labels")
        if not moved.where("new < component").limit(1).count():
            discard(both, moved)
            return labels
        # on to the label's own label
        up = moved.select(F.col("node").alias("new"), F.col("new").alias("above"))
        jumped = moved.select("node", "new").join(up, "new", "left")
        last = labels
        labels = stage(jumped.select("node", F.least("new", F.coalesce("above", "new")).alias("component")), "labels")
        discard(last, moved)
