"""Connected components, for link tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, kept_table


def components(links: DataFrame) -> DataFrame:
    """From links (a, b): node and component, the smallest node that it is linked with. Without links, no rows.

    Every round takes the smallest component among a node's neighbours and then that component's own component, until
    nothing changes; paths shorten by half in each. Rounds are written, so no lineage grows.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = kept_table(both.toDF("a", "b"), "links")
    label = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    label = kept_table(label.select("node", F.least("node", "low").alias("component")), "components")
    while True:
        of = label.select(F.col("node").alias("b"), F.col("component").alias("near"))
        near = both.join(of, "b").groupBy(F.col("a").alias("at")).agg(F.min("near").alias("near"))
        hooked = label.join(near, label["node"] == near["at"]).select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("component")
        )
        hooked = kept_table(hooked, "hooked")
        up = hooked.select(F.col("node").alias("root"), F.col("component").alias("top"))
        jumped = hooked.join(up, hooked["component"] == up["root"]).select("node", "was", F.col("top").alias("component"))
        jumped = kept_table(jumped, "components")
        forget(label, hooked)
        label = jumped
        if not jumped.filter(F.col("was") != F.col("component")).head(1):
            forget(both)
            return label
