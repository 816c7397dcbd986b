"""Connected components of a graph of links, and joins on keys that a great many rows share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Keys of more members than this, and of more than one in ``SENT_KEYS`` of all rows, aren't dealt to one task.
LARGE_KEY, SENT_KEYS = 256, 50_000


def join_sized(rows: DataFrame, sized: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``sized``, which has ``members``, how many rows hold its key, and is written already.

    Rows of large keys stay where they are and meet a broadcast; all others
    are dealt by the key. Of ``total`` rows, fewer than ``SENT_KEYS`` keys can hold
    more than one in ``SENT_KEYS``, so the broadcast is bounded at any size.
    """
    large = F.col("members") > max(LARGE_KEY, total // SENT_KEYS)
    if not sized.where(large).limit(1).count():
        return rows.join(sized, key)
    sent = sized.where(large)
    here = rows.join(F.broadcast(sent), key)
    rest = rows.join(F.broadcast(sent.select(key)), key, "left_anti").join(sized.where(~large), key)
    return here.unionByName(rest)


def components(links: DataFrame, most_rounds: int = 60, scratch: Scratch | None = None) -> DataFrame:
    """node, root for every end of the links (a, b): root is the smallest node reachable.

    Each round takes the smallest label among a node and its neighbours, then
    jumps to that label's own label, so long chains shrink quickly. Labels are
    pre-aggregated per task before they are shuffled; each round's labels are
    written to the shared folder, which cuts the lineage. Neither a node with
    very many neighbours nor a label of very many nodes is dealt to one task.
    """
    keep = (scratch or Scratch(links.sparkSession)).keep
    both = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    both = keep(both.toDF("node", "near"))
    total = both.count()
    near = both.groupBy("node").agg(F.min("near").alias("near"), F.count("*").alias("members"))
    labels = keep(near.select("node", F.least("node", "near").alias("root"), "members"))
    for _ in range(most_rounds):
        offered = join_sized(both, labels.toDF("near", "offer", "members"), "near", total).groupBy("node").agg(F.min("offer").alias("offer"))
        lower = keep(labels.join(offered, "node").select("node", "root", F.least("root", "offer").alias("hop"), F.col("members").alias("links")))
        jump = labels.select(F.col("node").alias("hop"), F.col("root").alias("beyond"))
        jump = keep(jump.join(lower.groupBy("hop").agg(F.count("*").alias("members")), "hop"))
        met = join_sized(lower, jump, "hop", total)
        new = keep(met.select("node", F.least("hop", "beyond").alias("root"), F.col("links").alias("members"), (F.least("hop", "beyond") < F.col("root")).alias("moved")))
        labels = new.select("node", "root", "members")
        if not new.where("moved").limit(1).count():
            return labels.select("node", "root")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
