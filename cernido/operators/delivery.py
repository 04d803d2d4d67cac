"""Messages delivered at least once: keep exactly one copy of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cernido.tables import blank_to_null, cut_lineage

IDS = ["idempotency_key", "pubsub_message_id"]


def message_nodes(outbox: DataFrame) -> DataFrame:
    """The deliveries with their identifiers as graph nodes ``k`` and ``p``.

    ``k``: the idempotency key without surrounding blanks, in lower case.
    ``p``: the broker's message id within its queue. Null where missing or blank.
    """
    return outbox.select(
        "delivery_no",
        "published_at",
        F.lower(blank_to_null(F.col("idempotency_key"))).alias("k"),
        F.when(
            blank_to_null(F.col("pubsub_message_id")).isNotNull(),
            F.concat_ws("\u0001", F.coalesce("queue_name", F.lit("")), blank_to_null(F.col("pubsub_message_id"))),
        ).alias("p"),
    )


def _converge(pairs: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of undirected ``(a, b)`` pairs: ``(node, root)`` for
    every node that isn't its own root, root being the least of the component.

    Alternates large-star and small-star steps; each step keeps at most one row
    an edge, combines before the shuffle, and is checkpointed to the shared
    folder. The rounds grow with the logarithm of a component's size.
    """
    edges = cut_lineage(pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = small.unionByName(down.withColumnRenamed("m", "b")).distinct()
        new = cut_lineage(new)
        # a forest of stars: every node has one parent and no parent has one
        stable = new.groupBy("a").count().filter("count > 1").isEmpty() and new.join(
            new.select(F.col("a").alias("b")), "b", "left_semi"
        ).isEmpty()
        edges = new
        if stable:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError("components did not converge")


def rank() -> Column:
    """The order of copies: the earliest published_at (missing is last), then delivery_no."""
    return F.struct(F.col("published_at").isNull().alias("late"), "published_at", "delivery_no")


def messages(nodes: DataFrame) -> DataFrame:
    """(message, k, p, best) of ``message_nodes``: the identifier pairs that occur,
    the message that each belongs to, and its best delivery by rank.

    Deliveries are combined by their identifiers within the tasks first, so a
    pair that a third of all rows carry is one row from there on, and rows
    without identifiers, each a message of its own, meet in no join. Two
    deliveries are of one message if they share an identifier, directly or
    through other deliveries. Ids that occur with one partner only never enter
    the component search: each idempotency key is first joined to the least
    broker id it occurs with, and only the broker ids that this links to
    another one go on.
    """
    some = F.col("k").isNotNull() | F.col("p").isNotNull()
    pairs = nodes.filter(some).groupBy("k", "p").agg(F.min(rank()).alias("best"))
    both = pairs.filter("k is not null and p is not null").select("k", "p")
    first = both.groupBy("k").agg(F.min("p").alias("least_p"), F.max("p").alias("most_p"))
    several = first.filter("least_p <> most_p").select("k", "least_p")
    links = both.join(several, "k").filter("p <> least_p").select(F.col("p").alias("a"), F.col("least_p").alias("b"))
    roots = _converge(links)
    # pairs with a broker id go by its root, keys alone by that of the least broker id they occur with
    of_key = first.select("k", F.col("least_p").alias("p"))
    alone = pairs.filter("p is null").drop("p").join(of_key, "k", "left")
    placed = pairs.filter("p is not null").select("k", "p", "best", F.col("p").alias("node"))
    placed = placed.unionByName(alone.filter("p is not null").select("k", F.lit(None).cast("string").alias("p"), "best", F.col("p").alias("node")))
    rooted = placed.join(roots, "node", "left").select(F.concat(F.lit("p"), F.coalesce("root", "node")).alias("message"), "k", "p", "best")
    lone_keys = alone.filter("p is null").select(F.concat(F.lit("k"), F.col("k")).alias("message"), "k", "p", "best")
    own = nodes.filter(~some).select(F.concat(F.lit("d"), F.col("delivery_no").cast("string")).alias("message"), "k", "p", rank().alias("best"))
    return rooted.unionByName(lone_keys).unionByName(own)


def kept_copies(outbox: DataFrame) -> DataFrame:
    """(message, delivery_no) of the copy to keep: the earliest published_at
    (missing is last), then the lowest delivery_no. The rank is a minimum, so
    it is combined before the shuffle and a message that holds a third of all
    deliveries costs one row a task. An empty table gives an empty one."""
    return messages(message_nodes(outbox)).groupBy("message").agg(F.min("best").alias("best")).select("message", "best.delivery_no")


def repeated_deliveries(outbox: DataFrame) -> DataFrame:
    """(delivery_no) of every delivery but the kept one of its message."""
    return outbox.select("delivery_no").join(kept_copies(outbox).select("delivery_no"), "delivery_no", "left_anti")


def new_messages(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The kept deliveries of ``batch`` of which no copy is stored yet.

    ``stored`` has the columns idempotency_key, pubsub_message_id and
    queue_name of all deliveries taken before. Whatever links a delivery of the
    batch to a stored one, some delivery of its message within the batch shares
    an identifier with a stored one; so components are sought in the batch only,
    and its identifiers anti-joined against the stored ones.
    """
    per = cut_lineage(messages(message_nodes(batch)))
    ids = per.select("message", F.explode(F.array(F.concat(F.lit("k"), "k"), F.concat(F.lit("p"), "p"))).alias("id")).filter("id is not null")
    old = message_nodes(stored.withColumns({"delivery_no": F.lit(0), "published_at": F.lit(None).cast("timestamp")}))
    old = old.select(F.explode(F.array(F.concat(F.lit("k"), "k"), F.concat(F.lit("p"), "p"))).alias("id")).filter("id is not null")
    known = ids.join(old, "id", "left_semi").select("message").distinct()
    fresh = per.groupBy("message").agg(F.min("best").alias("best")).join(known, "message", "left_anti").select("best.delivery_no")
    return batch.join(fresh, "delivery_no", "left_semi")
