"""Connected components over DataFrames of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import intervals
from .staging import settled, staged


#: Links that one task may hold: some 100 MB with their names.
TASK_LINKS = 1 << 20


def connected_components(links: DataFrame, task_links: int = TASK_LINKS, rounds: list | None = None) -> DataFrame:
    """(node, component) of every end of the links (a, b); the component is its smallest node.

    Links are dealt by ranges of their smaller ends, and each stretch of task_links links is replaced by the stars of its
    components, which have fewer links the more of a component lies together.  In a round every node then points at its
    smallest neighbour.  Along the pointers every second node is no larger than the one before, so they end in pairs that
    point at each other; the smaller of a pair is a root, the smallest of all that lead to it.  Pointers are doubled until
    they name roots, and the links are contracted to links of roots.  Each root stands for two nodes or more, so n nodes end
    in log2(n) rounds; once task_links or fewer links are left, either way, which bounds what a task holds, one task ends it.
    A link with a null end counts for its other end alone.

    rounds: gets the number of links (either way) that each round begins with.
    """
    return settled(links.sparkSession, lambda: _contracted(links, task_links, [] if rounds is None else rounds))


def _contracted(links: DataFrame, task_links: int, rounds: list) -> DataFrame:
    ends = links.select(F.coalesce("a", "b").alias("a"), F.coalesce("b", "a").alias("b")).where("a IS NOT NULL")
    stars = lambda own: staged(own.mapInArrow(_starred(task_links), own.schema))
    own = stars(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    levels = []
    if 2 * own.count() > task_links:
        own = stars(own.repartitionByRange("a", "b"))
    while 2 * (n := own.count()) > task_links:
        rounds.append(2 * n)
        levels.append(_rooted(own))
        end = lambda name: levels[-1].select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
        met = own.where("a <> b").join(end("a"), "a").join(end("b"), "b").where("root_a <> root_b")
        own = stars(met.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")))
    out = staged(own.repartition(1).mapInArrow(_spanned(), _schema(own)))
    for level in reversed(levels):
        out = staged(level.join(out.select(F.col("node").alias("root"), F.col("component").alias("__top")), "root", "left").select("node", F.coalesce("__top", "root").alias("component")))
    return out


def _rooted(own: DataFrame) -> DataFrame:
    """(node, root): each node's way over smallest neighbours to the end, by doubling."""
    ways = own.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("w")).select("w.*")
    low = staged(ways.groupBy("node").agg(F.min(F.when(F.col("node") != F.col("other"), F.col("other"))).alias("low")))
    back = low.select(F.col("node").alias("low"), F.col("low").alias("back"))
    own = low.join(back, "low", "left")
    # Alone, or the smaller of two that point at each other: a root.
    root = F.when(F.col("low").isNull() | ((F.col("back") == F.col("node")) & (F.col("node") < F.col("low"))), F.col("node")).otherwise(F.col("low"))
    at = staged(own.select("node", root.alias("root")))
    while True:
        ahead = at.select(F.col("node").alias("root"), F.col("root").alias("__next"))
        at = staged(at.join(ahead, "root").select("node", F.col("__next").alias("root"), (F.col("__next") != F.col("root")).alias("moved")))
        if at.where("moved").isEmpty():
            return at.select("node", "root")


def extend_components(known: DataFrame, links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """known (node, component) with further links (a, b): as if all links had been there from the start.

    The links are taken to the components of their ends, so only those that they touch are clustered anew; the others'
    rows pass through.
    """
    known = known.select("node", "component")
    part = lambda end: known.select(F.col("node").alias(end), F.col("component").alias(f"__{end}"))
    named = links.select("a", "b").join(part("a"), "a", "left").join(part("b"), "b", "left")
    named = staged(named.select("a", "b", F.coalesce("__a", "a").alias("__a"), F.coalesce("__b", "b").alias("__b")))
    merged = connected_components(named.select(F.col("__a").alias("a"), F.col("__b").alias("b")), task_links)
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("__new"))
    old = known.join(merged, "component", "left").select("node", F.coalesce("__new", "component").alias("component"))
    ends = named.select(F.col("a").alias("node"), F.col("__a").alias("component")).union(named.select("b", "__b")).where("node IS NOT NULL").distinct()
    fresh = ends.join(known, "node", "left_anti").join(merged, "component").select("node", F.col("__new").alias("component"))
    return old.union(fresh)


def _schema(links: DataFrame):
    kind = links.schema["a"].dataType.simpleString()
    return f"node {kind}, component {kind}"


def _labels():
    """A function of a table of links: (names in order, each one's place of its component's smallest, whether a link to another holds it).

    It holds all it needs, so that workers need no package.
    """

    def label_of(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute  # noqa: F401

        a, b = (table.column(i).combine_chunks() for i in (0, 1))
        names = pa.concat_arrays([a, b]).unique()
        names = names.take(pa.compute.sort_indices(names))
        a, b = (np.array(pa.compute.index_in(x, names), np.int64) for x in (a, b))
        label = np.arange(len(names))
        while len(a):
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while (label[label] != label).any():
                label = label[label]
            if (label == before).all():
                break
            open_ = label[a] != label[b]
            a, b = a[open_], b[open_]
        return names, label

    return label_of


def _spanned():
    """A function of all links as batches: (node, component) of their ends."""
    label_of = _labels()

    def run(batches):
        import pyarrow as pa

        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        names, label = label_of(pa.Table.from_batches(held))
        for i in range(0, len(label), 50_000):
            yield pa.RecordBatch.from_arrays([names.slice(i, 50_000), names.take(pa.array(label[i : i + 50_000]))], names=["node", "component"])

    return run


def _starred(most: int):
    """A function of links as batches: of each stretch of `most` links (a batch more at most) the stars of its components, and lone ends as links to themselves."""
    label_of = _labels()

    def stars(held):
        import numpy as np
        import pyarrow as pa

        names, label = label_of(pa.Table.from_batches(held))
        shown = (label != np.arange(len(label))) | (np.bincount(label, minlength=len(label)) == 1)
        at = np.flatnonzero(shown)
        for i in range(0, len(at), 50_000):
            part = at[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(label[part])), names.take(pa.array(part))], names=["a", "b"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not most:
                yield batch
                continue
            held.append(batch)
            n += batch.num_rows
            if n >= most:
                yield from stars(held)
                held, n = [], 0
        if n:
            yield from stars(held)

    return run


def cluster_keys(kv: DataFrame, key: str = "key", value: str = "val") -> DataFrame:
    """(key, cluster): keys that share a value, directly or through others, share a cluster; it is named by its smallest key."""
    hub = kv.groupBy(value).agg(F.min(key).alias("a"))  # a star for each value, never its pairs
    links = kv.join(hub, value).select("a", F.col(key).alias("b"))
    return connected_components(links).select(F.col("node").alias(key), F.col("component").alias("cluster"))


def cluster_members(kv: DataFrame, key: str = "key", value: str = "val") -> DataFrame:
    """kv with cluster: the clusters as a table of their keys and values."""
    return kv.select(key, value).distinct().join(cluster_keys(kv, key, value), key)


def cluster_graph(kv: DataFrame, key: str = "key", value: str = "val") -> dict[str, DataFrame]:
    """The graph behind the clusters: nodes (name, kind, cluster), edges (key, value, cluster)."""
    edges = staged(cluster_members(kv, key, value))
    ends = [edges.select(F.col(c).cast("string").alias("name"), F.lit(kind).alias("kind"), "cluster") for c, kind in ((key, "key"), (value, "value"))]
    return {"nodes": ends[0].unionByName(ends[1]).distinct(), "edges": edges}


def assign_loci(df: DataFrame, grouping: list[str] = (), pilegap: int = 0, pairgap: int = 200, maxovlp: int = 10) -> DataFrame:
    """df with locus: ranges joined by pile-ups and by pairs, transitively; a locus is named by its smallest pile-up.

    Pile-ups and pairs meet as distinct ranges of few columns; rows are exchanged once, for the locus of their range.
    """
    keys, text = [*grouping, "seqnames", "strand"], {f.name for f in df.schema if f.dataType.typeName() == "string"}
    emptied = [F.nullif(F.col(k), F.lit(intervals.NO_KEY)) if k in text else F.col(k) for k in grouping]
    pile = F.concat_ws("|", *emptied, intervals.origin_name(), "island")
    piled = intervals.named_ranges(df, grouping, pilegap).withColumn("__pile", pile).drop("island", "__origin")
    paired = intervals.identify_pairs(intervals._emptied(piled, keys), grouping, pairgap, maxovlp).where("paired_algn IS NOT NULL")
    # A pile-up without a pair is a locus of its own, and so needs no link.
    loci = cluster_keys(paired.select("__pile", "paired_algn").distinct(), "__pile", "paired_algn").where("cluster <> __pile")
    named = piled.join(loci, "__pile", "left").select(*keys, "start", "end", F.coalesce("cluster", "__pile").alias("locus"))
    return intervals._emptied(intervals._filled(df, keys).join(named, [*keys, "start", "end"]), keys).select(*df.columns, "locus")
