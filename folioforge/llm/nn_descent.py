"""Near-duplicate vectors through a neighbour graph refined by NN-descent.

A few trees of random hyperplanes give each vector its first neighbours; by themselves they let about half of all linked pairs meet.
Rounds then bring neighbours of neighbours together: centres that lie near each other form a group, and all that stand in their lists, in
either direction, are compared with one another. A vector's list holds its nearest, near or far, so that the next round finds nearer ones.
A list that is full of links is saturated; it is enlarged, twofold each round. Lists stay bounded all the same, links don't: wherever
vectors meet, all their links join them to linked sets, kept apart from the lists. The sets make components, in which every
direct link is counted.
A bounded sample of vectors is compared with all others. If too few of its links were found, more trees and rounds follow, and the query
fails if that doesn't help. The audit only measures: its links are no part of the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import acos, ceil, cos, log, log2, pi

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut
from .components import connected_components

THRESHOLD = 0.95
#: Length of a neighbour list, of an enlarged one; vectors of a leaf, and of centres in a group; of a block when links are counted.
NEIGHBOURS, ENLARGED, LEAF, BLOCK = 8, 16, 128, 512
#: Vectors of a large leaf that are compared at once: it is cut by chance.
LEAF_BLOCK = 1024
#: Rounds of a try at least and at most; share of new links in lists that ends them.
LEAST_ROUNDS, ROUNDS, SETTLED = 3, 8, 0.001
#: Recall that the trees are grown for, that the audit asks for, vectors in the audit's sample, tries.
TREES_FOR, RECALL, AUDITED, AGAIN = 0.5, 0.98, 512, 4
#: Rows of a product of vectors that is held at once.
AT_ONCE = 128

#: Rows that meetings give: neighbours with their cosine, or (link) two rows of one linked set.
MET = "a long, b long, c double, link boolean"


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def by_group(keys: list[str], f: Callable[[pd.DataFrame], pd.DataFrame | None], at_least: int = 1) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For mapInPandas over partitions sorted by keys: f on the rows of each key, if there are as many as that."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, out, size = None, [], 0
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            change = np.flatnonzero((rest[keys].to_numpy()[1:] != rest[keys].to_numpy()[:-1]).any(axis=1)) + 1
            edges = np.r_[0, change]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a >= at_least and (found := f(rest.iloc[a:b])) is not None:
                    out.append(found)
                    size += len(found)
                    if size > 20_000:
                        yield pd.concat(out, ignore_index=True)
                        out, size = [], 0
            rest = rest.iloc[edges[-1] :].reset_index(drop=True)
        if rest is not None and len(rest) >= at_least and (found := f(rest)) is not None:
            out.append(found)
        if out:
            yield pd.concat(out, ignore_index=True)

    return run


def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows: the first row of its linked set, the links (i, j) being given in both directions."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, i, root[j])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _nearest(ids: np.ndarray, unit: np.ndarray, bound: np.ndarray, threshold: float, keep: int) -> pd.DataFrame:
    """Up to keep neighbours of each row that are nearer than its bound, and (link) the first row of each row's linked set, from all links."""
    n = len(ids)
    keep, root, every = min(keep, n - 1), np.arange(n), np.arange(n)
    a, b, cs = [], [], []
    for at in range(0, n, AT_ONCE):
        c = unit[at : at + AT_ONCE] @ unit.T
        own = np.arange(len(c))
        c[own, at + own] = -2
        i, j = np.nonzero(c >= threshold)
        if len(i):
            root = _roots(np.r_[i + at, j, every, root], np.r_[j, i + at, root, every], n)
        y = np.argpartition(-c, keep - 1, axis=1)[:, :keep].ravel()
        x = np.repeat(own, keep)
        near = c[x, y] > bound[at + x]
        a, b, cs = [*a, at + x[near]], [*b, y[near]], [*cs, c[x[near], y[near]]]
    joined = np.flatnonzero(root != every)
    a, b, cs = (np.concatenate(x) for x in ([joined, *a], [root[joined], *b], [np.zeros(len(joined)), *cs]))
    return pd.DataFrame({"a": ids[a], "b": ids[b], "c": cs, "link": np.arange(len(a)) < len(joined)})


def trees_needed(bits: int, threshold: float, recall: float) -> int:
    """Trees after which a pair just at the threshold has been in one leaf with that probability."""
    met = (1 - acos(threshold) / pi) ** bits
    return 1 if met >= recall else ceil(log(1 - recall) / log(1 - met))


def _bits(n: int) -> int:
    """Hyperplanes of a tree over n vectors."""
    return max(0, ceil(log2(max(1, n / LEAF))))


def _placed(nodes: DataFrame, n: int, first: int, trees: int, of: str, block: int) -> DataFrame:
    """(tree, dim, leaf, part, node): the leaf of each node in some trees; leaves of many nodes are cut into parts of about `block` by hash."""
    bits = _bits(n)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for dim, own in x.groupby(x["v"].map(len)):
                unit = _unit(own["v"])
                for t in range(first, first + trees):
                    planes = np.random.default_rng([t, dim]).normal(size=(dim, bits))
                    yield pd.DataFrame({"tree": t, "dim": dim, "leaf": ((unit @ planes > 0) @ (1 << np.arange(bits))).astype(np.int64), "node": own["node"].to_numpy()})

    keys = ["tree", "dim", "leaf"]
    coded = cut(nodes.select("node", "v").mapInPandas(code, "tree int, dim int, leaf long, node long"))
    sizes = coded.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64(F.lit(of), "tree", "node"), F.col("parts")).cast("int")
    return coded.join(sizes, keys).select(*keys, part.alias("part"), "node")


def _leaves(nodes: DataFrame, n: int, first: int, trees: int, threshold: float) -> DataFrame:
    """Neighbours and links (a, b, c, link) met in the leaves of some trees."""
    keys = ["tree", "dim", "leaf", "part"]

    def meet(x: pd.DataFrame) -> pd.DataFrame:
        return _nearest(x["node"].to_numpy(), _unit(x["v"]), np.full(len(x), -2.0), threshold, NEIGHBOURS)

    rows = _placed(nodes, n, first, trees, "leaf", LEAF_BLOCK).join(nodes.select("node", "v"), "node").select(*keys, "node", "v")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(by_group(keys, meet, 2), MET)


def _best(edges: DataFrame, threshold: float, most: int) -> DataFrame:
    """The nearest NEIGHBOURS of each a, and further links up to `most` where these are links all."""
    one = edges.groupBy("a", "b").agg(F.max("c").alias("c"))
    ranked = one.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("c"), "b")))
    return ranked.where((F.col("r") <= NEIGHBOURS) | (F.col("c") >= threshold) & (F.col("r") <= most)).drop("r")


def _descend(graph: DataFrame, nodes: DataFrame, n: int, turn: int, threshold: float, most: int) -> DataFrame:
    """One round: what (a, b, c, link) the lists' members of centres that lie near each other meet. Centres are grouped by a tree of the round's own."""
    back = graph.select(F.col("b").alias("a"), F.col("a").alias("b"))
    back = back.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.xxhash64(F.lit(turn), "b")))).where(F.col("r") <= NEIGHBOURS).drop("r")
    keys = ["dim", "leaf", "part"]
    near = cut(_placed(nodes, n, 1 << 20 | turn, 1, "round", LEAF)).select(F.col("node").alias("a"), *keys)
    members = near.join(graph.select("a", "b").unionByName(back), "a").select(*keys, "b").unionByName(near.select(*keys, F.col("a").alias("b"))).distinct()
    # Nearer than this a list takes: a saturated one that isn't at its longest takes every link.
    held = graph.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n"), F.min("c").alias("least"))
    bound = F.when(F.coalesce("n", F.lit(0)) < NEIGHBOURS, -2.0).when((F.col("least") >= threshold) & (F.col("n") < most), threshold - 1e-12).otherwise(F.col("least"))
    known = nodes.select("node", "v").join(held, "node", "left").select(F.col("node").alias("b"), "v", bound.alias("bound"))
    rows = members.join(known, "b").select(*keys, F.col("b").alias("node"), "v", "bound")

    def join(x: pd.DataFrame) -> pd.DataFrame:
        return _nearest(x["node"].to_numpy(), _unit(x["v"]), x["bound"].to_numpy(), threshold, most)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(by_group(keys, join, 2), MET)


def _audit(nodes: DataFrame, n: int, threshold: float) -> DataFrame:
    """All links (a, b, c) of a bounded sample of nodes, by comparing it with every node."""
    sample = nodes.where(F.pmod(F.xxhash64(F.lit("audit"), "node"), F.lit(1 << 24)) < int(min(1.0, AUDITED / max(1, n)) * (1 << 24))).select("node", "v").toPandas()
    by_dim = {int(d): (own["node"].to_numpy(), _unit(own["v"])) for d, own in sample.groupby(sample["v"].map(len))}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for dim, own in x.groupby(x["v"].map(len)):
                if dim in by_dim:
                    ids, unit = by_dim[dim]
                    c = unit @ _unit(own["v"]).T
                    i, j = np.nonzero(c >= threshold)
                    found = pd.DataFrame({"a": ids[i], "b": own["node"].to_numpy()[j], "c": c[i, j]})
                    yield found[found["a"] != found["b"]]

    return nodes.select("node", "v").mapInPandas(run, "a long, b long, c double")


def _cores(large: DataFrame, threshold: float) -> DataFrame:
    """large(component, node, v, weight) with `core`: whether a node lies so near its component's mean direction that all core nodes of it link."""
    half = cos(acos(threshold) / 2 - 1e-7)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for component, own in x.groupby("component"):
                total = _unit(own["v"]).sum(axis=0)
                yield pd.DataFrame({"component": component, "pos": np.arange(len(total)), "x": total})

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for _, own in x.groupby("component"):
                middle = _unit(own["middle"].iloc[:1])[0]
                yield own.drop(columns="middle").assign(core=_unit(own["v"]) @ middle >= half)

    kind = large.schema["v"].dataType.simpleString()
    parts = large.select("component", "v").mapInPandas(sums, "component long, pos int, x double").groupBy("component", "pos").agg(F.sum("x").alias("x"))
    middles = parts.groupBy("component").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("middle"))
    return large.join(middles, "component").select("component", "node", "v", "weight", "middle").mapInPandas(mark, f"component long, node long, v {kind}, weight long, core boolean")


def _count_links(members: DataFrame, threshold: float) -> DataFrame:
    """(node, n): the weight of the nodes that each node links with, inside components (component, node, v, weight).

    Nodes within half the threshold's angle of their component's mean direction are its core: by the triangle inequality all of them link, which
    takes no comparing. The others are compared with all, block against block.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    sized = members.join(sizes, "component")
    small = sized.where(F.col("size") <= BLOCK).select("component", "node", "v", "weight", F.lit(False).alias("core"))
    marked = small.unionByName(cut(_cores(sized.where(F.col("size") > BLOCK).drop("size"), threshold)))
    blocks = lambda x: F.ceil(F.sum(x.cast("int")) / BLOCK).cast("int")
    kinds = marked.groupBy("component").agg(blocks(~F.col("core")).alias("rest"), blocks(F.col("core")).alias("cores"), F.sum(F.when(F.col("core"), F.col("weight")).otherwise(0)).alias("held"))
    placed = marked.join(kinds, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("core"), F.col("cores")).otherwise(F.col("rest"))).cast("int"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    # A pair of blocks is (i, j) of the rest, or (i, -1 - j) of the rest and the core.
    with_rest = F.transform(upto(F.col("rest")), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j"), (F.col("own") > o).alias("right")))
    with_core = F.transform(upto(F.col("cores")), lambda o: F.struct(F.col("own").alias("i"), (-1 - o).alias("j"), F.lit(False).alias("right")))
    of_core = F.transform(upto(F.col("rest")), lambda o: F.struct(o.alias("i"), (-1 - F.col("own")).alias("j"), F.lit(True).alias("right")))
    rows = placed.select("component", "node", "v", "weight", F.explode(F.when(F.col("core"), of_core).otherwise(F.concat(with_rest, with_core))).alias("x"))
    rows = rows.select("component", "x.i", "x.j", "x.right", "node", "v", "weight")

    def count(x: pd.DataFrame) -> pd.DataFrame:
        right, unit, ids, weight = x["right"].to_numpy(), _unit(x["v"]), x["node"].to_numpy(), x["weight"].to_numpy()
        if x["i"].iloc[0] == x["j"].iloc[0]:
            near = unit @ unit.T >= threshold
            np.fill_diagonal(near, False)
            return pd.DataFrame({"node": ids, "n": near @ weight})
        near = unit[~right] @ unit[right].T >= threshold
        return pd.DataFrame({"node": np.r_[ids[~right], ids[right]], "n": np.r_[near @ weight[right], near.T @ weight[~right]]})

    keys = ["component", "i", "j"]
    compared = rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(by_group(keys, count, 2), "node long, n long")
    inside = placed.where("core").select("node", (F.col("held") - F.col("weight")).alias("n"))
    return compared.unionByName(inside).groupBy("node").agg(F.sum("n").alias("n"))


def graph_of(nodes: DataFrame, n: int, threshold: float = THRESHOLD) -> tuple[DataFrame, float]:
    """Rows (a, b) that make the linked components of nodes(node, v), and the recall that the audit measured: of each sampled vector the share of its links
    found, as the mean of vectors with about as many links (by powers of two), the least of these means. Below RECALL it raises."""
    trees = trees_needed(_bits(n), threshold, TREES_FOR)
    truth = cut(_audit(nodes, n, threshold))
    links = truth.count()
    graph = nodes.sparkSession.createDataFrame([], "a long, b long, c double")
    met_links, recall, turn = None, 1.0, 0
    for again in range(AGAIN):
        met = cut(_leaves(nodes, n, again * trees, trees, threshold))
        graph = cut(_best(graph.unionByName(met.where("not link").drop("link")), threshold, NEIGHBOURS))
        ends = met.where("link").select("a", "b").distinct()
        met_links = cut(ends if met_links is None else met_links.unionByName(ends).distinct())
        held = graph.where(F.col("c") >= threshold).count()
        for k in range(ROUNDS):
            most = min(ENLARGED, NEIGHBOURS << k + 1)
            met = cut(_descend(graph, nodes, n, turn, threshold, most))
            graph = cut(_best(graph.unionByName(met.where("not link").drop("link")), threshold, most))
            met_links = cut(met_links.unionByName(met.where("link").select("a", "b")).distinct())
            before, held, turn = held, graph.where(F.col("c") >= threshold).count(), turn + 1
            if k + 1 >= LEAST_ROUNDS and held - before <= SETTLED * held:
                break
        recall = _recall(met_links, truth) if links else 1.0
        if recall >= RECALL:
            return met_links, recall
    raise RuntimeError(f"{AGAIN * trees} trees and {turn} rounds found {recall:.4f} of the audited links, fewer than {RECALL}")


def _recall(met_links: DataFrame, truth: DataFrame) -> float:
    """A link is found if both ends are in one component of the linked sets: these don't hold every link."""
    found = connected_components(met_links)
    ends = truth.join(found.select(F.col("node").alias("a"), F.col("component").alias("x")), "a").join(found.select(F.col("node").alias("b"), F.col("component").alias("y")), "b")
    of_vector = truth.groupBy("a").agg(F.count("*").alias("all")).join(ends.where("x = y").groupBy("a").agg(F.count("*").alias("n")), "a", "left")
    of_size = of_vector.groupBy(F.floor(F.log2("all")).alias("size")).agg(F.avg(F.coalesce("n", F.lit(0)) / F.col("all")).alias("share"))
    return of_size.agg(F.min("share")).first()[0]


def _nodes(usable: DataFrame) -> DataFrame:
    """(v, weight, least, node) for each different vector of usable (vec_id, v). Nodes are numbered by a hash of the vector, so every run gives the same
    numbers; should two be alike, all are hashed anew."""
    different = usable.groupBy("v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    seed = 0
    while True:
        nodes = cut(different.withColumn("node", F.xxhash64(F.lit(seed), "v")))
        if not nodes.groupBy("node").count().where("count > 1").head(1):
            return nodes
        seed += 1


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of vectors: (vec_id, n_links, component_id, kept).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; vectors of different
    lengths don't link. Equal vectors are one node and link with each other. Repeated rows count as other vectors. component_id is the smallest
    id reachable; kept is vec_id = component_id, null for a null id. The component of a null id alone is null.
    """
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = F.coalesce(F.forall("v", finite) & F.exists("v", lambda x: x != 0), F.lit(False))
    nodes = _nodes(own.where(usable))
    n = nodes.count()
    linked, _ = graph_of(nodes, n, threshold)
    parts = connected_components(linked)
    members = nodes.join(parts, "node")
    counts = _count_links(members.select("component", "node", "v", "weight"), threshold)
    least = members.groupBy("component").agg(F.min("least").alias("first"))
    of_node = nodes.join(parts, "node", "left").join(least, "component", "left").join(counts, "node", "left")
    of_node = of_node.select("v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("first", "least").alias("component_id"))
    out = own.withColumn("v", F.when(usable, F.col("v"))).join(of_node, "v", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
