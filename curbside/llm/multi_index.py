"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for either half of the vectors, span a grid of cells; every vector lies in one cell of its label. A
vector's search visits cells in the order of the sum of its distances to the two centroids (multi-sequence traversal)
and stops at the number of cells that reached the target recall on a sample of true pairs. What it meets is verified by
cosine in double precision.

Equal vectors of a label are one class with a number of copies, so copies are never expanded. A cell's members, and the
searches that visit it, come in blocks: tasks multiply a block of searches by a block of members and return sums per
search and a spanning forest of what they linked, never pairs. A cell with a third of all rows is many block pairs in
many tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.llm.components import connected_components
from curbside.session import settle

SAMPLE = 20_000  # vectors that the number of visited cells is fitted on, at most
POINTS = 16  # vectors to a centroid that the codebooks are fitted on; SAMPLE at least, MOST_SAMPLE at most
MOST_SAMPLE = 200_000
PARTNERS = 8  # true pairs of a sampled vector that the number of visited cells is fitted on, at most
BANDS = 3  # cosines from the threshold to 1 in so many bands
LEAST_PAIRS = 100  # of a group and band, to be looked at by themselves
TARGET = 0.995  # share of the pairs of each group and band that a search finds
BLOCK = 1024  # vectors of a block
ROUNDS = 15


def centroids_for(vectors: int) -> int:
    """Centroids of a codebook: some hundred vectors to a cell, all labels together, for a table of any size that
    MOST_SAMPLE vectors can fit (80 billion)."""
    return int(min(MOST_SAMPLE // POINTS, max(4, round((vectors / 500) ** 0.5))))


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves, and the cells a search visits."""

    left: np.ndarray
    right: np.ndarray
    visits: int

    @property
    def half(self) -> int:
        return self.left.shape[1]


def codebook(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids by k-means from distinct points drawn with a fixed seed."""
    points = np.unique(points, axis=0)
    if len(points) <= k:
        return points
    centroids = points[np.random.default_rng(seed).choice(len(points), k, replace=False)]
    for _ in range(ROUNDS):
        nearest = _distances(points, centroids).argmin(axis=1)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of points to centroids."""
    return np.maximum(
        (points**2).sum(axis=1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(axis=1), 0.0
    )


def visit_order(left: np.ndarray, right: np.ndarray, visits: int) -> list[tuple[int, int]]:
    """The `visits` cells of least summed distance: multi-sequence traversal of one search's two distance rows."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap = [(left[a[0]] + right[b[0]], 0, 0)]
    out, pushed = [], {(0, 0)}
    while heap and len(out) < visits:
        _, i, j = heapq.heappop(heap)
        out.append((int(a[i]), int(b[j])))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in pushed:
                pushed.add((x, y))
                heapq.heappush(heap, (left[a[x]] + right[b[y]], x, y))
    return out


def grid_distances(index: Index, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of both halves of the points to the centroids."""
    return _distances(points[:, : index.half], index.left), _distances(points[:, index.half :], index.right)


def home_cells(index: Index, points: np.ndarray) -> np.ndarray:
    """The cell each point lies in, numbered row by row."""
    left, right = grid_distances(index, points)
    return left.argmin(axis=1) * len(index.right) + right.argmin(axis=1)


def searched_cells(index: Index, points: np.ndarray) -> np.ndarray:
    """Cells that the points' searches visit, nearest first (points x visits)."""
    width = len(index.right)
    rows = zip(*grid_distances(index, points))
    return np.array([[i * width + j for i, j in visit_order(a, b, index.visits)] for a, b in rows], dtype=np.int64)


def _true_pairs(points: np.ndarray, labels: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (searching vector, other vector) of the sample, some partners of each vector, and their groups."""
    first, second = [], []
    order = np.argsort(labels, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1):
        for start in range(0, len(group), 500):
            block = group[start : start + 500]
            for i, row in zip(block.tolist(), points[block] @ points[group].T >= threshold):
                others = group[row]
                others = others[others != i]
                step = max(1, len(others) // PARTNERS)
                second += others[::step][:PARTNERS].tolist()
                first += [i] * (len(second) - len(first))
    return points[first], points[second], labels[first]


def _made_pairs(points: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Sampled vectors and noisy versions of them, cosines even between the threshold and 1."""
    rng = np.random.default_rng(3)
    first = points[:2000]
    noise = rng.normal(size=first.shape)
    noise -= (noise * first).sum(axis=1, keepdims=True) * first
    noise /= np.maximum(np.sqrt((noise * noise).sum(axis=1, keepdims=True)), 1e-12)
    cosine = rng.uniform(threshold, 1.0, (len(first), 1))
    return first, cosine * first + np.sqrt(1 - cosine**2) * noise


def cells_before(index: Index, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Cells that a search for each of `first` visits before it comes to the one where its partner lies."""
    out = np.zeros(len(first), dtype=np.int64)
    home = np.divmod(home_cells(index, second), len(index.right))
    for start in range(0, len(first), 2000):
        part = slice(start, start + 2000)
        a, b = grid_distances(index, first[part])
        here = np.arange(len(a))
        sums = a[here, home[0][part]] + b[here, home[1][part]]
        b.sort(axis=1)
        out[part] = [int(np.searchsorted(y, s - x).sum()) for x, y, s in zip(a, b, sums)]
    return out


def strata(first: np.ndarray, second: np.ndarray, groups: np.ndarray, threshold: float) -> Iterator[np.ndarray]:
    """Places of the pairs of each band of cosines in each group, and, for small groups, of each band in all of them. So a
    group that has most pairs does not speak for the others."""
    cosine = (first * second).sum(axis=1)
    band = np.clip(((cosine - threshold) / (1 - threshold) * BANDS).astype(int), 0, BANDS - 1)
    for k in range(BANDS):
        places = np.flatnonzero(band == k)
        _, which, sizes = np.unique(groups[places], return_inverse=True, return_counts=True)
        small = sizes[which] < LEAST_PAIRS
        yield places[small]
        for g in np.flatnonzero(sizes >= LEAST_PAIRS):
            yield places[which == g]


def fit(points: np.ndarray, labels: np.ndarray, threshold: float, k: int) -> Index:
    """An index whose number of visits reaches TARGET on the true pairs of the sample in every stratum, and on made pairs
    where these are too few to tell; all cells if it must."""
    half = points.shape[1] // 2
    left, right = codebook(points[:, :half], k, 1), codebook(points[:, half:], k, 2)
    every = Index(left, right, len(left) * len(right))
    first, second, groups = _true_pairs(points[:SAMPLE], labels[:SAMPLE], threshold)
    asked = [0]
    if len(first):
        ranks = cells_before(every, first, second)
        asked += [_needed(ranks[places]) for places in strata(first, second, groups, threshold) if len(places)]
    if len(first) < LEAST_PAIRS:
        asked.append(_needed(cells_before(every, *_made_pairs(points, threshold))))
    return Index(left, right, min(max(asked) + 2, every.visits))  # one more cell than the pairs ask for


def _needed(ranks: np.ndarray) -> int:
    return int(np.sort(ranks)[min(len(ranks) - 1, int(np.ceil(TARGET * len(ranks))))])


def _stars(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every linked row and column of a block pair to the least of all it is connected with there."""
    i, j = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(i):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    inside, most = linked[np.ix_(i, j)], np.iinfo(np.int64).max
    a, b = rows[i], columns[j]
    while True:
        new_a = np.minimum(a, np.where(inside, b, most).min(axis=1))
        new_b = np.minimum(b, np.where(inside, new_a[:, None], most).min(axis=0))
        if (new_a == a).all() and (new_b == b).all():
            break
        a, b = new_a, new_b
    ends, least = np.concatenate([rows[i], columns[j]]), np.concatenate([a, b])
    ends, least = ends[ends != least], least[ends != least]
    pairs = np.unique(np.column_stack([ends, least]), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _usable() -> Column:
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("label").isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors with a null label, null, zero, empty or with null or non-finite components have no link and are their own
    component, as are vectors of a length of their own. Repeated rows are linked copies if they are valid. A null
    vec_id counts as greater than all others; a component of these only has a null id and none of it is kept. Other
    columns are ignored.
    """
    spark = vectors.sparkSession
    stored = settle(vectors.where(_usable()).select("vec_id", "label", F.col("embedding").alias("v")), "vectors")
    # one row per distinct vector of a label; `cls` numbers them
    classes = settle(
        stored.groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    lengths = [r.n for r in classes.select(F.size("v").alias("n")).groupBy("n").count().orderBy("n").collect()]
    found = None
    for n in lengths:
        part = classes.where(F.size("v") == n)
        one = _links(spark, part, n, threshold)
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = spark.createDataFrame([], _LINKS)
    found = settle(found, "links")
    counts = found.where("other is null").groupBy("cls").agg(F.sum("links").alias("links"))
    component = connected_components(found.where("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    named = classes.join(counts, "cls", "left").join(component.withColumnRenamed("node", "cls"), "cls", "left").select(
        "label", "v", "cls", "least",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "cls").alias("component"),
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = settle(named.join(least, "component").select("label", "v", "n_links", "component_id"), "classes")
    valid = stored.join(named, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = vectors.where(~_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return valid.unionByName(alone).select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


_LINKS = "cls bigint, links bigint, other bigint"


def _links(spark, classes: DataFrame, length: int, threshold: float) -> DataFrame:
    """Sums of copies linked to each class (`other` null), and edges between classes, of vectors of one length."""
    single = classes.schema["v"].dataType.elementType.simpleString() == "float"
    stored_as = "<f4" if single else "<f8"

    def units(raw: np.ndarray) -> np.ndarray:
        """Unit vectors in double precision; vectors of one component get a second half of zero."""
        raw = raw.astype(np.float64)
        raw = raw / np.abs(raw).max(axis=1, keepdims=True)
        raw = raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))
        return np.hstack([raw, np.zeros_like(raw)]) if length < 2 else raw

    k = centroids_for(classes.count())
    size = min(MOST_SAMPLE, max(SAMPLE, POINTS * k))
    sample = classes.orderBy(F.xxhash64("v"), "cls").limit(size).select("label", "v").toPandas()
    points = units(np.array([np.asarray(v) for v in sample["v"]]))
    shared = spark.sparkContext.broadcast(fit(points, pd.factorize(sample["label"])[0], threshold, k))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each class once as a member of its cell, and once per cell that its search visits."""
        index = shared.value
        for batch in batches:
            if not len(batch):
                continue
            raw = np.array([np.asarray(v, dtype=stored_as) for v in batch["v"]])
            u, packed = units(raw), [row.tobytes() for row in raw]
            yield pd.DataFrame({
                "label": batch["label"], "cell": home_cells(index, u), "search": False,
                "cls": batch["cls"], "copies": batch["copies"], "u": packed,
            })
            visited = searched_cells(index, u)
            at = np.repeat(np.arange(len(batch)), visited.shape[1])
            yield pd.DataFrame({
                "label": batch["label"].to_numpy()[at], "cell": visited.ravel(), "search": True,
                "cls": batch["cls"].to_numpy()[at], "copies": 0, "u": [packed[i] for i in at.tolist()],
            })

    kind = classes.schema["label"].dataType.simpleString()
    placed = settle(
        classes.select("label", "v", "cls", "copies")
        .mapInPandas(place, f"label {kind}, cell bigint, search boolean, cls bigint, copies bigint, u binary"),
        "placed",
    )
    # a cell's rows are dealt by hash to as many blocks as they need; a block has about BLOCK vectors
    sizes = placed.groupBy("label", "cell", "search").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = settle(
        placed.join(sizes, ["label", "cell", "search"])
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .groupBy("label", "cell", "search", "block").agg(F.collect_list(F.struct("cls", "copies", "u")).alias("rows")),
        "blocks",
    )
    columns = ["label", "cell"]
    members = blocks.where("not search").select(*columns, F.col("rows").alias("members"))
    searches = blocks.where("search").select(*columns, F.col("rows").alias("searches"))

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def matrix(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            ids, copies = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("cls", "copies"))
            raw = np.frombuffer(b"".join(r["u"] for r in rows), dtype=stored_as).reshape(len(rows), -1)
            return ids, copies, units(raw)

        for batch in batches:
            parts = [pd.DataFrame({"cls": [], "links": [], "other": []}, dtype="Int64")]
            for a, b in zip(batch["searches"], batch["members"]):
                ids, _, left = matrix(a)
                others, copies, right = matrix(b)
                linked = (left @ right.T >= threshold) & (ids[:, None] != others)
                total = linked @ copies
                parts.append(pd.DataFrame({"cls": ids[total > 0], "links": total[total > 0]}))
                ends, least = _stars(linked, ids, others)
                parts.append(pd.DataFrame({"cls": ends, "other": least}))
            whole = pd.concat([p.astype("Int64") for p in parts], ignore_index=True)
            yield whole[["cls", "links", "other"]]

    # a pair of blocks is much work for few bytes, so pairs are dealt out evenly by salt before they are multiplied
    pairs = searches.join(members, columns).repartition(F.xxhash64(F.col("searches")[0]["cls"], F.col("members")[0]["cls"]))
    return pairs.mapInPandas(multiply, _LINKS)
