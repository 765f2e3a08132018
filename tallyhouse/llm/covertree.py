"""Embedding near-duplicates: exact cosine-threshold links by dual traversal of
cover trees.

On unit vectors a cosine of c is a distance of sqrt(2 - 2c), so the links are
the pairs within that distance.  A cover tree has nested levels with halving
radii; each node has a centre (one of its vectors) and a covering radius, the
largest distance to a vector below it.  A pair of nodes is dropped when their
centres are farther apart than both radii and the link distance together, and
else replaced by the pairs of their children; pairs of single vectors are
compared exactly, in double precision.

The upper level is common to all tasks: at most ``CELLS`` centres, chosen from
a bounded sample farthest first, every vector in the nearest one's cell.  Cells
are cut into blocks of about ``BLOCK`` vectors, each block gets its tree, and
each pair of blocks whose cells the bound lets through is traversed in one
task.  So one dense region, however many vectors it holds, is spread over many
tasks of bounded size.  Equal vectors form one class with a count, and a task
returns for each class its number of links and one connecting link, never the
pairs; ``pairs`` returns them for those who want them.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different length link with nothing
of the other length; repeated rows are rows of their own and link with each
other; a row without vec_id counts as a link but lends no id (its component_id
is null if its whole component has none, and such a row is kept); an empty
table gives no rows; labels and other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship_by_value, stored
from tallyhouse.llm.components import connected_components

ship_by_value(__name__)

THRESHOLD = 0.9
BLOCK = 4096           # classes in one block, about
CELLS = 256            # cells of the upper level at most
SAMPLE = 4096          # classes from which the cells' centres are chosen
RADII = (1.0, 0.5, 0.25)
LEAF = 16              # nodes of fewer vectors are not worth a bound: each vector stands for itself
ROWS_AT_ONCE = 1024
SLACK = 1e-7           # rounding of distances near zero
ROUGH = 1e-4           # error bound of a cosine in single precision (dimensions * 2**-23, for up to 800)


def unit(vectors) -> np.ndarray:
    v = np.concatenate(list(vectors)).astype(np.float64).reshape(len(vectors), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)          # no overflow in the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def distance(cosine):
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def farthest_first(vectors: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` of the vectors, each the farthest from those before."""
    chosen = [0]
    near = distance(vectors @ vectors[0])
    while len(chosen) < min(count, len(vectors)) and near.max() > SLACK:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distance(vectors @ vectors[chosen[-1]]))
    return vectors[chosen]


def net(vectors: np.ndarray, radius: float) -> np.ndarray:
    """For each vector the place of its centre: the first vector is one, and
    so is every vector farther than ``radius`` from all centres before it."""
    within = 1.0 - radius * radius / 2.0
    centres, own = [], np.empty(len(vectors), dtype=np.int64)
    for at in range(0, len(vectors), 512):
        part = vectors[at:at + 512]
        best, which = np.full(len(part), -2.0), np.zeros(len(part), dtype=np.int64)
        if centres:
            to = part @ vectors[centres].T
            which = to.argmax(axis=1)
            best = to[np.arange(len(part)), which]
            which = np.array(centres)[which]
        left = np.flatnonzero(best < within)
        among = part[left] @ part[left].T
        open_, new = np.ones(len(left), dtype=bool), []
        for k in range(len(left)):
            if open_[k]:
                new.append(k)
                open_ &= among[k] < within
        if new:
            to = part @ part[left[new]].T
            k = to.argmax(axis=1)
            value = to[np.arange(len(part)), k]
            closer = value > best
            which[closer] = (left[new] + at)[k[closer]]
            which[left[new]] = left[new] + at
            centres += (left[new] + at).tolist()
        own[at:at + 512] = which
    return own


def nest(vectors: np.ndarray, radii=RADII) -> np.ndarray:
    """Place of each vector's centre on each level, one column per radius; a
    vector in a node of fewer than LEAF is its own centre from there on."""
    path = np.repeat(np.arange(len(vectors))[:, None], len(radii), axis=1)
    groups = [np.arange(len(vectors))]
    for level, radius in enumerate(radii):
        below = []
        for group in groups:
            if level:                       # the centre above stays a centre
                centre = path[group[0], level - 1]
                group = np.concatenate([[centre], group[group != centre]])
            own = group[net(vectors[group], radius)]
            order = np.argsort(own, kind="stable")
            cuts = np.flatnonzero(np.diff(own[order])) + 1
            for node in np.split(order, cuts):
                if len(node) >= LEAF:
                    path[group[node], level] = own[node]
                    below.append(group[node])
        groups = below
    return path


class Tree:
    """Nodes and covering radii from the paths of ``nest``.  A node is named by
    its centre; a node of one vector has radius 0 and is that vector."""

    def __init__(self, vectors: np.ndarray, path: np.ndarray):
        self.vectors, self.levels = vectors, path.shape[1]
        self.rough = vectors.astype(np.float32) if vectors.shape[1] <= 800 else vectors
        self.radius = []
        for level in range(self.levels):
            far = distance(np.einsum("ij,ij->i", vectors, vectors[path[:, level]]))
            far[path[:, level] == np.arange(len(vectors))] = 0.0
            radius = np.zeros(len(vectors))
            np.maximum.at(radius, path[:, level], far)
            several = np.bincount(path[:, level], minlength=len(vectors)) > 1
            self.radius.append(np.where(several, np.maximum(radius, 10 * SLACK), 0.0))
        self.path = path
        self.top = np.unique(path[:, 0])

    def below(self, nodes: np.ndarray, level: int) -> np.ndarray:
        """The nodes of the next level (or the vectors) under some nodes."""
        chosen = np.zeros(len(self.vectors), dtype=bool)
        chosen[nodes] = True
        rows = np.flatnonzero(chosen[self.path[:, level]])
        return rows if level + 1 == self.levels else np.unique(self.path[rows, level + 1])


def traverse(a: Tree, b: Tree, threshold: float, found) -> None:
    """Call found(rows of a, rows of b, link matrix) until all links are told.

    Node pairs that the bound lets through go down together: those of one node
    (on the side that has fewer) with all of its partners.  Bounds are tested in
    single precision with room for its error; pairs of single vectors that come
    close are computed again in double precision.
    """
    reach = distance(threshold) + SLACK
    waiting = [(0, a.top, b.top)]
    while waiting:
        level, left, right = waiting.pop()
        ra = a.radius[level][left] if level < a.levels else np.zeros(len(left))
        rb = b.radius[level][right] if level < b.levels else np.zeros(len(right))
        # nodes of like radius stand together, single vectors apart from the rest
        for la in _by_radius(ra):
            for lb in _by_radius(rb):
                other = b.rough[right[lb]]
                single = ra[la].max() <= SLACK and rb[lb].max() <= SLACK
                for at in range(0, len(la), ROWS_AT_ONCE):
                    rows = la[at:at + ROWS_AT_ONCE]
                    cosine = a.rough[left[rows]] @ other.T
                    if single:
                        near = cosine >= np.float32(threshold - ROUGH)
                        i, j = np.flatnonzero(near.any(axis=1)), None
                        if len(i):
                            j = np.flatnonzero(near[i].any(axis=0))
                            link = a.vectors[left[rows[i]]] @ b.vectors[right[lb[j]]].T >= threshold
                            if link.any():
                                found(left[rows[i]], right[lb[j]], link)
                        continue
                    bound = np.minimum(2.0, ra[rows][:, None] + rb[lb][None, :] + reach)
                    near = cosine >= 1.0 - bound * bound / 2.0 - ROUGH
                    if len(rows) <= len(lb):
                        waiting += [(level + 1, a.below(left[rows[i:i + 1]], level), b.below(right[lb[near[i]]], level))
                                    for i in np.flatnonzero(near.any(axis=1))]
                    else:
                        waiting += [(level + 1, a.below(left[rows[near[:, j]]], level), b.below(right[lb[j:j + 1]], level))
                                    for j in np.flatnonzero(near.any(axis=0))]


def _by_radius(radius: np.ndarray) -> list[np.ndarray]:
    kind = np.where(radius <= SLACK, 99, np.floor(-np.log2(np.maximum(radius, SLACK))).clip(-1, 6)).astype(int)
    return [np.flatnonzero(kind == k) for k in np.unique(kind)]


def _connecting(rows, columns, link):
    """Links (pairs of the given names) that keep all connections of a matrix:
    all of them if few, else one tree per connected part."""
    if link.sum() <= 4 * (len(rows) + len(columns)):
        i, j = np.nonzero(link)
        return rows[i], columns[j]
    a, b = [], []
    open_rows = link.any(axis=1)
    while open_rows.any():
        start = int(open_rows.argmax())
        new_rows, seen = np.array([start]), np.zeros(link.shape[1], dtype=bool)
        open_rows[start] = False
        while len(new_rows):
            fresh = np.flatnonzero(link[new_rows].any(axis=0) & ~seen)
            seen[fresh] = True
            a.append(np.full(len(fresh), start))
            b.append(fresh)
            new_rows = np.flatnonzero(open_rows & link[:, fresh].any(axis=1)) if len(fresh) else fresh
            open_rows[new_rows] = False
            if len(new_rows):
                a.append(new_rows)
                b.append(link[new_rows].argmax(axis=1))
    # rows after the first hang on a column of the same part, columns on its first row
    return rows[np.concatenate(a)], columns[np.concatenate(b)]


def _roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _sides(rows: pd.DataFrame):
    side, pos = rows["side"].to_numpy(), rows["pos"].to_numpy()
    order = np.lexsort((pos, side))
    cut = int((side == 0).sum())
    columns = {c: rows[c].to_numpy()[order] for c in ("class", "copies", "vector", "path")}
    one = pd.DataFrame({c: v[:cut] for c, v in columns.items()})
    two = pd.DataFrame({c: v[cut:] for c, v in columns.items()})
    tree = lambda part: Tree(unit(part["vector"].to_numpy()),
                             np.concatenate(list(part["path"])).astype(np.int64).reshape(len(part), -1))
    return one, two, tree


def _compare(threshold: float):
    """Of one pair of blocks: class, its links into the other block (copies
    counted), and a class of the same component."""
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        one, two, tree = _sides(rows)
        empty = pd.DataFrame({"class": [], "n": [], "root": []}).astype("int64")
        same = bool((rows["a"] == rows["b"]).iloc[0])
        if not len(one) or not (same or len(two)):
            return empty
        a = tree(one)
        b = a if same else tree(two)
        copies_a = one["copies"].to_numpy()
        copies_b = copies_a if same else two["copies"].to_numpy()
        shift = 0 if same else len(one)
        count = np.zeros(len(one) + (0 if same else len(two)), dtype=np.int64)
        x, y = [], []

        def found(left, right, link):
            if same:
                link = link & (left[:, None] != right[None, :])
                if not link.any():
                    return
            count[left] += link @ copies_b[right]
            if not same:
                count[right + shift] += copies_a[left] @ link
            i, j = _connecting(left, right, link)
            x.append(i)
            y.append(j + shift)

        traverse(a, b, threshold, found)
        if not x:
            return empty
        name = one["class"].to_numpy() if same else np.concatenate([one["class"], two["class"]])
        root = _roots(len(count), np.concatenate(x), np.concatenate(y))
        linked = np.flatnonzero(count)
        return pd.DataFrame({"class": name[linked], "n": count[linked], "root": name[root[linked]]})
    return links


def _all_pairs(threshold: float):
    """Of one pair of blocks: every link with its cosine, once."""
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        one, two, tree = _sides(rows)
        same = bool((rows["a"] == rows["b"]).iloc[0])
        out = [pd.DataFrame({"a": [], "b": [], "cosine": []}).astype({"a": "int64", "b": "int64"})]
        if len(one) and (same or len(two)):
            a = tree(one)
            b = a if same else tree(two)
            left_name = one["class"].to_numpy()
            right_name = left_name if same else two["class"].to_numpy()

            def found(left, right, link):
                i, j = np.nonzero(link & (left[:, None] < right[None, :]) if same else link)
                i, j = left[i], right[j]
                out.append(pd.DataFrame({"a": left_name[i], "b": right_name[j],
                                         "cosine": np.einsum("ij,ij->i", a.vectors[i], b.vectors[j])}))

            traverse(a, b, threshold, found)
        return pd.concat(out, ignore_index=True)
    return links


def classes(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, class; null for vectors that link with nothing), and
    classes (class, vector, copies, low), one per different usable vector."""
    e = F.col("embedding")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = e.isNotNull() & ~F.exists(e, bad) & F.exists(e, lambda x: x != 0)
    rows = embeddings.select("vec_id", F.when(usable, e).alias("vector"))
    rows = rows.select("vec_id", "vector", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")).alias("class"))
    per = rows.filter("class IS NOT NULL").groupBy("class").agg(
        F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    return rows.select("vec_id", "class"), stored(per, "classes")


def _blocks(per: DataFrame, threshold: float, block: int, cells: int, sample: int) -> DataFrame:
    """Rows of all pairs of blocks that may hold links: a, b (block names),
    side, pos, class, copies, vector, path."""
    spark = per.sparkSession
    total = per.count()
    share = min(1.0, 2.0 * sample / max(1, total))
    drawn = per.filter(F.pmod(F.xxhash64("class"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1) \
        .select("class", "vector").limit(4 * sample).collect()
    drawn.sort(key=lambda r: r["class"])
    centres = {}                              # per vector length
    for size in sorted({len(r["vector"]) for r in drawn}):
        mine = [r["vector"] for r in drawn if len(r["vector"]) == size]
        centres[size] = farthest_first(unit(mine), max(1, min(cells, -(-total // block))))
    offset, number = {}, 0
    for size, c in centres.items():
        offset[size] = number
        number += len(c)
    known = spark.sparkContext.broadcast((centres, offset, number))

    def place(batches):
        centres, offset, other = known.value
        for batch in batches:
            cell, far = np.empty(len(batch), dtype=np.int64), np.zeros(len(batch))
            size = batch["vector"].map(len).to_numpy()
            for s in np.unique(size):
                mine = np.flatnonzero(size == s)
                if s not in centres:          # a length that the sample missed: one cell of any radius
                    cell[mine], far[mine] = other + s, 2.0
                    continue
                cosine = unit(batch["vector"].to_numpy()[mine]) @ centres[s].T
                best = cosine.argmax(axis=1)
                cell[mine] = offset[s] + best
                far[mine] = distance(cosine[np.arange(len(mine)), best])
            yield batch.assign(cell=cell, far=far)

    vector = per.schema["vector"].dataType.simpleString()
    placed = stored(per.select("class", "copies", "vector").mapInPandas(
        place, f"class bigint, copies bigint, vector {vector}, cell bigint, far double"), "cells")
    stats = {r["cell"]: (r["n"], r["far"]) for r in placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    parts = {cell: -(-n // block) for cell, (n, _) in stats.items()}
    reach = float(distance(threshold)) + SLACK
    where = {offset[s] + k: (s, c[k]) for s, c in centres.items() for k in range(len(c))}

    def may_link(x, y):
        if x == y:
            return True
        if x not in where or y not in where or where[x][0] != where[y][0]:
            return False
        return distance(where[x][1] @ where[y][1]) <= stats[x][1] + stats[y][1] + reach

    # the upper level's pairs of cells: at most CELLS squared
    beside = [(int(x), int(parts[x]), [(int(y), int(parts[y])) for y in stats if may_link(x, y)]) for x in stats]
    beside = spark.createDataFrame(beside or [(-1, 1, [])], "cell bigint, parts bigint, beside array<struct<cell:bigint,parts:bigint>>")
    rows = placed.join(F.broadcast(beside), "cell").withColumn(
        "part", F.pmod(F.xxhash64("class", F.lit("part")), F.col("parts")))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("class", ignore_index=True)
        path = nest(unit(group["vector"].to_numpy()))
        return group.assign(pos=np.arange(len(group)), path=list(path))

    kept = "cell bigint, part bigint, class bigint, copies bigint, vector " + vector + \
        ", beside array<struct<cell:bigint,parts:bigint>>"
    trees = stored(rows.select("cell", "part", "class", "copies", "vector").groupBy("cell", "part").applyInPandas(
        grow, kept.split(", beside")[0] + ", pos bigint, path array<bigint>"), "trees")
    mine = F.struct("cell", "part")
    other = trees.join(F.broadcast(beside.drop("parts")), "cell").withColumn("next", F.explode("beside")) \
        .withColumn("other_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("next.parts") - 1)))
    theirs = F.struct(F.col("next.cell").alias("cell"), F.col("other_part").alias("part"))
    return other.select(F.least(mine, theirs).alias("a"), F.greatest(mine, theirs).alias("b"),
                        F.when(mine <= theirs, 0).otherwise(1).alias("side"), "pos", "class", "copies", "vector", "path") \
        .withColumns({"a": F.concat_ws("-", "a.cell", "a.part"), "b": F.concat_ws("-", "b.cell", "b.part")})


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, cells: int = CELLS,
                    sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row."""
    rows, per = classes(embeddings)
    links = stored(_blocks(per, threshold, block, cells, sample).groupBy("a", "b").applyInPandas(
        _compare(threshold), "class bigint, n bigint, root bigint"), "links")
    parts = connected_components(links.select(F.col("class").alias("a"), F.col("root").alias("b")))
    count = links.groupBy("class").agg(F.sum("n").alias("n"))
    known = per.join(count, "class", "left").join(parts, F.col("class") == F.col("node"), "left").select(
        "class", "low", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "class").alias("component"))
    known = stored(known, "class-links")
    lowest = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = known.join(lowest, "component").select("class", "n_links", "component_id")
    return rows.join(known, "class", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")) \
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def pairs(embeddings: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, cells: int = CELLS,
          sample: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """Membership (vec_id, class) of all rows, and all links (a, b, cosine)
    between different classes."""
    rows, per = classes(embeddings)
    return rows, _blocks(per, threshold, block, cells, sample).groupBy("a", "b").applyInPandas(
        _all_pairs(threshold), "a bigint, b bigint, cosine double")


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS k, vec_id,
         CASE WHEN embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                   AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS e
  FROM embeddings),
l AS (SELECT a.k AS a, b.k AS b FROM v a JOIN v b ON a.k <> b.k AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
c(k, root) AS (SELECT k, k FROM v UNION SELECT l.b, c.root FROM c JOIN l ON l.a = c.k),
m AS (SELECT c.k, min(r.vec_id) AS component_id FROM c JOIN v r ON r.k = c.root GROUP BY c.k),
n AS (SELECT a AS k, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v JOIN m ON m.k = v.k LEFT JOIN n ON n.k = v.k
"""
