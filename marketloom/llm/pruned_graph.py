"""Near-duplicate vectors by a robust-pruned flat graph over overlapping cluster shards.

Only vectors of one label and one width are compared, by cosine in double precision. Equal vectors are
one node with a number of copies.

* Shards. All vectors of a label are one shard at first. A shard above ``SHARD_ROWS`` is
  split by pivots, far from each other, from a sample of about ``SAMPLE`` of its rows: each vector
  goes to its ``OVERLAP`` nearest pivots, the second only where a link can lead there. This
  repeats until shards are small. A dense group of near copies has one pivot and stays together.
* Graph. In each shard, by blocks of at most ``SHARD_ROWS``, a node's candidates are its nearest
  nodes; robust pruning keeps the nearest one and drops those that it stands for (``ALPHA``
  times as close to it as to the node). Links are kept both ways, with a few random ones, so that
  dense groups stay reachable. The adjacency lists of a node in all its shards are united.
* Search. Every vector is searched in the blocks of its shards: a greedy search with a beam from
  the medoids, over the united lists; from what lies within ``EXPANDED`` it goes on to all nodes
  within that range. Similarities of links are computed in double precision.
* Across shards. Two close links in a row, of which the ends share no shard, are verified too,
  until a round finds nothing new.
* Audit. A sample of ``AUDITED`` nodes is compared with all vectors; where less than ``RECALL``
  of their links was found, all is done again with twice the overlap, candidates and beam.

A task sees two blocks at most and returns numbers of links and a forest, no pairs, so a dense
group costs comparisons, not rows. A link found in several shards counts in the least of them.

Cases: a null vec_id or label, a null, empty or zero vector, and one with null or non-finite
components link with nothing and are kept; vectors of other widths are not compared; rows that
repeat an id or a vector are rows of their own; very large and small components are scaled first;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import flat_lists, written
from marketloom.llm.graph import components

SIMILARITY, EXPANDED, RECALL = 0.98, 0.95, 0.95
SHARD_ROWS, SAMPLE, PIVOTS, OVERLAP, LEVELS = 4_000, 2_048, 256, 2, 6
# Pivots are at least this far from each other, several times the distance of a link.
APART = 0.8
CANDIDATES, DEGREE, RANDOM_LINKS, ALPHA = 40, 16, 4, 1.2
MEDOIDS, BEAM, EXPANSIONS, SEARCHED = 32, 48, 4, 256
AUDITED, EFFORTS = 1_024, (1, 2, 4, 8, 16)
GROUP = ["label", "width", "shard"]
# Fills lists of shards, above all others.
NO_SHARD = np.iinfo(np.int64).max


def unit_rows(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors of one width as rows of length 1."""
    _, values = flat_lists(column)
    v = values.reshape(-1, width)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def usable(embedding: Column) -> Column:
    """The vector as doubles; null for one that links with nothing."""
    finite = F.forall(
        embedding,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)),
    )
    takes_part = finite & F.exists(embedding, lambda x: x != 0)
    return F.when(takes_part, F.transform(embedding, lambda x: x.cast("double")))


def spread_pivots(rows: np.ndarray, count: int, apart: float) -> np.ndarray:
    """Rows far from each other: each next one is the farthest, as long as it is ``apart``.

    The first one lies where rows are densest, so that a dense group has a pivot of its own.
    """
    chosen, nearest = [int((rows @ rows.sum(axis=0)).argmax())], np.full(len(rows), np.inf)
    while len(chosen) < count:
        nearest = np.minimum(nearest, np.sqrt(np.maximum(2 - 2 * rows @ rows[chosen[-1]], 0)))
        if nearest.max() < apart:
            break
        chosen.append(int(nearest.argmax()))
    return rows[chosen]


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


# Shards


def _pivots(table: pa.Table, shard_rows: int, overlap: int) -> pa.Table:
    """Pivots of a shard, as many as bring its parts to half the limit; none if there is one."""
    width = table["width"][0].as_py()
    wanted = min(PIVOTS, 2 * overlap * (table["rows"][0].as_py() // shard_rows + 1))
    pivots = spread_pivots(unit_rows(table["v"], width), wanted, APART)
    found = len(pivots) > 1
    return pa.table(
        {
            "shard": table["shard"][: int(found)],
            "pivots": pa.array([pivots.tobytes()] if found else [], pa.binary()),
        }
    )


def nearest_pivots(rows: np.ndarray, pivots: np.ndarray, overlap: int, reach: float) -> list[np.ndarray]:
    """The nearest pivots of each row, up to ``overlap``, as far as a link can lead to them.

    What lies within ``reach`` of a row has another nearest pivot only if the plane between the
    two pivots does too.
    """
    square = np.maximum(2 - 2 * rows @ pivots.T, 0)
    best = np.argsort(square, axis=1, kind="stable")[:, :overlap]
    close = np.take_along_axis(square, best, 1)
    between = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))[best[:, :1], best]
    kept = close - close[:, :1] <= 2 * reach * between + 1e-9
    return [b[k] for b, k in zip(best, kept, strict=True)]


def _assigned(
    batches: Iterable[pa.RecordBatch], overlap: int, reach: float
) -> Iterator[pa.RecordBatch]:
    """Rows of a shard behind its pivots: each with the numbers of its nearest pivots."""
    pivots = None
    for batch in batches:
        heads = np.flatnonzero(batch["pivots"].is_valid().to_numpy(zero_copy_only=False)).tolist()
        bounds = sorted({0, *heads, batch.num_rows})
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            if start in heads:
                width = batch["width"][start].as_py()
                pivots = np.frombuffer(batch["pivots"][start].as_py()).reshape(-1, width)
                start += 1
            if start == end:
                continue
            rows = batch.slice(start, end - start)
            near = nearest_pivots(unit_rows(rows["v"], pivots.shape[1]), pivots, overlap, reach)
            yield pa.RecordBatch.from_arrays(
                [rows["node"], rows["shard"], _lists(near, pa.int32())], ["node", "shard", "near"]
            )


def _parted(
    inside: DataFrame, heavy: DataFrame, shard_rows: int, overlap: int, reach: float
) -> DataFrame:
    """(node, shard, parts): rows of heavy shards and the shards that pivots put them in."""
    rows = inside.join(heavy, "shard")
    # Above the size of the sample, ids decide who is in it, so no group is larger.
    share = F.lit(2.0**31) * SAMPLE / F.col("rows")
    sample = rows.filter(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 31)) < share)
    pivots = (
        sample.select("shard", "width", "v", "rows")
        .groupBy("shard")
        .applyInArrow(lambda t: _pivots(t, shard_rows, overlap), "shard long, pivots binary")
    )
    pivots = written(pivots, "shard-pivots")
    # A hot shard is dealt to many tasks, each of which meets the pivots before its rows.
    salts = F.ceil(F.col("rows") / (4 * shard_rows)).cast("int")
    heads = pivots.join(heavy, "shard").select(
        "shard", "pivots", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")
    )
    widths = inside.groupBy("shard").agg(F.min("width").alias("width"))
    dealt = rows.join(pivots.select("shard"), "shard", "left_semi").select(
        "node", "width", "v", "shard", F.pmod(F.xxhash64("node"), salts).cast("int").alias("salt")
    )
    both = dealt.unionByName(heads.join(widths, "shard"), allowMissingColumns=True)
    streamed = both.repartition("shard", "salt").sortWithinPartitions(
        "shard", "salt", F.col("pivots").isNull()
    )
    moved = streamed.select("node", "width", "v", "shard", "pivots").mapInArrow(
        lambda b: _assigned(b, overlap, reach), "node long, shard long, near array<int>"
    )
    parts = F.transform("near", lambda p: F.xxhash64("shard", p))
    return moved.select("node", "shard", parts.alias("parts"))


def sharded(
    nodes: DataFrame,
    shard_rows: int = SHARD_ROWS,
    overlap: int = OVERLAP,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(node, shard): nodes in overlapping shards of similar vectors."""
    # The distance of two vectors of the least similarity.
    reach = (2 - 2 * similarity) ** 0.5
    cells = nodes.select("node", F.xxhash64("label", "width").alias("shard"))
    vectors = nodes.select("node", "width", "v")
    done = None
    for _ in range(LEVELS):
        heavy = cells.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
        heavy = written(heavy.filter(F.col("rows") > shard_rows), "heavy-shards")
        light = cells.join(heavy, "shard", "left_anti")
        done = light if done is None else done.unionByName(light)
        if heavy.isEmpty():
            return done
        inside = cells.join(heavy.select("shard"), "shard", "left_semi")
        parted = _parted(inside.join(vectors, "node"), heavy, shard_rows, overlap, reach)
        parted = written(parted, "parted-shards")
        # What no pivots part stays one shard, which is searched by blocks.
        whole = inside.join(parted.select("shard").distinct(), "shard", "left_anti")
        done = done.unionByName(whole)
        cells = parted.select("node", F.explode("parts").alias("shard")).distinct()
    return done.unionByName(cells)


# Graph


def robust_pruned(
    own: np.ndarray, others: np.ndarray, degree: int, alpha: float
) -> tuple[np.ndarray, np.ndarray]:
    """Which candidates each row keeps.

    ``own`` holds the distances of rows to their candidates, nearest first, ``others`` those among
    the candidates of a row. The nearest one left is kept, and drops those alpha times as close
    to it as to the row.
    """
    left = np.isfinite(own)
    kept = np.zeros_like(left)
    rows = np.arange(len(own))
    for _ in range(degree):
        open_ = left.any(axis=1)
        if not open_.any():
            break
        at = left.argmax(axis=1)
        kept[rows[open_], at[open_]] = True
        left &= alpha * others[rows, at] > own
        left[rows, at] = False
    return kept


def build(v: np.ndarray, candidates: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Adjacency lists of a flat graph over unit vectors."""
    n = len(v)
    count = min(candidates, n - 1)
    links = [np.empty((0, 2), np.int64)]
    for start in range(0, n if count > 0 else 0, 256):
        rows = np.arange(start, min(start + 256, n))
        near = v[rows] @ v.T
        near[np.arange(len(rows)), rows] = -np.inf
        best = np.argpartition(-near, count - 1, axis=1)[:, :count]
        close = np.take_along_axis(near, best, 1)
        order = np.argsort(-close, axis=1, kind="stable")
        best, close = np.take_along_axis(best, order, 1), np.take_along_axis(close, order, 1)
        among = v[best] @ v[best].transpose(0, 2, 1)
        own = np.sqrt(np.maximum(2 - 2 * close, 0))
        kept = robust_pruned(own, np.sqrt(np.maximum(2 - 2 * among, 0)), DEGREE, ALPHA)
        i, j = np.nonzero(kept)
        links.append(np.stack([rows[i], best[i, j]], axis=1))
        if n > DEGREE:
            far = rng.integers(0, n, (len(rows), RANDOM_LINKS))
            links.append(np.stack([np.repeat(rows, RANDOM_LINKS), far.ravel()], axis=1))
    both = np.concatenate(links)
    both = both[both[:, 0] != both[:, 1]]
    # Links back let a node be reached; each node keeps its own and its nearest ones back.
    own = np.unique(both, axis=0)
    back = np.unique(both[:, ::-1], axis=0)
    closeness = (v[back[:, 0]] * v[back[:, 1]]).sum(axis=1)
    back = back[np.lexsort([-closeness, back[:, 0]])]
    rank = np.arange(len(back)) - np.searchsorted(back[:, 0], back[:, 0])
    every = np.unique(np.concatenate([own, back[rank < 2 * DEGREE]]), axis=0)
    return np.split(every[:, 1], np.searchsorted(every[:, 0], np.arange(1, n)))


def _built(table: pa.Table, candidates: int) -> pa.Table:
    """Adjacency of one block of a shard: near nodes, and those within the expanded range."""
    nodes, width = table["node"].to_numpy(), table["width"][0].as_py()
    order = np.argsort(nodes)
    nodes, v = nodes[order], unit_rows(table["v"], width)[order]
    adjacent = build(v, candidates, np.random.default_rng(len(nodes)))
    close = [a[v[a] @ v[i] >= EXPANDED] for i, a in enumerate(adjacent)]
    return pa.table(
        {
            "node": pa.array(nodes),
            "near": _lists([nodes[a] for a in adjacent], pa.int64()),
            "close": _lists([nodes[a] for a in close], pa.int64()),
        }
    )


# Search


def search(
    queries: np.ndarray, v: np.ndarray, links: np.ndarray, medoids: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs within the expanded range, by greedy search and its expansion.

    ``links`` is the adjacency as a matrix, filled with -1.
    """
    count, n = len(queries), len(v)
    seen = np.zeros((count, n + 1), bool)
    seen[:, n] = True
    seen[:, medoids] = True
    near = queries @ v[medoids].T
    ids = np.tile(medoids, (count, 1))
    spread = np.zeros(ids.shape, bool)
    rows = np.arange(count)[:, None]
    within = []
    while True:
        keep = np.argsort(-near, axis=1, kind="stable")[:, :beam]
        ids, near, spread = (np.take_along_axis(x, keep, 1) for x in (ids, near, spread))
        # The best nodes of the beam that were not expanded yet.
        order = np.where(spread, -np.inf, near)
        at = np.argsort(-order, axis=1, kind="stable")[:, :EXPANSIONS]
        fresh = np.take_along_axis(order, at, 1) > -np.inf
        if not fresh.any():
            break
        np.put_along_axis(spread, at, True, 1)
        reached = links[np.take_along_axis(ids, at, 1)]
        reached = np.where(fresh[:, :, None], reached, -1).reshape(count, -1)
        reached = np.sort(np.where(reached < 0, n, reached), axis=1)
        new = ~seen[rows, reached]
        new[:, 1:] &= reached[:, 1:] != reached[:, :-1]
        seen[rows, reached] = True
        i, j = np.nonzero(new)
        found = np.full(reached.shape, -np.inf)
        found[i, j] = (queries[i] * v[reached[i, j]]).sum(axis=1)
        most = max(int(new.sum(axis=1).max(initial=0)), 1)
        best = np.argsort(-found, axis=1, kind="stable")[:, :most]
        ids = np.hstack([ids, np.take_along_axis(np.where(new, reached, 0), best, 1)])
        near = np.hstack([near, np.take_along_axis(found, best, 1)])
        spread = np.hstack([spread, ~np.take_along_axis(new, best, 1)])
    inside = near >= EXPANDED
    i, j = rows.repeat(ids.shape[1], 1)[inside], ids[inside]
    within.append((i, j))
    held = np.zeros((count, n), bool)
    held[i, j] = True
    while len(i):
        wanted = np.zeros((count, n + 1), bool)
        for part in range(0, len(i), 1 << 16):
            cut = slice(part, part + (1 << 16))
            wanted[np.repeat(i[cut], links.shape[1]), links[j[cut]].ravel()] = True
        i, j = np.nonzero(wanted[:, :n] & ~held)
        held[i, j] = True
        closeness = np.concatenate(
            [
                (queries[i[p : p + 65536]] * v[j[p : p + 65536]]).sum(axis=1)
                for p in range(0, len(i), 65536)
            ]
            or [np.empty(0)]
        )
        i, j = i[closeness >= EXPANDED], j[closeness >= EXPANDED]
        within.append((i, j))
    return tuple(np.concatenate(x) for x in zip(*within, strict=True))


def first_shared(ours: np.ndarray, theirs: np.ndarray, shard: int) -> np.ndarray:
    """Whether ``shard`` is the least one in both lists of each row; lists are filled with -1."""
    first = np.ones(len(ours), bool)
    for column in ours.T:
        shared = (theirs == column[:, None]).any(axis=1) & (column != NO_SHARD)
        first &= ~(shared & (column < shard))
    return first


def forest(linked: np.ndarray) -> list[tuple[int, int, bool]]:
    """(place, root, is a column) of the components of a matrix of links from rows to columns."""
    out, turned = [], np.ascontiguousarray(linked.T)
    seen_rows, seen_columns = ~linked.any(axis=1), np.zeros(linked.shape[1], bool)
    for root in np.flatnonzero(~seen_rows).tolist():
        if seen_rows[root]:
            continue
        rows = np.array([root])
        while len(rows):
            seen_rows[rows] = True
            out += [(r, root, False) for r in rows.tolist()]
            columns = np.flatnonzero(linked[rows].any(axis=0) & ~seen_columns)
            seen_columns[columns] = True
            out += [(c, root, True) for c in columns.tolist()]
            rows = np.flatnonzero(turned[columns].any(axis=0) & ~seen_rows)
    return out


def _padded(lists: pa.ChunkedArray, fill: int) -> np.ndarray:
    offsets, values = flat_lists(lists)
    sizes = np.diff(offsets)
    out = np.full((len(sizes), max(int(sizes.max(initial=0)), 1)), fill, np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1], sizes)] = values
    return out


def _searched(table: pa.Table, beam: int, similarity: float) -> pa.Table:
    """Numbers of links between two blocks of a shard (or within one), and a forest of them."""
    table = table.sort_by("node")
    shard, width = table["shard"][0].as_py(), table["width"][0].as_py()
    nodes, copies = table["node"].to_numpy(), table["copies"].to_numpy()
    v, shards = unit_rows(table["v"], width), _padded(table["shards"], NO_SHARD)
    visits = table["visits"].to_numpy(zero_copy_only=False)
    members, visitors = np.flatnonzero(visits != 1), np.flatnonzero(visits != 0)
    counted = np.zeros(len(nodes), np.int64)
    edges: list[tuple[int, int]] = []
    if len(members) and len(visitors):
        ours = nodes[members]
        near = _padded(table["near"], -1)[members]
        place = np.minimum(np.searchsorted(ours, near), len(ours) - 1)
        links = np.where(ours[place] == near, place, -1)
        rng = np.random.default_rng(len(ours))
        medoids = np.sort(rng.choice(len(ours), min(MEDOIDS, len(ours)), replace=False))
        linked = np.zeros((len(visitors), len(members)), bool)
        for start in range(0, len(visitors), SEARCHED):
            asked = visitors[start : start + SEARCHED]
            i, j = search(v[asked], v[members], links, medoids, beam)
            exact = (v[asked[i]] * v[members[j]]).sum(axis=1) >= similarity
            linked[start + i[exact], j[exact]] = True
        if len(members) == len(visitors) == len(nodes):
            np.fill_diagonal(linked, False)
            linked |= linked.T.copy()
        for at, root, column in forest(linked):
            node, top = int(nodes[(members if column else visitors)[at]]), int(nodes[visitors[root]])
            if node != top:
                edges.append((node, top))
        for start in range(0, len(visitors), SEARCHED):
            i, j = np.nonzero(linked[start : start + SEARCHED])
            i, j = visitors[i + start], members[j]
            first = first_shared(shards[i], shards[j], shard)
            i, j = i[first], j[first]
            np.add.at(counted, i, copies[j])
            if len(members) < len(nodes):
                np.add.at(counted, j, copies[i])
    held = np.flatnonzero(counted)
    a, b = zip(*edges, strict=True) if edges else ((), ())
    none = [None] * len(a)
    return pa.table(
        {
            "node": pa.array([*nodes[held].tolist(), *a], pa.int64()),
            "links": pa.array([*counted[held].tolist(), *none], pa.int64()),
            "root": pa.array([*[None] * len(held), *b], pa.int64()),
        }
    )


FOUND = "node long, links long, root long"


def _linked(nodes: DataFrame, shard_rows: int, effort: int, similarity: float) -> DataFrame:
    """(node, links, root): parts of the numbers of links, and links of a forest."""
    cells = written(sharded(nodes, shard_rows, OVERLAP * effort, similarity), "graph-cells")
    blocks = cells.groupBy("shard").agg(
        F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("blocks")
    )
    dealt = cells.join(blocks, "shard").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    dealt = written(dealt, "graph-blocks")
    vectors = nodes.select("node", "label", "width", "v", "copies")
    lists = (
        dealt.join(vectors, "node")
        .select(*GROUP, "block", "node", "v")
        .groupBy(*GROUP, "block")
        .applyInArrow(
            lambda t: _built(t, CANDIDATES * effort),
            "node long, near array<long>, close array<long>",
        )
    )
    united = lists.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"),
        F.array_distinct(F.flatten(F.collect_list("close"))).alias("close"),
    )
    places = dealt.groupBy("node").agg(F.array_sort(F.collect_set("shard")).alias("shards"))
    graph = written(vectors.join(united, "node").join(places, "node"), "graph")
    # Block k meets every block: as members those after it, as visitors those before it.
    each = dealt.join(graph.drop("close"), "node").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    pairs = each.withColumns(
        {
            "a": F.least("block", "other"),
            "b": F.greatest("block", "other"),
            "visits": F.when(F.col("other") < F.col("block"), 1)
            .when(F.col("other") > F.col("block"), 0)
            .otherwise(2),
        }
    )
    found = (
        pairs.select(*GROUP, "a", "b", "node", "v", "copies", "near", "shards", "visits")
        .groupBy(*GROUP, "a", "b")
        .applyInArrow(lambda t: _searched(t, BEAM * effort, similarity), FOUND)
    )
    return written(found, "graph-found").unionByName(_across(graph, similarity))


def _verified(batches: Iterable[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        widths = batch["width"].to_numpy()
        for width in np.unique(widths).tolist():
            rows = batch.filter(pa.array(widths == width))
            near = (unit_rows(rows["x"], width) * unit_rows(rows["y"], width)).sum(axis=1)
            kept = rows.filter(pa.array(near >= similarity))
            yield kept.select(["node", "copies", "end", "end_copies"])


def _across(graph: DataFrame, similarity: float) -> DataFrame:
    """Links between nodes that share no shard, by way of a node that is close to both."""
    close = graph.select("node", "shards", F.explode("close").alias("middle"))
    middles = graph.filter(F.size("shards") > 1).select(
        F.col("node").alias("middle"), F.col("close").alias("ends"), F.col("shards").alias("between")
    )
    # An end that shares no shard with the node shares one of the middle's others.
    further = F.size(F.array_except("between", "shards")) > 0
    ends = close.join(middles, "middle").filter(further)
    ends = ends.select("node", F.explode("ends").alias("end")).filter("node < end").distinct()
    here = graph.select("node", "width", "shards", F.col("v").alias("x"), "copies")
    there = graph.select(
        F.col("node").alias("end"),
        F.col("shards").alias("end_shards"),
        F.col("v").alias("y"),
        F.col("copies").alias("end_copies"),
    )
    apart = ends.join(here, "node").join(there, "end")
    apart = apart.filter(~F.arrays_overlap("shards", "end_shards"))
    near = apart.select("node", "copies", "end", "end_copies", "width", "x", "y").mapInArrow(
        lambda b: _verified(b, similarity), "node long, copies long, end long, end_copies long"
    )
    near = written(near, "graph-across")
    one = near.select("node", F.col("end_copies").alias("links"), F.col("end").alias("root"))
    two = near.select(
        F.col("end").alias("node"),
        F.col("copies").alias("links"),
        F.lit(None).cast("long").alias("root"),
    )
    return one.unionByName(two)


# Audit and result


def _true_links(
    batches: Iterable[pa.RecordBatch], sample: list, similarity: float
) -> Iterator[pa.RecordBatch]:
    """(node, links): what a batch adds to the sampled nodes' true numbers of links."""
    groups: dict[tuple, list] = {}
    for row in sample:
        groups.setdefault((row.label, row.width), []).append(row)
    asked = {
        key: (
            np.array([r.node for r in rows]),
            unit_rows(_lists([np.array(r.v) for r in rows], pa.float64()), key[1]),
        )
        for key, rows in groups.items()
    }
    for batch in batches:
        keys = list(zip(batch["label"].to_pylist(), batch["width"].to_pylist(), strict=True))
        for key in set(keys) & set(asked):
            rows = batch.filter(pa.array([k == key for k in keys]))
            nodes, queries = asked[key]
            near = queries @ unit_rows(rows["v"], key[1]).T >= similarity
            near &= nodes[:, None] != rows["node"].to_numpy()[None, :]
            links = near @ rows["copies"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(links, pa.int64())], ["node", "links"]
            )


def recall(nodes: DataFrame, found: DataFrame, similarity: float = SIMILARITY) -> float:
    """The share of the links of a sample of nodes that ``found`` has; 1 if they have none."""
    columns = ["node", "label", "width", "v"]
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(AUDITED).select(*columns).collect()
    true = nodes.select(*columns, "copies").mapInArrow(
        lambda b: _true_links(b, sample, similarity), "node long, links long"
    )
    asked = nodes.sparkSession.createDataFrame([(r.node,) for r in sample], "node long")
    known = true.agg(F.sum("links")).first()[0] or 0
    ours = found.join(asked, "node", "left_semi").agg(F.sum("links")).first()[0] or 0
    return ours / known if known else 1.0


def links(
    nodes: DataFrame, similarity: float = SIMILARITY, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(node, links, root): parts of the numbers of links, and links of a forest, audited.

    ``nodes`` has (node, label, width, v, copies). Raises an error where all efforts find less
    than ``RECALL`` of the sampled links.
    """
    for effort in EFFORTS:
        found = written(_linked(nodes, shard_rows, effort, similarity), "graph-links")
        share = recall(nodes, found, similarity)
        if share >= RECALL:
            return found
    raise ValueError(f"The search found {share:.3f} of the sampled links, less than {RECALL}.")


def near_duplicates(
    vectors: DataFrame, similarity: float = SIMILARITY, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, label, embedding)."""
    identified = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        "label",
        F.when(identified, usable(F.col("embedding"))).alias("v"),
    )
    nodes = (
        rows.filter("v IS NOT NULL")
        .groupBy("label", "v")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
        .withColumns({"width": F.size("v"), "node": F.monotonically_increasing_id()})
    )
    nodes = written(nodes, "graph-nodes")
    found = links(nodes.drop("least"), similarity, shard_rows)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = found.filter("root IS NOT NULL")
    joined = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.select("node", "label", "v", "copies", "least").join(joined, "node", "left")
    named = written(named.join(counts, "node", "left"), "graph-named")
    least = named.groupBy("component").agg(F.min("least").alias("component_least"))
    known = named.join(least.filter("component IS NOT NULL"), "component", "left").select(
        "label",
        "v",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_least", "least").alias("component_id"),
    )
    own = F.coalesce("component_id", "vec_id")
    return rows.join(known, ["label", "v"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"),
    )
