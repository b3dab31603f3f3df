"""Near duplicates among embeddings: navigable small-world graphs per shard of a label.

Equal vectors of a label are one point. The points of a label are dealt into shards of bounded
size, each with a hierarchical navigable small-world graph. Every point searches every shard of
its label with a beam; a beam that ends among matches is widened for that point. How wide beams
start is decided for each label by an audit: some of its points are compared with all others of
the label by scans, and the narrowest beam that finds enough of all their links is taken. A beam
that would hold a quarter of the shard is a scan.

Two shards that search each other share a task, so a link that either search finds counts for both
ends. Cosines of what is found are computed in double precision, links are counted where they are
found, and only edges that hold components together leave the task.

Defined results: see ``embedding_duplicates``; an empty table gives an empty result, and other
columns are ignored whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.components import components
from casemill.llm.shared import WORD_BASE, mix, ship
from casemill.session import staged

THRESHOLD = 0.93
SHARD_POINTS = 4_096
NEIGHBOURS = 16
BUILD_BEAM = 48
#: Beams that the audit tries, narrowest first.
BEAMS = (32, 128, 512, 2048)
#: Points searched together, and beam entries expanded in one step.
TOGETHER = 256
EXPANDED = 4
#: Points of a label that are audited against all of its shards.
AUDIT_POINTS = 256
TARGET_RECALL = 0.995

_NONE = -1


class Graph:
    """A hierarchical navigable small-world graph over unit vectors, searched in batches."""

    def __init__(self, vectors: np.ndarray, seeds: np.ndarray) -> None:
        self.x = np.ascontiguousarray(vectors, np.float32)
        n = len(self.x)
        draw = (mix(seeds.astype(np.uint64) * WORD_BASE) >> np.uint64(11)) / float(1 << 53)
        level = np.floor(-np.log(np.maximum(draw, 1e-300)) / np.log(NEIGHBOURS)).astype(int)
        self.level = np.minimum(level, 6)
        self.links = [
            np.full((n, NEIGHBOURS * (2 if depth == 0 else 1)), _NONE, np.int32)
            for depth in range(int(self.level.max()) + 1 if n else 0)
        ]
        self.entry = _NONE
        self.top = -1

    def build(self, order: np.ndarray) -> Graph:
        """Insert the points in this order, in batches that grow with the graph."""
        done = 0
        while done < len(order):
            size = max(1, min(TOGETHER, done // 4))
            self._insert(order[done : done + size])
            done += size
        return self

    def _insert(self, batch: np.ndarray) -> None:
        if self.entry != _NONE:
            near = np.full((len(batch), 1), self.entry)
            for depth in range(self.top, -1, -1):
                own = self.level[batch] >= depth
                wide = BUILD_BEAM if own.any() else 1
                found, score = self.search_level(self.x[batch], near, wide, depth)
                if own.any():
                    self._link(batch[own], found[own], score[own], depth)
                near = found[:, : min(8, found.shape[1])]
        else:
            self._link(batch, np.zeros((len(batch), 0), int), np.zeros((len(batch), 0)), 0)
        highest = batch[np.argmax(self.level[batch])]
        if self.level[highest] > self.top:
            self.entry, self.top = int(highest), int(self.level[highest])

    def _link(self, batch, found, score, depth) -> None:
        """Choose neighbours among what the search found and the rest of the batch."""
        if len(batch) > 1:
            inner = self.x[batch] @ self.x[batch].T
            np.fill_diagonal(inner, -np.inf)
            keep = min(NEIGHBOURS, len(batch) - 1)
            best = np.argpartition(-inner, keep - 1, axis=1)[:, :keep]
            found = np.concatenate([found, batch[best]], axis=1)
            score = np.concatenate([score, np.take_along_axis(inner, best, 1)], axis=1)
        if found.shape[1] == 0:
            return
        chosen = self._select(found, score, NEIGHBOURS)
        links = self.links[depth]
        links[batch, :NEIGHBOURS] = chosen
        source = np.repeat(batch, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target != _NONE], target[target != _NONE]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        points, starts, counts = np.unique(target, return_index=True, return_counts=True)
        added = np.full((len(points), int(counts.max())), _NONE)
        row = np.repeat(np.arange(len(points)), counts)
        added[row, np.arange(len(target)) - np.repeat(starts, counts)] = source
        width = links.shape[1]
        both = np.concatenate([links[points], added], axis=1)
        both = _no_repeats(both)
        if both.shape[1] <= width:
            links[points, : both.shape[1]] = both
            return
        over = (both[:, width:] != _NONE).any(axis=1)
        links[points[~over]] = both[~over, :width]
        if over.any():
            p, c = points[over], both[over]
            s = np.einsum("ad,akd->ak", self.x[p], self.x[c])
            s[c == _NONE] = -np.inf
            links[p] = self._select(c, s, width)

    def _select(self, found: np.ndarray, score: np.ndarray, width: int) -> np.ndarray:
        """Up to ``width`` of the found points, those nearer to the point than to a better one
        first; places left over go to the nearest of the others."""
        order = np.argsort(-score, axis=1, kind="stable")
        found = np.take_along_axis(found, order, 1)
        score = np.take_along_axis(score, order, 1).copy()
        score[found == _NONE] = -np.inf
        x = self.x[found]
        between = np.matmul(x, x.transpose(0, 2, 1))
        rows, n = found.shape
        covered = np.full((rows, n), -np.inf, np.float32)
        taken = np.zeros((rows, n), bool)
        count = np.zeros(rows, int)
        for j in range(n):
            take = (covered[:, j] < score[:, j]) & (count < width) & (score[:, j] > -np.inf)
            taken[:, j] = take
            count += take
            covered[take] = np.maximum(covered[take], between[take, j])
        rank = np.where(taken, 0, 1) * n + np.arange(n)
        rank[score == -np.inf] = 3 * n
        best = np.argsort(rank, axis=1, kind="stable")[:, :width]
        out = np.take_along_axis(found, best, 1)
        out[np.take_along_axis(score, best, 1) == -np.inf] = _NONE
        if out.shape[1] < width:
            out = np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=_NONE)
        return out

    def search_level(self, queries, near, beam, depth):
        """The ``beam`` best points of a level that a greedy search reaches, best first."""
        n, rows = len(self.x), len(queries)
        seen = np.zeros((rows, n + 1), bool)
        seen[:, n] = True
        ids = np.full((rows, beam), _NONE)
        score = np.full((rows, beam), -np.inf, np.float32)
        done = np.zeros((rows, beam), bool)
        near = _no_repeats(near)[:, :beam]
        ids[:, : near.shape[1]] = near
        first = np.einsum("ad,akd->ak", queries, self.x[near])
        first[near == _NONE] = -np.inf
        score[:, : near.shape[1]] = first
        seen[np.arange(rows)[:, None], near] = True
        seen[:, n] = True
        active = np.arange(rows)
        expanded = min(EXPANDED, beam)
        while len(active):
            open_score = np.where(done[active], -np.inf, score[active])
            if expanded < beam:
                pick = np.argpartition(-open_score, expanded - 1, axis=1)[:, :expanded]
            else:
                pick = np.broadcast_to(np.arange(beam), (len(active), beam))
            some = np.take_along_axis(open_score, pick, 1) > -np.inf
            alive = some.any(axis=1)
            active, pick, some = active[alive], pick[alive], some[alive]
            if not len(active):
                break
            at = active[:, None]
            nodes = np.where(some, ids[at, pick], _NONE)
            done[at, pick] = True
            fresh = np.where((nodes != _NONE)[:, :, None], self.links[depth][nodes], _NONE)
            fresh = fresh.reshape(len(active), -1)
            fresh = np.where(seen[at, fresh], _NONE, fresh)
            fresh = _no_repeats(fresh)
            seen[at, fresh] = True
            seen[:, n] = True
            s = np.einsum("ad,akd->ak", queries[active], self.x[fresh])
            s[fresh == _NONE] = -np.inf
            all_ids = np.concatenate([ids[active], fresh], axis=1)
            all_score = np.concatenate([score[active], s], axis=1)
            all_done = np.concatenate([done[active], np.zeros(fresh.shape, bool)], axis=1)
            best = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
            ids[active] = np.take_along_axis(all_ids, best, 1)
            score[active] = np.take_along_axis(all_score, best, 1)
            done[active] = np.take_along_axis(all_done, best, 1)
        ids[score == -np.inf] = _NONE
        order = np.argsort(-score, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)

    def search(self, queries: np.ndarray, beam: int):
        near = np.full((len(queries), 1), self.entry)
        for depth in range(self.top, 0, -1):
            near = self.search_level(queries, near, 4, depth)[0][:, :1]
        return self.search_level(queries, near, beam, 0)


def _no_repeats(ids: np.ndarray) -> np.ndarray:
    """Each row's distinct ids in front, the rest filled up with _NONE; needless columns go."""
    ids = -np.sort(-ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = _NONE
    ids = -np.sort(-ids, axis=1)
    used = int((ids != _NONE).sum(axis=1).max()) if ids.size else 0
    return ids[:, : max(1, used)]


def _scan(own, queries, threshold):
    return queries @ own.T >= threshold


def linked_points(
    graph: Graph, own: np.ndarray, queries: np.ndarray, threshold: float, beam: int
) -> list[np.ndarray]:
    """For each query the points of the shard that beams find with at least the threshold.

    ``own`` and ``queries`` are unit vectors in double precision.
    """
    n = len(own)
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
    open_rows = np.arange(len(queries))
    while len(open_rows):
        again = []
        for first in range(0, len(open_rows), TOGETHER):
            rows = open_rows[first : first + TOGETHER]
            if 4 * beam >= n:
                hits = _scan(own, queries[rows], threshold)
                for r, hit in zip(rows, hits, strict=True):
                    found[r] = np.flatnonzero(hit)
                continue
            ids, score = graph.search(queries[rows].astype(np.float32), beam)
            cosine = np.einsum("ad,akd->ak", queries[rows], own[ids])
            hits = (cosine >= threshold) & (ids != _NONE)
            # A beam whose last entries still match may have left others out.
            short = (score[:, -1] >= threshold - 0.02) & (ids[:, -1] != _NONE)
            for r, i, hit in zip(rows[~short], ids[~short], hits[~short], strict=True):
                found[r] = np.sort(i[hit])
            again.append(rows[short])
        open_rows = np.concatenate(again) if again else np.zeros(0, int)
        beam *= 4
    return found


def _unit(table: pa.Table) -> np.ndarray:
    flat = table["embedding"].combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _build(table: pa.Table) -> pa.Table:
    """The graph of one shard as a row of byte strings."""
    table = table.sort_by("point")
    x = _unit(table)
    ids = table["point"].to_numpy()
    graph = Graph(x, ids)
    graph.build(np.argsort(mix(ids.astype(np.uint64) + np.uint64(99))))
    links = b"".join(level.tobytes() for level in graph.links)
    row = {
        "label": table["label"][0].as_py(),
        "width": table["width"][0].as_py(),
        "shard": table["shard"][0].as_py(),
        "points": ids.tobytes(),
        "copies": table["copies"].to_numpy().tobytes(),
        "vectors": x.tobytes(),
        "levels": len(graph.links),
        "links": links,
        "entry": graph.entry,
        "top": graph.top,
    }
    return pa.Table.from_pylist([row], schema=_GRAPH_ARROW)


_GRAPH_ARROW = pa.schema(
    [
        ("label", pa.int64()),
        ("width", pa.int64()),
        ("shard", pa.int64()),
        ("points", pa.binary()),
        ("copies", pa.binary()),
        ("vectors", pa.binary()),
        ("levels", pa.int64()),
        ("links", pa.binary()),
        ("entry", pa.int64()),
        ("top", pa.int64()),
    ]
)
GRAPH_SCHEMA = (
    "label long, width long, shard long, points binary, copies binary, vectors binary, "
    "levels long, links binary, entry long, top long"
)
FOUND_SCHEMA = "a long, b long, links long"


def _load(row: dict) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["points"], np.int64)
    x = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)
    graph = Graph.__new__(Graph)
    graph.x = x.astype(np.float32)
    graph.entry, graph.top = row["entry"], row["top"]
    raw, at = np.frombuffer(row["links"], np.int32), 0
    graph.links = []
    for depth in range(row["levels"]):
        width = NEIGHBOURS * (2 if depth == 0 else 1)
        graph.links.append(raw[at : at + len(ids) * width].reshape(len(ids), width))
        at += len(ids) * width
    return graph, ids, np.frombuffer(row["copies"], np.int64), x


AUDIT_SCHEMA = "label long, width long, beam int, caught long, total long"


def _audit(threshold: float):
    def run(probes: pa.Table, graphs: pa.Table) -> pa.Table:
        """What each beam finds of the audited points' links into one shard, and all of them."""
        rows = []
        if len(probes) and len(graphs):
            row = graphs.to_pylist()[0]
            graph, ids, _, own = _load(row)
            queries, numbers = _unit(probes), probes["point"].to_numpy()
            others = ids[None, :] != numbers[:, None]
            total = int((_scan(own, queries, threshold) & others).sum())
            caught = -1
            for beam in BEAMS:
                if caught < total:  # else a wider beam finds them all as well
                    found = linked_points(graph, own, queries, threshold, beam)
                    caught = sum(int(others[q, hits].sum()) for q, hits in enumerate(found))
                rows.append((row["label"], row["width"], beam, caught, total))
        names = [f.split()[0] for f in AUDIT_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.table(
            {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)}
        )

    return run


def audited_beams(points: DataFrame, graphs: DataFrame, threshold: float) -> DataFrame:
    """label, width and beam: the narrowest beam that finds ``TARGET_RECALL`` of the links of the
    label's audited points, over all of its shards. Audited are the smallest hashes of the points.
    """
    order = Window.partitionBy("label", "width").orderBy(F.xxhash64(F.lit(5), "point"), "point")
    chosen = (
        points.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= AUDIT_POINTS)
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
        .select("label", "width", "shard", "point", "embedding")
    )
    key = ["label", "width", "shard"]
    counts = (
        chosen.groupBy(key)
        .cogroup(graphs.groupBy(key))
        .applyInArrow(_audit(threshold), AUDIT_SCHEMA)
        .groupBy("label", "width", "beam")
        .agg(F.sum("caught").alias("caught"), F.sum("total").alias("total"))
    )
    enough = F.col("caught") >= F.lit(TARGET_RECALL) * F.col("total")
    return counts.groupBy("label", "width").agg(
        F.coalesce(F.min(F.when(enough, F.col("beam"))), F.max("beam")).alias("beam")
    )


def _search_pair(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        """Links between two shards, or within one, and edges that span what they link."""
        shards = sorted(rows.to_pylist(), key=lambda r: r["shard"])
        (left, a_ids, a_copies, a), (right, b_ids, b_copies, b) = _load(shards[0]), _load(shards[-1])
        beam, alone = shards[0]["beam"], len(shards) == 1
        linked = np.zeros((len(a), len(b)), bool)
        for q, hits in enumerate(linked_points(right, b, a, threshold, beam)):
            linked[q, hits] = True
        if alone:
            linked |= linked.T
            np.fill_diagonal(linked, False)
        else:
            for q, hits in enumerate(linked_points(left, a, b, threshold, beam)):
                linked[hits, q] = True
        counts = [(a_ids, linked @ b_copies)]
        if not alone:
            counts.append((b_ids, linked.T @ a_copies))
        links = np.concatenate([n for _, n in counts])
        points = np.concatenate([i for i, _ in counts])
        # Each row hangs on the first of its links, and what later rows share is joined through it.
        root = np.arange(len(b))
        anchor = np.full(len(a), _NONE)
        for q in np.flatnonzero(linked.any(1)):
            hits = np.flatnonzero(linked[q])
            roots = root[hits]
            least = roots.min()
            if (roots != least).any():
                root[np.isin(root, roots)] = least
            anchor[q] = hits[0]
        some, member = links > 0, np.flatnonzero(root != np.arange(len(b)))
        hung = np.flatnonzero(anchor != _NONE)
        out_a = np.concatenate([points[some], a_ids[hung], b_ids[member]])
        out_b = np.concatenate(
            [np.zeros(int(some.sum()), np.int64), b_ids[anchor[hung]], b_ids[root[member]]]
        )
        n = np.concatenate([links[some], np.zeros(len(hung) + len(member), np.int64)])
        return pa.table(
            {"a": pa.array(out_a), "b": pa.array(out_b, mask=n > 0), "links": pa.array(n)}
        )

    return run


def embedding_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links between the rows of ``vectors`` (vec_id, embedding, label) of equal label.

    Returns a row per input row: vec_id, n_links (other vectors linked directly), component_id
    (smallest vec_id reachable, itself included) and kept (vec_id = component_id). A null label
    or vec_id, and a vector that is null, empty, zero or holds null or non-finite components,
    links with nothing; so do vectors of different lengths. Rows that repeat a vector are linked
    with each other and count each; rows that repeat a vec_id with other vectors are vectors of their
    own.
    """
    ship(vectors.sparkSession)
    number = F.col("vec_id").cast("long")
    values = F.col("embedding").cast("array<double>")
    sound = ~F.exists(
        values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    ) & F.exists(values, lambda v: v != 0)
    rows = vectors.select(
        number.alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        values.alias("embedding"),
        F.coalesce(
            F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound, F.lit(False)
        ).alias("usable"),
        F.coalesce(F.size(values), F.lit(0)).cast("long").alias("width"),
        F.xxhash64(values).alias("k1"),
        F.xxhash64(F.lit(1), values).alias("k2"),
    )
    same = ["label", "width", "k1", "k2"]
    usable = rows.filter("usable")
    groups = staged(
        usable.groupBy(same)
        .agg(
            F.min("vec_id").alias("least"),
            F.count("*").alias("copies"),
            F.first("embedding").alias("embedding"),
        )
        .withColumn("point", F.monotonically_increasing_id()),
        "vector-groups",
    )
    sizes = groups.groupBy("label", "width").agg(F.count("*").alias("points"))
    points = (
        groups.join(sizes, ["label", "width"])
        .withColumn("shards", F.ceil(F.col("points") / SHARD_POINTS).cast("long"))
        .withColumn("shard", F.pmod(F.xxhash64("point"), "shards"))
        .select("label", "width", "point", "copies", "embedding", "shards", "shard")
    )
    points = staged(points, "points")
    graphs = staged(
        points.select("label", "width", "shard", "point", "copies", "embedding")
        .groupBy("label", "width", "shard")
        .applyInArrow(_build, GRAPH_SCHEMA),
        "graphs",
    )
    beams = audited_beams(points, graphs, threshold)
    spread = sizes.select(
        "label", "width", F.ceil(F.col("points") / SHARD_POINTS).cast("long").alias("shards")
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))
    pairs = (
        graphs.join(spread, ["label", "width"])
        .join(beams, ["label", "width"])
        .withColumn("other", other)
        .withColumn("low", F.least("shard", "other"))
        .withColumn("high", F.greatest("shard", "other"))
        .drop("shards", "other")
    )
    found = staged(
        pairs.groupBy("label", "width", "low", "high").applyInArrow(
            _search_pair(threshold), FOUND_SCHEMA
        ),
        "found",
    )
    links = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("others"))
    linked = components(found.filter("b IS NOT NULL").select("a", "b"))
    known = groups.select("point", "least").join(linked, groups.point == linked.node)
    first = known.groupBy("component").agg(F.min("least").alias("first"))
    reached = known.select("point", "component").join(first, "component").select("point", "first")
    by_group = (
        groups.drop("embedding")
        .join(links, groups.point == links.a, "left")
        .join(reached, "point", "left")
        .select(*same, "least", "copies", "others", "first")
    )
    in_group = F.col("least").isNotNull()
    return (
        rows.select("vec_id", "usable", *same)
        .withColumn("label", F.when(F.col("usable"), F.col("label")))
        .join(by_group, same, "left")
        .select(
            "vec_id",
            F.when(in_group, F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
            .otherwise(0)
            .cast("long")
            .alias("n_links"),
            F.when(in_group, F.coalesce("first", "least"))
            .otherwise(F.col("vec_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
