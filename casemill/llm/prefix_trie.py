"""A trie of the prefixes that conversations share, built in range shards of sorted turn ids.

Every distinct turn (role and text) gets an integer by a dictionary, so a conversation is a row of
integers and texts travel no further than the scan. Conversations are sorted by their turn ids
over all partitions: each partition, a range shard, holds neighbours. A shard is a ternary search
tree over the ids. Its distinct sequences are inserted median first, so the search trees among the
children of a node stay balanced, and one iterative traversal adds up members, leaves and savings.

Only prefixes of a shard's first or last sequence can go on in another shard. These boundary nodes
leave the shard as parts; everything else is final. The parts are merged by a digest of the prefix
and their subtrees summed by doubling: in round k every node hands its sums to the ancestor 2^k
above, so even a path of thousands of turns takes few rounds, and no task holds the boundaries of
all shards.

Equal conversations are sorted by conv_id as well, so a group of copies spreads over as many
shards as its size needs. The list of members that end in a boundary node is joined in pieces by
the shards and hashed as a stream: SHA-256 has an order, but no list is ever held whole.

Defined results: a null role or text is empty; a row with a null conv_id belongs to no
conversation and is left out. Turns stand by turn, null first; equal turns of a conversation by
the digest of role and text, and repeated rows are repeated turns. A conversation may have any
number of turns; its own ids (8 bytes a turn) are the one thing a task holds whole. An empty table
has no nodes, not even a root. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.mixing import word_count
from casemill.llm.shared import ship
from casemill.session import staged

#: A rebuilt conversation takes its head from the first conversation of so many.
FAMILY = 20
#: Its head has fewer turns than this.
HEADS = 4
#: Turns of a range shard, about.
SHARD_TURNS = 200_000
#: Members' ids of one piece of a list.
PIECE_IDS = 10_000
#: Rows of one batch.
BATCH = 20_000
NO_MEMBERS = hashlib.sha256(b"").hexdigest()

_INNER, _EDGE, _PIECE = 0, 1, 2
_NODE = (
    "kind int, node_key binary, parent_key binary, parent_conv_id long, conv_id long, "
    "depth long, turn_id long, words long, n_convs long, n_children long, n_leaves long, "
    "saved long, ends string"
)
_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
_NODE_ARROW = pa.schema([(f.split()[0], _ARROW[f.split()[1]]) for f in _NODE.split(", ")])


def encode_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, ids and words: the turns of each conversation by dictionary, in their order.

    Rows of 32-byte digests meet the dictionary, not texts; Spark splits a very common turn in that
    join.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias(
            "turn_key"
        ),
        word_count(text).alias("words"),
    )
    dictionary = staged(
        turns.groupBy("turn_key")
        .agg(F.first("words").alias("words"))
        .withColumn("turn_id", F.monotonically_increasing_id()),
        "turn-dictionary",
    )
    coded = turns.drop("words").join(dictionary, "turn_key")
    line = F.sort_array(F.collect_list(F.struct("turn", "turn_key", "turn_id", "words")))
    own = coded.groupBy("conv_id").agg(line.alias("line"))
    return own.select(
        "conv_id", F.col("line.turn_id").alias("ids"), F.col("line.words").alias("words")
    )


def rebuilt(coded: DataFrame) -> DataFrame:
    """Each conversation with its first h turns replaced by those of its family's first one.

    h is the CRC-32 of the decimal conv_id, modulo ``HEADS``; the family's first is
    ``conv_id - conv_id % FAMILY``, with Spark's sign of ``%``. ``coded`` is read twice.
    """
    heads = coded.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("head_id"),
        F.slice("ids", 1, HEADS - 1).alias("head_ids"),
        F.slice("words", 1, HEADS - 1).alias("head_words"),
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")

    def spliced(name: str):
        head = F.coalesce(F.col(f"head_{name}"), F.array().cast("array<long>"))
        return F.concat(F.slice(head, F.lit(1), h), F.slice(name, h + 1, F.size(name) + 1))

    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    return coded.join(heads, family == F.col("head_id"), "left").select(
        "conv_id", spliced("ids").alias("ids"), spliced("words").alias("words")
    )


class _Run:
    """Equal conversations next to each other: their turns and members."""

    def __init__(self, ids: np.ndarray, words: np.ndarray) -> None:
        self.ids = ids
        self.words = words
        self.members: list[int] = []

    def pieces(self) -> Iterator[tuple[int, str]]:
        """First id and text of the pieces of the members' list."""
        for at in range(0, len(self.members), PIECE_IDS):
            part = self.members[at : at + PIECE_IDS]
            yield part[0], ",".join(map(str, part))

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.members)).encode()).hexdigest()


def _runs(batches: Iterator[pa.RecordBatch]) -> list[_Run]:
    """The distinct sequences of a sorted shard."""
    runs: list[_Run] = []
    last = None
    for batch in batches:
        ids, words = batch.column(1), batch.column(2)
        ends = np.asarray(ids.offsets)
        flat, counts = np.asarray(ids.values, np.int64), np.asarray(words.values, np.int64)
        for i, conv_id in enumerate(batch.column(0).to_pylist()):
            row = flat[ends[i] : ends[i + 1]]
            raw = row.tobytes()
            if raw != last:
                runs.append(_Run(row.copy(), counts[ends[i] : ends[i + 1]].copy()))
                last = raw
            runs[-1].members.append(conv_id)
    return runs


class TernaryTree:
    """A ternary search tree over sequences of integers; node 0 is the root of the trie."""

    def __init__(self) -> None:
        self.key, self.low, self.equal, self.high = [0], [-1], [-1], [-1]
        self.parent, self.depth, self.words = [-1], [0], [0]
        self.run = [-1]

    def _add(self, key: int, parent: int, words: int) -> int:
        for column, value in (
            (self.key, key), (self.low, -1), (self.equal, -1), (self.high, -1),
            (self.parent, parent), (self.depth, self.depth[parent] + 1),
            (self.words, words), (self.run, -1),
        ):
            column.append(value)
        return len(self.key) - 1

    def insert(self, ids: list[int], words: list[int], run: int) -> None:
        node = 0
        for key, count in zip(ids, words, strict=True):
            at, side, above = self.equal[node], self.equal, node
            while at >= 0 and (own := self.key[at]) != key:
                side, above = (self.low if key < own else self.high), at
                at = side[at]
            if at < 0:
                at = self._add(key, node, count)
                side[above] = at
            node = at
        self.run[node] = run

    def insert_by_medians(self, runs: list[_Run]) -> None:
        """Insert sorted runs, the median of each range before its halves."""
        ranges = [(0, len(runs))]
        while ranges:
            first, end = ranges.pop()
            if first < end:
                middle = (first + end) // 2
                run = runs[middle]
                self.insert(run.ids.tolist(), run.words.tolist(), middle)
                ranges += [(middle + 1, end), (first, middle)]

    def path(self, ids: list[int]) -> list[int]:
        """The nodes of a sequence that was inserted, the root first."""
        nodes = [0]
        for key in ids:
            at = self.equal[nodes[-1]]
            while self.key[at] != key:
                at = self.low[at] if key < self.key[at] else self.high[at]
            nodes.append(at)
        return nodes

    def ordered(self) -> list[int]:
        """All nodes in the order of their prefixes, a prefix before what it starts."""
        order, waiting = [0], [self.equal[0]]
        while waiting:
            at = waiting.pop()
            if at < -1:
                order.append(-at - 2)
            elif at >= 0:
                waiting += [self.high[at], self.equal[at], -at - 2, self.low[at]]
        return order


def _edge_keys(ids: np.ndarray) -> Iterator[bytes]:
    """A digest of each prefix of a sequence, the empty one first."""
    state = hashlib.sha256()
    yield state.digest()
    for one in ids.astype("<i8"):
        state.update(one.tobytes())
        yield state.copy().digest()


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard: inner ones final, those on its first or last path as parts."""
    runs = _runs(batches)
    if not runs:
        return
    tree = TernaryTree()
    tree.insert_by_medians(runs)
    order = tree.ordered()
    outer = {0, len(runs) - 1}
    edge: dict[int, bytes] = {}
    for r in outer:
        path = tree.path(runs[r].ids.tolist())
        edge.update(zip(path, _edge_keys(runs[r].ids), strict=True))

    n = len(tree.key)
    convs, least = [0] * n, [2**63 - 1] * n
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for node in reversed(order):
        if (r := tree.run[node]) >= 0:
            convs[node] += len(runs[r].members)
            least[node] = min(least[node], runs[r].members[0])
        up = tree.parent[node]
        if up < 0:
            continue
        convs[up] += convs[node]
        least[up] = min(least[up], least[node])
        if node not in edge:
            leaves[node] += not children[node]
            saved[node] += (convs[node] - 1) * tree.words[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]

    rows = []
    for node in order:
        up, r = tree.parent[node], tree.run[node]
        rows.append(
            (
                _EDGE if node in edge else _INNER,
                edge.get(node),
                edge.get(up),
                None if up in edge or up < 0 else least[up],
                least[node], tree.depth[node], tree.key[node] if up >= 0 else None,
                tree.words[node], convs[node], children[node], leaves[node], saved[node],
                None if r < 0 or r in outer else runs[r].digest(),
            )
        )
        if len(rows) >= BATCH:
            yield _batch(rows)
            rows = []
    for r in outer:
        *_, key = _edge_keys(runs[r].ids)
        for first, text in runs[r].pieces():
            rows.append((_PIECE, key, None, None, first, *[None] * 7, text))
            if len(rows) >= 64:
                yield _batch(rows)
                rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), _NODE_ARROW, strict=True)],
        schema=_NODE_ARROW,
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node_key and digest of the joined pieces; the rows are sorted by node_key and first id."""
    key, state = None, hashlib.sha256()

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["node_key", "list_sha"]
        )

    for batch in batches:
        for own, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if own != key:
                if key is not None:
                    yield done()
                key, state = own, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.as_py().encode())
    if key is not None:
        yield done()


def _subtree_sums(edges: DataFrame, deepest: int) -> DataFrame:
    """node_key, n_leaves and saved of the boundary nodes' whole subtrees, by doubling.

    Before round k a row has the sums over its descendants less than 2^k below it, and ``up`` is
    its ancestor 2^k above.
    """
    kids = edges.groupBy(F.col("parent_key").alias("node_key")).agg(F.count("*").alias("kids"))
    leaf = (F.col("n_children") + F.coalesce("kids", F.lit(0)) == 0).cast("long")
    sums = edges.join(kids, "node_key", "left").select(
        "node_key",
        F.col("parent_key").alias("up"),
        (F.col("n_leaves") + leaf).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    for _ in range(max(0, deepest).bit_length()):
        sums = staged(sums, "trie-sums")
        below = (
            sums.filter("up is not null")
            .groupBy(F.col("up").alias("node_key"))
            .agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        )
        above = sums.select(F.col("node_key").alias("up"), F.col("up").alias("next_up"))
        sums = (
            sums.join(below, "node_key", "left")
            .join(above, "up", "left")
            .select(
                "node_key",
                F.col("next_up").alias("up"),
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            )
        )
    return sums.drop("up")


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per distinct prefix of ``sequences`` (conv_id, ids, words), the empty one included.

    conv_id must not repeat. Returns conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 (of the members that end here) and turn_id.
    """
    ship(sequences.sparkSession)
    sequences = staged(sequences, "trie-sequences")  # the sort samples it
    total = sequences.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = staged(
        sequences.repartitionByRange(max(1, math.ceil(total / shard_turns)), "ids", "conv_id")
        .sortWithinPartitions("ids", "conv_id")
        .select("conv_id", "ids", "words")
        .mapInArrow(_shard, _NODE),
        "trie-shards",
    )
    edges = staged(
        shards.filter(F.col("kind") == _EDGE)
        .groupBy("node_key")
        .agg(
            *[F.first(c).alias(c) for c in ("parent_key", "depth", "turn_id", "words")],
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
            F.max("ends").alias("ends"),
        ),
        "trie-edges",
    )
    deepest = edges.agg(F.max("depth")).first()[0] or 0
    sums = _subtree_sums(edges, deepest)
    lists = (
        shards.filter(F.col("kind") == _PIECE)
        .select("node_key", "ends", "conv_id")
        .repartition("node_key")
        .sortWithinPartitions("node_key", "conv_id")
        .select("node_key", "ends")
        .mapInArrow(_hashed, "node_key binary, list_sha string")
    )
    kids = edges.groupBy(F.col("parent_key").alias("node_key")).agg(F.count("*").alias("kids"))
    above = edges.select(
        F.col("node_key").alias("parent_key"), F.col("conv_id").alias("edge_conv_id")
    )
    outer = (
        edges.drop("n_leaves", "saved")
        .join(sums, "node_key")
        .join(kids, "node_key", "left")
        .join(lists, "node_key", "left")
        .join(above, "parent_key", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
        .withColumn("ends", F.coalesce("ends", "list_sha"))
        .withColumn("parent_conv_id", F.col("edge_conv_id"))
    )
    inner = shards.filter(F.col("kind") == _INNER)
    hung = inner.filter("parent_key is not null").join(above, "parent_key")
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_MEMBERS)).alias("ends_sha256"), "turn_id",
    ]
    return (
        inner.filter("parent_key is null")
        .select(*columns)
        .unionByName(hung.withColumn("parent_conv_id", F.col("edge_conv_id")).select(*columns))
        .unionByName(outer.select(*columns))
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt conversations of ``conversations``."""
    return prefix_trie(rebuilt(staged(encode_turns(conversations), "coded-conversations")))
