"""Conversation prefix trie: every prefix that conversations share, by union-find over sorted neighbours.

Each conversation is rebuilt and kept as an array of turns, a turn as two hashes of its role and text and the bytes of its text.
Equal conversations are one sequence with a number of members. The sequences are range-partitioned in order, so that those which
share a prefix are neighbours; a task cuts its range into chunks. In a chunk the longest common prefixes of neighbours are
taken in descending depth: each joins two components at a node of that depth, a branching node unless the one side ends there,
and the turns between a component's node and the new one are its unary nodes above.

A node that is no prefix of the chunk's first or last sequence has all its members in the chunk and is whole. The others are
open: what hangs below them is contracted into sums, and the open nodes of all chunks, a path or two a chunk, are merged by their
prefix hashes; sums over their subtrees come from doubling the distance to the ancestor that each adds itself to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import written

#: A conversation takes up to eight turns over from the first one of its five.
FAMILY = 5
HEADS = 9
#: Turns of a chunk, 24 bytes each; a longer conversation is a chunk of its own.
CHUNK_TURNS = 1 << 19
#: Ids that are joined to one piece of text before a digest reads them.
PIECE_IDS = 1 << 14

_TURNS = "array<struct<h1:long,h2:long,size:long>>"
_NODES = (
    "open boolean, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, size long, ends_sha256 string"
)
_NAMES = [field.split(" ")[0] for field in _NODES.split(", ")]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turns): each conversation's first turns from the first one of its five, then its own."""
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        conversations["turn"].isNotNull().alias("numbered"),
        conversations["turn"].alias("turn"),
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(text, role, F.lit(1)).alias("h2"),
        F.octet_length(text).cast("long").alias("size"),
    )
    own = conversations.where(conversations["conv_id"].isNotNull()).select(conversations["conv_id"].alias("conv_id"), turn.alias("turn"))
    own = own.withColumn("first", F.col("conv_id") - F.col("conv_id") % FAMILY).repartition("first")
    own = own.groupBy("first", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    turns = F.transform("turns", lambda t: F.struct(t["h1"], t["h2"], t["size"]))
    own = own.select("first", "conv_id", turns.cast(_TURNS).alias("turns"))
    family = Window.partitionBy("first")
    head = F.max(F.when(F.col("conv_id") == F.col("first"), F.slice("turns", 1, HEADS - 1))).over(family)
    n = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS)).cast("int")
    both = F.concat(F.slice(F.coalesce("head", F.array().cast(_TURNS)), F.lit(1), n), F.slice("turns", n + 1, F.size("turns")))
    return own.withColumn("head", head).select("conv_id", both.alias("turns"))


def _digests(sequences: DataFrame, members: DataFrame) -> DataFrame:
    """Rows (d1, d2, ends_sha256) of sequences with more than one member: the digest of their ids in ascending order.

    Ids are sorted and joined to pieces by many tasks; only the pieces of one sequence, joined text, are read by one.
    """
    shared = sequences.where("n > 1").select("d1", "d2")
    ids = members.select("d1", "d2", "conv_id").join(shared, ["d1", "d2"]).repartitionByRange("d1", "d2", "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            d1, d2, conv = (rows.column(c).to_numpy() for c in range(3))
            cuts = np.flatnonzero((np.diff(d1) != 0) | (np.diff(d2) != 0)) + 1
            edges = [0, *cuts.tolist(), rows.num_rows]
            starts = [s for a, b in zip(edges, edges[1:]) for s in range(a, b, PIECE_IDS)]
            ends = [*starts[1:], rows.num_rows]
            pieces = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(starts, ends)]
            yield pa.record_batch([pa.array(x) for x in (d1[starts], d2[starts], conv[starts])] + [pa.array(pieces, pa.string())], ["d1", "d2", "least", "piece"])

    pieces = ids.sortWithinPartitions("d1", "d2", "conv_id").mapInArrow(join, "d1 long, d2 long, least long, piece string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, out = None, None, []
        for rows in batches:
            for d1, d2, piece in zip(*(rows.column(c).to_pylist() for c in (0, 1, 3))):
                if at == (d1, d2):
                    state.update(b"," + piece.encode())
                    continue
                if state:
                    out.append((*at, state.hexdigest()))
                at, state = (d1, d2), hashlib.sha256(piece.encode())
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out)], ["d1", "d2", "ends_sha256"])
                out = []
        if state:
            yield pa.record_batch([pa.array([x]) for x in (*at, state.hexdigest())], ["d1", "d2", "ends_sha256"])

    return pieces.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "least").mapInArrow(digest, "d1 long, d2 long, ends_sha256 string")


def _sequences(members: DataFrame) -> DataFrame:
    """Rows (turns, n, conv_id, ends_sha256): each different conversation with the number of members and the least id."""
    grouped = members.groupBy("d1", "d2").agg(F.first("turns").alias("turns"), F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    grouped = written(grouped, "sequences")
    several = _digests(grouped, members)
    single = grouped.where("n = 1").withColumn("ends_sha256", F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
    return single.unionByName(grouped.where("n > 1").join(several, ["d1", "d2"])).select("turns", "n", "conv_id", "ends_sha256")


class _Node:
    """The top of a component: a node whose children in the chunk are all known once it is left for its parent."""

    __slots__ = ("depth", "n", "least", "lo", "hi", "ends", "children", "leaves", "saved", "rows")

    def __init__(self, depth: int, n: int, least: int, lo: int, hi: int, ends: str | None = None) -> None:
        self.depth, self.n, self.least, self.lo, self.hi, self.ends = depth, n, least, lo, hi, ends
        self.children = self.leaves = self.saved = 0  # of those children that are whole
        self.rows: list[int] = []  # rows of whole children, which wait for this node's least id

    def take(self, other: _Node) -> None:
        """Another node of the same depth and prefix is this one."""
        self.n, self.least = self.n + other.n, min(self.least, other.least)
        self.lo, self.hi, self.ends = min(self.lo, other.lo), max(self.hi, other.hi), self.ends or other.ends
        self.children, self.leaves, self.saved = self.children + other.children, self.leaves + other.leaves, self.saved + other.saved
        if len(self.rows) < len(other.rows):
            self.rows, other.rows = other.rows, self.rows
        self.rows += other.rows


class _Chunk:
    """The trie of some sequences in order: (turns as rows of h1, h2, size; members; least id; digest of ids)."""

    def __init__(self, sequences: list[tuple[np.ndarray, int, int, str]]) -> None:
        self.turns = [s[0] for s in sequences]
        self.last = len(sequences) - 1
        self.nodes = [_Node(len(t), n, least, i, i, ends) for i, (t, n, least, ends) in enumerate(sequences)]
        self.parents = list(range(len(sequences)))
        self.keys = {i: self._prefix_keys(i) for i in {0, self.last}}
        self.out: list[list] = []

    def _prefix_keys(self, i: int) -> list[bytes]:
        state, keys = xxhash.xxh3_128(), []
        keys.append(state.digest())
        for row in np.ascontiguousarray(self.turns[i][:, :2]):
            state.update(row.tobytes())
            keys.append(state.digest())
        return keys

    def _shared(self, i: int) -> int:
        """How many turns sequences i and i + 1 begin with in common."""
        a, b = self.turns[i], self.turns[i + 1]
        n = min(len(a), len(b))
        apart = np.flatnonzero((a[:n, :2] != b[:n, :2]).any(axis=1))
        return int(apart[0]) if len(apart) else n

    def _find(self, i: int) -> int:
        while self.parents[i] != i:
            self.parents[i] = self.parents[self.parents[i]]
            i = self.parents[i]
        return i

    def _leave(self, node: _Node) -> _Node:
        """Put the node out and go up to its parent, which has no other child yet."""
        d = node.depth
        size = int(self.turns[node.lo][d - 1, 2]) if d else 0
        up = _Node(d - 1, node.n, node.least, node.lo, node.hi)
        spine = 0 if node.lo == 0 else self.last if node.hi == self.last else None
        if spine is None:
            leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * size
            self.out.append([False, None, None, d, node.least, None, node.n, node.children, leaves, saved, size, node.ends])
            up.children, up.leaves, up.saved, up.rows = 1, leaves, saved, [len(self.out) - 1]
            child_key = None
        else:
            child_key = self.keys[spine][d]
            above = self.keys[spine][d - 1] if d else None
            self.out.append([True, child_key, above, d, node.least, None, node.n, node.children, node.leaves, node.saved, size, node.ends])
        for r in node.rows:
            self.out[r][5] = node.least
            self.out[r][2] = child_key
        return up

    def run(self) -> list[list]:
        shared = np.array([self._shared(i) for i in range(self.last)], np.int64)
        for i in np.argsort(-shared, kind="stable"):
            depth, ends = int(shared[i]), []
            for side in (self._find(int(i)), self._find(int(i) + 1)):
                node = self.nodes[side]
                while node.depth > depth:
                    node = self._leave(node)
                ends.append((side, node))
            (a, one), (b, two) = ends
            one.take(two)
            self.parents[b], self.nodes[a] = a, one
        node = self.nodes[self._find(0)]
        while node.depth >= 0:
            node = self._leave(node)
        return self.out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the chunks of a task's sequences, which come in order."""

    def done(held: list) -> pa.RecordBatch:
        rows = list(zip(*_Chunk(held).run()))
        kinds = [pa.bool_(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds)], _NAMES)

    held, size = [], 0
    for rows in batches:
        column = rows.column(0)
        fields = np.stack([column.flatten().field(f).to_numpy(zero_copy_only=False) for f in ("h1", "h2", "size")], axis=1)
        lengths = column.value_lengths().to_pylist()
        ends = np.cumsum(lengths)
        for n, end, members, least, sha in zip(lengths, ends, *(rows.column(c).to_pylist() for c in (1, 2, 3))):
            if held and size + n > CHUNK_TURNS:
                yield done(held)
                held, size = [], 0
            held.append((fields[end - n : end], members, least, sha))
            size += n
    if held:
        yield done(held)


def _subtree_sums(merged: DataFrame) -> DataFrame:
    """Rows (key, leaves, saved): sums over a node and everything below it.

    After k rounds a node's sums cover the descendants fewer than 2^k levels down, and it adds them to the ancestor 2^k up.
    """
    state = written(merged.select("key", F.col("parent_key").alias("up"), "leaves", "saved"), "open-sums")
    while state.where("up is not null").limit(1).count():
        adds = state.where("up is not null").groupBy("up").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        ups = state.select(F.col("key").alias("up"), F.col("up").alias("far"))
        climbing = state.where("up is not null").join(ups, "up").select("key", "leaves", "saved", F.col("far").alias("up"))
        climbed = climbing.unionByName(state.where("up is null").select("key", "leaves", "saved", "up"))
        adds = adds.withColumnRenamed("up", "of")
        joined = climbed.join(adds, climbed["key"] == adds["of"], "left")
        sums = [(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")]
        state = written(joined.select("key", "up", *sums), "open-sums")
    return state.select("key", "leaves", "saved")


def _merged(opened: DataFrame) -> DataFrame:
    """Rows (key, parent_key, depth, conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of the open nodes of all chunks."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    same = [F.max(c).alias(c) for c in ("parent_key", "depth", "size", "ends_sha256")]
    nodes = written(opened.groupBy("key").agg(F.min("conv_id").alias("conv_id"), *sums, *same), "open-nodes")
    below = nodes.where("parent_key is not null").groupBy(F.col("parent_key").alias("of")).agg(F.count("*").alias("more"))
    nodes = nodes.join(below, nodes["key"] == below["of"], "left").drop("of")
    nodes = nodes.withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    leaves = F.col("n_leaves") + (F.col("n_children") == 0).cast("long")
    saved = F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")
    nodes = written(nodes.withColumns({"leaves": leaves, "saved": saved}), "open-nodes")
    totals = _subtree_sums(nodes).withColumnRenamed("key", "of")
    kept = nodes.drop("leaves", "saved", "more", "n_leaves", "saved_tokens")
    joined = kept.join(totals, kept["key"] == totals["of"]).drop("of")
    return written(joined.withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"}), "open-nodes")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one for each node.

    A node is a sequence of first turns (role and text) of a rebuilt conversation, the root with none; conv_id is its least
    member. Turns of a conversation are ordered by number, NULL first, and those of one number by hashes of what they hold, so
    repeated rows are turns each. NULL roles and texts are empty ones. Rows without a conv_id are no conversation. A table
    without conversations gives no rows, not even a root. Other columns are left aside.
    """
    members = rebuilt(conversations).withColumns({"d1": F.xxhash64("turns"), "d2": F.xxhash64("turns", F.lit(1))})
    members = written(members, "rebuilt")
    sequences = _sequences(members).repartitionByRange("turns").sortWithinPartitions("turns")
    nodes = written(sequences.mapInArrow(_chunks, _NODES), "trie-nodes")
    merged = _merged(nodes.where("open"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    columns = [*names, F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256")]
    above = merged.select(F.col("key").alias("of"), F.col("conv_id").alias("above"))

    def under(rows: DataFrame, how: str) -> DataFrame:
        joined = rows.drop("parent_conv_id").join(above, rows["parent_key"] == above["of"], how)
        return joined.withColumnRenamed("above", "parent_conv_id").select(*columns)

    whole = nodes.where("not open and parent_key is null").select(*columns)
    return whole.unionByName(under(nodes.where("not open and parent_key is not null"), "inner")).unionByName(under(merged, "left"))
