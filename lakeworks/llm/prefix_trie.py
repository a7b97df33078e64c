"""Prefix trie of conversations, built in ternary search trees over range shards.

Every turn (role, text) becomes a 128-bit key.  Equal conversations are one
sequence of keys with a member count, the distinct sequences are dealt into
shards by range, so a shard holds one stretch of the sorted order.  In a shard the
keys are numbered by a dictionary and the sequences inserted median first into a
ternary search tree, which keeps the trees of siblings balanced.  A pass over the
nodes from the last to the first, without recursion, adds up members, leaves and
savings.

Only the nodes on the way to a shard's first and last sequence can occur in other
shards.  They are written as parts and merged by key; what hangs below them is
complete and enters as sums.  Their subtree sums take no recursion either: every
merged node hands its own share to the least shard path that holds it, each path
is summed from its end, and a node's total is the sum over the paths through it.

Limits: one conversation's keys (24 bytes a turn) are one array, and a shard is
about ``SHARD_TURNS`` turns of distinct conversations; a longer sequence makes its
shard larger.  Groups of equal conversations may be of any size: their ids are
joined in pieces of ``PIECE_IDS`` and hashed as a stream.

Defined results: null role or text is empty; turns are ordered by number, null
first, then by the key of role and text; repeated rows are turns of their own;
rows without a conversation id belong to no conversation; an empty table has no
nodes, not even a root.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.llm.arrays import trim
from lakeworks.operators.joins import sized_lookup
from lakeworks.session import cut_lineage

#: Turns of distinct conversations in a shard; ids that are joined together.
SHARD_TURNS, PIECE_IDS = 100_000, 4096
#: Nodes handed back at a time.
OUT_ROWS = 20_000

NODE = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        ("node", pa.binary()),
        ("parent", pa.binary()),
        ("size", pa.int64()),
        ("paths", pa.list_(pa.int64())),
    ]
)
NODE_DDL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, node binary, parent binary, size long, paths array<long>"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def digest(*values: Column) -> Column:
    """128 bits of a list of texts, their lengths included."""
    joined = F.concat(*(part for v in values for part in (F.octet_length(v).cast("string"), F.lit(":"), v)))
    return F.unhex(F.substring(F.sha2(joined, 256), 1, 32))


def turn_sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: conv_id, turns array<struct<key, size>>, ``size`` the bytes of the text."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    entry = F.struct(
        F.col(turn).isNotNull().alias("numbered"),
        F.col(turn).alias("turn"),
        digest(r, t).alias("key"),
        F.octet_length(t).cast("long").alias("size"),
    )
    rows = turns.filter(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), entry.alias("entry"))
    return rows.groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list("entry")), lambda e: F.struct(e["key"].alias("key"), e["size"].alias("size"))).alias("turns")
    )


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """Conversations with the same turns as one row: n, least, ends_sha256, keys, sizes."""
    keys = F.transform("turns", lambda t: t["key"])
    rows = sequences.select(
        "conv_id", "turns", F.unhex(F.substring(F.sha2(F.array_join(F.transform(keys, F.hex), ","), 256), 1, 32)).alias("sequence")
    )
    pieces = rows.groupBy("sequence", F.floor(F.col("conv_id") / PIECE_IDS).alias("piece")).agg(
        F.count("*").alias("n"),
        F.min("conv_id").alias("least"),
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"),
        F.first("turns").alias("turns"),
    )
    kind = "n long, least long, ends_sha256 string, keys array<binary>, sizes array<long>"
    # the turns of a group travel with its first piece alone
    first = Window.partitionBy("sequence").orderBy("piece")
    pieces = pieces.withColumn("turns", F.when(F.row_number().over(first) == 1, F.col("turns")))
    pieces = pieces.select(
        "*", F.transform("turns", lambda t: t["key"]).alias("keys"), F.transform("turns", lambda t: t["size"]).alias("sizes")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, row, sha = None, None, None
        for batch in batches:
            out = []
            for sequence, n, least, ids, keys, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                if sequence != now:
                    if row:
                        out.append((*row[:2], sha.hexdigest(), *row[2:]))
                    now, row, sha = sequence, [0, least, keys, sizes], hashlib.sha256()
                else:
                    sha.update(b",")
                row[0] += n
                sha.update(ids.encode())
            yield _sequence_batch(out)
        if row:
            yield _sequence_batch([(*row[:2], sha.hexdigest(), *row[2:])])

    # the window has dealt the pieces by sequence; its order is kept, so this sorts nothing anew
    return pieces.sortWithinPartitions("sequence", "piece").select("sequence", "n", "least", "ids", "keys", "sizes").mapInArrow(hashed, kind)


def _sequence_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["n", "least", "ends_sha256", "keys", "sizes"]
    )


class TernaryTree:
    """A trie node for each distinct prefix; the children of a node are a binary search tree by symbol."""

    def __init__(self) -> None:
        self.symbol, self.low, self.high, self.below, self.parent, self.depth = [-1], [-1], [-1], [-1], [-1], [0]

    def _add(self, symbol: int, parent: int) -> int:
        self.symbol.append(symbol)
        for links in (self.low, self.high, self.below):
            links.append(-1)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.symbol) - 1

    def insert(self, sequence: list[int]) -> int:
        """The node of the whole sequence, new or known."""
        symbol, low, high, below = self.symbol, self.low, self.high, self.below
        node = 0
        for s in sequence:
            at, links, owner = below[node], below, node
            while at != -1 and symbol[at] != s:
                links, owner = (low, at) if s < symbol[at] else (high, at)
                at = links[at]
            if at == -1:
                at = links[owner] = self._add(s, node)
            node = at
        return node

    def path(self, node: int) -> list[int]:
        """Nodes from the root to this one."""
        out = [node]
        while self.parent[out[-1]] != -1:
            out.append(self.parent[out[-1]])
        return out[::-1]


def median_order(n: int) -> list[int]:
    """0 to n - 1, the middle of every range before its halves."""
    out, ranges = [], [(0, n)]
    for a, z in ranges:
        if a < z:
            middle = (a + z) // 2
            out.append(middle)
            ranges += [(a, middle), (middle + 1, z)]
    return out


def shard_nodes(rows: list[tuple], shard: int) -> Iterator[tuple]:
    """Nodes of one shard's sorted sequences (n, least, ends_sha256, keys, sizes), as rows of ``NODE``."""
    known = sorted({key for row in rows for key in row[3]})
    number = {key: k for k, key in enumerate(known)}
    tree = TernaryTree()
    total = sum(len(row[3]) for row in rows) + 1
    members, least, ends, sizes = [0] * total, [None] * total, [None] * total, [0] * total
    node_of = [0] * len(rows)
    for k in median_order(len(rows)):
        n, first, ends_sha, keys, own_sizes = rows[k]
        node = node_of[k] = tree.insert([number[key] for key in keys])
        members[node], least[node], ends[node] = n, first, ends_sha
        for size in reversed(own_sizes):
            if sizes[node]:
                break
            sizes[node] = size
            node = tree.parent[node]
    n_nodes = len(tree.symbol)
    children, leaves, saved = [0] * n_nodes, [0] * n_nodes, [0] * n_nodes
    paths: dict[int, list[int]] = {}
    for side, k in enumerate((0, len(rows) - 1)):
        for node in tree.path(node_of[k]):
            paths.setdefault(node, []).append(2 * shard + side)
    # a child is numbered after its parent, so the reverse order meets children first
    for node in range(n_nodes - 1, 0, -1):
        up = tree.parent[node]
        members[up] += members[node]
        if least[up] is None or least[node] < least[up]:
            least[up] = least[node]
        if node in paths:  # it is counted when the parts are merged
            continue
        leaves[node] = leaves[node] or 1
        saved[node] += (members[node] - 1) * sizes[node]
        children[up] += 1
        leaves[up] += leaves[node]
        saved[up] += saved[node]
    ids = {0: b""}
    for node in sorted(paths, key=tree.depth.__getitem__):
        if node:
            up = tree.parent[node]
            ids[node] = hashlib.blake2b(ids[up] + known[tree.symbol[node]], digest_size=16).digest()
    for node in range(n_nodes):
        up = tree.parent[node]
        yield (
            least[node],
            tree.depth[node],
            None if node in paths or up in paths else least[up],
            members[node],
            children[node],
            leaves[node],
            saved[node],
            ends[node],
            ids.get(node),
            ids.get(up),
            sizes[node],
            paths.get(node),
        )


def _shards(sequences: DataFrame) -> DataFrame:
    """Nodes of all shards: complete ones, and parts of those on the border of a shard."""
    turns = sequences.agg(F.sum(F.size("keys").cast("long") + 1)).first()[0] or 0
    n_shards = max(1, -(-turns // SHARD_TURNS))
    dealt = sequences.repartitionByRange(n_shards, "keys").sortWithinPartitions("keys")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        out = []
        for row in shard_nodes(rows, TaskContext.get().partitionId()) if rows else ():
            out.append(row)
            if len(out) == OUT_ROWS:
                yield _node_batch(out)
                out = []
        yield _node_batch(out)
        trim()

    return dealt.mapInArrow(grow, NODE_DDL)


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(NODE)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, NODE)], schema=NODE)


def _merged(parts: DataFrame) -> DataFrame:
    """Border nodes with the sums of their parts and of the border nodes below them."""
    merged = parts.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.max("size").alias("size"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends_sha256").alias("ends_sha256"),
        F.min(F.array_min("paths")).alias("path"),
    )
    merged = cut_lineage(merged, "border")
    kids = merged.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"))
    merged = merged.join(kids, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids")
    own = merged.select(
        "node",
        "path",
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    steps = parts.select("node", "depth", F.explode("paths").alias("path"))
    up = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    shares = steps.join(own, ["node", "path"], "left").select(
        "node",
        F.sum(F.coalesce("leaves", F.lit(0))).over(up).alias("leaves"),
        F.sum(F.coalesce("saved", F.lit(0))).over(up).alias("saved"),
    )
    totals = shares.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return merged.drop("n_leaves", "saved_tokens").join(totals, "node").join(above, "parent", "left")


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def build(sequences: DataFrame) -> DataFrame:
    """All trie nodes of conversations (conv_id, turns array<struct<key, size>>).

    ``conv_id`` is a node's smallest member, ``n_convs`` its members, ``n_leaves``
    and ``saved_tokens`` are sums over its subtree; the latter is the text of every
    node counted once for each member but one.  ``ends_sha256`` hashes the ids of
    the conversations that end in the node, ascending and joined by commas.
    """
    nodes = cut_lineage(_shards(cut_lineage(distinct_sequences(sequences), "sequences")), "nodes")
    parts, complete = nodes.filter("paths IS NOT NULL"), nodes.filter("paths IS NULL")
    border = cut_lineage(_merged(parts), "merged")
    above = sized_lookup(border.select(F.col("node").alias("parent"), F.col("conv_id").alias("above")))
    inner = complete.join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    found = inner.select(COLUMNS).unionByName(border.select(COLUMNS))
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
