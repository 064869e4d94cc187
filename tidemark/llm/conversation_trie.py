"""The tree of shared conversation starts.

A turn becomes an id of 32 bytes, a big-endian number: the SHA-256 of its role and text. A conversation
is the ids of its turns one after the other, and such keys in order are dealt out to tasks. A task
builds adaptive radix trees over its keys, a bounded number at a time, and every depth that is a
multiple of the width of an id is a node of the result. Nodes that other trees may share, those on the
ways to the first and the last key of a tree, are handed over in parts and put together by Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, hot_keys, saved
from tidemark.llm.radix_tree import Node, RadixTree, shared

#: Bytes of a turn id.
WIDTH = 32
#: The head of a conversation comes from the first of so many, and has fewer turns than this.
FAMILY, HEADS = 20, 4
#: Bytes of keys in one tree, and of conversation ids in one piece of a list that tasks share.
TREE_BYTES, PIECE_BYTES = 8 << 20, 1 << 20
#: Rows of a batch that a task hands over.
ROWS_OUT = 20_000

WORD = r"[^\x20\x09-\x0D]+"
NOBODY = hashlib.sha256(b"").hexdigest()

FOUND = pa.schema(
    [
        ("node", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("words", pa.int64()),
        ("ends_sha256", pa.string()), ("piece", pa.binary()),
    ]
)
FOUND_DDL = (
    "node binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, ends_sha256 string, piece binary"
)
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def turn_id(role: Column, text: Column) -> Column:
    """Equal for equal roles and texts only, as far as SHA-256 tells them apart."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def whole_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` of (turn, id, words) in order; rows without a conversation are left out."""
    role = F.coalesce(column("role").cast("string"), F.lit(""))
    text = F.coalesce(column("text").cast("string"), F.lit(""))
    rows = turns.select(
        column("conv_id").cast("long").alias("conv_id"), column("turn").cast("long").alias("turn"),
        turn_id(role, text).alias("id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    told = rows.filter("conv_id IS NOT NULL").groupBy("conv_id")
    return told.agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, key, words``: the head of the family's first conversation, then the own rest."""
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = conversations.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, HEADS - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = conversations.withColumn("first", first).join(heads, "first", "left").withColumn("h", h)
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    told = joined.select("conv_id", F.concat(head, rest).alias("t"))
    key = F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["id"])), ""))
    return told.select("conv_id", key.alias("key"), F.transform("t", lambda t: t["words"]).alias("words"))


# --- trees inside tasks ----------------------------------------------------------------------


@dataclass
class Ending:
    """The conversations with one key."""

    words: list[int]
    n: int
    least: int
    digest: str | None


@dataclass
class Sums:
    """What a place of the radix tree knows of the tree nodes from it downwards. ``saved`` and
    ``leaves`` leave out what shared nodes below have taken for themselves; ``tops`` are the nodes
    still without a parent."""

    n: int = 0
    least: int | None = None
    words: list[int] | None = None
    saved: int = 0
    leaves: int = 0
    tops: int = 0
    rows: tuple = ()
    last: tuple = (None, None)


def _prefix_digests(key: bytes) -> list[bytes]:
    state = hashlib.sha256()
    found = [state.digest()]
    for at in range(0, len(key), WIDTH):
        state.update(key[at : at + WIDTH])
        found.append(state.digest())
    return found


def tree_nodes(keys: list[bytes], endings: list[Ending]) -> Iterator[tuple]:
    """Rows of ``FOUND`` for one tree over distinct keys in order. Nodes on the ways to the first and the
    last key are shared: they carry their digest and what hangs below them without shared nodes."""
    tree = RadixTree()
    for key, ending in zip(keys, endings):
        tree.insert(key, ending)
    borders = (keys[0], keys[-1])
    digests = [_prefix_digests(key) for key in borders]
    places = []
    on: dict[int, list[bool]] = {}
    for node, parent, begin, own in tree.walk():
        along = on[id(parent)] if parent is not None else [True, True]
        # How far the ways to both borders go along with this node's bytes.
        reach = [begin + shared(own, b[begin : begin + len(own)]) if a else -1 for a, b in zip(along, borders)]
        on[id(node)] = [r == begin + len(own) for r in reach]
        places.append((node, parent, begin, begin + len(own), reach))
    for node, parent, begin, end, reach in reversed(places):
        depths = range(end // WIDTH, -1 if parent is None else begin // WIDTH, -1)
        node.note = _measured(node, end, depths, reach, digests)
    for node, parent, *_ in places:
        above = parent.note.last if parent is not None else (None, None)
        for shared_node, conv, depth, n, children, leaves, saved, words, digest in node.note.rows:
            parent_conv, parent_node = above
            yield (shared_node, parent_node, conv, depth, parent_conv, n, children, leaves, saved, words, digest, None)
            above = (None, shared_node) if shared_node is not None else (conv, None)
        node.note.last = above
    for node, *_ in places:
        node.note = None


def _measured(node: Node, end: int, depths: range, reach: list[int], digests: list[list[bytes]]) -> Sums:
    """The tree nodes at the turn-aligned ``depths`` of one place, deepest first, and what goes up."""
    own: Ending | None = node.value
    below = [child.note for _, child in node.layout.items()]
    sums = Sums(
        n=sum(b.n for b in below) + (own.n if own else 0),
        least=min([b.least for b in below] + ([own.least] if own else [])),
        words=own.words if own else below[0].words,
        saved=sum(b.saved for b in below), leaves=sum(b.leaves for b in below), tops=sum(b.tops for b in below),
    )
    rows = []
    for depth in depths:
        words = sums.words[depth - 1] if depth else 0
        digest = own.digest if own and depth * WIDTH == end else NOBODY
        way = next((k for k in (0, 1) if reach[k] >= depth * WIDTH), None)
        if way is not None:
            node_digest = digests[way][depth]
            rows.append((node_digest, sums.least, depth, sums.n, sums.tops, sums.leaves, sums.saved, words, digest))
            sums.saved = sums.leaves = sums.tops = 0
        else:
            sums.saved += (sums.n - 1) * words
            sums.leaves = sums.leaves if sums.tops else 1
            rows.append((None, sums.least, depth, sums.n, sums.tops, sums.leaves, sums.saved, words, digest))
            sums.tops = 1
    sums.rows = tuple(reversed(rows))
    return sums


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(FOUND)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)


class _Builder:
    """Takes (key, words, conv_id) in order of key and id; hands over rows of ``FOUND``."""

    def __init__(self) -> None:
        self.keys: list[bytes] = []
        self.endings: list[Ending] = []
        self.size = 0
        self.out: list[tuple] = []
        self.key: bytes | None = None
        self.cut = True  # the key of a task's start may have begun in another task

    def take(self, key: bytes, words: list[int], conv: int) -> None:
        if key != self.key:
            self.end_key(False)
            self.key, self.words, self.least, self.n = key, words, conv, 0
            self.names: list[str] = []
            self.name_bytes, self.begin = 0, conv
        if not self.names:
            self.begin = conv
        self.n += 1
        self.names.append(str(conv))
        self.name_bytes += len(self.names[-1]) + 1
        if self.name_bytes > PIECE_BYTES:
            self.hand_over_piece()

    def hand_over_piece(self) -> None:
        """Ids of a long list, or of one that other tasks may continue, go out as they come."""
        if self.names:
            node = hashlib.sha256(self.key).digest()
            joined = ",".join(self.names).encode()
            self.out.append((node, None, self.begin, *[None] * 8, joined))
        self.names, self.name_bytes, self.cut = [], 0, True

    def end_key(self, at_end: bool) -> None:
        if self.key is None:
            return
        long_list = self.n > len(self.names)
        if self.cut or at_end:
            self.hand_over_piece()
            digest = None
        else:
            digest = hashlib.sha256(",".join(self.names).encode()).hexdigest()
        self.keys.append(self.key)
        self.endings.append(Ending(self.words, self.n, self.least, digest))
        self.size += len(self.key) + WIDTH
        self.cut = False
        # A key whose ids went out in pieces must be the first or the last of its tree.
        if long_list or at_end or self.size > TREE_BYTES:
            self.end_tree()

    def end_tree(self) -> None:
        if self.keys:
            self.out.extend(tree_nodes(self.keys, self.endings))
        self.keys, self.endings, self.size = [], [], 0

    def ready(self, all_rows: bool = False) -> Iterator[pa.RecordBatch]:
        if self.out and (all_rows or len(self.out) > ROWS_OUT or any(r[-1] for r in self.out[-1:])):
            rows, self.out = self.out, []
            for at in range(0, len(rows), ROWS_OUT):
                yield _batch(rows[at : at + ROWS_OUT])


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    builder = _Builder()
    for batch in batches:
        for key, words, conv in zip(*[c.to_pylist() for c in batch.columns]):
            builder.take(key, words, conv)
            yield from builder.ready()
    builder.end_key(True)
    yield from builder.ready(True)


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every node's pieces in order; only the state of one list is held."""
    node, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["_node", "_digest"])

    for batch in batches:
        for at, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at != node:
                if node is not None:
                    yield row()
                node, state = at, hashlib.sha256(piece)
            else:
                state.update(b"," + piece)
    if node is not None:
        yield row()


# --- putting shared nodes together -----------------------------------------------------------


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """``node, saved, leaves`` summed over each node's subtree, in rounds that double the distance
    looked down; the number of rounds is the logarithm of the depth."""
    deepest = nodes.agg(F.max("depth")).first()[0]
    state = nodes.select("node", F.col("parent").alias("above"), "saved", "leaves")
    reach = 1
    while deepest is not None and reach <= deepest:
        gained = state.filter("above IS NOT NULL").groupBy(F.col("above").alias("node")).agg(
            F.sum("saved").alias("s"), F.sum("leaves").alias("l")
        )
        jump = state.select(F.col("node").alias("above"), F.col("above").alias("next"))
        state = saved(
            state.join(gained, "node", "left").join(jump, "above", "left").select(
                "node", F.col("next").alias("above"),
                (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
                (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            ),
            "trie-sums",
        )
        reach *= 2
    return state.select("node", "saved", "leaves")


def _shared_nodes(found: DataFrame) -> DataFrame:
    """The nodes that trees had parts of, whole: ``COLUMNS`` and ``node``."""
    pieces = found.filter("piece IS NOT NULL").select("node", "piece", "conv_id")
    ends = pieces.repartition("node").sortWithinPartitions("node", "conv_id").select("node", "piece")
    digests = ends.mapInArrow(_hash_pieces, "_node binary, _digest string")
    parts = found.filter("node IS NOT NULL AND piece IS NULL").groupBy("node").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("hanging"),
        F.sum("n_leaves").alias("leaves_below"), F.sum("saved_tokens").alias("saved_below"),
        F.max("words").alias("words"), F.max(F.nullif("ends_sha256", F.lit(NOBODY))).alias("digest"),
    )
    parts = saved(parts.join(digests, F.col("node") == F.col("_node"), "left").drop("_node"), "trie-parts")
    children = parts.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("shared_children"))
    n_children = F.col("hanging") + F.coalesce("shared_children", F.lit(0))
    own = saved(
        parts.join(children, "node", "left").select(
            "node", "parent", "conv_id", "depth", "n_convs", n_children.alias("n_children"),
            F.coalesce("_digest", "digest", F.lit(NOBODY)).alias("ends_sha256"),
            (F.col("saved_below") + (F.col("n_convs") - 1) * F.col("words")).alias("saved"),
            (F.col("leaves_below") + (n_children == 0).cast("long")).alias("leaves"),
        ),
        "trie-shared",
    )
    sums = _subtree_sums(own).select("node", F.col("saved").alias("saved_tokens"), F.col("leaves").alias("n_leaves"))
    above = own.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return saved(
        own.drop("saved", "leaves").join(sums, "node").join(above, "parent", "left").select("node", *COLUMNS), "trie-whole"
    )


def _with_parent(tops: DataFrame, known: DataFrame) -> DataFrame:
    """``tops`` with the conversation of their shared parent. Parents of very many nodes, such as the
    root, are looked up in a broadcast table, which is bounded by the number of partitions."""
    names = known.select(F.col("node").alias("parent"), F.col("conv_id").alias("_conv"))
    hot = saved(hot_keys(tops, "parent", tops.count()).drop("_salts").join(names, "parent"), "trie-hot")
    first = tops.join(F.broadcast(hot), "parent", "left")
    quick = first.filter("_conv IS NOT NULL")
    rest = first.filter("_conv IS NULL").drop("_conv").join(names, "parent")
    return quick.unionByName(rest).withColumn("parent_conv_id", F.col("_conv")).select(*COLUMNS)


def conversation_trie(turns: DataFrame) -> DataFrame:
    """``COLUMNS`` of every node of the tree of rebuilt conversations.

    ``turns`` has ``conv_id, turn, role, text``. Null roles and texts are empty. Turns of a conversation
    are ordered by number, null first; turns of one number, by their id, so repeated rows are repeated
    turns. Rows without ``conv_id`` belong to no conversation. A conversation whose head is missing
    starts with its own rest; if nothing is left it ends at the root. Without conversations there is
    no root and the result is empty. Further columns are ignored.

    A conversation is held as one row of 32 bytes a turn. Conversations are not: equal ones, and those
    that share a start, are dealt out by key and id, and lists of ids are hashed as a stream.
    """
    conversations = saved(whole_conversations(turns), "conversations")
    keys = saved(rebuilt(conversations), "conversation-keys")
    ordered = keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = saved(ordered.select("key", "words", "conv_id").mapInArrow(_grow, FOUND_DDL), "trie-nodes")
    known = _shared_nodes(found)
    own = found.filter("node IS NULL")
    inner = own.filter("parent IS NULL").select(*COLUMNS)
    tops = own.filter("parent IS NOT NULL")
    return inner.unionByName(_with_parent(tops, known)).unionByName(known.select(*COLUMNS))
