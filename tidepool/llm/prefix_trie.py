"""The trie of conversation prefixes: ternary search trees over dictionary-encoded turns, one a range shard, merged at their boundaries.

Every turn gets a number from a dictionary of the different (role, text). A
conversation is then a list of numbers, and the lists, ordered, are cut into
ranges. A shard builds its own ternary search tree by inserting its lists from
the middle one outwards, so that siblings form balanced binary trees. A prefix
spans two shards exactly if the last list of one and the first of the next both
start with it; so two lengths a shard tell which nodes are partial and which
shard counts what, and the partial rows of a node add up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, cut, grouped, shield

#: Turns and conversations of a shard, about: what one task holds at a time.
SHARD = 500_000
#: Turns that stand in more than one of so many rows join by broadcast: there are fewer of them than this.
HOT_SHARE = 1000
#: Boundary nodes that go to every task; more are joined by a shuffle on salted keys.
BROADCAST_NODES = 100_000
SALTS = 64
#: Conversation ids of one piece of a boundary node's list.
PIECE = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()

_ROWS = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, owner int, parent_owner int, shard int, pieces array<string>"


def encode_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq, words): each conversation's turns as dictionary numbers, and the words of each turn's text.

    Turns are ordered by turn, null first, ties by the SHA-256 of role and text.
    A null role or text is an empty one; a row with a null conv_id belongs to no
    conversation and goes; repeated rows are further turns; other columns are
    not read; an empty table gives none. Two turns are equal if the SHA-256 of
    role and text is. A text is read whole and stays where it is: only its
    digest and word count are shuffled. A conversation's numbers are held
    together in one task.
    """
    own, (conv, turn, role, text), _ = shield(conversations, "conv_id", "turn", "role", "text")
    said = F.coalesce(F.col(text), F.lit(""))
    by = F.coalesce(F.col(role), F.lit(""))
    turns = own.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said), 256)).alias("digest"),
        F.regexp_count(said, F.lit(WORD_PATTERN)).alias("words"),
    )
    turns = cut(turns, "turns")
    known = turns.groupBy("digest").agg(F.count("*").alias("n"))
    known = cut(known.withColumn("id", F.monotonically_increasing_id()), "turn-dictionary")
    share = turns.count() // HOT_SHARE
    hot = known.where(F.col("n") > share).select("digest", "id")
    rare = known.where(F.col("n") <= share).select("digest", "id")
    marked = turns.join(F.broadcast(hot), "digest", "left")
    # no key of the shuffled join is in more than one of HOT_SHARE rows
    rest = marked.where("id is null").drop("id").join(rare, "digest")
    named = marked.where("id is not null").unionByName(rest)
    listed = named.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("given"), F.coalesce(F.col("turn"), F.lit(0)).alias("turn"), "digest", "id", "words"))).alias("t"))
    return listed.select("conv_id", F.col("t.id").alias("seq"), F.col("t.words").alias("words"))


def with_shared_heads(sequences: DataFrame, span: int = 20, most: int = 3) -> DataFrame:
    """Every sequence rebuilt on another's head: the first h of conversation c - c % span, then its own from its h-th on; h = crc32(c) % (most + 1)."""
    heads = sequences.where(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("_base"), F.slice("seq", 1, most).alias("_seq"), F.slice("words", 1, most).alias("_words"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    joined = sequences.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % span, "_h": h}).join(heads, "_base", "left")

    def rebuilt(own: str, head: str):
        none = F.slice(F.col(own), 1, 0)
        first = F.when(F.col("_h") == 0, none).otherwise(F.slice(F.coalesce(F.col(head), none), 1, F.greatest(F.col("_h"), F.lit(1))))
        return F.concat(first, F.slice(F.col(own), F.col("_h") + 1, F.size(own) + 1)).alias(own)

    return joined.select("conv_id", rebuilt("seq", "_seq"), rebuilt("words", "_words"))


class TernaryTrie:
    """Sequences of numbers as nodes with a lower sibling, a higher sibling and a first child. Node 0 is the root; a node's parent has a smaller number."""

    def __init__(self):
        self.symbol, self.low, self.high, self.down = [None], [-1], [-1], [-1]
        self.parent, self.depth, self.words = [-1], [0], [0]

    def _new(self, symbol: int, parent: int, words: int) -> int:
        n = len(self.symbol)
        self.symbol.append(symbol)
        self.low.append(-1)
        self.high.append(-1)
        self.down.append(-1)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.words.append(words)
        return n

    def insert(self, sequence: list[int], words: list[int]) -> int:
        """The node that the sequence ends at."""
        symbol, low, high, down = self.symbol, self.low, self.high, self.down
        at = 0
        for s, w in zip(sequence, words):
            node = down[at]
            if node < 0:
                down[at] = node = self._new(s, at, w)
            while (here := symbol[node]) != s:
                side = low if s < here else high
                if side[node] < 0:
                    side[node] = self._new(s, at, w)
                node = side[node]
            at = node
        return at

    def insert_sorted(self, sequences: list[list[int]], words: list[list[int]]) -> list[int]:
        """The end nodes of sorted sequences, inserted median first, then the medians of both halves, and so on."""
        ends = [0] * len(sequences)
        open_ranges = [(0, len(sequences))]
        for a, b in open_ranges:
            if a < b:
                middle = (a + b) // 2
                ends[middle] = self.insert(sequences[middle], words[middle])
                open_ranges.append((a, middle))
                open_ranges.append((middle + 1, b))
        return ends

    def path(self, sequence: list[int]) -> list[int]:
        """The nodes of an inserted sequence, from the root on."""
        nodes = [0]
        for s in sequence:
            node = self.down[nodes[-1]]
            while self.symbol[node] != s:
                node = self.low[node] if s < self.symbol[node] else self.high[node]
            nodes.append(node)
        return nodes


def _common(a: str, b: str):
    """How many first elements two arrays of non-null numbers share; -1 if either is null."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    return F.when(F.col(a).isNull() | F.col(b).isNull(), -1).otherwise(F.coalesce(F.nullif(F.array_position(same, F.lit(False)).cast("int"), F.lit(0)) - 1, F.size(a)))


class Shards:
    """What the shards share: for each, in order, the length of the prefix in common with the one before and between its first and last list."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        rows = sorted(rows)
        self.place = {r[0]: i for i, r in enumerate(rows)}
        self.before = [r[1] for r in rows] + [-1]
        self.within = [r[2] for r in rows]

    def owners(self, i: int) -> list[int]:
        """By depth: the first shard that holds the node of that depth on shard i's first path, for nodes shared with the shard before."""
        found = []
        for depth in range(self.before[i] + 1):
            j = i - 1
            while self.before[j] >= depth and self.within[j] >= depth:
                j -= 1
            found.append(j)
        return found

    def nodes(self) -> int:
        """An upper bound of the boundary nodes."""
        return sum(b + 1 for b in self.before)


def _shard_rows(i: int, shards: Shards, seqs: list[list[int]], words: list[list[int]], ids: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """All node rows of shard i: its different sequences, sorted, and the sorted ids of each."""
    trie = TernaryTrie()
    ends = trie.insert_sorted(seqs, words)
    n = len(trie.symbol)
    parent, depth, said = (np.array(c, dtype=np.int64) for c in (trie.parent, trie.depth, trie.words))
    p, q = shards.before[i], shards.before[i + 1]
    first, last = trie.path(seqs[0]), trie.path(seqs[-1])
    owner = np.full(n, -1, dtype=np.int32)
    for d in range(min(q, len(last) - 1) + 1):
        owner[last[d]] = i
    counted_before = np.zeros(n, dtype=bool)
    for d, o in enumerate(shards.owners(i)):
        owner[first[d]] = o
        counted_before[first[d]] = True

    members = np.zeros(n, dtype=np.int64)
    least = np.full(n, np.iinfo(np.int64).max)
    stops = np.append(starts[1:], len(ids))
    members[ends] = stops - starts
    least[ends] = ids[starts]
    childless = np.array([d < 0 for d in trie.down])
    if len(seqs[-1]) <= q:
        childless[last[-1]] = False  # the next shard has this sequence too, or one that goes on from it
    leaves = childless.astype(np.int64)
    children = np.zeros(n, dtype=np.int64)
    np.add.at(children, parent[1:][~counted_before[1:]], 1)
    by_depth = np.argsort(depth, kind="stable")
    edges = np.searchsorted(depth[by_depth], np.arange(1, depth.max() + 2)) if n > 1 else []
    levels = [by_depth[a:b] for a, b in zip(edges[:-1], edges[1:])] if n > 1 else []
    for level in reversed(levels):
        up = parent[level]
        np.add.at(members, up, members[level])
        np.minimum.at(least, up, least[level])
        np.add.at(leaves, up, leaves[level])
    saved = (members - ~counted_before) * said
    for level in reversed(levels):
        np.add.at(saved, parent[level], saved[level])

    digests: list[str | None] = [NO_ENDS] * n
    pieces: list[list[str] | None] = [None] * n
    for node, a, b in zip(ends, starts.tolist(), stops.tolist()):
        own = ids[a:b].tolist()
        if owner[node] < 0:
            digests[node] = hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        else:
            pieces[node] = [",".join(map(str, own[k : k + PIECE])) for k in range(0, len(own), PIECE)]
    above = np.where(parent < 0, 0, parent)
    columns = [
        pa.array(least),
        pa.array(depth.astype(np.int32)),
        pa.array(least[above], mask=(parent < 0) | (owner[above] >= 0)),
        pa.array(members),
        pa.array(children),
        pa.array(leaves),
        pa.array(saved),
        pa.array(digests, pa.string()),
        pa.array(owner),
        pa.array(np.where(parent < 0, -1, owner[above]).astype(np.int32)),
        pa.array(np.full(n, i, dtype=np.int32)),
        pa.array(pieces, pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in _ROWS.split(", ")])


def _build(shards: Shards):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, ["shard"]):
            for shard in np.unique(batch.column(0).to_numpy()).tolist():
                at = np.flatnonzero(batch.column(0).to_numpy() == shard)
                part = batch.slice(int(at[0]), len(at))
                seqs, words, ids = part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_numpy()
                starts = [k for k in range(len(seqs)) if k == 0 or seqs[k] != seqs[k - 1]]
                rows = _shard_rows(shards.place[shard], shards, [seqs[k] for k in starts], [words[k] for k in starts], ids, np.array(starts))
                for k in range(0, rows.num_rows, 10_000):
                    yield rows.slice(k, 10_000)

    return run


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order, piece by piece."""
    key, h, first = None, None, True
    for batch in batches:
        for o, d, piece in zip(*(batch.column(c).to_pylist() for c in (0, 1, 2))):
            if (o, d) != key:
                if key:
                    yield pa.RecordBatch.from_pylist([{"owner": key[0], "depth": key[1], "ends": h.hexdigest()}], _ENDS)
                key, h, first = (o, d), hashlib.sha256(), True
            h.update(piece.encode() if first else b"," + piece.encode())
            first = False
    if key:
        yield pa.RecordBatch.from_pylist([{"owner": key[0], "depth": key[1], "ends": h.hexdigest()}], _ENDS)


_ENDS = pa.schema([("owner", pa.int32()), ("depth", pa.int32()), ("ends", pa.string())])


def prefix_trie(sequences: DataFrame, shard_rows: int = SHARD) -> DataFrame:
    """One row per node of the trie of `sequences` (conv_id, seq, words): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a prefix that some sequence starts with, the empty one included:
    an empty table gives no node, a sequence without turns is a member of the
    root alone. conv_id is the smallest member, parent_conv_id the parent's
    (null for the root), n_leaves the childless nodes at or below the node,
    saved_tokens the sum over the same nodes of (members - 1) * words of the
    last turn, ends_sha256 the digest of the decimal ids, ascending and joined
    by commas, of the members that end there. Each conv_id is one row with
    non-null numbers; equal sequences of any number are spread over shards by
    conv_id. Columns other than the three are not read.

    A task holds one shard, about `shard_rows` sequences and turns. The driver
    holds two numbers a shard. Only the ids that end at a boundary node pass
    through one task, packed and as a stream, as SHA-256 must read them in order.
    """
    spark = sequences.sparkSession
    seqs = cut(sequences.select("conv_id", "seq", "words"), "sequences")
    size = seqs.agg(F.sum(F.size("seq") + 1)).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_rows))
    dealt = cut(seqs.repartitionByRange(n, "seq", "conv_id").withColumn("shard", F.spark_partition_id()), "shards")

    # one row a shard: a table as small as the number of shards
    order = Window.orderBy("shard")
    spans = dealt.groupBy("shard").agg(F.min("seq").alias("first"), F.max("seq").alias("last")).withColumn("previous", F.lag("last").over(order))
    shards = Shards([tuple(r) for r in spans.select("shard", _common("previous", "first"), _common("first", "last")).collect()])

    sorted_rows = dealt.select("shard", "seq", "words", "conv_id").repartitionByRange(n, "shard").sortWithinPartitions("shard", "seq", "conv_id")
    rows = cut(sorted_rows.mapInArrow(_build(shards), _ROWS), "trie-rows")
    nodes = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    partial = rows.where("owner >= 0")
    # equal sequences are cut by conv_id: the order of the shards is that of the ids
    pieces = partial.where("pieces is not null").select("owner", "depth", "shard", F.posexplode("pieces").alias("place", "piece"))
    ends = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "shard", "place").select("owner", "depth", "piece").mapInArrow(_join_pieces, "owner int, depth int, ends string")
    merged = partial.groupBy("owner", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_owner").alias("parent_owner"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    )
    merged = cut(merged.join(ends, ["owner", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).drop("ends"), "boundary-nodes")

    known = merged.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_above"))
    whole = rows.where("owner < 0").drop("owner", "shard", "pieces")
    inside = whole.where("parent_owner < 0")
    below = whole.where("parent_owner >= 0").drop("parent_conv_id").unionByName(merged.where("parent_owner >= 0").drop("owner"))
    if shards.nodes() <= BROADCAST_NODES:
        below = below.join(F.broadcast(known), ["parent_owner", "depth"])
    else:
        salted = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        below = below.withColumn("_salt", F.pmod(F.hash("conv_id"), F.lit(SALTS))).join(salted, ["parent_owner", "depth", "_salt"])
    below = below.withColumn("parent_conv_id", F.col("_above"))
    top = merged.where("parent_owner < 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return inside.select(nodes).unionByName(below.select(nodes)).unionByName(top.select(nodes)).withColumn("depth", F.col("depth").cast("long"))
