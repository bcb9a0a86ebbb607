"""Conversation prefix trie: adaptive radix trees over big-endian turn ids.

A turn's id is a digest of role and text, 16 bytes wide, so a conversation is a byte string and a trie node is a prefix of it that ends at
a turn.  Equal conversations are one string first, with their number; the distinct strings are dealt by range, which keeps the strings of
a subtree together wherever it is small enough and cuts it where it is not.  Each part builds an adaptive radix tree: inner nodes
grow through four layouts, single-child paths are kept as byte runs, and only depths that are whole turns give nodes.  Subtree sums
are taken bottom-up inside the part.

Neighbouring parts share only nodes on the paths of their border strings.  A shared node belongs to the first part that has it; sums over distinct
nodes count it there alone, sums over members add up, so one grouped sum of the shared nodes completes all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save

WIDTH = 16  # bytes of a turn id
PART = 20_000  # distinct conversations of a part, about
PART_BYTES = 16_000_000  # their bytes, about
BUCKET = 16  # ids that agree but for so many last bits are joined to text together


class Node:
    """A tree node: the bytes after its edge, the string that ends here, and children in the smallest layout that holds them.

    ``kind`` 0: none; 4 and 16: edge bytes in order beside their children; 48: a place for each of 256 bytes and 48 children;
    256: a child for each byte.
    """

    __slots__ = ("path", "end", "kind", "keys", "kids", "n", "low", "gross", "net", "leaves", "orphans", "heads", "first", "last")

    def __init__(self, path: bytes, end=None) -> None:
        self.path, self.end, self.kind, self.keys, self.kids = path, end, 0, None, None
        self.first = self.last = False

    def find(self, byte: int):
        if self.kind == 0:
            return None
        if self.kind == 256:
            return self.kids[byte]
        if self.kind == 48:
            at = self.keys[byte]
            return self.kids[at - 1] if at else None
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, child: "Node") -> None:
        """Add a child, or put another in its place."""
        if self.kind == 0:
            self.kind, self.keys, self.kids = 4, bytearray(), []
        if self.kind == 256:
            self.kids[byte] = child
            return
        if self.kind == 48:
            at = self.keys[byte]
            if at:
                self.kids[at - 1] = child
            elif len(self.kids) < 48:
                self.kids.append(child)
                self.keys[byte] = len(self.kids)
            else:
                kids: list = [None] * 256
                for b, at in enumerate(self.keys):
                    if at:
                        kids[b] = self.kids[at - 1]
                kids[byte] = child
                self.kind, self.keys, self.kids = 256, None, kids
            return
        at = self.keys.find(byte)
        if at >= 0:
            self.kids[at] = child
        elif len(self.keys) < self.kind:
            at = sum(b < byte for b in self.keys)
            self.keys.insert(at, byte)
            self.kids.insert(at, child)
        elif self.kind == 4:
            self.kind = 16
            self.put(byte, child)
        else:
            places = bytearray(256)
            for at, b in enumerate(self.keys):
                places[b] = at + 1
            self.kind, self.keys = 48, places
            self.put(byte, child)

    def children(self) -> list["Node"]:
        """In any order."""
        return [k for k in self.kids if k is not None] if self.kind else []


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Tree:
    """An adaptive radix tree of byte strings with path compression; strings may be prefixes of others."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.empty = True

    def insert(self, key: bytes, end) -> None:
        if self.empty:
            self.root, self.empty = Node(key, end), False
            return
        above, edge, node, at = None, 0, self.root, 0
        while True:
            rest = key[at:at + len(node.path)]
            if rest != node.path:
                m = _common(rest, node.path)
                split = Node(node.path[:m])
                split.put(node.path[m], node)
                node.path = node.path[m + 1:]
                if above is None:
                    self.root = split
                else:
                    above.put(edge, split)
                if at + m == len(key):
                    split.end = end
                else:
                    split.put(key[at + m], Node(key[at + m + 1:], end))
                return
            at += len(node.path)
            if at == len(key):
                node.end = end
                return
            child = node.find(key[at])
            if child is None:
                node.put(key[at], Node(key[at + 1:], end))
                return
            above, edge, node, at = node, key[at], child, at + 1

    def mark(self, key: bytes, name: str) -> None:
        """Set the flag ``name`` of the nodes on the way to a string of the tree."""
        node, at = self.root, 0
        while True:
            setattr(node, name, True)
            at += len(node.path)
            if at == len(key):
                return
            node, at = node.find(key[at]), at + 1


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "gross", "net", "ends", "node", "parent")


def part_nodes(keys: list[bytes], counts: list[int], lows: list[int], lens: list, ends: list[str], before: int, after: int) -> list[list]:
    """Rows (COLUMNS) of the trie nodes of one part.

    ``before`` and ``after``: bytes that the first string shares with the last one of the part before, and the last one with the first of the next
    (-1: no such part).  Nodes within them are shared: they carry their identity in ``node``, and their children in ``parent``.
    gross: sum over the subtree of members times characters; net: of characters of nodes that belong to this part.
    """
    tree = Tree()
    for k, key in enumerate(keys):
        tree.insert(key, k)
    first, last = min(keys), max(keys)
    tree.mark(first, "first")
    tree.mark(last, "last")
    names = {True: _names(first, before), False: _names(last, after)}
    out: list[list] = []
    stack = [(tree.root, 0, False, True)]
    while stack:
        node, start, done, top = stack.pop()
        stop = start + len(node.path) + (0 if top else 1)
        if not done:
            stack.append((node, start, True, top))
            stack += [(child, stop, False, False) for child in node.children()]
            continue
        n, low, gross, net, leaves, heads, orphans, sample = 0, None, 0, 0, 0, 0, [], None
        if node.end is not None:
            n, low, sample = counts[node.end], lows[node.end], lens[node.end]
        for child in node.children():
            n += child.n
            low = child.low if low is None else min(low, child.low)
            gross, net, leaves, heads = gross + child.gross, net + child.net, leaves + child.leaves, heads + child.heads
            orphans = orphans + child.orphans if len(orphans) >= len(child.orphans) else child.orphans + orphans
            sample = child.end if sample is None else sample
            child.orphans = None
        lowest = start if top else start + 1  # byte depths start + 1 .. stop belong to this node, 0 to the root
        for depth in range(stop // WIDTH, -(-lowest // WIDTH) - 1, -1):
            at = depth * WIDTH
            owned = not (node.first and at <= before)
            shared = not owned or (node.last and at <= after)
            size = sample[depth - 1] if depth else 0
            here = node.end if at == stop else None
            leaf = owned and heads == 0 and here is not None and not shared
            gross, net, leaves = gross + n * size, net + (size if owned else 0), leaves + leaf
            name = names[not owned].get(depth) if shared else None
            row = [low, depth, None, n, heads, leaves, gross, net, None if here is None else ends[here], name, None]
            for o in orphans:
                o[2], o[10] = (None, name) if shared else (low, None)
            out.append(row)
            orphans, heads = [row], int(owned)
        node.n, node.low, node.gross, node.net, node.leaves, node.heads, node.orphans, node.end = n, low, gross, net, leaves, heads, orphans, sample
    return out


def _names(key: bytes, upto: int) -> dict[int, bytes]:
    """Identity of each prefix of whole turns within ``upto`` bytes: digests of the prefixes, one pass."""
    if upto < 0:
        return {}
    digest, names = hashlib.md5(), {0: hashlib.md5().digest()}
    for depth in range(1, min(upto, len(key)) // WIDTH + 1):
        digest.update(key[(depth - 1) * WIDTH:depth * WIDTH])
        names[depth] = digest.copy().digest()
    return names


def rebuilt(df: DataFrame, heads: int = 6, group: int = 100, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation c with its first h turns taken from c - c % group, h = crc32(decimal c) % heads.

    ``turns``: (id, n) in order of the turn number, null first, ties by id; id is the digest of role and text (null: empty), n the text's characters.
    Texts are never shuffled, only their digests; one conversation's digests, 28 bytes a turn, meet in a row.  Rows without a conversation id are none's.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    # the role's length keeps ("ab", "c") and ("a", "bc") apart
    digest = F.unhex(F.md5(F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said).cast("binary")))
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("conv_id"), F.struct(
        F.col(turn).alias("t"), digest.alias("id"), F.length(said[1]).alias("n")).alias("turn"))
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    own = save(own.select("conv_id", F.transform("turns", lambda x: F.struct(x["id"].alias("id"), x["n"].alias("n"))).alias("turns")))
    head = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    joined = own.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(head, "base", "left")
    nothing = F.array().cast("array<struct<id: binary, n: int>>")
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("head", nothing), F.lit(1), F.col("h")),
                                             F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def _ends(convs: DataFrame) -> DataFrame:
    """(kd, ends): digest of the ids, ascending and joined by commas, of the conversations of each string.

    Ids are joined in ranges of 2^BUCKET, which bounds every group; the ranges of one string then stream in order through
    the digest, which holds no more than one of them.
    """
    pieces = convs.groupBy("kd", F.shiftright("conv_id", BUCKET).alias("range")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_set("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, digest = None, None
        for pdf in batches:
            names, found = [], []
            for kd, ids in zip(pdf["kd"], pdf["ids"]):
                if kd == last:
                    digest.update(b"," + ids.encode())
                    continue
                if last is not None:
                    names.append(last)
                    found.append(digest.hexdigest())
                last, digest = kd, hashlib.sha256(ids.encode())
            yield pd.DataFrame({"kd": names, "ends": found})
        if last is not None:
            yield pd.DataFrame({"kd": [last], "ends": [digest.hexdigest()]})

    return pieces.repartition("kd").sortWithinPartitions("kd", "range").select("kd", "ids").mapInPandas(run, "kd binary, ends string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the prefix trie of ``conversations`` (conv_id, turns as ``rebuilt`` gives them).

    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  Without conversations
    there is no node.
    """
    spark = conversations.sparkSession
    convs = conversations.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("key"),
                                 F.transform("turns", lambda t: t["n"]).alias("lens"))
    convs = save(convs.withColumn("kd", F.unhex(F.md5("key"))))
    distinct = convs.groupBy("key", "kd").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"), F.first("lens").alias("lens"))
    distinct = save(distinct.join(_ends(convs.select("kd", "conv_id")), "kd").drop("kd"))
    count, size = distinct.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()
    parts = 1 + max(count // PART, size // PART_BYTES)
    dealt = save(distinct.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()))
    borders = _borders(dealt)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = part_nodes([bytes(k) for k in pdf["key"]], pdf["n"].tolist(), pdf["low"].tolist(), pdf["lens"].tolist(), pdf["ends"].tolist(),
                          int(pdf["before"].iloc[0]), int(pdf["after"].iloc[0]))
        frame = pd.DataFrame(rows, columns=list(COLUMNS))
        return frame.astype({"parent_conv_id": "Int64"})

    fields = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, gross long, net long, ends string, "
              "node binary, parent binary")
    nodes = save(dealt.join(borders, "part").groupBy("part").applyInPandas(build, fields))
    shared = nodes.where("node is not null").groupBy("depth", "node").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "gross", "net")],
        F.max("ends").alias("ends"), F.max("parent").alias("parent"))
    shared = save(shared)
    columns = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "gross", "net", "ends", "parent")
    inner = nodes.where("node is null")
    # only children of shared nodes, and shared nodes, still ask for their parent
    asking = inner.where("parent is not null").select(*columns).union(shared.select(*columns))
    named = shared.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    asking = asking.join(named, ["depth", "parent"], "left")
    all_nodes = inner.where("parent is null").select("parent_conv_id", *columns).union(asking.select("parent_conv_id", *columns))
    return all_nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                            (F.col("gross") - F.col("net")).alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def _borders(dealt: DataFrame) -> DataFrame:
    """(part, before, after): the bytes that border strings of neighbouring parts share.  Two strings a part meet in joins, only part numbers on the driver."""
    spark = dealt.sparkSession
    ranges = save(dealt.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")))
    order = [r[0] for r in ranges.select("part").orderBy("part").collect()]
    nexts = spark.createDataFrame(list(zip(order, order[1:])), "part int, next int")
    pairs = ranges.select("part", "last").join(nexts, "part").join(ranges.select(F.col("part").alias("next"), "first"), "next")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"part": pdf["part"], "next": pdf["next"], "same": [_common(bytes(a), bytes(b)) for a, b in zip(pdf["last"], pdf["first"])]})

    same = save(pairs.select("part", "next", "last", "first").mapInPandas(compare, "part int, next int, same int"))
    out = ranges.select("part").join(same.select("part", F.col("same").alias("after")), "part", "left")
    out = out.join(same.select(F.col("next").alias("part"), F.col("same").alias("before")), "part", "left")
    return out.fillna(-1, ["before", "after"])
