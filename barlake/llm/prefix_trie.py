"""The trie of conversation prefixes, from vertical bitmaps.

A shard holds some consecutive conversations. Its index maps (position, turn) to
the set of its conversations with that turn there, as the bits of an integer.
From the root, whose set is all of the shard, the children of a node are the
intersections of its set with the postings of the next position: the lowest
conversation left names a posting, its part of the set is a child, and is taken
out. Popcounts are the members, what is left when a conversation has no further
turn are the ends. Once a set has one conversation, its remaining turns are
nodes without an intersection.

Nodes of different shards are one node if they have the same prefix, told by a
128-bit digest chained over its turns, and their counts are summed. What belongs
to whole subtrees is told by their members: a node belongs to its smallest
member, and a conversation's own nodes are the last ones of its path. The turns
before those are the ones that a trie saves it, and each node sums what its
members are saved from there on. A second pass over the shards does so.

Turns go by ``turn`` (null first), then by the SHA-256 of role and text; repeated
rows are repeated turns. Null role or text is empty. Rows without ``conv_id``
belong to no conversation. Only the four named columns are read. An empty table
has the root only if a conversation is given, so an empty result. The digest of
the ends of a node streams their ids in order, in pieces of a shard; a shard's
postings are bounded by ``MEMBERS`` and ``TURNS``, and a conversation longer
than that is a shard by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.jaccard import stored
from barlake.llm.skew import join_with_heavy_keys

MEMBERS = 1024
TURNS = 1 << 17
BLANKS = r"[^\x20\x09-\x0D]+"


# ------------------------------------------------------- conversations


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (turn digest, words)) with the turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.length(role).cast("string"), F.lit("\n"), role, F.lit("\n"), text)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(said.cast("binary"), 256).alias("name"),
        F.regexp_count(text, F.lit(BLANKS)).cast("long").alias("words"))
    entry = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "name", "words")
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    short = F.transform("turns", lambda t: F.struct(F.substring(F.unhex(t["name"]), 1, 16).alias("name"), t["words"].alias("words")))
    return listed.select("conv_id", short.alias("turns"))


def taken_over(conv_id: Column) -> Column:
    """How many turns the first conversation of twenty lends."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 4).cast("int")


def rebuilt(listed: DataFrame, group: int = 20) -> DataFrame:
    """Conversations that begin with the first turns of the first of their group of ``group`` ids."""
    base = (F.col("conv_id") - F.col("conv_id") % group)
    heads = (listed.filter(F.col("conv_id") % group == 0)
             .select(F.col("conv_id").alias("_base"), F.slice("turns", 1, 3).alias("_head")))
    own = F.slice(F.col("turns"), taken_over(F.col("conv_id")) + 1, F.greatest(F.size("turns"), F.lit(1)))
    lent = F.coalesce(F.slice(F.col("_head"), F.lit(1), taken_over(F.col("conv_id"))), F.array().cast(listed.schema["turns"].dataType))
    return listed.withColumn("_base", base).join(heads, "_base", "left").select("conv_id", F.concat(lent, own).alias("turns"))


# ---------------------------------------------------------------- shards


class Shard:
    """Some conversations in the order of their ids, and their postings."""

    def __init__(self, ids: list[int], paths: list[list[bytes]]):
        self.ids, self.paths = ids, paths
        self.postings: dict[tuple[int, bytes], int] = {}
        for member, path in enumerate(paths):
            bit = 1 << member
            for place, turn in enumerate(path):
                self.postings[place, turn] = self.postings.get((place, turn), 0) | bit

    def nodes(self) -> Iterator[tuple[bytes, bytes | None, int, int, int]]:
        """(digest, digest of the parent, depth, members, those that end here), depth first; sets are bits."""
        stack = [(b"", None, 0, (1 << len(self.ids)) - 1)]
        while stack:
            node, parent, depth, members = stack.pop()
            rest, ends = members, 0
            while rest:
                low = rest & -rest
                path = self.paths[low.bit_length() - 1]
                if len(path) == depth:
                    ends |= low
                    rest ^= low
                    continue
                child = rest & self.postings[depth, path[depth]]
                rest ^= child
                below = blake2b(node + path[depth], digest_size=16).digest()
                if child == low:
                    yield from self.tail(below, node, depth + 1, path, low)
                else:
                    stack.append((below, node, depth + 1, child))
            yield node, parent, depth, members, ends

    def tail(self, node: bytes, parent: bytes, depth: int, path: list[bytes], one: int):
        """The nodes of a single conversation from ``depth`` on."""
        while True:
            yield node, parent, depth, one, one if depth == len(path) else 0
            if depth == len(path):
                return
            node, parent, depth = blake2b(node + path[depth], digest_size=16).digest(), node, depth + 1


def shards(batches: Iterator[pa.RecordBatch], extra: tuple[str, ...], most: int,
           most_turns: int) -> Iterator[tuple[Shard, list[list[int]], list[tuple]]]:
    """(shard, words of the turns, other columns) of rows that come in the order of conv_id."""
    ids, paths, words, more, turns = [], [], [], [], 0
    for batch in batches:
        lists = batch.column("turns")
        columns = [batch.column(c).to_pylist() for c in extra]
        for at, conv in enumerate(batch.column("conv_id").to_pylist()):
            said = lists[at].values
            size = 0 if said is None else len(said)
            if ids and (len(ids) == most or turns + size > most_turns):
                yield Shard(ids, paths), words, more
                ids, paths, words, more, turns = [], [], [], [], 0
            ids.append(conv)
            paths.append(said.field("name").to_pylist() if size else [])
            words.append(said.field("words").to_pylist() if size else [])
            more.append(tuple(c[at] for c in columns))
            turns += size
    if ids:
        yield Shard(ids, paths), words, more


def members_of(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


PART = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("n", pa.int64()), ("first", pa.int64()),
                  ("n_ends", pa.int64()), ("first_end", pa.int64()), ("ends", pa.string())])
PARTS = "node binary, parent binary, depth long, n long, first long, n_ends long, first_end long, ends string"


def _counted(batches: Iterator[pa.RecordBatch], most: int = MEMBERS, most_turns: int = TURNS) -> Iterator[pa.RecordBatch]:
    """Each shard's nodes: members, the smallest of them, and those that end there in order."""
    for shard, _, _ in shards(batches, (), most, most_turns):
        ids = shard.ids
        rows = [(node, parent, depth, members.bit_count(), ids[lowest(members)], ends.bit_count(), ids[lowest(ends)] if ends else None,
                 ",".join(str(ids[m]) for m in members_of(ends)) if ends else None)
                for node, parent, depth, members, ends in shard.nodes()]
        yield from _batches(rows, PART)


def _batches(rows: list[tuple], schema: pa.Schema, size: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), size):
        columns = zip(*rows[at : at + size])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


SUM = pa.schema([("node", pa.binary()), ("leaves", pa.int64()), ("saved", pa.int64())])
SUMS = "node binary, leaves long, saved long"


def _summed(batches: Iterator[pa.RecordBatch], most: int = MEMBERS, most_turns: int = TURNS) -> Iterator[pa.RecordBatch]:
    """Each shard's nodes that conversations share: leaves that members own, words of members from here to their own nodes."""
    for shard, words, found in shards(batches, ("own", "alone", "leaf"), most, most_turns):
        leaf, own, passed, shared = 0, [], [], []
        for member, (row, (first, alone, is_leaf)) in enumerate(zip(words, found)):
            own.append(len(row) + 1 if first is None else first)
            passed.append(sum(row[: own[-1] - 1]) if own[-1] else 0)
            shared.append(len(row) + 1 if alone is None else alone)
            leaf |= bool(is_leaf) << member
        rows = []
        for node, _, depth, members, _ in shard.nodes():
            one = lowest(members)
            if depth < shared[one]:
                before = sum(words[one][: max(depth - 1, 0)])
                rows.append((node, (members & leaf).bit_count(), sum(passed[m] - before for m in members_of(members) if own[m] > depth)))
        yield from _batches(rows, SUM)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids that end at a node; pieces come node by node, in the order of ids."""
    current, state = None, None
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    for batch in batches:
        out = []
        for node, piece in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if state is not None and node == current:
                state.update(b"," + piece.encode())
                continue
            if state is not None:
                out.append((current, state.hexdigest()))
            current, state = node, sha256(piece.encode())
        yield from _batches(out, schema)
    if state is not None:
        yield from _batches([(current, state.hexdigest())], schema)


# ------------------------------------------------------------------ trie


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id, turns as of ``conversations``)."""
    convs = stored(convs, "conversations")
    parts = stored(_by_shard(convs, _counted, PARTS), "parts")
    nodes = stored(parts.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.sum("n").alias("n_convs"), F.min("first").alias("conv_id"),
        F.sum("n_ends").alias("n_ends")), "nodes")
    one = F.col("n_convs") == 1
    owners = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("own"), F.min(F.when(one, F.col("depth"))).alias("alone"),
        F.bool_or(F.col("n_ends") == F.col("n_convs")).alias("leaf"))
    sums = (_by_shard(stored(convs.join(owners, "conv_id", "left"), "owners"), _summed, SUMS)
            .groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    ends = (parts.filter("ends is not null").select("node", "first_end", "ends").repartition("node")
            .sortWithinPartitions("node", "first_end").mapInArrow(_ends, "node binary, ends_sha256 string"))
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("children"))
    trie = nodes.join(children, "node", "left").join(sums, "node", "left").join(ends, "node", "left").select(
        "node", "parent", "conv_id", "depth", "n_convs", F.coalesce("children", F.lit(0)).cast("long").alias("n_children"),
        F.when(one, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        F.when(one, 0).otherwise(F.col("saved")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
    trie = stored(trie, "trie")
    above = trie.filter("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_n"))
    shown = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    below = join_with_heavy_keys(trie.filter("parent is not null"), above, ["parent"], "_n", trie.count())
    top = trie.filter("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return below.select(*shown).unionByName(top.select(*shown))


def _by_shard(convs: DataFrame, step, schema: str) -> DataFrame:
    return convs.repartitionByRange("conv_id").sortWithinPartitions("conv_id").mapInArrow(step, schema)
