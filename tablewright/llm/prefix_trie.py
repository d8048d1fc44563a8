"""A trie of conversation prefixes from vertical bitmaps.

Conversations are cut by id into shards of some thousands. A shard indexes
(position, turn) to a bitset of its conversations, and a depth-first walk
intersects a node's bitset with the postings of the next position: what is left
is a child, its bits are the members. Nodes of shards that stand for the same
prefix are known by a hash chained over the turns and are added up; what a whole
subtree holds is summed inside shards, each node by the one shard whose
conversation is its smallest member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.session import map_arrow, materialize

SHARD_CONVS = 4096
SHARD_TURNS = 1 << 16
ROOT = bytes(16)


@dataclass
class Trie:
    """``nodes``: key (128-bit hash of the prefix), depth, conv_id (smallest member), parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens. ``ends``: key, part, shard, conv_ids; the ids that end
    at a node, ascending within a row and along (part, shard)."""

    nodes: DataFrame
    ends: DataFrame


def turn_key(role: Column, text: Column) -> Column:
    """128-bit hash of a turn; a null role or text is the empty one."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def numbered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, at (from 0), key, tokens (code points of the text).

    Turns order by number, null first, then by their hash; rows without a
    conversation's id belong to none. Only hashes and lengths are shuffled.
    """
    c = conversations
    rows = c.where(c[conv].isNotNull()).select(
        c[conv].cast("long").alias("conv_id"), c[turn].alias("turn"), turn_key(c[role], c[text]).alias("key"),
        F.length(F.coalesce(c[text], F.lit(""))).cast("long").alias("tokens"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "key")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("at"), "key", "tokens")


def bits(x: int) -> Iterator[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


class Shard:
    """The conversations of a shard, in ascending order of their ids."""

    def __init__(self):
        self.ids: list[int] = []
        self.paths: list[list[bytes]] = []
        self.tokens: list[list[int]] = []
        self.turns = 0

    def index(self) -> tuple[list[dict[bytes, int]], dict[int, int]]:
        """Postings by position, and the conversations that end at a depth."""
        postings: list[dict[bytes, int]] = []
        ends: dict[int, int] = {}
        for i, path in enumerate(self.paths):
            bit = 1 << i
            postings += [{} for _ in range(len(path) - len(postings))]
            for own, turn in zip(postings, path):
                own[turn] = own.get(turn, 0) | bit
            ends[len(path)] = ends.get(len(path), 0) | bit
        return postings, ends

    def nodes(self) -> list[tuple]:
        """(parent number, depth, key, parent key, tokens, conv_id, n_convs, ends), parents before children."""
        postings, ends = self.index()
        out: list[tuple] = []
        todo = [((1 << len(self.ids)) - 1, 0, ROOT, None, -1)]
        while todo:
            members, depth, key, above, parent = todo.pop()
            done = members & ends.get(depth, 0)
            first = (members & -members).bit_length() - 1
            tokens = self.tokens[first][depth - 1] if depth else 0
            out.append((parent, depth, key, above, tokens, self.ids[first], members.bit_count(), [self.ids[i] for i in bits(done)]))
            number, rest, children = len(out) - 1, members ^ done, []
            while rest:
                turn = self.paths[(rest & -rest).bit_length() - 1][depth]
                child = rest & postings[depth][turn]
                rest ^= child
                children.append((child, depth + 1, hashlib.blake2b(key + turn, digest_size=16).digest(), key, number))
            todo += reversed(children)
        return out


LOCAL = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("node", pa.int32()), ("size", pa.int32()), ("parent", pa.int32()), ("depth", pa.int64()), ("key", pa.binary()),
    ("parent_key", pa.binary()), ("tokens", pa.int64()), ("own_id", pa.int64()), ("own_convs", pa.int64()), ("conv_ids", pa.list_(pa.int64())),
])
LOCAL_SQL = ("part int, shard int, node int, size int, parent int, depth long, key binary, parent_key binary, tokens long, own_id long, own_convs long, "
             "conv_ids array<long>")


def _local(shard_convs: int, shard_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, shard = TaskContext.get().partitionId(), 0, Shard()

        def flush():
            rows = shard.nodes()
            size = np.ones(len(rows), np.int64)
            for i in range(len(rows) - 1, 0, -1):
                size[rows[i][0]] += size[i]
            parent, *cols = zip(*rows)
            heads = [[part] * len(rows), [number] * len(rows), range(len(rows)), size, parent]
            for a in range(0, len(rows), 8192):
                yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 8192], f.type) for c, f in zip([*heads, *cols], LOCAL)], schema=LOCAL)

        for batch in batches:
            for conv, key, tokens in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "tokens"))):
                if not shard.ids or shard.ids[-1] != conv:
                    if len(shard.ids) >= shard_convs or shard.turns >= shard_turns:
                        yield from flush()
                        number, shard = number + 1, Shard()
                    shard.ids.append(conv)
                    shard.paths.append([])
                    shard.tokens.append([])
                if key is not None:
                    shard.paths[-1].append(key)
                    shard.tokens[-1].append(tokens)
                    shard.turns += 1
        if shard.ids:
            yield from flush()

    return run


SUMS = "key binary, parent_conv_id long, n_leaves long, saved_tokens long"


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the subtrees of each shard; rows come by shard and node."""
    held: list[pa.RecordBatch] = []

    def flush():
        t = pa.Table.from_batches(held)
        size, parent, tokens, own, conv, n, children = (t.column(c).to_numpy() for c in ("size", "parent", "tokens", "own_id", "conv_id", "n_convs", "n_children"))
        mine = own == conv  # each prefix counts in the shard of its smallest member
        at = np.arange(len(size))

        def below(values):
            total = np.append(0, np.cumsum(np.where(mine, values, 0)))
            return pa.array(total[at + size] - total[at], pa.int64())

        above = pa.array(conv[np.maximum(parent, 0)], pa.int64(), mask=parent < 0)
        yield from pa.table([t.column("key"), above, below((children == 0).astype(np.int64)), below((n - 1) * tokens)],
                            ["key", "parent_conv_id", "n_leaves", "saved_tokens"]).to_batches(8192)

    for batch in batches:
        node = batch.column("node").to_numpy()
        starts = np.flatnonzero(node == 0).tolist()
        for a, b in zip([0, *starts], [*starts, batch.num_rows]):
            if held and a < len(node) and node[a] == 0:
                yield from flush()
                held.clear()
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield from flush()


def prefix_trie(rows: DataFrame, shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS) -> Trie:
    """The trie of ``rows``: conv_id, at (order within it), key (a turn's hash), tokens.

    A row with a null key stands for its conversation alone, so one without turns
    can be named. A conversation's turns are all of its rows in order of ``at``.
    The root has depth 0 and is there as soon as a conversation is; an empty table
    gives no nodes. saved_tokens of a node: over its subtree, (n_convs - 1) times
    the tokens of the last turn.

    A task streams its range of ids and holds one shard: ``shard_convs``
    conversations or ``shard_turns`` turns, or one longer conversation (50 bytes a
    turn). A prefix sends one row per shard that knows it, so a common one (the
    root, a common first turn) is as many rows as there are shards.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("conv_id", "at", "key", "tokens").repartitionByRange(n, "conv_id").sortWithinPartitions("conv_id", "at")
    local = materialize(map_arrow(dealt, _local(shard_convs, shard_turns), LOCAL_SQL), "trie-shards")
    found = local.groupBy("key").agg(F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("own_id").alias("conv_id"), F.sum("own_convs").alias("n_convs"))
    found = materialize(found, "trie-prefixes")
    below = found.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    found = materialize(found.join(below, "key", "left").select("key", "depth", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")), "trie-prefixes")
    known = local.drop("conv_ids", "depth", "parent_key").join(found.drop("depth"), "key")
    sums = map_arrow(known.repartition(n, "part", "shard").sortWithinPartitions("part", "shard", "node"), _subtrees, SUMS)
    sums = sums.groupBy("key").agg(F.max("parent_conv_id").alias("parent_conv_id"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    return Trie(found.join(sums, "key"), local.where(F.size("conv_ids") > 0).select("key", "part", "shard", "conv_ids"))


def last_turns(trie: Trie, turns: DataFrame) -> DataFrame:
    """``nodes`` with the columns of the turn that each ends in; ``turns``: conv_id, at and any more."""
    named = turns.withColumns({"depth": F.col("at") + 1}).drop("at")
    return trie.nodes.join(named, ["conv_id", "depth"], "left")


def end_digests(trie: Trie) -> DataFrame:
    """key, ends_sha256 of every node where conversations end: their ids, ascending, comma-joined.

    A digest reads its list from front to back, so one node's rows meet in one
    task; they are streamed, packed by shard.
    """
    spark = trie.ends.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = trie.ends.select("key", "part", "shard", F.array_join(F.transform("conv_ids", lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def batch_of(pairs):
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in pairs], pa.binary()), pa.array([d for _, d in pairs], pa.string())], ["key", "ends_sha256"])

        for batch in batches:
            out = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k == key:
                    digest.update(b"," + ids.encode())
                else:
                    if key is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(ids.encode())
            yield batch_of(out)
        if key is not None:
            yield batch_of([(key, digest.hexdigest())])

    return map_arrow(text.repartition(n, "key").sortWithinPartitions("key", "part", "shard"), run, "key binary, ends_sha256 string")


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations that begin with the head of another, in the form that ``prefix_trie`` reads.

    Conversation c begins with the first h turns of c - c % ``every``, then has
    its own after its first h; h is the unsigned crc32 of its decimal id modulo
    ``most``. A row with a null key names each.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    turns = materialize(turns, "turns")
    convs = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("at") < most - 1)).withColumnRenamed("conv_id", "base")
    begin = convs.join(heads, "base").where("at < h").select("conv_id", "at", "key", "tokens")
    # the own turns stand behind every head
    own = turns.where(F.col("at") >= h).select("conv_id", (F.col("at") + most).alias("at"), "key", "tokens")
    return convs.select("conv_id", F.lit(-1).cast("long").alias("at")).unionByName(begin, allowMissingColumns=True).unionByName(own)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    trie = prefix_trie(rebuilt(numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
    nothing = hashlib.sha256(b"").hexdigest()
    return trie.nodes.join(end_digests(trie), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


QUERIES = {"op12_prefix_trie": op12_prefix_trie}
SQL = {
    "op12_prefix_trie": r"""
with crc_table as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)),
turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, unhex(k)) - 1 as pos, k, tok
  from (select conv_id, turn, length(coalesce(text, '')) as tok, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as k
        from conversations where conv_id is not null)),
convs as (
  select c, c - c % 100 as base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6 as h
  from (select distinct conv_id as c from conversations where conv_id is not null), crc_table),
joined as (
  select c, 0 as part, pos, k, tok from convs join turns on conv_id = base and pos < h
  union all select c, 1, pos, k, tok from convs join turns on conv_id = c and pos >= h),
seq as (select c, row_number() over w as d, tok, md5(string_agg(k, '') over w) as key from joined window w as (partition by c order by part, pos)),
paths as (select c, d, key, tok from seq union all select c, 0, '', 0 from convs),
lens as (select c, max(d) as n from paths group by c),
nodes as (select key, d, min(c) as conv_id, count(*) as n_convs, max(tok) as tok from paths group by key, d),
edges as (select distinct n.key, p.key as parent from paths n join paths p on n.c = p.c and n.d = p.d + 1),
kids as (select parent as key, count(*) as n_children from edges group by parent),
below as (select distinct a.key as top, b.key from paths a join paths b on a.c = b.c and b.d >= a.d),
sums as (
  select top as key, sum((n_convs - 1) * tok)::bigint as saved_tokens, count(*) filter (kids.key is null) as n_leaves
  from below join nodes using (key) left join kids using (key) group by top),
ends as (select p.key, string_agg(p.c::varchar, ',' order by p.c) as ids from paths p join lens on p.c = lens.c and p.d = lens.n group by p.key)
select n.conv_id, n.d as depth, up.conv_id as parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) as n_children, sums.n_leaves, sums.saved_tokens,
       sha256(coalesce(ends.ids, '')) as ends_sha256
from nodes n join sums using (key) left join kids using (key) left join ends using (key) left join edges using (key) left join nodes up on up.key = edges.parent"""
}
