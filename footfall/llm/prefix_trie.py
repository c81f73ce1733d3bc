"""Operator 13: the prefix trie of conversations, from padded turn-id matrices.

A turn is a 128-bit id and the bytes of its text. Conversations are dealt into
ranges of (turn ids, conv_id), so those that begin alike lie side by side. A
task puts its range (a shard) into matrices of ``COLUMNS`` turns a row, shorter
rows padded, the next columns only for rows that go on; it sorts them with
lexsort, and the changes from row to row, or-ed from column to column, mark
where a node of each depth starts. ``reduceat`` then sums members, ends and
children of every depth at once.

Only nodes on the path of a shard's first or last conversation can reach into
other shards. Their parts are added up by key. Subtree sums of these boundary
nodes are running sums along the shards' paths, where each node counts on one
path only (its owner), so no chain of depths is walked step by step. A node's
children that lie whole within a shard look up their parent's smallest member
when that parent is a boundary node.

A conversation is the unit of work: its turn ids (about 60 bytes a turn, not its
texts) are held in a task. The digest of a node's ends is sequential by nature,
so its ids pass through one task in chunks of ``CHUNK`` bytes, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored
from footfall.operators.joins import salted_left_join

EVERY = 5  # a conversation takes its first turns from the one at the multiple of this below it
HEAD = 9  # of which it takes 0 to HEAD - 1
COLUMNS = 32  # turns in a row of a matrix
SHARD_TURNS = 400_000
CHUNK = 1 << 16
SALTS = 32  # tasks over which the children of one boundary node are spread
ID_HEX = 32  # hexadecimal digits of a turn id
NO_ENDS = hashlib.sha256().hexdigest()

RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NODE, EDGE, ENDS = 0, 1, 2  # kinds of a shard's rows: whole node, part of a boundary node, ids of its ends
PARTS = pa.schema([
    ("kind", pa.int32()), ("shard", pa.int32()), ("side", pa.int32()), ("key", pa.string()), ("parent_key", pa.string()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_ends", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("n_bytes", pa.int64()),
    ("ends_sha256", pa.string()), ("ids", pa.string()),
])
PARTS_SQL = (
    "kind int, shard int, side int, key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_ends long, n_children long, n_leaves long, saved_tokens long, n_bytes long, ends_sha256 string, ids string"
)


def conversation_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and ``items``, its turns in order
    (turn, nulls first; then role, then text) as structs of role, ``id`` and
    ``n_bytes`` of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.substring(F.sha2(named, 256), 1, ID_HEX).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
    )

    def listed(df: DataFrame, *order: str) -> DataFrame:
        return df.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", *order, "id", "n_bytes"))).alias("items"))

    convs = stored(listed(rows, "role"), "trie_conversations")
    # Equal turns of one role go by their texts, which only such conversations are read for again.
    before = lambda i: F.get("items", i - 1)
    same = lambda x, i: x["turn"].eqNullSafe(before(i)["turn"]) & (x["role"] == before(i)["role"]) & (x["id"] != before(i)["id"])
    tied = F.size(F.filter("items", lambda x, i: (i > 0) & same(x, i))) > 0
    marked = stored(convs.withColumn("tied", tied).filter("tied").select("conv_id"), "trie_tied")
    pick = F.transform("items", lambda x: F.struct(x["id"].alias("id"), x["n_bytes"].alias("n_bytes")))
    if marked.isEmpty():
        return convs.select("conv_id", pick.alias("items"))
    again = listed(rows.join(marked, "conv_id", "left_semi"), "role", "text")
    plain = convs.join(marked, "conv_id", "left_anti")
    return stored(plain.select("conv_id", pick.alias("items")).unionByName(again.select("conv_id", pick.alias("items"))), "trie_turns")


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations with their first turns taken from another one: ``conv_id``,
    ``path`` (the turn ids in hexadecimal, joined) and ``n_bytes`` of the texts.

    Takes the first h turns of conversation ``conv_id - conv_id % 5`` (the
    remainder has the sign of conv_id), then its own after its first h;
    h is the crc32 of the decimal conv_id modulo 9."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("int")
    heads = convs.filter(F.col("conv_id") % EVERY == 0).select(F.col("conv_id").alias("base"), F.slice("items", 1, HEAD - 1).alias("head"))
    own = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % EVERY)
    joined = own.join(heads, "base", "left")
    none = F.slice("items", 1, 0)
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("items", F.col("h") + 1, F.greatest(F.size("items"), F.lit(1))))
    return joined.select("conv_id", turns.alias("turns")).select(
        "conv_id", F.array_join(F.col("turns.id"), "").alias("path"), F.col("turns.n_bytes").alias("n_bytes")
    )


def _key(path: str, depth: int) -> list[str]:
    """Keys of a path's nodes, from the root."""
    h, out = hashlib.sha256(), []
    for d in range(depth + 1):
        out.append(f"{d}:{h.hexdigest()[:ID_HEX]}")
        h.update(path[d * ID_HEX : (d + 1) * ID_HEX].encode())
    return out


class Shard:
    """The nodes of the conversations of one range."""

    def __init__(self, convs: np.ndarray, paths: list[str], n_bytes: np.ndarray) -> None:
        self.convs, self.paths = convs, paths
        self.length = np.array([len(p) // ID_HEX for p in paths], np.int64)
        flat = np.frombuffer(bytes.fromhex("".join(paths)), ">u8").astype(np.uint64).reshape(-1, 2)
        self.start = np.cumsum(self.length) - self.length
        self.ids, self.n_bytes = flat, n_bytes
        rows = range(len(paths))
        self.first = min(rows, key=lambda i: (paths[i], convs[i]))
        self.last = max(rows, key=lambda i: (paths[i], convs[i]))
        # Per node, in order of depth.
        self.node: dict[str, list[np.ndarray]] = {k: [] for k in ("depth", "parent", "n", "least", "ends", "bytes", "edge")}
        self.levels: list[tuple[int, int]] = []  # from and to of the nodes of each depth in a block
        self.end_rows: list[np.ndarray] = []  # rows that end, with their nodes
        self.end_nodes: list[np.ndarray] = []
        self.side_nodes: tuple[list[int], list[int]] = ([], [])  # of the first and the last row
        self.count = 0
        self._build()

    def _level(self, rows: np.ndarray, starts: np.ndarray, depth: int, parents: np.ndarray) -> np.ndarray:
        """Adds the nodes of one depth; ``starts`` are where runs of equal
        prefixes begin among the sorted ``rows``. Returns the node of each row
        (its parent's, of rows that are shorter)."""
        here = self.length[rows[starts]] >= depth
        sizes = np.diff(np.append(starts, len(rows)))
        number = np.full(len(starts), -1, np.int64)
        number[here] = self.count + np.arange(int(here.sum()))
        ending = self.length[rows] == depth
        of = np.repeat(number, sizes)
        at = rows[starts[here]]
        add = self.node
        add["depth"].append(np.full(len(at), depth, np.int64))
        add["parent"].append(parents[starts[here]])
        add["n"].append(sizes[here].astype(np.int64))
        add["least"].append(np.minimum.reduceat(self.convs[rows], starts)[here])
        add["ends"].append(np.add.reduceat(ending.astype(np.int64), starts)[here])
        add["bytes"].append(self.n_bytes[self.start[at] + depth - 1] if depth else np.zeros(len(at), np.int64))
        edge = np.zeros(len(at), bool)
        for side, row in enumerate((self.first, self.last)):
            found = np.flatnonzero(rows == row)
            if len(found) and self.length[row] >= depth:
                node = int(of[found[0]])
                edge[node - self.count] = True
                self.side_nodes[side].append(node)
        add["edge"].append(edge)
        self.end_rows.append(rows[ending])
        self.end_nodes.append(of[ending])
        self.levels.append((self.count, self.count + len(at)))
        self.count += len(at)
        return np.where(of >= 0, of, parents)

    def _build(self) -> None:
        rows = np.argsort(self.convs, kind="stable")
        above = self._level(rows, np.zeros(1, np.int64), 0, np.full(len(rows), -1, np.int64))
        group = np.zeros(len(rows), np.int64)
        depth = 0
        while len(rows):
            longer = self.length[rows] > depth
            rows, above, group = rows[longer], above[longer], group[longer]
            if not len(rows):
                break
            width = int(min(COLUMNS, (self.length[rows] - depth).max()))
            matrix = np.zeros((len(rows), width, 2), np.uint64)
            for d in range(width):
                has = self.length[rows] > depth + d
                matrix[has, d] = self.ids[self.start[rows[has]] + depth + d]
            keys = [matrix[:, d, half] for d in range(width - 1, -1, -1) for half in (1, 0)]
            order = np.lexsort([self.convs[rows], *keys, group])
            rows, above, group, matrix = rows[order], above[order], group[order], matrix[order]
            change = np.ones((len(rows), width), bool)
            change[1:] = (matrix[1:] != matrix[:-1]).any(axis=2)
            change[1:, 0] |= group[1:] != group[:-1]
            change = np.logical_or.accumulate(change, axis=1)
            for d in range(width):
                above = self._level(rows, np.flatnonzero(change[:, d]), depth + d + 1, above)
            group = np.cumsum(change[:, -1])
            depth += width

    def parts(self, shard: int) -> Iterator[dict]:
        """Columns of the shard's rows: whole nodes, parts of boundary nodes, ids of their ends."""
        depth, parent, n, least, ends, size, edge = (np.concatenate(self.node[k]) for k in ("depth", "parent", "n", "least", "ends", "bytes", "edge"))
        saved = np.where(edge, 0, (n - 1) * size)
        leaves = np.where(edge, 0, ends == n).astype(np.int64)
        children = np.zeros(len(n), np.int64)
        whole = np.flatnonzero(~edge)
        np.add.at(children, parent[whole], 1)  # a whole node has a parent: the root is a boundary node
        for lo, hi in reversed(self.levels[1:]):
            np.add.at(saved, parent[lo:hi], saved[lo:hi])
            np.add.at(leaves, parent[lo:hi], leaves[lo:hi])

        keys: dict[int, str] = {}
        for row, nodes in zip((self.first, self.last), self.side_nodes):
            keys |= zip(nodes, _key(self.paths[row], len(nodes) - 1))
        open_ends = {s[-1] for s in self.side_nodes}  # other shards may hold ends of these

        end_rows, end_nodes = np.concatenate(self.end_rows), np.concatenate(self.end_nodes)
        by = np.lexsort((self.convs[end_rows], end_nodes))
        end_rows, end_nodes = end_rows[by], end_nodes[by]
        cut = np.flatnonzero(np.diff(end_nodes)) + 1
        digest: dict[int, str] = {}
        chunks: list[tuple[str, int, str]] = []
        for some in np.split(np.arange(len(end_nodes)), cut) if len(end_nodes) else []:
            node, ids = int(end_nodes[some[0]]), self.convs[end_rows[some]]
            if node not in open_ends:
                digest[node] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
                continue
            step = CHUNK // 20
            chunks += [(keys[node], int(ids[a]), ",".join(map(str, ids[a : a + step].tolist()))) for a in range(0, len(ids), step)]

        inner = edge[parent[whole]]
        yield {
            "kind": np.full(len(whole), NODE), "conv_id": least[whole], "depth": depth[whole],
            "parent_conv_id": pa.array(least[parent[whole]], mask=inner), "parent_key": [keys.get(p) if e else None for p, e in zip(parent[whole].tolist(), inner)],
            "n_convs": n[whole], "n_children": children[whole], "n_leaves": leaves[whole], "saved_tokens": saved[whole],
            "ends_sha256": [digest.get(i, NO_ENDS) for i in whole.tolist()],
        }
        given: set[int] = set()
        for side, nodes in enumerate(self.side_nodes):
            at = np.array(nodes, np.int64)
            new = np.array([i not in given for i in nodes])  # a node on both paths gives its part once
            given.update(nodes)
            part = lambda values: np.where(new, values[at], 0)
            yield {
                "kind": np.full(len(at), EDGE), "shard": np.full(len(at), shard), "side": np.full(len(at), side),
                "key": [keys[i] for i in nodes], "parent_key": [None, *(keys[i] for i in nodes[:-1])], "conv_id": least[at], "depth": depth[at],
                "n_convs": part(n), "n_ends": part(ends), "n_children": part(children), "n_leaves": part(leaves), "saved_tokens": part(saved),
                "n_bytes": size[at], "ends_sha256": [digest.get(i) for i in nodes],
            }
        if chunks:
            yield {"kind": np.full(len(chunks), ENDS), "key": [c[0] for c in chunks], "conv_id": [c[1] for c in chunks], "ids": [c[2] for c in chunks]}


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    rows = pa.Table.from_batches(table)
    sizes = rows["n_bytes"].combine_chunks()
    made = Shard(rows["conv_id"].to_numpy(), rows["path"].to_pylist(), sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
    for part in made.parts(TaskContext.get().partitionId()):
        n = len(part["kind"])
        columns = [pa.array(part[f.name], f.type) if f.name in part else pa.nulls(n, f.type) for f in PARTS]
        for at in range(0, n, 50_000):
            yield pa.RecordBatch.from_arrays([c.slice(at, 50_000) for c in columns], schema=PARTS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest per key of chunks that come in order of key, then place."""
    key, h = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([h.hexdigest()])], names=["key", "open_sha256"])

    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k != key:
                if h is not None:
                    yield row()
                key, h = k, hashlib.sha256()
            else:
                h.update(b",")
            h.update(ids.encode())
    if h is not None:
        yield row()


def _boundary(parts: DataFrame) -> DataFrame:
    """The boundary nodes, whole: their shards' parts added up."""
    edges = parts.filter(F.col("kind") == EDGE)
    ends = parts.filter(F.col("kind") == ENDS).select("key", "conv_id", "ids")
    ends = ends.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ids").mapInArrow(_digests, "key string, open_sha256 string")
    nodes = stored(
        edges.groupBy("key")
        .agg(
            F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_ends", "n_children", "n_leaves", "saved_tokens")],
            F.max("n_bytes").alias("n_bytes"), F.max("ends_sha256").alias("ends_sha256"), F.min(F.struct("shard", "side")).alias("owner"),
        )
        .join(ends, "key", "left")
        .withColumn("ends_sha256", F.coalesce("open_sha256", "ends_sha256", F.lit(NO_ENDS)))
        .drop("open_sha256"),
        "trie_boundary",
    )
    own = nodes.select("key", "owner", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saves"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"))
    steps = salted_left_join(edges.select("key", "shard", "side", "depth"), own, ["key"], SALTS, "shard")
    mine = (F.struct("shard", "side") == F.col("owner")).cast("long")
    upward = Window.partitionBy("shard", "side").orderBy(F.desc("depth"))
    below = steps.withColumn("mine", mine).select(
        "key",
        F.sum(F.col("mine") * F.col("saves")).over(upward).alias("saves"),
        F.sum(F.col("mine") * F.col("leaf")).over(upward).alias("leaves"),
        F.coalesce(F.lag("mine").over(upward), F.lit(0)).alias("child"),
    )
    below = below.groupBy("key").agg(F.sum("saves").alias("saves"), F.sum("leaves").alias("leaves"), F.sum("child").alias("child"))
    return stored(
        nodes.join(below, "key").select(
            "key", "parent_key", "conv_id", "depth", "n_convs", (F.col("n_children") + F.col("child")).alias("n_children"),
            (F.col("n_leaves") + F.col("leaves")).alias("n_leaves"), (F.col("saved_tokens") + F.col("saves")).alias("saved_tokens"), "ends_sha256",
        ),
        "trie_boundary_nodes",
    )


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``paths`` (``conv_id``, ``path``,
    ``n_bytes``; see ``rebuilt``): smallest member ``conv_id``, ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``."""
    spark = paths.sparkSession
    held = stored(paths, "trie_paths")
    turns = held.agg(F.sum(F.size("n_bytes"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    parts = stored(held.repartitionByRange(shards, "path", "conv_id").mapInArrow(_shards, PARTS_SQL), "trie_parts")
    edges = _boundary(parts)
    unknown = edges.withColumn("parent_conv_id", F.lit(None).cast("long"))
    nodes = parts.filter(F.col("kind") == NODE).select(*RESULT, "parent_key").unionByName(unknown.select(*RESULT, "parent_key"))
    up = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of_edge"))
    known = nodes.filter(F.col("parent_key").isNull())
    asking = salted_left_join(nodes.filter(F.col("parent_key").isNotNull()), up, ["parent_key"], SALTS, "conv_id")
    asking = asking.withColumn("parent_conv_id", F.col("of_edge"))
    return known.select(*RESULT).unionByName(asking.select(*RESULT))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt conversations of ``turns``.

    Rows without a conv_id take no part. Null roles and texts are empty; equal
    turns of a conversation go by role, then text, and rows that repeat are
    turns of their own. A conversation without turns is a member of the root
    alone. An empty table has no node, not even the root. Other columns are
    not used."""
    return prefix_trie(rebuilt(conversation_turns(turns)))


def conversation_trie_sql() -> str:
    """The same in DuckDB SQL; the crc32 is folded bit by bit."""
    crc = (
        "xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(cast(conv_id AS VARCHAR), ''), "
        "lambda b: [ascii(b), -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"
    )
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list({{'id': sha256(strlen(role) || ':' || role || text), 'n': strlen(text)}} ORDER BY turn NULLS FIRST, role, text) AS items
  FROM t GROUP BY conv_id
),
h AS (SELECT conv_id, items, conv_id - conv_id % {EVERY} AS base, cast({crc} % {HEAD} AS BIGINT) AS h FROM own),
r AS MATERIALIZED (
  SELECT h.conv_id, list_concat(coalesce(b.items[1:h.h], []), h.items[h.h + 1:]) AS items
  FROM h LEFT JOIN own b ON b.conv_id = h.base
),
steps AS (
  SELECT conv_id, d, len(items) AS len, list_transform(items[1:d], lambda x: x.id) AS p, CASE WHEN d > 0 THEN items[d].n ELSE 0 END AS n
  FROM (SELECT conv_id, items, unnest(range(0, len(items) + 1)) AS d FROM r)
),
nodes AS MATERIALIZED (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n) AS saves, count(*) FILTER (WHERE len = d) = count(*) AS leaf,
         sha256(coalesce(string_agg(cast(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len = d), '')) AS ends_sha256
  FROM steps GROUP BY p, d
),
up AS (
  SELECT p[1:a] AS p, a AS d, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saves) AS saved, count(*) FILTER (WHERE a = d - 1) AS n_children
  FROM (SELECT p, d, leaf, saves, unnest(range(0, d + 1)) AS a FROM nodes) GROUP BY p[1:a], a
)
SELECT nodes.conv_id, nodes.d AS depth, above.conv_id AS parent_conv_id, nodes.n_convs, up.n_children, up.n_leaves,
       cast(up.saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN up ON up.p = nodes.p AND up.d = nodes.d
LEFT JOIN nodes above ON above.d = nodes.d - 1 AND above.p = nodes.p[1:nodes.d - 1]"""
