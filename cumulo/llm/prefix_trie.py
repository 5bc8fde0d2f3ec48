"""Conversation prefix trie: ternary search trees over dictionary-encoded turns, one per range shard.

1. `encode_turns`: distinct turns (role, text) get a dictionary id; a conversation becomes the array of
   its turn ids and, aligned with it, of their word counts. Turns that hold a large share of the rows
   (fewer than `HOT` can) are looked up by broadcast, the others by a shuffled join.
2. Conversations with equal arrays are one sequence: members are sorted by (sequence, id) over all
   partitions, written as chunks of id text, and the chunks of a sequence are hashed one after the other
   as a stream, so no list of members is ever held.
3. Distinct sequences are sorted and dealt by range into shards. Each shard inserts its sequences into a
   ternary search tree, the median first, then the medians of both halves and so on, which keeps the
   trees between siblings balanced. An iterative traversal gives each node its parent and depth, and in
   reverse order members, children, leaves and savings are accumulated.
4. Only prefixes of a shard's first and last sequence can go on in another shard. These boundary nodes
   are not finished: the two paths, with what has been accumulated below each of their nodes, are the
   sequences of the next, far smaller level, which is treated in the same way until one shard is left.
5. A finished node whose parent is a boundary node gets the parent's number by a join on the shard and
   the chained digest of the parent's prefix.

A node is told by its smallest member and its depth: nodes of one depth share no members.

Defined cases: rows with a NULL conversation id belong to no conversation; NULL roles and texts are
empty; turns are ordered by number, NULL first, those of one number by role and then by the digest of
the text; a row that comes twice is two turns; a conversation without turns is a member of the root
alone; conversations that repeat an id in `prefix_trie` count as members each; an empty table has no
node; other columns are not looked at. A conversation is one array (16 bytes a turn), since it is one
path of the trie; texts are never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cumulo.llm.common import materialise, words

HOT = 1000  # a turn is hot if it has more than 1 / HOT of all rows
CHUNK = 1 << 16  # characters of member ids hashed at once
SHARD = 200_000  # turns of a shard's sequences, at most (but for one longer sequence)
LEAST = 5_000  # turns that make a shard of their own where there are tasks enough
MERGED = 8  # boundary paths of a shard of the next level, at least
_OWN = "array<struct<d:int,members:long,least:long,children:long,leaves:long,saved:long,ends:string>>"
_PATHS = f"seq array<long>, words array<long>, own {_OWN}"
_NODES = ("least long, depth long, parent long, parent_key binary, key binary, members long, children long, leaves long, "
          "saved long, ends string")
NOTHING = hashlib.sha256(b"").hexdigest()


# -- sequences ------------------------------------------------------------------------------------

def encode_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per conversation: id, seq (turn ids in order), words (words of each turn)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    role = F.coalesce(F.col(f"`{role_col}`"), F.lit(""))
    turns = rows.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"),
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.unhex(F.sha2(text, 256)).alias("tie"), F.size(words(text)).cast("long").alias("n_words"))
    distinct = turns.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("n_words").alias("n_words"))
    dictionary = materialise(distinct.withColumn("turn_id", F.monotonically_increasing_id()), "turn-dictionary")
    total = dictionary.agg(F.sum("n")).first()[0] or 0
    hot = dictionary.where(F.col("n") * HOT > total).select("digest", F.col("turn_id").alias("hot_id"))
    marked = turns.join(F.broadcast(hot), "digest", "left")
    rest = dictionary.where(F.col("n") * HOT <= total).select("digest", "turn_id")
    cold = marked.where("hot_id IS NULL").drop("hot_id").join(rest, "digest")
    both = marked.where("hot_id IS NOT NULL").withColumnRenamed("hot_id", "turn_id").unionByName(cold)
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "tie", "turn_id", "n_words")
    ordered = both.groupBy("id").agg(F.sort_array(F.collect_list(place)).alias("t"))
    return ordered.select("id", F.col("t.turn_id").alias("seq"), F.col("t.n_words").alias("words"))


def _member_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members sorted by (key, id) -> (key, first, last, n, text of the ids, seq, words)."""
    open_: dict = {"key": None, "ids": [], "size": 0}

    def row():
        ids = open_["ids"]
        return {"key": open_["key"], "first": ids[0], "last": ids[-1], "n": len(ids), "text": ",".join(map(str, ids)),
                "seq": open_["seq"], "words": open_["words"]}

    schema = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("last", pa.int64()), ("n", pa.int64()),
                        ("text", pa.string()), ("seq", pa.list_(pa.int64())), ("words", pa.list_(pa.int64()))])
    for b in batches:
        out = []
        for key, i, seq, count in zip(*(b.column(c).to_pylist() for c in ("key", "id", "seq", "words"))):
            if open_["ids"] and (key != open_["key"] or open_["size"] >= CHUNK):
                out.append(row())
                open_["ids"], open_["size"] = [], 0
            open_["key"], open_["seq"], open_["words"] = key, seq, count
            open_["ids"].append(i)
            open_["size"] += 12
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if open_["ids"]:
        yield pa.RecordBatch.from_pylist([row()], schema)


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by (key, first, last) -> a path for each key with its members at the end."""
    at: dict = {"key": None}

    def path():
        own = {"d": len(at["seq"]), "members": at["n"], "least": at["least"], "children": 0, "leaves": 0, "saved": 0,
               "ends": at["hash"].hexdigest()}
        return {"seq": at["seq"], "words": at["words"], "own": [own]}

    for b in batches:
        out = []
        for key, first, n, text, seq, count in zip(*(b.column(c).to_pylist()
                                                     for c in ("key", "first", "n", "text", "seq", "words"))):
            if key == at["key"]:
                at["hash"].update(b",")
                at["n"] += n
            else:
                if at["key"] is not None:
                    out.append(path())
                at = {"key": key, "hash": hashlib.sha256(), "n": n, "least": first, "seq": seq, "words": count}
            at["hash"].update(text.encode())
        if out:
            yield pa.RecordBatch.from_pylist(out, _ARROW_PATHS)
    if at["key"] is not None:
        yield pa.RecordBatch.from_pylist([path()], _ARROW_PATHS)


_ARROW_OWN = pa.struct([("d", pa.int32()), ("members", pa.int64()), ("least", pa.int64()), ("children", pa.int64()),
                        ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())])
_ARROW_PATHS = pa.schema([("seq", pa.list_(pa.int64())), ("words", pa.list_(pa.int64())), ("own", pa.list_(_ARROW_OWN))])


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """(seq, words, own): one path for each distinct sequence, `own` has its members at the last depth."""
    key = F.unhex(F.sha2(F.concat_ws(",", F.col("seq").cast("array<string>")), 256))
    members = sequences.where("id IS NOT NULL").select(key.alias("key"), "id", "seq", "words")
    chunks = members.repartitionByRange("key", "id").sortWithinPartitions("key", "id").mapInArrow(
        _member_chunks, "key binary, first long, last long, n long, text string, seq array<long>, words array<long>")
    return chunks.repartition("key").sortWithinPartitions("key", "first", "last").mapInArrow(_hash_chunks, _PATHS)


# -- the tree of a shard ----------------------------------------------------------------------------

class TernaryTree:
    """Ternary search tree; node 0 is the root of the trie, every other node ends one prefix."""

    def __init__(self):
        self.split, self.low, self.equal, self.high, self.words = [0], [-1], [-1], [-1], [0]

    def insert(self, seq: list[int], words: list[int]) -> list[int]:
        """The nodes of the prefixes of `seq`, from the root on."""
        split, low, equal, high = self.split, self.low, self.equal, self.high
        links, at, path = equal, 0, [0]
        for turn, n in zip(seq, words):
            node = links[at]
            while node >= 0 and split[node] != turn:
                links, at = (low, node) if turn < split[node] else (high, node)
                node = links[at]
            if node < 0:
                node = links[at] = len(split)
                split.append(turn)
                for links_of in (low, equal, high):
                    links_of.append(-1)
                self.words.append(n)
            path.append(node)
            links, at = equal, node
        return path

    def walk(self) -> tuple[list[int], list[int], list[int]]:
        """Nodes in an order in which parents come first, and parent and depth of each node."""
        order, parent, depth = [0], [-1] * len(self.split), [0] * len(self.split)
        todo = [(self.equal[0], 0, 1)]
        while todo:
            node, up, d = todo.pop()
            if node < 0:
                continue
            order.append(node)
            parent[node], depth[node] = up, d
            todo += ((self.low[node], up, d), (self.high[node], up, d), (self.equal[node], node, d + 1))
        return order, parent, depth


def medians_first(n: int) -> Iterator[int]:
    """0 .. n-1, the middle one first, then the middles of both halves and so on."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            todo += ((a, mid), (mid + 1, b))


def _chain(key: bytes, turn: int) -> bytes:
    return hashlib.blake2b(key + turn.to_bytes(8, "little", signed=True), digest_size=16).digest()


def build_shard(paths: list[dict], last_level: bool, keyed: bool) -> tuple[list[dict], list[dict]]:
    """(finished nodes, boundary paths) of sorted distinct paths. `keyed`: nodes carry their prefix digest."""
    tree, where = TernaryTree(), [None] * len(paths)
    for i in medians_first(len(paths)):
        where[i] = tree.insert(paths[i]["seq"], paths[i]["words"])
    n = len(tree.split)
    members, least, children, leaves, saved, ends = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n, [None] * n
    for path, nodes in zip(paths, where):
        for own in path["own"]:
            node = nodes[own["d"]]
            members[node] += own["members"]
            children[node] += own["children"]
            leaves[node] += own["leaves"]
            saved[node] += own["saved"]
            if own["least"] is not None and (least[node] is None or own["least"] < least[node]):
                least[node] = own["least"]
            ends[node] = ends[node] or own["ends"]
    order, parent, depth = tree.walk()
    boundary = set() if last_level else {*where[0], *where[-1]}
    key: dict[int, bytes] = {}
    for node in order:
        if keyed or node in boundary:
            key[node] = _chain(key[parent[node]], tree.split[node]) if node else b""
    finished = []
    for node in reversed(order):
        if node in boundary:
            continue
        saved[node] += (members[node] - 1) * tree.words[node]
        if not children[node]:
            leaves[node] = 1
        up = parent[node]
        if up >= 0:
            members[up] += members[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            if least[up] is None or least[node] < least[up]:
                least[up] = least[node]
        finished.append(node)
    rows = [{"least": least[x], "depth": depth[x],
             "parent": least[parent[x]] if x and parent[x] not in boundary else None,
             "parent_key": key[parent[x]] if x and parent[x] in boundary else None,
             "key": key.get(x), "members": members[x], "children": children[x], "leaves": leaves[x], "saved": saved[x],
             "ends": ends[x]} for x in finished]
    outer, done = [], set()
    for i in sorted({0, len(paths) - 1}) if boundary else ():
        own = [{"d": d, "members": members[x], "least": least[x], "children": children[x], "leaves": leaves[x],
                "saved": saved[x], "ends": ends[x]} for d, x in enumerate(where[i]) if x not in done]
        done.update(where[i])
        outer.append({"seq": paths[i]["seq"], "words": paths[i]["words"], "own": own})
    return rows, outer


def _shard_job(last_level: bool, keyed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = [row for b in batches for row in b.to_pylist()]
        if not paths:
            return
        rows, outer = build_shard(paths, last_level, keyed)
        shard = TaskContext.get().partitionId()
        schema = pa.schema([("shard", pa.int64()), ("node", _ARROW_NODE), ("path", pa.struct(list(_ARROW_PATHS)))])
        out = [{"shard": shard, "node": r, "path": None} for r in rows] + [{"shard": shard, "node": None, "path": p}
                                                                           for p in outer]
        for a in range(0, len(out), 5000):
            yield pa.RecordBatch.from_pylist(out[a:a + 5000], schema)
    return run


_ARROW_NODE = pa.struct([("least", pa.int64()), ("depth", pa.int64()), ("parent", pa.int64()), ("parent_key", pa.binary()),
                         ("key", pa.binary()), ("members", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()),
                         ("saved", pa.int64()), ("ends", pa.string())])


# -- all shards -------------------------------------------------------------------------------------

def prefix_trie(sequences: DataFrame, shard: int = SHARD, least: int = LEAST) -> DataFrame:
    """Nodes of the trie of (id, seq, words): conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = sequences.sparkSession
    paths = materialise(distinct_sequences(sequences), "distinct-sequences")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    levels, keyed = [], False
    while True:
        count, turns = paths.agg(F.count(F.lit(1)), F.sum(F.size("seq") + F.lit(1))).first()
        turns = turns or 0
        if keyed:
            n = min(-(-turns // shard), -(-count // MERGED))
        else:
            n = max(-(-turns // shard), min(-(-turns // least), tasks))
        dealt = paths.repartitionByRange(n, "seq") if n > 1 else paths.repartition(1)
        job = _shard_job(n <= 1, keyed)
        done = materialise(dealt.sortWithinPartitions("seq").mapInArrow(
            job, f"shard long, node struct<{_NODES.replace(' ', ':').replace(',:', ',')}>, "
                 f"path struct<seq:array<long>,words:array<long>,own:{_OWN}>"), "trie-shards")
        levels.append(done.where("node IS NOT NULL").select(F.lit(len(levels)).alias("level"), "shard", "node.*"))
        if n <= 1:
            break
        paths, keyed = done.where("path IS NOT NULL").select("path.*"), True
    nodes = levels[0]
    for more in levels[1:]:
        nodes = nodes.unionByName(more)
    if len(levels) > 1:
        whose = levels[1]
        for more in levels[2:]:
            whose = whose.unionByName(more)
        whose = whose.select(F.col("key").alias("parent_key"), F.col("least").alias("parent_least"))
        open_ = nodes.where("parent_key IS NOT NULL")
        asked = open_.select("level", "shard", "parent_key").distinct().join(whose, "parent_key")
        told = open_.join(asked, ["level", "shard", "parent_key"]).withColumn("parent", F.col("parent_least")).drop("parent_least")
        nodes = nodes.where("parent_key IS NULL").unionByName(told)
    return nodes.select(
        F.col("least").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))
