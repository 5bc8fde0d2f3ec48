"""Prefix trie against a plain dictionary, with shards so small that several merge levels are needed."""

import hashlib
import random
from collections import defaultdict

import pytest

from cumulo.llm import prefix_trie as trie
from cumulo.llm import queries
from tests.conftest import SF_SMALL


def _plain(convs):
    """Nodes of [(id, [(turn, words), ...])]."""
    members, ends = defaultdict(list), defaultdict(list)
    for i, turns in convs:
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(i)
        ends[tuple(turns)].append(i)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in sorted(members, key=len, reverse=True):
        saved[k] += (len(members[k]) - 1) * (k[-1][1] if k else 0)
        if not kids[k]:
            leaves[k] = 1
        if k:
            kids[k[:-1]] += 1
            leaves[k[:-1]] += leaves[k]
            saved[k[:-1]] += saved[k]
    digest = lambda k: hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()
    return {(min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), kids[k], leaves[k], saved[k],
             digest(k)) for k in members}


def _frame(spark, convs):
    return spark.createDataFrame([(i, [t for t, _ in turns], [w for _, w in turns]) for i, turns in convs],
                                 "id long, seq array<long>, words array<long>")


WORDS = [3, 0, 12, 7, 1, 1, 25, 2, 9]  # words of each turn


def _convs(n, seed=1):
    rnd = random.Random(seed)
    words = WORDS
    out = [(i, [(t, words[t]) for t in (rnd.choices(range(9), [60, 9, 9, 9, 9, 1, 1, 1, 1])[0]
                                        for _ in range(rnd.choice([0, 1, 2, 3, 5, 9])))]) for i in range(-5, n)]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("shard,least", [(200_000, 5_000), (60, 10), (15, 5)])
def test_trie_matches_plain(spark_llm, shard, least):
    convs = _convs(300) + [(1000 + i, [(0, 3)] * 40) for i in range(30)] + [(2000, [(7, 2)] * 900)]
    got = trie.prefix_trie(_frame(spark_llm, convs).repartition(3), shard=shard, least=least).collect()
    assert len(got) == len({(r.conv_id, r.depth) for r in got})
    assert {tuple(r) for r in got} == _plain(convs)


def test_many_members_of_one_sequence(spark_llm, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 100)
    convs = [(i, [(1, 2), (2, 5)]) for i in range(3000)] + [(5000, [(1, 2)]), (5001, [])]
    assert {tuple(r) for r in trie.prefix_trie(_frame(spark_llm, convs)).collect()} == _plain(convs)


def test_median_insertion_is_balanced():
    tree = trie.TernaryTree()
    for i in trie.medians_first(1023):
        tree.insert([i], [1])

    def height(x):
        return 0 if x < 0 else 1 + max(height(tree.low[x]), height(tree.high[x]))
    assert sorted(trie.medians_first(1023)) == list(range(1023)) and height(tree.equal[0]) == 10


def test_encoding_on_tricky_rows(spark_llm):
    schema = "conv_id long, turn long, role string, text string, id long, seq int, n long, digest string"
    rows = [(1, 1, "user", "b"), (1, None, "user", "a x"), (1, 2, None, None), (1, 2, "", ""), (2, 0, "user", "a x"),
            (2, 1, "user", "b"), (2, 1, "user", "b"), (None, 0, "user", "lost"), (3, 5, "use", "ra x"), (4, None, None, None)]
    df = spark_llm.createDataFrame([(*r, 1, 2, 3, "z") for r in rows], schema)
    for hot in (1000, 3):
        trie.HOT, keep = hot, trie.HOT
        try:
            got = {r.id: r for r in trie.encode_turns(df).collect()}
        finally:
            trie.HOT = keep
        assert set(got) == {1, 2, 3, 4}
        assert got[1].words == [2, 1, 0, 0] and got[2].words == [2, 1, 1] and got[3].words == [2] and got[4].words == [0]
        a, b, none = got[1].seq[0], got[1].seq[1], got[1].seq[2]
        assert got[1].seq == [a, b, none, none] and got[2].seq == [a, b, b] and got[4].seq == [none]
        assert got[3].seq[0] not in (a, b, none)
    nodes = trie.prefix_trie(trie.encode_turns(df))
    assert nodes.where("depth = 0").first().n_convs == 4
    assert trie.prefix_trie(trie.encode_turns(df.where("false"))).count() == 0


def test_rebuilt_turnless_conversation(spark_llm):
    """Conversation 21 has one turn, gives up its first three and gets those of 20, which is absent."""
    seqs = _frame(spark_llm, [(i, [(9, 1)]) for i in range(21, 40)] + [(43, [(9, 1), (8, 1)])])
    got = {r.id: r.seq for r in queries.shared_heads(seqs).collect()}
    import zlib
    for i in range(21, 40):
        assert got[i] == ([9] if zlib.crc32(str(i).encode()) % 4 == 0 else [])
    assert [] in got.values()


def test_registered_query(spark_llm):
    got = queries.QUERIES["op11_prefix_trie"](spark_llm, SF_SMALL).collect()
    root = [r for r in got if r.depth == 0][0]
    assert root.n_leaves == sum(r.n_children == 0 for r in got) and root.parent_conv_id is None
    for r in got:
        kids = [x for x in got if x.depth == r.depth + 1 and x.parent_conv_id == r.conv_id]
        assert r.n_children == len(kids)
