"""The prefix trie, against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from amphora.llm import prefix_trie, queries


def brute(convs):
    """Nodes of {conv: [(role, text), ...]}."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = {}, dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    for p in sorted(nodes, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) or 1
        saved[p] = sum(saved[k] for k in below) + ((len(nodes[p]) - 1) * len(p[-1][1]) if p else 0)
    out = []
    for p, cs in nodes.items():
        ends = sorted(c for c in cs if len(convs[c]) == len(p))
        out.append((min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    return out


def found(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def make(spark, convs, more=()):
    rows = [(c, i, r, t, "x", 5) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows + list(more), "conv_id long, turn long, role string, text string, id string, depth int").repartition(5)


def random_convs(n, seed, alphabet=3, most=9):
    rng = random.Random(seed)
    said = [("u", "a"), ("u", "bé"), ("v", "a"), ("", "ccc"), ("w", "")]
    return {rng.randrange(10**6): [said[rng.randrange(alphabet)] for _ in range(rng.randint(1, most))] for _ in range(n)}


@pytest.mark.parametrize("segment, shard, hot", [(64, 1 << 19, "1000000"), (3, 40, "20"), (2, 100, "0"), (5, 7, "3")])
def test_trie(spark, segment, shard, hot):
    convs = random_convs(150, 3)
    convs |= {2_000_000 + i: [("u", "hot")] * 4 for i in range(60)} | {5: [("u", "long")] * 90, 6: [("u", "long")] * 70 + [("v", "z")] * 3}
    spark.conf.set("spark.amphora.hotKeyRows", hot)
    try:
        turns = prefix_trie.ordered_turns(make(spark, convs))
        members = spark.createDataFrame([(c,) for c in convs] + [(-3,), (7_000_000,)], "conv_id long")
        got = prefix_trie.trie(turns, members, segment=segment, shard_turns=shard)
        assert found(got) == brute(convs | {-3: [], 7_000_000: []})
    finally:
        spark.conf.unset("spark.amphora.hotKeyRows")


def test_no_turns_at_all(spark):
    turns = prefix_trie.ordered_turns(make(spark, {1: [("u", "x")]})).limit(0)
    members = spark.createDataFrame([(4,), (2,)], "conv_id long")
    assert found(prefix_trie.trie(turns, members)) == brute({4: [], 2: []})
    assert found(prefix_trie.trie(turns, members.limit(0))) == []


def test_nulls_and_order(spark):
    rows = [(1, None, None, None), (1, 2, "u", "b"), (1, 1, "u", None), (None, 1, "u", "x"), (2, 0, "", ""), (2, 5, "u", ""), (3, 7, "r", "r"), (3, 7, "r", "r")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = prefix_trie.ordered_turns(df)
    want = brute({1: [("", ""), ("u", ""), ("u", "b")], 2: [("", ""), ("u", "")], 3: [("r", "r"), ("r", "r")]})
    assert found(prefix_trie.trie(turns, turns.select("conv_id").distinct())) == want


def test_rebuilt(spark):
    convs = {c % 700: t for c, t in random_convs(300, 9, most=7).items()}
    convs.pop(300, None)
    turns, members = queries.rebuilt(prefix_trie.ordered_turns(make(spark, convs)))
    assert found(prefix_trie.trie(turns, members, segment=4, shard_turns=200)) == brute(rebuilt(convs))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    convs = {}
    for r in sorted(spark.read.parquet(f"{sf_dir}/conversations.parquet").collect(), key=lambda r: (r["conv_id"], r["turn"])):
        convs.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert found(queries.op11_prefix_trie(spark, sf_dir)) == brute(rebuilt(convs))
