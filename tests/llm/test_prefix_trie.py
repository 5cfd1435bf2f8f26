"""The prefix trie against a trie of Python dictionaries."""

import collections
import hashlib
import random
import zlib

import pytest

from mapstrata.llm import prefix_trie
from mapstrata.llm.prefix_trie import conversation_paths, trie_nodes
from mapstrata.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, size string, depth string, id string"


def said_in_order(rows):
    """conv_id -> [(role, text)], by turn, null first."""
    found = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            found[conv_id].append(((turn is not None, turn or 0), (role or "", text or "")))
    return {c: [said for _, said in sorted(turns, key=lambda t: t[0])] for c, turns in found.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute_trie(conversations):
    members, ended = collections.defaultdict(set), collections.defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ended[tuple(turns)].append(c)
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node in members:
        words = len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * words
    return sorted(
        (
            min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ended.get(node, [])))).encode()).hexdigest(),
        )
        for node, of in members.items()
    )


def found(df):
    rows = df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    return sorted(map(tuple, rows))


def grown_conversations(seed, n, longest):
    """Conversations that continue, copy and leave each other at every depth, with nulls."""
    draw = random.Random(seed)
    rows, told = [], [[]]
    for c in draw.sample(range(-50, 5 * n), n):
        turns = draw.choice(told)[: draw.randint(0, longest)] if draw.random() < 0.8 else []
        if draw.random() < 0.8:
            turns = turns + [(draw.choice(["user", "assistant", None]), draw.choice(["a b", "c", "", None, "d\te  f"])) for _ in range(draw.randint(0, longest // 2))]
        told.append(turns)
        rows += [(c, None if t == 0 and draw.random() < 0.5 else t, *said) for t, said in enumerate(turns)]
    rows += [(None, 0, "user", "lost"), (None, None, None, None)]
    draw.shuffle(rows)
    return rows


def as_table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize(("seed", "n", "longest", "first"), [(1, 60, 5, 16), (2, 250, 9, 4), (3, 120, 40, 2)])
def test_trie(spark, monkeypatch, seed, n, longest, first):
    monkeypatch.setattr(prefix_trie, "FIRST_BATCH", first)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = grown_conversations(seed, n, longest)
    own = said_in_order(rows)
    table = as_table(spark, rows)
    assert found(trie_nodes(conversation_paths(table))) == brute_trie(own)
    assert found(trie_nodes(conversation_paths(table, rebuild=True))) == brute_trie(rebuilt(own))


def test_salted_joins(spark, monkeypatch):
    """The same nodes where nothing is small enough to broadcast."""
    monkeypatch.setattr("mapstrata.operators.joins.BROADCAST_BYTES", -1)
    monkeypatch.setattr("mapstrata.operators.joins.SALTS", 3)
    rows = grown_conversations(5, 60, 6)
    assert found(trie_nodes(conversation_paths(as_table(spark, rows)))) == brute_trie(said_in_order(rows))


def test_one_chain_and_copies(spark):
    """A conversation logged after each turn, and a group of copies that ends at one node."""
    turns = [("user", f"word {i}") for i in range(40)]
    rows = [(c, t, *turns[t]) for c in range(1, 41) for t in range(c)]
    rows += [(1000 + c, t, *turns[t]) for c in range(300) for t in range(3)]
    assert found(trie_nodes(conversation_paths(as_table(spark, rows)))) == brute_trie(said_in_order(rows))


def test_repeated_rows_are_repeated_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a")]
    assert found(trie_nodes(conversation_paths(as_table(spark, rows)))) == brute_trie(said_in_order(rows))


def test_empty_table_and_turnless_conversations(spark):
    assert found(trie_nodes(conversation_paths(as_table(spark, [])))) == []
    lost = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lost, 0, "user", "a b c")]
    nodes = found(trie_nodes(conversation_paths(as_table(spark, rows), rebuild=True)))
    assert nodes == brute_trie({lost: []}) == [(lost, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest())]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op12_prefix_trie"](spark, SF_DIR)) == brute_trie(rebuilt(said_in_order(rows)))
