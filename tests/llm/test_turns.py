"""The prefix trie against a plain one built in dictionaries, over several blocks, and edge cases."""

import hashlib
import math
import random
import zlib

import pytest

from fieldbook.llm import turns

TURN = "conv_id long, turn long, role string, text string, start string, level long, key string, n long, end string"


def plain(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, t) for _, r, _, t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))  # as in SQL, also below 0
        paths[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        todo, found = [node], []
        while todo:
            found.append(todo.pop())
            todo += children.get(found[-1], [])
        return found

    out = []
    for node, convs in members.items():
        tree = below(node)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(paths[c]) == len(node)))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
            sum(n not in children for n in tree), sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in tree if n),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out)


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.collect())


def conversations(rng, n):
    said = ["", None, "hi", "hello there", "é", "ok \x00"]
    rows = []
    for c in rng.sample(range(-20, 200), n):
        size = rng.choice([0, 1, 2, 3, 8, 9, 12, 31])
        rows += [(c, k if rng.random() < 0.9 else None, rng.choice(["user", None, ""]), rng.choice(said)) for k in range(size)]
    start = [(0, k, "user", "same") for k in range(10)]
    rows += start + [(5 * c + 1000, k, "user", "same") for c in range(12) for k in range(10)]  # a large group of equal conversations
    return [r + ("x", 1, "y", 2, "z") for r in rows] + [(None, 1, "user", "lost", "x", 1, "y", 2, "z")]


@pytest.mark.parametrize("width", [3, 16])
def test_against_a_plain_trie(store, width):
    rows = conversations(random.Random(width), 60)
    assert found(turns.prefix_trie(store(rows, TURN), width)) == plain(rows)


def test_long_ids_are_joined_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(turns, "_CHUNK", 50)
    ends = spark.createDataFrame([(bytearray([k % 3]), k) for k in range(2000)], "end binary, conv_id long").repartition(7)
    got = {bytes(r.end): r.sha for r in turns.digests(ends).collect()}
    assert got == {bytes([e]): hashlib.sha256(",".join(str(k) for k in range(e, 2000, 3)).encode()).hexdigest() for e in range(3)}


def test_edges(store):
    assert turns.prefix_trie(store([], TURN, 1)).collect() == []
    assert turns.prefix_trie(store([(None, 1, "user", "x", "", 1, "", 1, "")], TURN, 1)).collect() == []
    # Rebuilt without turns: crc32("1") % 9 own turns go and conversation 0 is absent.
    h = zlib.crc32(b"1") % 9
    rows = [(1, k, "user", "x" * 100_000, "", 1, "", 1, "") for k in range(max(h, 1))]
    assert found(turns.prefix_trie(store(rows, TURN))) == plain(rows)
    twice = [(5, 1, "user", "é", "", 1, "", 1, "")] * 2 + [(10, None, None, None, "", 1, "", 1, "")] * 20
    assert found(turns.prefix_trie(store(twice, TURN))) == plain(twice)
