"""Conversation trie against a plain rewrite of its definition."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from pricestrata.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def by_hand(seq: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in seq.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for path in members:
        if path:
            kids[path[:-1]].add(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        own = members[path]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saved[path] = (len(own) - 1) * words + sum(saved[k] for k in kids[path])
        ends = ",".join(map(str, sorted(c for c in own if len(seq[c]) == len(path))))
        out.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(kids[path]),
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def sequences(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    out = defaultdict(list)
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out[c].append((role or "", text or ""))
    return out


def rebuilt_by_hand(own: dict) -> dict:
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def collected(df) -> list[tuple]:
    return sorted((tuple(r)[:8] for r in df.collect()), key=repr)


def made(seed: int, n: int = 60) -> list[tuple]:
    """Few kinds of turns, so that conversations share beginnings and whole copies occur."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(500), n):
        rows += [
            (c, t, rng.choice(["user", None, ""]), rng.choice(["a b", "a  b c", "", None, "é x"]))
            for t in range(rng.choice([1, 2, 3, 3, 6]))
        ]
    return rows


@pytest.mark.parametrize(("limit", "block"), [(20_000, 4_096), (6, 3), (1, 1)])
def test_trie_equals_a_plain_rewrite(stored, limit, block):
    rows = made(limit)
    rng = random.Random(3)
    rng.shuffle(rows)
    table = stored(rows, SCHEMA)
    assert collected(trie.prefix_trie(table, limit, block)) == by_hand(sequences(rows))
    assert collected(trie.rebuilt_trie(table, limit, block)) == by_hand(rebuilt_by_hand(sequences(rows)))


def test_long_and_shared_conversations(stored):
    """Two long conversations that part late, and many copies of one, beyond the container size."""
    long = [("user" if t % 2 else "bot", f"turn {t}") for t in range(150)]
    seq = {1: long, 2: [*long[:140], ("user", "other"), ("bot", "end")], 3: long[:70]}
    seq |= {10 + i: [("user", "hello"), ("bot", "hello you")] for i in range(60)}
    seq |= {100 + i: [("user", "hello"), ("bot", f"number {i}")] for i in range(5)}
    rows = [(c, t, *turn) for c, turns in seq.items() for t, turn in enumerate(turns)]
    for limit in (20, 1_000):
        assert collected(trie.prefix_trie(stored(rows, SCHEMA), limit, 16)) == by_hand(seq)


def test_odd_rows_and_no_rows(stored):
    rows = [
        (7, None, None, None), (7, 1, "user", "x"), (7, 1, "user", "x"), (None, 1, "user", "lost"),
        (7, None, "", ""), (27, 5, "bot", " ".join(["w"] * 30_000)), (0, 0, None, ""), (-3, 1, "u", "v"),
    ]
    clash = ", number bigint, depth string, t1 string, size string"
    table = stored([(*r, 1, "a", "b", "c") for r in rows], SCHEMA + clash)
    assert collected(trie.prefix_trie(table)) == by_hand(sequences(rows))
    ties = stored([(1, 1, "u", "a"), (1, 1, "u", "b"), (2, 1, "u", "b"), (2, 1, "u", "a")], SCHEMA)
    assert [r["n_convs"] for r in trie.prefix_trie(ties).collect()] == [2, 2, 2]
    assert trie.rebuilt_trie(stored([], SCHEMA)).collect() == []
    gone = stored([(1, None, "u", "a")], SCHEMA)  # rebuilt without turns: it ends in the root
    got = trie.rebuilt_trie(gone).collect()
    assert [tuple(r)[:8] for r in got] == by_hand(rebuilt_by_hand({1: [("u", "a")]}))
