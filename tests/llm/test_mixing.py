"""Mixing: targets against a plain rewrite, rounding against its invariants."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from pricestrata.llm import mixing

SCHEMA = "doc_id bigint, text string, source string"


def targets_by_hand(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        out = {s: 3 * sizes[s] if s in full else rest * weight[s] / open_ for s in names}
        above = {s for s in names if s not in full and out[s] > 3 * sizes[s]}
        if not above:
            return out
        full |= above


def check(rows: list[tuple], got: list) -> None:
    sizes, longest = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        longest[source] = max(longest[source], n)
    want = targets_by_hand(sizes)
    taken = Counter()
    for r in got:
        s = r["source"]
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s], abs=1e-6)
        low = want[s] / sizes[s] if sizes[s] else 0
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        assert not r["size"] or int(low + 1e-9) <= r["copies"] <= int(low + 1e-9) + (low % 1 > 1e-9)
        taken[s] += r["taken"]
    assert len(got) == len(rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) < max(longest[s], 1)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def made(n: int, sources: list) -> list[tuple]:
    """A third of the rows in one source; lengths from none to some thousand words."""
    return [
        (i, " ".join(["w"] * ((i * i * 7919) % (3_000 if i % 50 == 0 else 60))),
         sources[0] if i % 3 == 0 else sources[i % len(sources)])
        for i in range(n)
    ]


@pytest.mark.parametrize(("n", "fan"), [(900, 128), (300, 3)])
def test_targets_and_totals(stored, n, fan):
    rows = made(n, ["b", "a", None, "ä", "Z", "", "zz"])
    table = stored(rows, SCHEMA)
    got = mixing.mix(table, fan=fan).collect()
    check(rows, got)
    again = mixing.mix(table.repartition(3), fan=fan).collect()
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_rounding_is_fair(stored):
    """Over many documents of one size, and over runs with other ids, the share of extra copies is p."""
    table = stored([(i, "one two three", "a" if i < 3_000 else "b") for i in range(4_000)], SCHEMA)
    got = mixing.mix(table).collect()
    a = [r["copies"] for r in got if r["source"] == "a"]
    assert abs(sum(a) / len(a) - got[0]["target"] / got[0]["source_size"]) < 1e-3 or got[0]["source"] == "b"
    runs = [sum(r["copies"] for r in got[k::10]) for k in range(10)]
    assert max(runs) - min(runs) < 120


def test_small_and_odd_inputs(stored):
    assert mixing.mix(stored([], SCHEMA)).collect() == []
    empty = mixing.mix(stored([(1, None, "a"), (None, "", None), (2, " \n", "a")], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in empty] == [(0, 0.0, 0)] * 3
    one = mixing.mix(stored([(1, "a b c", "x")], SCHEMA)).collect()
    assert [(r["target"], r["taken"]) for r in one] == [(3.0, 3)]
    clash = ", rank string, size string, p string, target string, number string, base string"
    rows = [(5, "same same", "a")] * 300 + [(None, "x " * 20_000, None), (5, None, "a"), (7, "y", "b")]
    got = mixing.mix(stored([(*r, *"012345") for r in rows], SCHEMA + clash)).collect()
    check(rows, got)
