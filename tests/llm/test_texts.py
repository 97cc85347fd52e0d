"""Each operator on odd rows, on no rows, and against a plain rewrite of its definition."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from pricestrata.llm import (
    bpe, components, language, licences, nearcopies, quality, repeats, rollup, sharding, spans, texts,
    tokenfiles,
)

from .conftest import LONG, ODD

SPACES = " \t\n\v\f\r"


def words(text):
    return (text or "").encode().translate(None).split()


# --- general helpers


def test_hash_of_a_range_does_not_depend_on_its_place():
    data = np.frombuffer(b"abcabcxxabc", np.uint8)
    sums = texts.prefix(data)
    h = texts.ranged(sums, np.array([0, 3, 8, 1]), np.array([3, 6, 11, 4]))
    assert h[0] == h[1] == h[2] != h[3]


def test_slices_bound_bytes_and_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "", "c" * 5]})
    cut = list(texts.slices([batch], limit=20))
    assert [x for b in cut for x in b.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(sum(len(x or "") for x in b.column("text").to_pylist()) for b in cut[::2]) <= 100


def test_components_of_paths_stars_and_pairs(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    lone = {x for x in root if all(a == b for a, b in edges if x in (a, b))}
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in root if x not in lone}


# --- 1 licences


def test_licence_rules_take_their_sentences_in_order(docs):
    apache = [t for n, t in licences.SENTENCES if n.startswith("apache-") and n != "apache-line"]
    bsd = [t for n, t in licences.SENTENCES if n.startswith("bsd-")]
    wrapped = "\n\n".join(t.replace(" ", "\n") for t in apache)
    rows = {
        0: "Text before.\nReleased under the MIT License.\nAnd after.",
        1: "\n".join(apache), 2: wrapped, 3: "\n".join(bsd), 4: "\n".join(bsd[:3]),
        5: "\n".join([bsd[0], "Other words.", bsd[1]]),
        6: "released UNDER the mit license. Licensed under CC BY-NC 4.0.", 7: "All about licenses.",
    }
    got = {r["doc_id"]: r for r in licences.scan(docs(list(rows.items()))).collect()}
    assert [got[i]["licences"] for i in range(8)] == [
        "MIT", "Apache-2.0", "Apache-2.0", "BSD-3-Clause", "BSD-2-Clause", "",
        "CC-BY-NC-4.0,MIT", "",
    ]
    assert got[5]["n_sentences"] == 2 and got[5]["n_matches"] == 0
    assert got[1]["n_matches"] == 1 and got[6]["n_matches"] == 2


def test_licence_sentences_need_all_their_pieces(docs):
    gpl = [t for n, t in licences.SENTENCES if n in ("gpl-a", "gpl-b", "gpl-c")]
    rows = [
        "\n".join(gpl),
        "\n".join(gpl).replace("version 3", "version 2").replace("software:", "software;"),
        "\n".join(gpl).replace("GNU General", "GNU Affero General"),
        "\n".join(gpl).replace("GNU General", "GNU Lesser General").replace("This program", "This library"),
        "This program is free software.", gpl[0], gpl[0].replace("software: you", "software: Really. You"),
        'Licensed under the Apache License, Version 2.0 (the "License"). '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ]
    got = {r["doc_id"]: r for r in licences.scan(docs(rows)).collect()}
    assert [got[i]["licences"] for i in range(len(rows))] == [
        "GPL-3.0-or-later", "", "", "", "", "GPL-3.0-or-later", "", "",
    ]
    assert got[0]["sentence_ids"] == "gpl-a,gpl-b,gpl-c" and got[1]["sentence_ids"] == "gpl-b,gpl-c"


def test_licence_line_ends_are_read_place_by_place(docs):
    import textwrap

    text = dict(licences.SENTENCES)
    wrap = lambda *n: "\n\n".join("\n".join(textwrap.wrap(text[x], 40)) for x in n)
    rows = [
        "Field notes\nLicensed under CC BY 4.0.\n\n" + wrap("mit-a", "mit-b"),
        wrap("apache-a", "apache-b") + "\n\nA title\nReleased under the MIT License.\nMore\n",
        "Title\n" + wrap("gpl-a") + "\nLicensed under CC BY-SA 4.0",
        "# Notes\n# " + wrap("gpl-a").replace("\n", "\n# ") + "\n#\n# Released under the\n# MIT License.",
    ]
    got = {r["doc_id"]: r for r in licences.scan(docs(rows)).collect()}
    assert [(got[i]["licences"], got[i]["sentence_ids"]) for i in range(4)] == [
        ("CC-BY-4.0,MIT", "cc-by-line,mit-a,mit-b"), ("Apache-2.0,MIT", "apache-a,apache-b,mit-line"),
        ("CC-BY-SA-4.0,GPL-3.0-or-later", "gpl-a,cc-by-sa-line"), ("GPL-3.0-or-later,MIT", "gpl-a,mit-line"),
    ]


def test_licence_lookup_equals_the_comparison_sql(docs):
    import duckdb

    from pricestrata.llm import sqltext

    rng = random.Random(11)
    words = [t.split() for _, t in licences.SENTENCES]
    rows = []
    for _ in range(600):
        text = ""
        for _ in range(rng.randint(1, 7)):
            w = list(rng.choice(words))
            if rng.random() < 0.2:
                del w[rng.randrange(len(w))]
            if rng.random() < 0.2:
                w = w[: rng.randint(1, len(w))]
            gaps = rng.choices([" ", "\n", "\n# ", " \n\t", "\n\n", ", "], [30, 3, 1, 1, 0.2, 0.2], k=len(w))
            text += "".join(x + g for x, g in zip(w, gaps)) + rng.choice(["\n", "\n\n", " ", ".\n", "; ", "", "\r\n", " And more\n"])
        rows.append(rng.choice([str, str.upper, str.title])(text))
    rows += [None, "", "\n", "\x01", licences.SENTENCES[0][1]]
    frame = docs(rows)
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    wanted = con.execute(sqltext.licences()).fetchall()
    got = [tuple(r) for r in licences.scan(frame).collect()]
    assert sorted(got) == sorted(wanted)
    assert len({r[4] for r in got}) > 10 and sum(r[1] > 1 for r in got) > 100


def test_licence_notices_with_inner_stops_and_new_licences(docs):
    text = dict(licences.SENTENCES)
    rows = [
        text["mpl-a"].replace(" ", "\n") + "\n" + text["mpl-b"], text["mpl-a"].replace("v. 2.0", "v. 1.1"),
        "Notes\n" + text["isc-a"], text["unlicense-a"] + " " + text["unlicense-b"], text["boost-line"].upper(),
    ]
    got = {r["doc_id"]: r for r in licences.scan(docs(rows)).collect()}
    assert [got[i]["licences"] for i in range(5)] == ["MPL-2.0", "", "ISC", "Unlicense", "BSL-1.0"]
    assert got[0]["n_matches"] == 1 and got[0]["sentence_ids"] == "mpl-a,mpl-b"


# --- 2 quality


def base_by_hand(text):
    own = words(text)
    windows = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
    hit = {j for i in range(len(own) - 7) if windows[tuple(own[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.strip(SPACES)]
    chars = sum(1 for c in (text or "") if c not in SPACES)
    symbols = sum(c in "#*$%&|<>" for c in (text or ""))
    failed = len(own) < 20 or 100 * len(hit) > 30 * len(own)
    return len(own), chars, symbols, len(lines) - len(set(lines)), len(hit), failed


def test_base_counts_and_verdicts(docs, stored):
    rng = random.Random(2)
    good = [" ".join(rng.choice(["tree", "house", "über", "sea", "of", "the"]) + str(rng.randrange(99)) for _ in range(rng.randrange(5, 80))) for _ in range(60)]
    bad = [" ".join(f"{rng.randrange(99)}$$$ ###" for _ in range(rng.randrange(15, 60))) for _ in range(40)]
    loop = [("one two three four five six seven eight nine\n" * n) for n in (1, 2, 5)]
    rows = good + bad + loop + ["x\n \nx\nx", None, ""]
    table = docs(rows)
    labels = stored([(i, int(i < 60), 0) for i in range(100)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.quality_rules(table, labels).collect()}
    for i, text in enumerate(rows):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base_by_hand(text), text
        assert not (r["kept"] and r["base_failed"]) and 0 <= r["score"] <= 1
    assert all(got[i]["kept"] or got[i]["base_failed"] for i in range(60))
    assert sum(got[i]["kept"] for i in range(60, 100)) <= 4
    kept = quality.kept(table, quality.train(table, labels))
    assert kept.schema == table.schema
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i]["kept"]}


def test_quality_without_labels_uses_the_base_rule(docs, stored):
    labels = stored([], "doc_id bigint, quality int, toxic int")
    got = quality.quality_rules(docs(["w " * 25, "a b"]), labels).collect()
    assert [r["score"] for r in got] == [None, None] and not any(r["kept"] for r in got)


# --- 3 BPE


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, own, rng = Tokenizer.from_file(path), bpe.Coder(path), random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz" * 2 + "ABC'stredvmlL0123456789 \n\t!?.,;#$%é́İΣςß中文👍\x1c\x85ก²½"
    rows = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(4000)]
    rows += ["".join(rng.choice("aehnst") for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    rows += ["", "a<|endoftext|>B <|startoftext|>", "ssss'sss", "aaaaaaaaaaaaa", LONG]
    for text, (ids, decoded) in zip(rows, own.code(rows), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)), text
        assert decoded == library.decode(want, skip_special_tokens=False), text
        assert decoded == own.decode(want)


def test_bpe_table_may_be_emptied(monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_WORDS", 3)
    monkeypatch.setattr(bpe, "TABLE_PAIRS", 2)
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = ["several words go here", "and others there", "several words again <|endoftext|>"]
    assert [bpe.Coder(path).code([x])[0] for x in rows] == bpe.Coder(path).code(rows)


# --- 4 language


def test_language_profiles_held_out(docs, stored):
    rng = random.Random(1)
    parts = {"aa": ["the", "ing", "of", "and", "th"], "bb": ["der", "ung", "sch", "und", "ei"], "cc": ["que", "les", "eau", "ou", "é"]}
    rows = []
    for i in range(300):
        lang = rng.choice(list(parts))
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(30))
        rows.append((i, text, lang, "s", 0))
    rows += [(900, None, "aa", "s", 0), (901, "12 !!", "bb", "s", 0), (902, "the thing", None, "s", 0)]
    got = {r["doc_id"]: r for r in language.identify(stored(rows)).collect()}
    for i, text, lang, *_ in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i]["score"] <= 1
        if i < 300:
            assert got[i]["lang_pred"] == lang
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und"


def test_language_by_hand(stored):
    """Profiles, ranks and distances of a plain version."""
    rng, size = random.Random(9), 40
    rows = [(i, "".join(rng.choice("abcdeé  -1") for _ in range(rng.randrange(60))), rng.choice(["x", "y"]), "s", 0) for i in range(80)]

    def grams(text):
        cells = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        for w in cells:
            p = f"_{w}_"
            yield from (p[i : i + n] for n in (1, 2, 3) for i in range(len(p) - n + 1) if p[i : i + n] != "_")

    def code(g):
        return sum((1 if c == "_" else ord(c) + 1) << (21 * i) for i, c in enumerate(g))

    def rank(counter):
        return [g for g, _ in sorted(counter.items(), key=lambda x: (-x[1], code(x[0])))[:size]]

    learned = defaultdict(Counter)
    for i, text, lang, *_ in rows:
        if zlib.crc32(str(i).encode()) % 5:
            learned[lang].update(grams(text))
    profile = {k: {g: n for n, g in enumerate(rank(c))} for k, c in learned.items()}
    got = {r["doc_id"]: r for r in language.identify(stored(rows), size).collect()}
    for i, text, *_ in rows:
        own = rank(Counter(grams(text)))
        if not own:
            assert got[i]["lang_pred"] == "und"
            continue
        away = {k: sum(abs(p[g] - n) if g in p else size for n, g in enumerate(own)) for k, p in profile.items()}
        best = min(sorted(away), key=away.get)
        assert got[i]["lang_pred"] == best
        assert got[i]["score"] == pytest.approx(1 - away[best] / (len(own) * size))


# --- 5 repeats


def removed_by_hand(rows, length):
    raw = [(x or "").encode() for x in rows]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        hit = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                hit[i : i + length] = b"\1" * length
        rest = bytes(x for x, h in zip(b, hit, strict=True) if not h)
        spans_ = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out.append((len(b), sum(hit), spans_, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "letters"), [(20, "ab"), (24, "abcdefgh é"), (40, "abcdefghijklmnop")])
def test_repeats_against_every_window(docs, monkeypatch, length, letters):
    monkeypatch.setattr(repeats, "RUN", 200)
    monkeypatch.setattr(repeats, "RANGE", 400)
    rng = random.Random(length)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(30)]
    rows = [*base, None, "", "a" * 150, "ab" * 80]
    for _ in range(80):
        x, y = rng.choice(base), rng.choice(base)
        i = rng.randrange(len(x) + 1)
        rows.append(y[: rng.randrange(60)] + x[i : i + rng.randrange(1, 3 * length)] + rng.choice(letters) + y[:40])
        z = list(x)
        for _ in range(rng.randrange(5)):
            if z:
                z[rng.randrange(len(z))] = rng.choice(letters)
        rows.append("".join(z))
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.dedup(docs(rows), length).collect()}
    assert [got[i] for i in range(len(rows))] == removed_by_hand(rows, length)


def test_ranges_stay_bounded_when_all_documents_share_a_passage(spark, docs, monkeypatch):
    monkeypatch.setattr(repeats, "RUN", 200)
    monkeypatch.setattr(repeats, "RANGE", 400)
    rng, length = random.Random(31), 400
    some = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    shared = some(300)
    rows = [some(rng.randrange(380, 420)) + shared + some(rng.randrange(380, 420)) for _ in range(1500)]
    inside = []
    for rid, text in enumerate(rows):
        _, at, lo, hi, *_ = repeats.anchors_of(*texts.utf8(pa.array([text])), length)
        start = text.index(shared)
        own = [(a, b, c) for a, b, c in zip(at.tolist(), lo.tolist(), hi.tolist(), strict=True) if start <= a <= start + 300 - repeats.GRAM]
        inside.append((rid, text, own))
    chosen = spark.createDataFrame([r for r in inside if r[2]], "rid bigint, text string, own array<struct<at:int,lo:int,hi:int>>").repartition(4)
    count = sum(len(own) for *_, own in inside)
    cuts = repeats.borders(chosen, count, length)
    held, seen = Counter(), Counter()
    for r in repeats.sorted_runs(chosen, cuts, length).collect():
        held[r["bucket"]] += r["ghost"].count(0) + len(np.frombuffer(r["rid"], np.int64))
        seen["refs"] += len(np.frombuffer(r["rid"], np.int64))
    assert seen["refs"] == 2 * count > 5 * repeats.RANGE
    assert max(held.values()) <= 4 * repeats.RANGE
    some_rows = rows[:150] + [rows[3] + "x", shared + rows[9][-390:], shared * 3]
    monkeypatch.setattr(repeats, "RANGE", 60)
    monkeypatch.setattr(repeats, "RUN", 40)
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.dedup(docs(some_rows), length).collect()}
    assert [got[i] for i in range(len(some_rows))] == removed_by_hand(some_rows, length)


def test_loser_tree_gives_order_and_shared_prefixes():
    rng = random.Random(3)
    runs = [sorted({bytes(rng.choices(b"ab", k=rng.randrange(1, 12))) for _ in range(rng.randrange(0, 30))}) for _ in range(7)]
    coded = [repeats.Run(*repeats.front_coded(r)) for r in runs if r]
    runs = [r for r in runs if r]
    got = [(runs[k][i], share) for k, i, share in repeats.merge(coded)]
    assert [s for s, _ in got] == sorted(x for r in runs for x in r)
    for (a, _), (b, share) in zip(got, got[1:], strict=False):
        assert share == repeats.shared_prefix(a, b)


def test_strip_keeps_rows_and_columns(docs):
    table = docs(["x" * 30 + "unique one", "x" * 30 + "other", None, "short"])
    got = repeats.strip(table, 20)
    assert got.columns == table.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {0: "unique one", 1: "other", 2: None, 3: "short"}


# --- 6 spans


def hits_by_hand(text, items, window):
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    split = lambda t: "".join(c if not c.isascii() or c.isalnum() else " " for c in lower(t)).split(" ")
    own = [w for w in split(text) if w]
    hit, found = set(), set()
    for name, item in items:
        w = [x for x in split(item) if x]
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            for i in range(len(own) - n + 1):
                if own[i : i + n] == w[j : j + n]:
                    hit.update(range(i, i + n))
                    found.add(name)
    names = ",".join(sorted(found))
    return len(own), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("shortest", [1, 2, 4, 8])
def test_spans_against_all_windows(docs, stored, shortest):
    rng = random.Random(shortest)
    vocabulary = ["Aa", "b", "ç", "d1", "e", "日本", "g"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, some(rng.randrange(shortest, 9))) for i in range(12)] + [(50, None), (51, "..."), (3, some(6))]
    rows = [some(rng.randrange(0, 60)).replace(" ", rng.choice([" ", ", ", "\n"])) for _ in range(60)] + [None, ""]
    rows += [items[2][1] + "! " + some(5)]
    got = spans.decontaminate(docs(rows), stored(items, "item_id bigint, text string"), 5)
    named = [(str(i), t) for i, t in items]
    for r in got.collect():
        assert tuple(r)[1:] == hits_by_hand(rows[r["doc_id"]], named, 5), rows[r["doc_id"]]


@pytest.mark.parametrize("shortest", [1, 4])
def test_spans_of_many_blocks_equal_those_of_one(docs, stored, monkeypatch, shortest):
    rng = random.Random(70 + shortest)
    some = lambda n: " ".join(rng.choice(["Aa", "b", "ç", "d1", "e", "日本", "g"]) for _ in range(n))
    items = [(i, some(rng.randrange(shortest, 60))) for i in range(12)] + [(50, None), (3, some(40))]
    rows = [some(rng.randrange(0, 40)) for _ in range(60)] + [None, "", "", items[2][1] + "! zz. " + items[5][1]]
    rows.append("zz " * 99 + items[2][1] + ", y " + items[5][1])
    table, bench = docs(rows), stored(items, "item_id bigint, text string")
    whole = {r["doc_id"]: r["text"] for r in spans.clean(table, bench, 5).collect()}
    monkeypatch.setattr(spans, "BLOCK_WORDS", 24)
    monkeypatch.setattr(spans, "PART_WORDS", 8)
    assert len(spans.blocks(bench, 5)) > 3
    named = [(str(i), t) for i, t in items]
    got = spans.decontaminate(table, bench, 5).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == hits_by_hand(rows[r["doc_id"]], named, 5), rows[r["doc_id"]]
    made = spans.clean(table, bench, 5)
    assert made.columns == table.columns
    assert {r["doc_id"]: r["text"] for r in made.collect()} == whole


def test_clean_removes_stretches_and_mostly_hit_documents(docs, stored):
    item = "alpha beta gamma delta epsilon"
    table = docs([f"Before it, {item.upper()}; after it all is well here.", item, "nothing here", None])
    got = spans.clean(table, stored([(1, item)], "item_id bigint, text string"), 5)
    assert got.schema == table.schema
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {
        0: "Before it, ; after it all is well here.", 2: "nothing here", 3: None,
    }


# --- 7 near copies


def links_by_hand(rows):
    sets = {}
    for i, text in rows:
        w = words(text)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else None
    distinct = set(filter(None, sets.values()))
    near = {a: [b for b in distinct if a != b and 10 * len(a & b) >= 8 * len(a | b)] for a in distinct}
    group = {}
    for a in distinct:
        if a not in group:
            todo, group[a] = [a], a
            while todo:
                for b in near[todo.pop()]:
                    if b not in group:
                        group[b] = a
                        todo.append(b)
    first = defaultdict(list)
    for i, s in sets.items():
        first[group[s] if s else i].append(i)
    least = {i: min(m) for m in first.values() for i in m}
    copies = Counter(s for s in sets.values() if s)
    return {i: (least[i], len(near[s]) if s else 0, copies[s] if s else 1) for i, s in sets.items()}


@pytest.mark.parametrize("block", [4, 256])
def test_near_copies_against_all_pairs(docs, monkeypatch, block):
    monkeypatch.setattr(nearcopies, "BLOCK", block)
    rng = random.Random(8)
    some = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    rows = []
    for _ in range(6):
        base = some(rng.randrange(60, 300))
        for _ in range(rng.randrange(1, 14)):
            own = list(base)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(len(own))] = "new" + str(rng.randrange(9999))
            rows.append(" ".join(own))
    rows += rows[:5] + ["a b", "a  b", "a b c", "", " ", None] + [" ".join(some(40)) for _ in range(20)]
    table = docs(rows)
    got = {r["doc_id"]: tuple(r)[1:] for r in nearcopies.near_copies(table).collect()}
    want = links_by_hand(list(enumerate(rows)))
    assert got == want
    kept = nearcopies.first_of_each(table)
    assert kept.columns == table.columns
    assert kept.count() == len({c for c, *_ in want.values()})


def test_pruning_needs_more_matches_at_later_steps():
    least = nearcopies.least_matches(0.8, 1e-9)
    assert least == sorted(least) and len(least) == nearcopies.HASHES // nearcopies.STEP
    # A pair right at the threshold is below the last bound with a chance of less than 1e-6.
    rng = np.random.default_rng(0)
    assert (rng.binomial(nearcopies.HASHES, 0.8, 1_000_000) < least[-1]).sum() == 0


# --- 8 token files


def test_token_files_round_trip(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(6)
    rows = [(rng.randrange(40), "".join(rng.choice("ab cdé 日\n'st 12<|endoftext|>") for _ in range(rng.randrange(50)))) for _ in range(60)]
    rows += [(None, "no id"), (7, None), (7, ""), (99, "x<|endoftext|>y"), (100, LONG), (3, "same"), (3, "same")]
    root = str(tmp_path / "files")
    manifest = tokenfiles.write(docs(rows), root, path)
    got = sorted(tokenfiles.read(spark, root, manifest, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] is not None for r in got] == [False] + [True] * (len(rows) - 1)
    ids = [r["doc_id"] for r in got[1:]]
    assert ids == sorted(ids)
    at, want = 0, Counter()
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    for i, text in rows:
        own = library.encode(text or "", add_special_tokens=False).ids + [0]
        want[i, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


# --- 9 shards


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1500])
def test_shards_are_a_permutation(docs, n):
    rows = [(i % max(n - 3, 1), f"t{i % 11}" * (i % 5)) for i in range(n)]
    got = sharding.shard(docs(rows)).collect()
    assert len(got) == n and {r["law"] for r in got} == {"rows"}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1
    want = Counter((i, len(t) + 1, zlib.crc32(t.encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def test_shards_have_no_python(docs):
    plan = sharding.shard(docs(["a", "b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- 10 token counts


def test_rollup_batches_count_once(spark, stored, tmp_path):
    root = str(tmp_path / "rollup")
    table = stored([(0, "a b", "en", "x", 0), (1, "c", None, "x", 0), (1, "c", None, "x", 0), (2, None, "en", None, 0)])
    table = rollup.measured(table)
    first = rollup.counted(table, "words/1")
    assert rollup.commit(root, "b/1", first) and not rollup.commit(root, "b/1", first)
    total = lambda: {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals(spark, root).collect()}
    assert total() == {("x", "en", "words/1"): (1, 2), ("x", None, "words/1"): (2, 2), (None, "en", "words/1"): (1, 0)}
    assert rollup.commit(root, "b/2", rollup.deleted(rollup.counted(table.where("doc_id = 1"), "words/1")))
    assert total() == {("x", "en", "words/1"): (1, 2), (None, "en", "words/1"): (1, 0)}
    only = table.where("doc_id = 0")
    change = rollup.revised(rollup.counted(only, "words/1"), rollup.counted(only, "words/2"))
    assert rollup.commit(root, "b/3", change)
    assert total() == {("x", "en", "words/2"): (1, 2), (None, "en", "words/1"): (1, 0)}


def test_rollup_writes_a_torn_batch_anew(spark, stored, tmp_path):
    root = str(tmp_path / "rollup")
    rows = rollup.counted(rollup.measured(stored([(0, "a b", "en", "x", 0)])), "words/1")
    rollup.commit(root, "one", rows)
    (tmp_path / "rollup" / "batch=one" / "_SUCCESS").unlink()
    assert rollup.totals(spark, root).count() == 0
    assert rollup.commit(root, "one", rows)
    assert rollup.totals(spark, root).first()["n_docs"] == 1
    assert rollup.commit(root, "none", rows.limit(0)) and rollup.totals(spark, root).count() == 1


# --- all operators on odd rows and on no rows


@pytest.fixture
def operators(spark, stored, tmp_path):
    labels = stored([(4, 1, 0), (6, 1, 0), (5, 0, 0), (8, 0, 1), (None, None, None)], "doc_id bigint, quality int, toxic int")
    items = stored([(1, " ".join(LONG.split()[500:520])), (None, None)], "item_id bigint, text string")
    word, byte = (public_tokenizers.path(f"{x}.json") for x in ("word_bpe_49k", "byte_bpe_50k"))

    def files(d):
        root = str(tmp_path / f"files-{random.random()}")
        return tokenfiles.read(spark, root, tokenfiles.write(d, root, byte), byte)

    return {
        "licences": licences.scan, "quality": lambda d: quality.quality_rules(d, labels),
        "bpe": lambda d: bpe.encode_decode(d, word, keep=True), "language": language.identify,
        "dedup": repeats.dedup, "strip": repeats.strip, "spans": lambda d: spans.decontaminate(d, items),
        "clean": lambda d: spans.clean(d, items), "near": nearcopies.near_copies,
        "first": nearcopies.first_of_each, "files": files, "shards": sharding.shard,
    }


def test_odd_rows_give_one_result_each(operators, odd):
    for name, run in operators.items():
        got = run(odd)
        rows = got.collect()
        ids = Counter(r["doc_id"] for r in rows)
        want = Counter(i for i, _ in ODD)
        if name == "first":
            want[5] = 1  # the repeated row goes
        assert ids == want, name
        if name in ("strip", "clean", "first"):
            assert got.columns == odd.columns, name
            assert {r["_rid"] for r in rows} == {"x"}, name


def test_no_rows_give_no_rows(operators, none):
    for name, run in operators.items():
        assert run(none).count() == 0, name
