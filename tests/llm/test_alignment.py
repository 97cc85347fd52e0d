"""Token alignment against both libraries and a plain rewrite of its definition."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from pricestrata.llm import alignment

from .conftest import LONG, ODD

LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            out[chr(256 + n)] = b
            n += 1
    return out


def by_hand(rows: list[str | None]) -> list[tuple]:
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(LEFT)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=RIGHT)
    byte = letters()
    docs = []
    for text in rows:
        groups = []
        if text:
            raw = (" " + text).encode()
            x = a.encode(" " + text, add_special_tokens=False).ids
            y = b.encode(text)
            bx = [bytes(byte[c] for c in a.id_to_token(i)) for i in x]
            pieces = [(i, b.id_to_piece(i)) for i in y]
            by = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
            if b"".join(bx) == raw == b"".join(by):
                ends_x, ends_y = np.cumsum([len(t) for t in bx]), np.cumsum([len(t) for t in by])
                i = j = 0
                for end in sorted(set(ends_x.tolist()) & set(ends_y.tolist())):
                    p, q = int(np.searchsorted(ends_x, end)) + 1, int(np.searchsorted(ends_y, end)) + 1
                    groups.append((x[i:p], y[j:q]))
                    i, j = p, q
        docs.append(groups)
    held = Counter(p for groups in docs for p in {(s, t) for g, h in groups for s in g for t in h})
    most = defaultdict(int)
    for (s, _), n in held.items():
        most[s] = max(most[s], n)
    out = []
    for groups in docs:
        links = [(s, t) for g, h in groups for s in g for t in h]
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        out.append((
            sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links),
            sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


CASES = [
    "plain words, some of them twice: words", " leading and  double   spaces \t tabs\nlines\n\n", "a▁b under", "▁", " ",
    "naïve Grüße 日本語テキスト 👍🏽 mixed", "<|endoftext|> and <s> </s> <unk> <0x41> as text", "\x00\x01 control", "x" * 3_000,
    "日本" * 700, "12,345.67 http://example.org/a?b=c#d", "don't I'll we've", "é" * 5, "  wide　", None, "", "same", "same",
]


def rows_of(df) -> list[tuple]:
    return [tuple(r[c] for c in NAMES) for r in sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))]


@pytest.mark.parametrize(("lane", "pairs"), [(256, 2_000_000), (3, 40)])
def test_alignment_equals_a_plain_rewrite(docs, lane, pairs, monkeypatch):
    monkeypatch.setattr(alignment, "GROUP", 1_024 if lane > 3 else 2)
    texts = [*CASES, LONG[:40_000]]
    got = rows_of(alignment.align(docs(texts), LEFT, RIGHT, lane, pairs))
    assert got == by_hand(texts)


def test_real_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id is not null")
    want = by_hand([r["text"] for r in table.orderBy("doc_id").collect()])
    assert rows_of(alignment.align(table, LEFT, RIGHT)) == want


def test_odd_rows_and_no_rows(odd, none):
    got = alignment.align(odd, LEFT, RIGHT).collect()
    order = lambda rows: sorted(rows, key=repr)
    want = by_hand([t for _, t in ODD])
    assert order((r["doc_id"], *(r[c] for c in NAMES)) for r in got) == order(
        (i, *w) for (i, _), w in zip(ODD, want, strict=True)
    )
    assert alignment.align(none, LEFT, RIGHT).collect() == []


def test_lanes_do_not_change_cuts():
    rng = np.random.default_rng(1)
    sizes = [5, 1, 300, 40]
    a = [np.sort(rng.choice(1_000, n, replace=False)) + 1 for n in sizes]
    b = [np.sort(rng.choice(1_000, n + 7, replace=False)) + 1 for n in sizes]
    a_ends = np.concatenate([np.append(x, 1_002) + 1_002 * i for i, x in enumerate(a)])
    b_ends = np.concatenate([np.append(x, 1_002) + 1_002 * i for i, x in enumerate(b)])
    first = np.append(0, np.cumsum([n + 1 for n in sizes]))
    common = np.intersect1d(a_ends, b_ends)
    for lane in (1, 2, 7, 1_000):
        x, y = alignment.cuts(a_ends, b_ends, first, lane)
        assert (a_ends[x] == common).all() and (b_ends[y] == common).all()
