"""Token alignment against a plain version with the public tokenizers."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from charloom.llm import align

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def texts():
    r = random.Random(11)
    words = ["river", "New", "naïve", "日本語", "e-mail", "x_1", "🙂", "don't", "été", "123.45", "ABCdef", "ﬁn", "á", "的"]
    out = [" ".join(r.choice(words) for _ in range(r.randint(1, 40))) for _ in range(60)]
    out += ["  two  spaces\tand\n\nlines ", "<|endoftext|> plain <s> and <0x41>", "▁ is itself", "\x00 zero", "a\xa0b c", " ", "\n", "word"]
    out += ["日本語のテキスト" * 300, "x" * 5000, "ab" * 3000 + " " + "🙂" * 500, "the river " * 3000, "​﻿", "é́" * 20]
    return out + [None, "", *out[:10]]


def plain(rows):
    to_byte = align.byte_level_alphabet()
    found = []
    holding = Counter()
    for t in rows:
        groups = []
        if t:
            a, b = A.encode(" " + t, add_special_tokens=False).ids, B.encode(t)
            sa = [bytes(to_byte[c] for c in A.id_to_token(i)) for i in a]
            sb = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
            raw = (" " + t).encode()
            if b"".join(sa) == raw and b"".join(sb) == raw:
                ends_a, ends_b, at = [], [], 0
                for s in sa:
                    ends_a.append(at := at + len(s))
                at = 0
                for s in sb:
                    ends_b.append(at := at + len(s))
                common = sorted(set(ends_a) & set(ends_b))
                last = 0
                for e in common:
                    groups.append(([x for x, z in zip(a, ends_a) if last < z <= e], [y for y, z in zip(b, ends_b) if last < z <= e]))
                    last = e
        found.append(groups)
        holding.update({(x, y) for one, two in groups for x in set(one) for y in set(two)})
    top = defaultdict(int)
    for (x, _), n in holding.items():
        top[x] = max(top[x], n)
    out = []
    for groups in found:
        links = [holding[x, y] for one, two in groups for x in one for y in two]
        best = sum(holding[x, y] == top[x] for one, two in groups for x in one for y in two)
        spelt = ";".join(f"{','.join(map(str, one))}|{','.join(map(str, two))}" for one, two in groups)
        n_a, n_b = (sum(len(g[i]) for g in groups) for i in (0, 1))
        out.append((n_a, n_b, len(groups), len(links), best, sum(links), hashlib.sha256(spelt.encode()).hexdigest() if groups else ""))
    return out


@pytest.mark.parametrize("block_chars", [1 << 30, 500])
def test_alignment_equals_a_plain_version(spark, block_chars, monkeypatch):
    monkeypatch.setattr(align, "MEMO_WINDOWS", block_chars >> 3)
    rows = texts()
    keys = [2**60 + i if i % 7 else None for i in range(len(rows))]
    df = spark.createDataFrame(list(zip(keys, rows, range(len(rows)), strict=True)), "doc_id long, text string, block int")
    got = align.align_tokens(df.repartition(3), block_chars=block_chars).collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(((g["doc_id"] or 0), *[g[c] for c in names]) for g in got) == sorted(
        (k or 0, *w) for k, w in zip(keys, plain(rows), strict=True)
    )
    # Some texts are whole in both, some are not.
    assert {g["n_a"] > 0 for g in got} == {True, False}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align.align_tokens(df).count() == 0


def test_windows_join_to_the_groups_of_the_whole_text():
    t = align.Tokenizers()
    cut, rows = align.Aligner(t), [x for x in texts() if t(x)]
    found, listed, holding = cut(rows)
    for text, (_, _, groups, links, digest, at, times) in zip(rows, found, strict=True):
        a, b = t(text)
        whole = align.Aligner(t).align([align.np.array([*a, *(x + len(t.a.tokens) for x in b)], align.np.int32).tobytes()])
        assert (groups, links) == (whole.groups[0], whole.links[0])
        assert digest == hashlib.sha256(whole.spelt[0].encode()).hexdigest()
        want = Counter()
        for p, n in zip(whole.pairs.tolist(), whole.times.tolist(), strict=True):
            want[p] += n
        assert dict(zip(listed[at].tolist(), times.tolist(), strict=True)) == want
    assert holding.sum() == sum(len(f[5]) for f in found)
    assert len(cut.memo) < sum(len(x.split(" ")) for x in rows)
