"""Merge-path alignment against a plain walk over both tokenizers' offsets."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tests.llm import helpers
from tokenizers import Tokenizer

from playstats.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("seed", range(6))
def test_pieces_find_every_common_end(seed):
    rng = random.Random(seed)
    a = np.array(sorted(rng.sample(range(400), rng.choice([0, 1, 90, 300]))), np.int64)
    b = np.array(sorted(rng.sample(range(400), rng.choice([0, 2, 120, 399]))), np.int64)
    for piece in (1, 2, 3, 7, 64, 5000):
        cut_a, cut_b = ta.merge_path(a, b, piece)
        merged = sorted([(v, 0) for v in a.tolist()] + [(v, 1) for v in b.tolist()])
        for i, j in zip(cut_a, cut_b):  # the first i + j of the merge, equal values of a first
            assert sorted([(v, 0) for v in a[:i].tolist()] + [(v, 1) for v in b[:j].tolist()]) == merged[:i + j]
        assert set(np.diff(cut_a + cut_b)[:-1]) <= {piece}
        at_a, at_b = ta.common_ends(a, b, piece)
        assert a[at_a].tolist() == b[at_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def brute(texts):
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    out = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        ia = lib.encode(" " + (text or ""), add_special_tokens=False).ids
        ib = piece.encode(text or "")
        ba = [bytes(back[c] for c in lib.id_to_token(i)) for i in ia]
        bb = [bytes([int(t[3:5], 16)]) if piece.is_byte(i) else t.replace("\u2581", " ").encode()
              for i in ib for t in [piece.id_to_piece(i)]]
        if not text or b"".join(ba) != whole or b"".join(bb) != whole:
            out.append((0, 0, [], []))
            continue
        groups, links, ga, gb, ea, eb, jb = [], [], [], [], 0, 0, 0
        for i, t in zip(ia, ba):
            ga.append(str(i))
            ea += len(t)
            while jb < len(ib) and eb + len(bb[jb]) <= ea:
                eb += len(bb[jb])
                gb.append(str(ib[jb]))
                jb += 1
            if ea == eb:
                links.append((i, int(gb[-1])))
                groups.append(",".join(ga) + "|" + ",".join(gb))
                ga, gb = [], []
        out.append((len(ia), len(ib), groups, links))
    n = Counter(x for o in out for x in o[3])
    most = {}
    for (i, j), k in n.items():
        most[j] = max(most.get(j, 0), k)
    return [(a, b, len(g), len(x), sum(n[p] == most[p[1]] for p in x), sum(n[p] for p in x),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for a, b, g, x in out]


ODD = ["", None, "a", " ", "  two  spaces ", "line\nbreak\r\n\ttab", "caf\u00e9 \u4e16\u754c \U0001f600",
       "<|endoftext|> <s> <0x0A> \u2581x\u2581", "\u0378 unassigned", "nul \x00 in", "e\u0301 combining",
       "same text", "same text", "I'm we'll 12345 !!! ..."]


@pytest.mark.parametrize("frequent, piece", [(ta.FREQUENT, ta.PIECE), (40, 5), (0, 1)])
def test_equals_a_plain_walk(spark, frequent, piece):
    rng = random.Random(3)
    texts = ODD + [helpers.sentence(rng, rng.randrange(1, 60)) for _ in range(40)] + [helpers.sentence(rng, 20_000)]
    texts += ["the same copy of a document"] * 30
    rows = [(None if k % 17 == 5 else k // 2, t, "en", k) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, links string, row int").repartition(3)
    aligned = ta.stored(ta.align(df, A, B, digest=True, piece=piece), "aligned")
    n_b = sentencepiece.SentencePieceProcessor(model_file=B).get_piece_size()
    got = sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                 for r in ta.link_scores(aligned, n_b, frequent).collect())
    assert got == sorted((str(r[0]), *b) for r, b in zip(rows, brute(texts)))


def test_groups_and_empty_table(spark):
    df = spark.createDataFrame([(1, "hello world")], "doc_id bigint, text string")
    row = ta.token_alignment(df, A, B).first()
    assert row.groups.count("|") == row.n_groups == row.n_links == row.n_best == row.count_sum
    assert ta.token_alignment(df.limit(0), A, B).collect() == []
