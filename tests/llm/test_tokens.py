import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from tokenizers import Tokenizer

from playstats.llm import bpe_codec, pretokens, token_counts, token_orc
from playstats.llm.common import shared_path
from tests.llm.helpers import docs, rows_by_id

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")

TEXTS = ["", None, "  ", "Hello, world's end!  \n\n x", "\n\n a\t b'll 'tis I'll''s  x\u0085y  　 z",
         "<|endoftext|>", "a<|endoftext|><|startoftext|>'re b ", "İstanbul ǅ ΑΣ Σ ẞ ﬁ K ſ", "日本語 テスト 123 ١٢٣ ½",
         "\U0001F600‍!!'s'd 'll'S", "՘abc ͸x <|endoftext|>", "a\x00b\x1c\x1d c", "x" * 3000, "'s'abc 're's ''s",
         "é café ñ", "don't DON'T we'Ve", "!!!!????....", "1234567 12 1", "a" * 40 + " " * 40 + "b"]


def _random_texts(n=60, seed=9):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzéñöß"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(300)]
    return [" ".join(rng.choice(words) + rng.choice(["", ",", ".\n", "!!", "'s", " 12"]) for _ in range(rng.randint(1, 80)))
            for _ in range(n)]


ALL = TEXTS + _random_texts()


@pytest.fixture(scope="module")
def byte_ids():
    lib = Tokenizer.from_file(BYTE)
    return [lib.encode(t or "", add_special_tokens=False).ids for t in ALL]


@pytest.fixture(scope="module")
def word_ids():
    lib = Tokenizer.from_file(WORD)
    return [lib.encode(t or "", add_special_tokens=False).ids for t in ALL]


def test_counts_equal_the_library(spark, byte_ids):
    got = rows_by_id(token_counts.token_counts(docs(spark, ALL), BYTE, limit=20, frequent=50))
    for i, ids in enumerate(byte_ids):
        assert got[i]["n_bytes"] == len((ALL[i] or "").encode())
        assert got[i]["n_tokens"] == len(ids), ALL[i]
        assert got[i]["over_limit"] == (len(ids) > 20)


def test_frequent_pieces_are_bounded_and_exact(spark):
    texts = ["the cat the dog the end"] * 50 + _random_texts(20)
    found = token_counts.frequent_pieces(docs(spark, texts).select("doc_id", "text"), BYTE, size=8)
    lib = Tokenizer.from_file(BYTE)
    assert len(found) <= 8 and " the" in found
    assert all(n == len(lib.encode(p, add_special_tokens=False).ids) for p, n in found.items())


def test_cache_keeps_what_is_used():
    calls = []
    cache = pretokens.PieceCache(lambda p: calls.append(p) or len(p), {"pin": 3}, limit=4)
    for k in range(40):
        assert cache["hot"] == 3 and cache[f"w{k}"] == len(f"w{k}") and cache["pin"] == 3
        cache.trim()
        assert len(cache) <= 6 and len(cache.old) <= 7
    assert calls.count("hot") == 1 and "pin" not in calls


def test_codec_equals_the_library(spark, word_ids):
    lib = Tokenizer.from_file(WORD)
    got, full = (rows_by_id(f(docs(spark, ALL), WORD)) for f in (bpe_codec.codec_digest, bpe_codec.encode_decode))
    for i, ids in enumerate(word_ids):
        decoded = lib.decode(ids, skip_special_tokens=False)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), ALL[i]
        assert got[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
        assert full[i]["ids"] == ids and full[i]["decoded"] == decoded


def test_speculation_is_checked_exactly():
    bpe = bpe_codec.WordBpe(WORD)
    words = sorted({w for t in _random_texts(40, 1) for w in bpe.words(t)})
    exact = [[t.id for t in bpe.library.model.tokenize(pretokens.as_symbols(w))] for w in words]
    greedy = [bpe.propose(pretokens.as_symbols(w)) for w in words]
    assert bpe.encode_words(words) == exact
    # exactly the wrong guesses are merged again
    assert bpe.exact_words == sum(a != b for a, b in zip(greedy, exact)) > 0


def test_splits_agree_on_every_assigned_code_point():
    bpe, lib = pretokens.byte_bpe(BYTE), Tokenizer.from_file(BYTE)
    rng = random.Random(0)
    points = [chr(c) for c in range(0x3000) if not pretokens.has_unassigned(chr(c))]
    points += [chr(rng.randrange(0x3000, 0x110000)) for _ in range(4000)]
    points = [c for c in points if not 0xD800 <= ord(c) < 0xE000 and not pretokens.has_unassigned(c)]
    text = "".join(f"a{c}1{c}!{c} {c}" for c in points)
    offsets = lib.pre_tokenizer.pre_tokenize_str(text)
    assert bpe.pieces(text) == [text[a:b] for _, (a, b) in offsets]


@pytest.mark.parametrize("pattern", [pretokens.BYTE_LEVEL_PATTERN, bpe_codec.WORD_PATTERN])
def test_latin_pattern_equals_the_full_one(pattern):
    import regex

    rng = random.Random(1)
    latin, full = pretokens.latin_pattern(pattern), regex.compile(pattern)
    points = [chr(c) for c in range(0x250)] + list(" '\n\t") * 40 + list("srtvemld") * 20
    for _ in range(3000):
        text = "".join(rng.choice(points) for _ in range(rng.randint(1, 30)))
        assert latin.findall(text) == full.findall(text), repr(text)


def test_orc_round_trip(spark, byte_ids):
    path = shared_path(spark, "test-orc")
    ids = list(range(len(ALL)))
    random.Random(3).shuffle(ids)
    order = sorted(range(len(ALL)), key=lambda k: ids[k])
    token_orc.write_token_orc(docs(spark, ALL, ids), path, BYTE)
    got = rows_by_id(token_orc.token_digest(spark, path))
    start = 0
    for k in order:
        want = [*byte_ids[k], 0]
        row = got[ids[k]]
        assert (row["start"], row["n_tokens"]) == (start, len(want))
        assert row["ids_crc32"] == zlib.crc32(np.asarray(want, "<u4").tobytes())
        start += len(want)
    assert {r.doc_id: (r.start, r.ids) for r in token_orc.read_token_orc(spark, path).collect()} == {
        ids[k]: (got[ids[k]]["start"], [*byte_ids[k], 0]) for k in order}
    files = [r.file_path for r in spark.read.format("binaryFile").load(path).selectExpr("path file_path").collect()]
    meta = [orc.ORCFile(f.removeprefix("file:")) for f in files]
    assert sum(m.nrows for m in meta) == len(ALL)
    assert all(m.compression == "ZSTD" and m.row_index_stride == token_orc.ROW_INDEX_STRIDE for m in meta)
    plan = spark.read.schema(token_orc.FILE_SCHEMA).orc(path).filter("doc_id = 7")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in plan


@pytest.mark.parametrize("run", [lambda d: token_counts.token_counts(d, BYTE), lambda d: bpe_codec.codec_digest(d, WORD)])
def test_repeated_null_ids_and_extra_columns(spark, run):
    df = docs(spark, ["a b", "a b", None], [4, 4, None]).selectExpr("*", "1 as n_tokens", "2 as ids")
    assert sorted((str(r.doc_id), r.n_tokens) for r in run(df).collect()) == [("4", 2), ("4", 2), ("None", 0)]
    assert run(docs(spark, [])).count() == 0


def test_orc_edge_rows(spark):
    path = shared_path(spark, "test-orc")
    df = docs(spark, ["a b", "a b", None, "z"], [4, 4, None, 2]).selectExpr("*", "1 as file_no", "2 as start")
    token_orc.write_token_orc(df, path, BYTE)
    rows = token_orc.token_digest(spark, path).collect()
    assert sorted((r.start, str(r.doc_id), r.n_tokens) for r in rows) == [
        (0, "None", 1), (1, "2", 2), (3, "4", 3), (6, "4", 3)]
    empty = shared_path(spark, "test-orc")
    token_orc.write_token_orc(docs(spark, []), empty, BYTE)
    assert token_orc.token_digest(spark, empty).count() == 0


def test_orc_hot_id_lies_in_several_files(spark):
    rng = random.Random(9)
    rows = [(5, f"text {rng.random()}") for _ in range(600)] + [(None, "same")] * 600 + [(k, f"t {k}") for k in range(10, 610)]
    path = shared_path(spark, "test-orc")
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    token_orc.write_token_orc(df, path, BYTE)
    back = token_orc.read_token_orc(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in back] == [None] * 600 + [5] * 600 + list(range(10, 610))
    at = 0
    for r in back:
        assert r.start == at
        at += r.n_tokens
    sizes = sorted(r["count"] for r in spark.read.schema(token_orc.FILE_SCHEMA).orc(path).groupBy("file_no").count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert sorted(bytes(np.asarray(r.ids, "<u4")) for r in back) == sorted(
        bytes(np.asarray([*pretokens.byte_bpe(BYTE).library_ids(t), 0], "<u4")) for _, t in rows)


def test_ranks_give_the_pieces_of_the_library():
    bpe = pretokens.byte_bpe(BYTE)
    ranks = pretokens.rank_encoder(bpe)
    rng = random.Random(1)
    pieces = ["".join(rng.choice("abcdeinorst éßñ\u4e16\n \t1!\u00a0") for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    pieces = {p for text in pieces for p in bpe.pieces(text)} | {" ", "   ", "\n\n", "x" * 5000, "\U0001f600" * 40}
    for p in pieces:
        assert ranks.encode_ordinary(p) == bpe.piece_ids(p), p
