"""Operators 3 and 9: exact against the tokenizer libraries, and round trips."""

import base64
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from llm_data import EDGES, docs_of, words
from tokenizers import Tokenizer

from tidemart.llm import bpe, pretokens, queries, token_binary

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("text", [
    "", " ", "  ", "a  b", "a \n b", "\n\n x", "it's 'sing 'rest ''s ' s x'", "'", "a'", "  'll we'll've", "1a2 ½ x",
    "tab\tx \t y", "end  ", "日本 語。 x", "á é​z", " x y\x85z\x1c w", "'S 'Re", "🙂🙂 🙂", "don't'd"])
def test_split_equals_the_pattern(text):
    joined, starts, ends, first = pretokens.split(["x", text, "", "'t"])
    got = [[joined[a:b] for a, b in zip(starts[lo:hi], ends[lo:hi])] for lo, hi in zip(first[:-1], first[1:])]
    assert got == [regex.findall(public_tokenizers.PATTERN, t) for t in ("x", text, "", "'t")]


def test_split_of_random_texts():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list(" \n\t'strevmld1!é "), 40)) for _ in range(400)]
    joined, starts, ends, first = pretokens.split(texts)
    for i, t in enumerate(texts):
        assert [joined[a:b] for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])] == regex.findall(public_tokenizers.PATTERN, t)


@pytest.mark.parametrize("layout", ["byte", "bit"])
def test_planes_round_trip(layout):
    for n in (1, 7, 8, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << 32, n).astype("<u4")
        assert (token_binary.from_planes(token_binary.to_planes(ids, layout), n, layout) == ids).all()


@pytest.mark.parametrize("layout", ["byte", "bit"])
def test_files_hold_the_library_ids(spark, edges, tmp_path, layout):
    path = f"{tmp_path}/ids"
    token_binary.write_tokens(edges, path, MODEL, layout=layout, block_ids=1000)  # long texts cross many blocks
    rows = token_binary.read_tokens(spark, path).orderBy("start").collect()
    model = Tokenizer.from_file(MODEL)
    got, start = sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in rows), 0
    want = sorted(((i is not None, i or 0, np.array(model.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
                   for i, t, _ in EDGES))
    assert got == want
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys)
    for r in rows:
        assert (r.start, r.n_tokens) == (start, len(r.ids) // 4)
        start += r.n_tokens


def test_no_documents_write_no_ids(spark, nothing, tmp_path):
    token_binary.write_tokens(nothing, f"{tmp_path}/none", MODEL)
    assert token_binary.read_tokens(spark, f"{tmp_path}/none").count() == 0


def test_bpe_equals_tiktoken_and_decodes(spark, edges):
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.decode(bpe.encode(edges, RANKS), RANKS).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got = sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in rows), key=key)
    want = sorted(((i, own.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in EDGES), key=key)
    assert got == want


def test_bpe_of_repeated_characters_and_every_byte(spark):
    texts = ["a" * 300, "ab" * 100, " " * 70 + "x", "".join(map(chr, range(1, 700))), "<|endoftext|>", "".join(words(1, 50))]
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    rows = bpe.encode(docs_of(spark, [(i, t) for i, t in enumerate(texts)]), RANKS).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == {i: own.encode_ordinary(t) for i, t in enumerate(texts)}


def test_bpe_of_nothing_and_null_ids(spark, nothing):
    assert bpe.encode(nothing, RANKS).count() == 0
    rows = spark.createDataFrame([(1, None, "kept"), (2, [], "kept"), (3, [64, 65], "kept")], "doc_id long, ids array<int>, decoded string")
    got = {r.doc_id: r.decoded for r in bpe.decode(rows, RANKS).collect()}
    pieces = {v: k for k, v in bpe.read_ranks(RANKS).items()}
    assert got == {1: None, 2: b"", 3: pieces[64] + pieces[65]}


def test_the_rank_map_stays_out_of_the_plan(spark):
    coded = bpe.encode(docs_of(spark, [(1, "unheardofness zyxwv"), (2, None)]), RANKS)
    assert len(coded._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    ranks = bpe.rank_table(spark, RANKS).collect()
    assert [tuple(map(list, r)) for r in ranks] == [bpe.rank_map(bpe.pair_ranks(bpe.read_ranks(RANKS)))]


def test_rank_map_finds_every_pair_and_nothing_else():
    pairs = bpe.pair_ranks(bpe.read_ranks(RANKS))
    shifts, slots = bpe.rank_map(pairs)
    for key in [*list(pairs)[::97], 12345, (1 << 32) - 1]:
        c = (key * bpe.CLASS_MUL >> 28) % (1 << bpe.CLASS_BITS)
        entry = slots[bpe._slot(key, shifts[c])]
        assert (entry & ((1 << bpe.RANK_BITS) - 1) if entry >> bpe.RANK_BITS == key else None) == pairs.get(key)


def test_long_words_are_cut_where_no_piece_spans(spark):
    """100,000 bytes without a break: mixed scripts, digits and rules of signs."""
    pick = random.Random(9)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = ["".join(chr(pick.randint(0x4E00, 0x9FFF)) for _ in range(33_000)), "".join(pick.choice("bcdfghjklmnpqrstvwxzßñ") for _ in range(3_000)),
             "".join(pick.choice("aeinst") for _ in range(700)), "".join(chr(pick.randint(0xAC00, 0xD7A3)) for _ in range(5_000))]
    rows = bpe.decode(bpe.encode(docs_of(spark, [(i, t) for i, t in enumerate(texts)]), RANKS), RANKS).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: own.encode_ordinary(t) for i, t in enumerate(texts)}
    assert {r.doc_id: bytes(r.decoded).decode() for r in rows} == dict(enumerate(texts))


def test_frequent_words_change_no_id(spark, monkeypatch):
    """The same ids without the dictionary, with a small one, and with small rows and chunks."""
    docs = docs_of(spark, [(i, " ".join(words(i % 7, 300))) for i in range(40)])
    want = {r.doc_id: r.ids for r in bpe.encode(docs, RANKS).collect()}
    for name, value in (("DICTIONARY", 50), ("ROW_WORDS", 3), ("CHUNK_CHARS", 5000), ("DICTIONARY", 0)):
        monkeypatch.setattr(bpe, name, value)
        assert {r.doc_id: r.ids for r in bpe.encode(docs, RANKS).collect()} == want
        assert len(bpe.frequent_words(docs, RANKS).hashes) <= max(bpe.DICTIONARY, 0)


def test_one_pass_over_the_pieces_of_a_word_equals_merging_pair_by_pair(spark):
    """Words of pieces of the vocabulary and of random letters, up to more bytes than a mask holds."""
    pick = random.Random(5)
    ranks = bpe.read_ranks(RANKS)
    table = bpe._Words(ranks)
    assert not table.odd.any()  # a trained vocabulary: every word of up to MASK_BYTES takes the one pass
    pieces = [p.decode() for p in ranks if p.isalpha()]
    texts = [" ".join("".join(pick.choices(pieces, k=pick.randint(2, 6))) for _ in range(300)),
             " ".join("".join(pick.choices("aeinstéñß日я🙂", k=pick.randint(2, 12))) for _ in range(300)),
             " ".join("z" * n for n in range(2, 40))]
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.encode(docs_of(spark, list(enumerate(texts))), RANKS).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: own.encode_ordinary(t) for i, t in enumerate(texts)}
    offsets = np.array([0, 5, 5 + bpe.MASK_BYTES, 6 + 2 * bpe.MASK_BYTES])
    _, sizes, words, _ = table.unfolded(np.frombuffer(b"hello" + b"e" * (2 * bpe.MASK_BYTES + 1), np.uint8), offsets)
    assert np.frombuffer(sizes[0].as_py(), np.int32).tolist() == [5, bpe.MASK_BYTES, 0]
    assert [len(w) for w in words[0].as_py()] == [0, 0, bpe.MASK_BYTES + 1]


def test_pieces_that_come_up_late_are_merged_pair_by_pair(spark, tmp_path):
    """A rank file no training makes: "abc" ranks before "bc", its only way; "zzz" before "zz"."""
    pieces = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"zzz", b"zz", b"xa", b"abcabc", b"q\xc3"]
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % i for i, p in enumerate(pieces)))
    ranks = bpe.read_ranks(str(path))
    odd = bpe._Words(ranks).odd
    assert [pieces[i] for i in np.flatnonzero(odd)] == [b"abc", b"zzz", b"abcabc"]
    own = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["yabc xabc abcabcd xabcabc", "yzz zzzz zzzzzzz" + "z" * 40, "bcbc qé aqéabc ybcq", " ".join("".join(p) for p in itertools.product("abcxz", repeat=5))]
    rows = bpe.encode(docs_of(spark, list(enumerate(texts))), str(path)).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: own.encode_ordinary(t) for i, t in enumerate(texts)}


def test_op9_digests_on_the_small_table(spark):
    import hashlib

    import duckdb

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    small = "/root/testdata/sf0.001"
    want = set()
    for i, text in duckdb.sql(f"select doc_id, text from '{small}/documents.parquet'").fetchall():
        ids = own.encode_ordinary(text or "")
        want.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert {tuple(r) for r in queries.op9_bpe(spark, small).collect()} == want


def test_added_tokens_inside_texts_equal_the_library(spark, tmp_path):
    model = Tokenizer.from_file(MODEL)
    mark = "<|endoftext|>"
    texts = ["plain", f"a {mark} b", mark, mark + mark, f"{mark}start", f"end{mark}", f"x{mark}{mark} y\n{mark} ", "", f"{mark[:-1]} {mark}", None]
    path = f"file://{tmp_path}/ids"
    token_binary.write_tokens(docs_of(spark, list(enumerate(texts))), path, MODEL)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_binary.read_tokens(spark, path).collect()}
    assert got == {i: model.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}


def test_op3_digests_on_the_small_table(spark):
    import zlib

    import duckdb

    model, small, want, start = Tokenizer.from_file(MODEL), "/root/testdata/sf0.001", set(), 0
    for i, text in duckdb.sql(f"select doc_id, text from '{small}/documents.parquet' order by doc_id").fetchall():
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.add((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert {tuple(r)[:4] for r in queries.op3_token_binary(spark, small).collect()} == want
