import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, prefix_bpe, token_blocks
from tidemark.llm.byte_tokens import byte_tokens
from tidemark.llm.prefix_bpe import PrefixTable, prefix_tokens

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", " ", "  a", "a  b", "foo\n\n  bar \n", "foo\n bar", " don't  stop's x", "é　 　x  ", "a ​ b 12.5, (foo)", "!\x1c!", "<|endoftext|> a", "中文 text", "x" * 5000, "\t\n", "áb", "W!! A?? ok.", "nul\x00 a  b", "a\n\n\nb \t c\r\nd", " lead\n", "tab\tb\x0bc", "a　 b", "x\u2028 y", "a.\n"]
texts = st.text(st.sampled_from("ab éñ中 \n\t'.,12!\x1c　x"), max_size=60)


@pytest.fixture(scope="module")
def library():
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return Tokenizer.from_file(JSON), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(texts, max_size=5))
def test_ids_are_the_libraries(library, some):
    some = some + ODD[:6]
    for text, a, b in zip(some, byte_tokens(JSON).encode_many(some), prefix_tokens(RANKS, P.PATTERN).encode_many(some)):
        assert a.tolist() == library[0].encode(text, add_special_tokens=False).ids
        assert b.tolist() == library[1].encode_ordinary(text)


def test_odd_texts(library):
    for text, a, b in zip(ODD, byte_tokens(JSON).encode_many(ODD), prefix_tokens(RANKS, P.PATTERN).encode_many(ODD)):
        assert a.tolist() == library[0].encode(text, add_special_tokens=False).ids, text
        assert b.tolist() == library[1].encode_ordinary(text), text
        assert prefix_tokens(RANKS, P.PATTERN).vocabulary.decode(b.tolist()) == text.encode()


def test_memory_forgets_without_harm(library):
    tokens = type(byte_tokens(JSON))(JSON)
    tokens.known.most = 3
    for k in range(6):
        some = [f"word{k} other{k % 2} same same{k}", "same other0"]
        assert [x.tolist() for x in tokens.encode_many(some)] == [library[0].encode(t, add_special_tokens=False).ids for t in some]


def test_prefix_tables_append_and_edit():
    v, rng = prefix_tokens(RANKS, P.PATTERN).vocabulary, random.Random(2)
    for _ in range(200):
        s = bytes(rng.choice(b"aeiothnsr") for _ in range(rng.randint(0, 40)))
        a, b = sorted((rng.randint(0, len(s)), rng.randint(0, len(s))))
        grown = PrefixTable(v, s[:a])
        grown.append(s[a:])
        assert grown.last == PrefixTable(v, s).last
        grown.edit(a, b, b"then")
        assert grown.last == PrefixTable(v, s[:a] + b"then" + s[b:]).last


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 9), st.integers(0, 2**32 - 1)), max_size=300), max_size=4))
def test_frames_round_trip(lists):
    ids = [np.array(x, "<u4") for x in lists]
    names = [None if k == 1 else k - 2 for k in range(len(ids))]
    got, sizes, flat = token_blocks.decode_frame(token_blocks.encode_frame(names, ids))
    assert got == names and sizes.tolist() == [len(x) for x in lists] and flat.tolist() == [i for x in lists for i in x]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 9), st.integers(0, 2**32 - 1)), max_size=700))
def test_a_block_alone(ids):
    payload = token_blocks.encode_frame([4, 5], [np.array(ids, "<u4"), np.array([7], "<u4")])
    whole = [*ids, 7]
    for k in range(-(-len(whole) // 128)):
        assert token_blocks.decode_block(payload, k).tolist() == whole[128 * k : 128 * k + 128]
    with pytest.raises(IndexError):
        token_blocks.decode_block(payload, -(-len(whole) // 128))


def test_shortcut_only_for_its_pattern(library):
    import tiktoken

    other = r"\S+|\s+"
    plain = tiktoken.Encoding("other", pat_str=other, mergeable_ranks={b: i for b, i in prefix_tokens(RANKS, P.PATTERN).vocabulary.ranks.items()}, special_tokens={})
    some = ["don't stop. now", "a  b c!\nd", "x y"]
    assert [x.tolist() for x in prefix_bpe.PrefixTokens(RANKS, other).encode_many(some)] == [plain.encode_ordinary(t) for t in some]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, start string, ids int, k int")


ROWS = [(5, "b c", "x", 1, 1), (2, None, "x", 1, 1), (2, "zz top", "x", 1, 1), (None, "n", "x", 1, 1), (9, "", "x", 1, 1), (2, "zz top", "x", 1, 1), (7, "long word " * 3000, "x", 1, 1)]


def test_store(spark, library, tmp_path):
    token_blocks.write_token_store(docs(spark, ROWS), f"file://{tmp_path}/s", JSON, 2)
    got = token_blocks.read_token_store(spark, f"file://{tmp_path}/s").orderBy("start").collect()
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for g, r in zip(got, rows, strict=True):
        want = library[0].encode(r[1] or "", add_special_tokens=False).ids + [2]
        assert (g["doc_id"], g["start"], g["n_tokens"]) == (r[0], start, len(want)) and np.frombuffer(g["ids"], "<u4").tolist() == want
        assert zlib.crc32(np.array(want, "<u4").tobytes()) == zlib.crc32(bytes(g["ids"]))
        start += len(want)
    token_blocks.write_token_store(docs(spark, []), f"file://{tmp_path}/e", JSON, 2)
    assert token_blocks.read_token_store(spark, f"file://{tmp_path}/e").count() == 0


def test_round_trips_and_decode(spark, library):
    import hashlib

    got = prefix_bpe.round_trips(docs(spark, ROWS), RANKS, P.PATTERN).collect()
    assert sorted((str(g["doc_id"]), g["ids_sha256"], g["decoded_sha256"]) for g in got) == sorted(
        (str(r[0]), hashlib.sha256(",".join(map(str, library[1].encode_ordinary(r[1] or ""))).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in ROWS
    )
    back = prefix_bpe.decode(prefix_bpe.encode(docs(spark, ROWS), RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert sorted(bytes(b["data"]) for b in back) == sorted((r[1] or "").encode() for r in ROWS)
    assert prefix_bpe.round_trips(docs(spark, []), RANKS, P.PATTERN).count() == 0


def best_fit(sizes, window):
    left = []
    for s in sorted(sizes, reverse=True):
        fits = [x for x in left if x >= s]
        if fits:
            left.remove(min(fits))
        left.append((min(fits) if fits else window) - s)
    return sorted(left)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=80))
def test_plan_is_best_fit_decreasing(sizes):
    from collections import Counter

    windows = {}
    for s, lo, hi, seq, each, at in packing.plan(Counter(sizes), 16):
        for r in range(lo, hi):
            windows.setdefault(seq + (r - lo) // each, []).append((at + (r - lo) % each * s, s))
    for parts in windows.values():
        parts.sort()
        assert all(at == sum(s for _, s in parts[:k]) for k, (at, _) in enumerate(parts))
    assert sorted(16 - sum(s for _, s in w) for w in windows.values()) == best_fit(sizes, 16)


def test_pack(spark, library):
    packed = packing.pack(docs(spark, ROWS), JSON, 64, 1)
    rows = packed.collect()
    want = sorted(tuple(library[0].encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in ROWS)
    whole = {}
    for r in rows:
        whole.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    assert sum(r["length"] for r in rows) == sum(map(len, want))
    seqs = packing.sequences(packed, 64).collect()
    assert sum(s["n_tokens"] for s in seqs) == sum(map(len, want)) and all(len(s["ids"]) == 256 for s in seqs)
    assert all(sum(p["length"] for p in s["documents"]) == s["n_tokens"] for s in seqs)
    assert packing.pack(docs(spark, []), JSON).count() == 0
