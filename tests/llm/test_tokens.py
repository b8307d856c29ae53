import glob
import hashlib
import random
import zlib

import numpy as np
import pyarrow.orc as orc
import pytest

from crewspark.llm import bpe, token_orc
from crewspark.llm.slices import slice_hashes, words_of

ALPHABET = " \n\t'' strmdvel'stm  abZé1٣²!.,漢😀　 \x1c\x85́ŕ"


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))) for _ in range(3000)] + [
        "", "a" * 3000, "ab" * 2000, " " * 500 + "x", "\n" * 300, "'s'll've" * 50, "I'm's 's  's", "don't, we'll.", "<|endoftext|> x", "word " * 30_000]


def test_bpe_equals_tiktoken_and_decodes(texts):
    import public_tokenizers as P
    import tiktoken

    own = bpe.encoder(bpe.byte_bpe_path())
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    ids, before, offsets = own.encode(texts)
    for text, b, e, back in zip(texts, before[:-1], before[1:], own.decode(ids, before, offsets)):
        assert ids[b:e].tolist() == theirs.encode_ordinary(text)
        assert back.decode() == text
    joined = "".join(texts).encode()
    assert all(joined[o:o + len(own.tokens[i])] == own.tokens[i] for i, o in zip(ids.tolist(), offsets.tolist()))


def test_bpe_equals_tiktoken_for_every_code_point():
    import public_tokenizers as P
    import tiktoken

    own = bpe.encoder(bpe.byte_bpe_path())
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    every = [chr(c) + "'sab 1" + chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 1 << 16):
        some = every[at:at + (1 << 16)]
        ids, before, _ = own.encode(some)
        assert [ids[b:e].tolist() for b, e in zip(before[:-1], before[1:])] == [theirs.encode_ordinary(t) for t in some]


def test_offsets_place_the_tokens():
    own = bpe.encoder(bpe.byte_bpe_path())
    ids, before, offsets = own.encode(["", "hello wörld unbelievableness", "", "x"])
    assert len(set(offsets.tolist())) == len(offsets)
    assert own.decode(ids, before, offsets)[1].decode() == "hello wörld unbelievableness"
    shifted = own.decode(ids[before[3]:], np.array([0, 1]), np.array([0]))
    assert shifted == [b"x"] and own.decode(np.empty(0, np.int64), np.zeros(2, np.int64), np.empty(0, np.int64)) == [b""]


def test_scan_is_the_prefix_product():
    start, product, _, _ = bpe.monoid()
    rng = np.random.default_rng(5)
    for n in (1, 63, 64, 65, 5000):
        x = start[rng.integers(0, len(start), n)]
        want, at = [], 0
        for e in x:
            at = product[at, e]
            want.append(at)
        assert bpe.scan(x, product).tolist() == want


def test_bpe_rows(frame):
    rows = [(1, "a text", "x"), (2, None, "x"), (3, "", None), (None, "a text", "y"), (1, "a text", "x")]
    got = bpe.encode_decode(frame(rows, "doc_id long, text string, ids string"), extra=("ids", "decoded")).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == 5
    for r in got:
        want = "a text" if r["doc_id"] in (1, None) else ""
        assert r["decoded"] == want and r["decoded_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
        assert want or (r["n_tokens"] == 0 and r["ids_sha256"] == empty)
    assert bpe.encode_decode(frame([], "doc_id long, text string")).count() == 0


@pytest.fixture(scope="module")
def library():
    """The tokenizer file as the library reads it, unaltered and not the operator's own object."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_orc.word_bpe_path())


def same_as_library(library, texts):
    ids, before = token_orc.word_encoder(token_orc.word_bpe_path()).encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [ids[b:e].tolist() for b, e in zip(before[:-1], before[1:])]
    wrong = [(t[:80], g[:20], w[:20]) for t, g, w in zip(texts, got, want) if g != w]
    assert not wrong, wrong[:5]


def test_word_encoder_equals_the_library(texts, library):
    same_as_library(library, texts)


def test_added_tokens_and_combining_marks(library):
    letters = "ABCDEHJKTWYÅÉÜÑßaehtwy<"
    marks = [chr(c) for c in range(0x300, 0x370)]
    same_as_library(library, [f"x {a}{m}{b}! It's" for a in letters for m in marks for b in ("", "B", "\u0301")])
    same_as_library(library, ["a <|endoftext|> b", "<|startoftext|>A<|ENDOFTEXT|>", "<|endoftext|>", "É<|endoftext|>É\u0301x", "no token <|end", "", "A" * 5000 + "<|endoftext|>" + "É" * 5000])


def test_word_encoder_for_every_code_point(library):
    same_as_library(library, [f"Ab{chr(c)}C!{chr(c)} 'S{chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000])


def test_orc_files_round_trip(spark, frame, tmp_path, library):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(3000)] + [(None, "no id"), (5000, None), (5001, "twice"), (5001, "twice")]
    out = str(tmp_path / "ids")
    token_orc.write_token_ids(frame([(a, b, 1) for a, b in rows], "doc_id long, text string, n_tokens int"), out)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r)[:4] for r in token_orc.token_index(spark, out).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    files = glob.glob(out + "/*.orc")
    assert sum(orc.ORCFile(f).nrows for f in files) == len(rows)
    assert all(orc.ORCFile(f).row_index_stride == 1000 for f in files)
    plan = token_orc.read_token_ids(spark, out, [17])._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "doc_id" in plan.split("PushedFilters")[1][:200]
    assert [r["ids"] for r in token_orc.read_token_ids(spark, out, [17]).collect()] == [library.encode(rows[17][1], add_special_tokens=False).ids + [2]]


def test_no_documents(spark, frame, tmp_path):
    out = str(tmp_path / "none")
    token_orc.write_token_ids(frame([], "doc_id long, text string"), out)
    assert token_orc.token_index(spark, out).count() == 0


def test_slice_hashes_depend_on_the_bytes_only():
    h, before, data, begin, end = words_of(["a bb a", None or "", "\x0b a  " + "z" * 9000 + " bb", "é"])
    assert before.tolist() == [0, 3, 3, 6, 7]
    words = [data[b:e] for b, e in zip(begin, end)]
    same = {}
    for w, x in zip(words, h.tolist()):
        assert same.setdefault(w, x) == x
    assert len(set(h.tolist())) == len(set(words))
    assert slice_hashes(b"", np.empty(0, np.int64), np.empty(0, np.int64)).tolist() == []
