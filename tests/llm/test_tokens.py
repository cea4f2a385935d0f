"""BPE and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from entity360.llm import bpe_reuse, token_files, tokenizer
from entity360.llm.common import new_path
from entity360.llm.huffman import Code, code_lengths
from entity360.llm.queries import QUERIES
from entity360.llm.tokenizer import BytePairs
from tests.llm.cases import FOLDER, documents, empty, messy, messy_rows

PAIRS = BytePairs()
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ALPHABET = " \n\t.'ab1é½語😀\x1c\x85  "


def _ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), max_size=4))
def test_batches_encode_as_the_library_does(texts):
    assert [x.tolist() for x in PAIRS.encode(texts)] == [_ids(t) for t in texts]
    assert [PAIRS.decode(x) for x in PAIRS.encode(texts)] == texts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), max_size=4))
def test_words_found_by_arrow_encode_as_the_library_does(texts):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tokenizer, "FEW_CHARS", 0)
        assert [x.tolist() for x in PAIRS.encode(texts)] == [_ids(t) for t in texts]


def test_a_large_batch_makes_no_python_object_per_word():
    words = [f"w{i}é" for i in range(20_000)]
    texts = [" ".join(words[k::10]) for k in range(10)] + ["語 " + " ".join(words) + " 😀", "a  b \x85a"]
    PAIRS.forget()
    assert [x.tolist() for x in PAIRS.encode(texts)] == [_ids(t) for t in texts]
    assert len(tokenizer._memory(PAIRS.file).index) < 20  # first words and those of other scripts
    PAIRS.forget()


@settings(max_examples=200, deadline=None)
@given(st.text(ALPHABET + "cdefg", max_size=200), st.lists(st.integers(0, 200), max_size=6))
def test_joins_are_repaired_wherever_the_cuts_are(text, cuts):
    at = sorted({0, len(text), *(c for c in cuts if c < len(text))})
    parts = [(a, b, PAIRS.encode([text[a:b]])[0]) for a, b in zip(at[:-1], at[1:], strict=True)]
    if parts:
        assert bpe_reuse.joined(text, parts, PAIRS.encode).tolist() == _ids(text)


def test_chunks_follow_content_not_place():
    random.seed(4)
    shared = "".join(random.choices("abcdefgh ", k=20_000))
    keys = [{k for k, _ in bpe_reuse.chunks(random.choice("xyz") * n + shared)} for n in (1, 777)]
    assert len(keys[0] & keys[1]) >= 0.7 * len(keys[0])
    assert "".join(p for _, p in bpe_reuse.chunks(shared)) == shared
    assert bpe_reuse.chunks("") == []


def test_query_agrees_with_the_library(spark):
    rows = {r.doc_id: r for r in QUERIES["op7_bpe"](spark, FOLDER).collect()}
    for i, text in documents(spark):
        ids = _ids(text)
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        again = LIBRARY.decode(ids, skip_special_tokens=False)
        assert rows[i].decoded_sha256 == hashlib.sha256(again.encode()).hexdigest()
    assert len(rows) == len(documents(spark))


def test_bpe_of_odd_rows(spark):
    got = sorted(
        (r.id if r.id is not None else -1, np.frombuffer(r.ids, "<u4").tolist())
        for r in bpe_reuse.encode(messy(spark)).collect()
    )
    assert got == sorted((i if i is not None else -1, _ids(t)) for i, t in messy_rows())
    assert bpe_reuse.encode(empty(spark)).count() == 0


def test_token_file_query_agrees_with_the_library(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_token_files"](spark, FOLDER).collect()}
    start = 0
    for i, text in documents(spark):
        ids = np.array([*_ids(text), 0], "<u4")
        assert (rows[i].start, rows[i].n_tokens) == (start, len(ids))
        assert rows[i].ids_crc32 == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_token_files_of_odd_rows(spark):
    path = new_path(spark, "test-files")
    token_files.write_files(messy(spark), path, PAIRS)
    rows = token_files.read_files(spark, path).orderBy("start").collect()
    assert sorted(tuple(np.frombuffer(r.tokens, "<u4")) for r in rows) == sorted(
        (*_ids(t), 0) for _, t in messy_rows()
    )
    assert [r.doc_id for r in rows] == sorted(
        (i for i, _ in messy_rows()), key=lambda i: (i is not None, i)
    )
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    path = new_path(spark, "test-files")
    token_files.write_files(empty(spark), path, PAIRS)
    assert token_files.read_files(spark, path).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 50, 5_000])
def test_codes_are_prefix_codes_within_the_limit(n):
    counts = (1.6 ** np.minimum(np.arange(n), 60)).astype(np.int64)
    lengths = code_lengths(counts)
    assert lengths.max() <= 18 and lengths.min() >= 1
    assert n == 1 or sum(2.0 ** -int(x) for x in lengths) == 1.0


def test_blocks_decode_from_their_checkpoints():
    random = np.random.default_rng(8)
    ids = random.zipf(1.3, 40_000) % 5_000
    sizes = np.array([1, 127, 128, 129, 10_000, 29_615])
    code = Code(code_lengths(np.bincount(ids, minlength=5_000)))
    payloads, marks = code.encode(ids, sizes)
    for k, (payload, mark) in enumerate(zip(payloads, marks, strict=True)):
        own = ids[sizes[:k].sum() : sizes[: k + 1].sum()]
        counts = np.full(len(mark), 128)
        counts[-1] = len(own) - 128 * (len(mark) - 1)
        assert np.array_equal(code.decode(payload, mark, counts), own)
        last = mark[-1:]  # the last checkpoint alone is enough
        assert np.array_equal(code.decode(payload, last, counts[-1:]), own[-counts[-1] :])
