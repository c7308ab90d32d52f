from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import packing
from lakemart.llm.registry import tokenizer_path
from llm_util import ODD


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def expected(tokenizer, text):
    return [*(tokenizer.encode(text, add_special_tokens=False).ids if text else []), 1]


@given(st.integers(1, 20_000), st.sampled_from([64, 100, 2048]))
@settings(max_examples=200, deadline=None)
def test_cut_covers_and_fits_classes(length, capacity):
    parts = packing.cut(length, capacity, 0.01)
    assert sum(n for n, _ in parts) == length
    assert all(j == capacity // n and n * j <= capacity for n, j in parts)


@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs"]), st.sampled_from("ab XY.,'İΣ\x1ć")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_word_ids_equal_the_tokenizer(text):
    if not hasattr(packing, "_test_store"):
        with open(tokenizer_path(), encoding="utf-8") as f:
            packing._test_store = packing.WordIds(f.read())
    store = packing._test_store
    ids = store.tokenizer.encode(text, add_special_tokens=False).ids
    assert store.by_word and store.text(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_round_trip_and_little_padding(docs_of, prose, tokenizer):
    texts = [prose(5 + 37 * i, i) for i in range(60)] + ODD + ["word"]
    docs = docs_of(texts).repartition(3)
    rows = packing.pack(docs, tokenizer_path()).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for i, t in enumerate(texts):  # every id in exactly one piece, in order
        got, at = [], 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            ids = struct.unpack(f"<{r['length']}I", bytes(r["ids"]))
            assert r["start"] == at and r["length"] > 0
            got += ids
            at += r["length"]
        assert got == expected(tokenizer, t) and all(r["doc_tokens"] == len(got) for r in by_doc[i])
    padding = used = 0
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY
        used += at
        padding += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    assert padding <= 0.011 * used


def test_pieces_carry_the_checksum_of_their_ids(docs_of, prose):
    docs = docs_of([prose(900, 1), None])
    full = {(r["doc_id"], r["start"]): r for r in packing.pack(docs, tokenizer_path()).collect()}
    for r in packing.pieces(docs, tokenizer_path()).collect():
        assert r["ids_crc32"] == zlib.crc32(bytes(full[r["doc_id"], r["start"]]["ids"]))


def test_empty_table_repeated_rows_and_null_ids(docs_of):
    assert packing.pack(docs_of([]), tokenizer_path()).count() == 0
    rows = packing.pieces(docs_of(["a b", "a b", "c"], ids=[7, 7, None]), tokenizer_path()).collect()
    ids = defaultdict(int)
    for r in rows:
        ids[r["doc_id"]] += r["length"]
    assert ids == {7: 6, None: 2}  # the repeated row is packed twice
