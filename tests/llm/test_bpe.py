from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import bpe
from lakemart.llm.registry import tokenizer_path
from llm_util import ODD

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
_HELD: dict = {}


def both(name):
    """The library's tokenizer and an encoder of the same file."""
    from tokenizers import Tokenizer

    if name not in _HELD:
        with open(tokenizer_path(name), encoding="utf-8") as f:
            _HELD[name] = Tokenizer.from_file(tokenizer_path(name)), bpe.Encoder(bpe.Rules(f.read()))
    return _HELD[name]


ALPHABET = st.one_of(st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs"]),
                     st.sampled_from("aaabbbnnoothe 'sXY.,!12İΣ\x1c\x1f́\t"), st.sampled_from(["<|endoftext|>", "😀", "中", " "]))


@pytest.mark.parametrize("name", FILES)
@given(st.lists(ALPHABET, max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_and_text_equal_the_library(name, parts):
    library, encoder = both(name)
    text = "".join(parts)
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], dtype="<i4").tolist() == want
    assert encoder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_every_latin_character():
    """The short way for Latin text gives what the vocabulary's own steps give."""
    library, encoder = both(FILES[0])
    texts = [f"{before}{chr(c)}{after}" for c in range(0x250) for before, after in (("", ""), ("a", "b"), ("1", "!"), ("É", "É"))]
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, dtype="<i4").tolist() == library.encode(text, add_special_tokens=False).ids, hex(ord(max(text)))


@pytest.mark.parametrize("name", FILES)
def test_runs_and_long_words(name):
    library, encoder = both(name)
    texts = ["a" * 5000, "aab" * 700, "!" * 999, "ha" * 3001, "é" * 500, "x" * 200_000, "the" * 11 + " " + "0" * 77]
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, dtype="<i4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_verified_proposals_are_exact_and_failing_ones_are_not(name):
    """The pair test accepts a proposal exactly when the merges give it."""
    _, encoder = both(name)
    rng = np.random.default_rng(5)
    pieces = [s for s in encoder.rules.inner if s.isascii() and s.isalpha()]
    words = ["".join(rng.choice(pieces, rng.integers(1, 5))) for _ in range(4000)] + ["a" * n for n in range(1, 40)]
    proposals = [encoder.propose(w) for w in words]
    exact = [[n[0] for n in encoder.rules.merges.nodes(encoder.rules.symbols(w))] for w in words]
    assert encoder.verify(proposals).tolist() == [p == e for p, e in zip(proposals, exact)]
    assert [encoder.rules.merges.ids(encoder.rules.symbols(w)) for w in words] == exact


def test_small_stores_and_decoding_of_unknown_ids():
    library, _ = both(FILES[0])
    encoder = bpe.Encoder(both(FILES[0])[1].rules, room=3)
    texts = [f"some words {i} here" for i in range(50)] + [None, ""]
    for t in texts:
        assert np.frombuffer(encoder.encode([t])[0], dtype="<i4").tolist() == library.encode(t or "", add_special_tokens=False).ids
    assert encoder.decode([-1, 10**9]) == "" and encoder.decode([]) == ""


def test_query_equals_the_library(spark, docs_of, prose):
    library, _ = both(FILES[0])
    texts = [prose(30 + i, i) for i in range(40)] + ODD + ["Isn't <|endoftext|> it?", "ÉCOLE İ ΑΣ", "x" * 30_000] + [prose(31, 1)] * 2
    rows = bpe.digest(docs_of(texts).repartition(3), tokenizer_path()).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_decoding_a_column_of_ids(spark):
    library, _ = both(FILES[1])
    ids = library.encode("Some ids, naïve ones\n").ids
    df = spark.createDataFrame([(1, ids), (2, None), (3, [])], "k int, ids array<int>").repartition(1)
    out = df.select("k", bpe.decode(df["ids"], bpe.shared_rules(df, tokenizer_path(FILES[1]))).alias("text"))
    assert {r["k"]: r["text"] for r in out.collect()} == {1: "Some ids, naïve ones\n", 2: "", 3: ""}


def test_columns_pass_through(spark, docs_of):
    assert bpe.digest(docs_of([]), tokenizer_path()).count() == 0
    odd = spark.createDataFrame([(None, "a b", 7, "x"), (None, "a b", 7, "x"), (3, None, None, None)], "doc_id long, text string, ids int, _text string")
    out = bpe.encode(odd, tokenizer_path())
    assert out.columns == ["doc_id", "text", "_text", "ids", "decoded"]
    assert sorted((str(r["doc_id"]), r["text"], r["_text"], len(r["ids"]), r["decoded"]) for r in out.collect()) == [
        ("3", None, None, 0, ""), ("None", "a b", "x", 2, "a</w> b</w>"), ("None", "a b", "x", 2, "a</w> b</w>")]


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        bpe.Rules('{"model": {"type": "WordPiece", "vocab": {}}}')
