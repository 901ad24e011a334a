"""The lexicon's automaton and the corpus encoding, against the public library."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orgloom.llm import tokenize
from orgloom.llm.lexicon import Lexicon, compile_lexicon

RANKS = f"{tokenize.TOKENIZERS}/byte_bpe_50k.tiktoken"


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 60_000), max_size=4), max_size=40), st.binary(max_size=6))
def test_lexicon_is_the_dictionary(entries, other):
    lexicon = Lexicon(compile_lexicon(entries))
    assert lexicon.size == len(entries)
    for word, ids in entries.items():
        assert lexicon.get(word) == list(ids)
    assert lexicon.get(other) == (list(entries[other]) if other in entries else None)
    assert [lexicon.rank(w) for w in sorted(entries)] == list(range(len(entries)))


def test_suffixes_are_shared():
    stems = [bytes([a, b]) for a in range(97, 117) for b in range(97, 117)]
    lexicon = Lexicon(compile_lexicon({s + b"ation": [1] for s in stems}))
    assert len(lexicon.base) < 40  # a tree would have thousands of states


def test_a_mapped_file(tmp_path):
    (tmp_path / "x.bin").write_bytes(compile_lexicon({b"a": [1], b"ab": [2, 3]}))
    lexicon = Lexicon.map_file(str(tmp_path / "x.bin"))
    assert (lexicon.get(b"ab"), lexicon.get(b"abc"), lexicon.get(b"")) == ([2, 3], None, None)
    with pytest.raises(ValueError):
        compile_lexicon({b"": [1]})
    with pytest.raises(ValueError):
        Lexicon(b"nonsense" + bytes(64))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokenize.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def test_merges(library):
    ranks = tokenize.read_ranks(RANKS)
    random.seed(1)
    words = ["a" * 4000, "zzxqj", "été", "日本", "مسجد"] + ["".join(random.choices("etaoinshrdlu", k=random.randint(1, 30))) for _ in range(200)]
    for w in words:
        assert tokenize.merge(w.encode(), ranks) == library.encode(w, add_special_tokens=False).ids


@pytest.mark.parametrize("lexicon_words", [0, 5, 50_000])
def test_encode(spark, library, lexicon_words):
    texts = ["The board's  meeting\n\n at 5:30", "", None, " ", "<|endoftext|> x", "نماز جمعہ", "😀é\u0000", "word " * 3000, "The board's meeting", "The board's meeting"]
    df = spark.createDataFrame([(i if i != 4 else None, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    got = tokenize.encode(df, "doc_id", "text", lexicon_words=lexicon_words)
    assert got.columns == ["doc_id", "ids"]
    ids = {r.doc_id: list(r.ids) for r in got.collect()}
    for i, t in enumerate(texts):
        assert ids[i if i != 4 else None] == library.encode(t or "", add_special_tokens=False).ids
    assert ids[1] == ids[2] == []


def test_counts_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b")], "id int, t string")
    assert [tuple(r) for r in tokenize.encode(df, "id", "t", counts_only=True).collect()] == [(1, 2), (1, 2)]
    assert tokenize.encode(df.limit(0), "id", "t").count() == 0


def test_encode_carries_columns_without_a_join(spark):
    """Null and repeated ids keep their own rows and sources."""
    df = spark.createDataFrame([(1, "a b", "web"), (1, "a b c", "news"), (None, "x", "web"), (None, None, None)], "id long, t string, source string")
    got = sorted(tuple(r) for r in tokenize.encode(df.select("t", "source", "id"), "id", "t", counts_only=True, carry=["source"]).select(F.coalesce("id", F.lit(-1)), F.coalesce("source", F.lit("")), "n_tokens").collect())
    assert got == [(-1, "", 0), (-1, "web", 1), (1, "news", 3), (1, "web", 2)]
