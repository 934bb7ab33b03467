"""Ids and decoded texts against the tokenizers library; the transducer against a dictionary."""

import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import bpe, transducer
from starloom.llm.transducer import Transducer, compiled

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


def ids_of(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


HARD = [
    "", " ", "Hello  World's it'll I'm don't 12ab", "a<|endoftext|>b<|startoftext|>", "<|endoftext", "é é ñ Å ΣΑΣ İ ß ẞ", "x\x1cy \x1f z\x85q　w​v", "!!!'s ''' '''s",
    "日本語テキスト 한국어 العربية हिन्दी ไทย", "😀👨‍👩‍👧 ½ ² ١٢", "a" * 300, "abc" * 200, "-" * 120, "\0\x01", "don'T CAN'T 'Re", "0x1f 3.14159 1e-9",
]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(library, vocabulary, text):
    codec = bpe.Codec(vocabulary, Transducer(compiled([])))
    packed = codec.encode(text)
    expected = library.encode(text, add_special_tokens=False).ids
    assert ids_of(packed) == expected
    assert codec.decode(packed) == library.decode(expected, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from("abcdehinorst' \n<|>")), max_size=60))
def test_any_text(text):
    with open(PATH, encoding="utf-8") as file:
        test_any_text.vocabulary = getattr(test_any_text, "vocabulary", None) or bpe.Vocabulary(file.read())
    test_any_text.library = getattr(test_any_text, "library", None) or Tokenizer.from_file(PATH)
    codec = bpe.Codec(test_any_text.vocabulary, Transducer(compiled([])))
    assert ids_of(codec.encode(text)) == test_any_text.library.encode(text, add_special_tokens=False).ids


def test_long_pieces_merge_alike(vocabulary):
    piece = "thetionofandinger" * 9
    parts = [vocabulary._characters[b] for b in piece.encode()]
    parts[-1] += "</w>"
    long = [vocabulary.ids[p] for p in vocabulary._merged_long(list(parts))]
    while True:
        ranked = [(vocabulary.ranks[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in vocabulary.ranks]
        if not ranked:
            break
        _, i = min(ranked)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    assert long == [vocabulary.ids[p] for p in parts]


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in bpe.encode_texts(docs, PATH, lexicon_words=500).collect():
        expected = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert ids_of(row["ids"]) == expected
        assert row["decoded"] == library.decode(expected, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.binary(max_size=6), st.binary(max_size=8), max_size=60))
def test_transducer_is_a_dictionary(entries):
    automaton = Transducer(compiled(list(entries.items())))
    for word, output in entries.items():
        assert automaton.get(word) == output
    for word in (b"", b"a", b"zz", b"abc"):
        assert automaton.get(word) == entries.get(word)


def test_transducer_shares_endings(tmp_path):
    words = [stem + ending for stem in (b"walk", b"talk", b"jump") for ending in (b"", b"s", b"ed", b"ing")]
    content = compiled([(w, w.upper()) for w in words])
    file = tmp_path / "lexicon"
    file.write_bytes(content)
    automaton = Transducer.open(str(file))
    assert all(automaton.get(w) == w.upper() for w in words)
    assert automaton.words == len(words)
    assert automaton.states < 20  # 13 for the stems at most, endings once


@pytest.mark.parametrize("word", ["word", "Word.", "WORD?", "don't", "it's.", "a..", "x1.", ".", "..", "<|endoftext|>.", "Straße,", "ΣΑΣ.", "z" * 60 + "!"])
def test_words_of_letters_are_cut_as_the_patterns_cut_them(library, vocabulary, word):
    assert ids_of(vocabulary.encoded(word)) == library.encode(word, add_special_tokens=False).ids


def test_a_codec_that_forgets_gives_the_same_ids(vocabulary, monkeypatch):
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{'s' * (i % 5)}" for i in range(900)) + " waa wba" * 50
    plain = bpe.Codec(vocabulary, Transducer(compiled([]))).encode(text)
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    monkeypatch.setattr(transducer, "MOST_HEADS", 7)
    vocabulary._pieces.clear()
    words = sorted(set(text.split()))[::2]
    codec = bpe.Codec(vocabulary, Transducer(compiled([(w.encode(), vocabulary.encoded(w)) for w in words])))
    assert codec.encode(text) == plain and len(codec._ids) <= 20 and len(codec._before) <= 20
    assert all(len(x) <= 40 for x in (vocabulary._pieces, codec.lexicon._heads))
    # Words that were in use last outlive a change of halves.
    monkeypatch.setattr(Transducer, "get", lambda *_: pytest.fail("looked up again"))
    assert codec.encode(text.split()[-1]) == vocabulary.encoded(text.split()[-1])
