"""Words that encoders remember: each is encoded once, and its ids are those of the library."""

from array import array

import pyarrow as pa
from tokenizers import Tokenizer

import public_tokenizers
from citelight.llm import packing, token_files, words

BYTE_FILE, WORD_FILE = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json"))


class Counting:
    """A tokenizer that notes what its model is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given, self.model = tokenizer, [], self

    def tokenize(self, letters):
        self.given.append(letters)
        return self.tokenizer.model.tokenize(letters)

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)


def test_token_files_encode_a_word_once_whatever_marks_close_it():
    encoder, tokenizer = token_files.Encoder(BYTE_FILE), Tokenizer.from_file(BYTE_FILE)
    encoder.tokenizer = counting = Counting(encoder.tokenizer)
    texts = ["so wéird, then wéird. and wéird! or wéird?!", "then wéird;\nwéird: wéird, wéird", ""]
    for _ in range(2):
        assert encoder.batch(pa.array(texts)) == [array("I", tokenizer.encode(t).ids).tobytes() for t in texts]
    spelt = "Ġ" + "wéird".encode().decode("latin-1").translate(token_files._LETTERS)
    assert counting.given.count(spelt) == 1
    assert counting.given.count(spelt[1:]) == 1  # after a line feed


def test_packing_encodes_a_word_once_whatever_marks_close_it():
    encoder, tokenizer = packing.WordEncoder(WORD_FILE), Tokenizer.from_file(WORD_FILE)
    encoder.tokenizer = counting = Counting(encoder.tokenizer)
    texts = ["wéird, Wéird. and WéIRD! or wéird?!", "then wéird;\nwéird: wéird, wéird", "", None]
    for _ in range(2):
        assert encoder.ids(pa.array(texts)) == [array("I", tokenizer.encode(t or "").ids).tobytes() for t in texts]
    assert counting.given.count("wéird".encode().decode("latin-1").translate(token_files._LETTERS)) == 1


def test_every_letter_of_the_patterns_is_a_letter():
    import pyarrow.compute as pc

    letters = [chr(c) for c in range(1, 0x400)]
    of_files = pc.match_substring_regex(pa.array(letters), token_files._PLAIN).to_pylist()
    assert of_files == [c.isalpha() and c < "ɐ" for c in letters]
    for c, easy in zip(letters, pc.match_substring_regex(pa.array(letters), packing._PLAIN).to_pylist()):
        assert not easy or c.isalpha() and len(c.lower()) == 1 and c.lower() < "ɐ"


def test_remembered_words_move_to_the_younger_set():
    asked = []

    def encode(new):
        asked.extend(new.to_pylist())
        return new.cast(pa.binary()).cast(pa.large_binary())

    held = words.Remembered(4)
    for row in (["a", "b", "c"], ["d", "a", "e"], ["f", "b", "a"], ["a"], [], ["g", "a", "h"], ["a", "g"]):
        assert held.ids(pa.array(row, pa.string()), encode).to_pylist() == [w.encode() for w in row]
        assert len(held.young) <= 4 and len(held.old) <= 4
    assert asked.count("a") == asked.count("g") == 1 and "a" in held.young and b"zzz" not in held.young
