"""Words as the packing stage looks them up and encodes them."""

import random

import numpy as np

from larder.llm import packing as K
from larder.llm.queries import tokenizer_path


def test_words_are_looked_up_without_signs_and_in_lower_case():
    words = [w.encode() for w in ("Élan", "élan###", "ÉLAN.,", "élan", "x<|y.", "don't.", "it's", "1,5%", "á.", "×.", "ßÿ&&&", "...", "Σας.")]
    cores, tails, plain = K.Vocabulary.parts(words)
    assert [c.decode() for c in cores] == ["élan", "élan", "élan", "élan", "x<|y.", "don't", "it's", "1,5", "á.", "×.", "ßÿ", "...", "Σας."]
    assert [t.decode() for t in tails] == ["", "###", ".,", "", "", ".", "", "%", "", "", "&&&", "", ""]
    assert plain.tolist() == [True] * 4 + [False] * 6 + [True] + [False] * 2


def test_words_of_letters_are_encoded_many_at_a_time(monkeypatch):
    from tokenizers import Tokenizer

    tokenizer, vocabulary, asked = Tokenizer.from_file(tokenizer_path()), K.Vocabulary(tokenizer_path()), []
    plain = vocabulary.encode
    monkeypatch.setattr(vocabulary, "encode", lambda texts, **how: asked.extend(texts) or plain(texts, **how))
    draw = random.Random(3)
    letters = "abcdeghilmnorstuÀÉÑßàéñöüÿ"
    texts = [" ".join("".join(draw.choices(letters, k=draw.randint(1, 12))).title() + draw.choice(["", "", ".", "###", "?!", "'s", "’s", "<|", "́"]) for _ in range(400)) for _ in range(5)]
    texts += ["<|endoftext|> a<|endoftext|>b. <|x|>.", "", "İstanbul. ΟΔΟΣ. ﬁn½% 3²."]
    for text, ids in zip(texts, vocabulary.tokens([t.encode().split() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(asked) < 1000  # of 2000 words, most of them different


def test_a_chunk_asks_for_the_ids_of_a_word_once(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from larder.llm import common as C

    tokenizer, vocabulary, asked = Tokenizer.from_file(tokenizer_path()), K.Vocabulary(tokenizer_path()), []
    plain = vocabulary.look_up
    monkeypatch.setattr(vocabulary, "look_up", lambda parts, letters: asked.append(parts) or plain(parts, letters))
    texts = [None, "", "ab", "cd ab. Ab, AB###", " \t\n", "x<|endoftext|>y don't don't Éa. éa 12 12,", "word, " * 500 + " word word", "ab", "", None]
    chunk = C.raw(pa.array(texts, pa.string()))
    for _ in range(2):
        body, at = vocabulary.encoded(*chunk)
        ids = [np.frombuffer(body[a:b], "<u4").tolist() for a, b in zip(at[:-1], at[1:])]
        assert ids == [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert len(asked) == 2
    assert sorted(asked[0]) == sorted(w.encode() for w in ("ab", "cd", "", ".", ",", "###", "x<|endoftext|>y", "don't", "éa", "12", "word", " word word"))
    body, at = vocabulary.encoded(*C.raw(pa.array([None, " "], pa.string())))
    assert len(body) == 0 and at.tolist() == [0, 0, 0]


def test_what_is_forgotten_is_learnt_again():
    from tokenizers import Tokenizer

    tokenizer, vocabulary = Tokenizer.from_file(tokenizer_path()), K.Vocabulary(tokenizer_path(), remember=20)
    draw = random.Random(5)
    for _ in range(30):
        text = " ".join("".join(draw.choices("abe", k=draw.randint(1, 4))) + draw.choice(["", ".", "1"]) for _ in range(40))
        assert np.frombuffer(vocabulary.tokens([text.encode().split()])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(vocabulary.ids) <= 20 + 80
