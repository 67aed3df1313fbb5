"""How texts reach the tokenizers library."""

import random

import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from kubus.llm import encoding, packing  # noqa: E402


def test_plain_words_reach_the_model_alone(monkeypatch):
    coder = encoding.Encoder(public_tokenizers.path("word_bpe_49k.json"), "dropped")
    r = random.Random(3)
    words = ["".join(r.choices("abcdeinorst", k=r.randint(1, 14))) for _ in range(400)]
    odd = ["Über", "naïve", "İstanbul", "ﬁne", "it's", "don't", "x2", "a-b", "ſ", "ª", "★", "é", "中文", "İ"]
    texts = [" ".join(r.choices(words + [w.title() for w in words] + odd, k=200)) for _ in range(20)]
    want = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
    seen, encode = [], coder._encode
    monkeypatch.setattr(coder, "_encode", lambda some: seen.extend(some) or encode(some))
    found = coder.encode(texts)
    assert found == [encoding.np.array(w.ids, encoding.ID_TYPE).tobytes() for w in want]
    assert not {w for text in seen for w in text.split()} & {w for w in words if len(w) > 3}


def test_texts_are_held_by_their_bytes():
    texts = pa.array(["a" * 10, None, "b" * 95, "", "c" * 250, "d", "e" * 40, "é" * 40])
    shares = packing._shares(texts, 100)
    assert [n for _, n in shares] and sum(n for _, n in shares) == len(texts)
    assert [at for at, _ in shares] == [sum(n for _, n in shares[:i]) for i in range(len(shares))]
    for at, n in shares:
        assert sum(len((t or "").encode()) for t in texts.to_pylist()[at + 1:at + n]) < 100
    assert packing._shares(pa.array([], pa.string())) == []
