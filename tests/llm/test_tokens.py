import zlib

import numpy as np
import pytest

from riskloom.llm import tokens
from riskloom.llm.queries import VOCABULARY, tokenizer

ODD = [
    "a\tb\x0bc\x0cd\r\ne", "It's the DON'T <|endoftext|> end", "İstanbul ΣΊΣΥΦΟΣ Straße", "x...y a.b,c.", "é É ́", "<|ENDOFTEXT|>", "", ". , ,a .b",
    "日本語 テスト。", "a b c\x85d e\x1cf", "ﬁn K ſs", "AB12, abc.. \U0001f600, ok.",
]


@pytest.mark.parametrize("bits", [1, 3, 11, 15, 16, 17, 20, 31, 32])
def test_bits_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64)
        assert (tokens.unpack(tokens.pack(ids, bits), bits, n) == ids).all()
    assert tokens.id_bits(VOCABULARY) == 16 and tokens.id_bits(50_257) == 16 and tokens.id_bits(65_537) == 17 and tokens.id_bits(1) == 1


def test_random_access_to_a_file():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 50_000, 20_000, dtype=np.uint32)
    packed = tokens.PackedFile(tokens.file_bytes(np.array([5, 9]), np.array([0, 7000, 20_000]), ids, 16))
    assert packed.doc_ids.tolist() == [5, 9] and packed.starts.tolist() == [0, 7000, 20_000]
    for a, b in ((0, 20_000), (4095, 4097), (8192, 8192), (12_345, 19_999), (19_999, 30_000)):
        assert (packed.ids(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        tokens.PackedFile(b"x" * 64)


def test_words_have_the_ids_of_whole_texts(small_documents):
    encoder = tokens.Encoder(tokenizer(), True)
    texts = ODD + [r.text or "" for r in small_documents.select("text").collect()]
    want = encoder._plain(texts)
    assert encoder.encode(texts) == want
    encoder.MAX_WORDS = 5  # with words forgotten in between
    assert [encoder.encode([t])[0] for t in texts] == want


def test_files_of_awkward_rows(documents, awkward):
    rows = awkward + [(100 + i, t) for i, t in enumerate(ODD)]
    out = tokens.round_trip(documents(rows), tokenizer(), VOCABULARY, by_word=True).collect()
    plain = tokens.Encoder(tokenizer(), False)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for doc_id, text in order:
        ids = np.frombuffer(plain.encode([text or ""])[0], "<u4").tolist() + [tokens.END_ID]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, out), key=lambda r: r[1]) == want


def test_counts_and_empty_table(documents):
    assert tokens.token_counts(documents([(1, None), (2, "hello")]), tokenizer(), True).orderBy("doc_id").collect()[0].n_tokens == 1
    assert tokens.round_trip(documents([]), tokenizer(), VOCABULARY, True).collect() == []


def test_words_have_the_ids_of_whole_texts(monkeypatch):
    """Hostile strings in batches, with few words remembered, so that words are forgotten and learned again."""
    import random

    import pyarrow as pa

    monkeypatch.setattr(tokens.Encoder, "MAX_WORDS", 300)
    rng = random.Random(5)
    pieces = [*"aZé.,'|<>-09_ \t\n\x0b\x1c\x85\xa0ßΣſKİ日ु́\U0001f600", "<|", "don't", "...", "a.", "b,", "Straße.", "<|endoftext|>", "  ", "word", "x1", "1.", "é,"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(25))) for _ in range(6000)]
    encoder = tokens.Encoder(tokenizer(), True)
    whole = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        assert encoder.encode(some) == whole[at : at + 500]
        assert (4 * encoder.counts(pa.array(some))).tolist() == [len(w) for w in whole[at : at + 500]]
    assert len(encoder.hash) < 2000
    long = " ".join(f"w{i % 977}é{i % 31}." for i in range(400_000))
    assert encoder.encode([long, "", long]) == [np.array(encoder.tokenizer.encode(long, add_special_tokens=False).ids, "<u4").tobytes(), b"", encoder.encode([long])[0]]
