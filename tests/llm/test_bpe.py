import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parcelight.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _texts():
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz    \n\n\t'',.!?0123éüñ日\x1c\x1f\xa0<|>"
    texts = ["", " ", "Hello  world\n\n  it's 'll we'll''s x\t\ty \x85z", "<|endoftext|>",
             "a <|endoftext|> b<|endoftext|>", "x<|endoftext", "½ Ⅻ 一二三 ١٢ ",
             "a" * 40_000, " " * 40_000 + "x", "\n" * 30_000 + " x", "1" * 30_000 + "!" * 33_333,
             "a'" * 20_000 + "ll", "z" * 20_001 + "'ll", "🙂👩‍👩‍👧" * 6000]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 300))) for _ in range(100)]
    texts += ["".join(rng.choice("etaoin -=") for _ in range(40_000)) for _ in range(4)]
    return texts


@pytest.mark.parametrize("chunk", [1 << 16, 997, 5])
def test_any_chunks_give_the_ids_of_the_whole(vocabulary, library, chunk):
    book = bpe.Codebook(vocabulary)
    for text in _texts():
        if len(text) > 3000 and chunk == 5:
            continue
        parts = (text[k : k + chunk] for k in range(0, len(text), chunk))
        got = [i for ids in book.encode_stream(parts) for i in ids]
        assert got == library.encode(text, add_special_tokens=False).ids


def test_lookahead_follows_a_chain(vocabulary):
    # aa, then ab: whether the last a of a run pairs with b depends on the run.
    small = bpe.Vocabulary([b"a", b"b", b"c", b"bc", b"ab"],
                           bpe.np.array([(1, 2, 3), (0, 1, 4)]), {}, "x")
    assert small.lookahead == 3  # "ab" is decided once it is known that no c follows
    assert 0 < vocabulary.lookahead < 5000


def test_a_long_piece_in_small_windows(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 64)
    merger = bpe.Merger(vocabulary)
    rng = random.Random(3)
    for _ in range(20):
        text = "".join(rng.choice("thereaonig") for _ in range(3000))
        piece, ids = bpe.LongPiece(merger), []
        for at in range(0, len(text), 100):
            ids += piece.feed(text[at : at + 100].encode())
            assert len(piece.held) <= 64 + vocabulary.lookahead + 100
        assert ids + piece.feed(b"", True) == library.encode(text, add_special_tokens=False).ids


def test_a_bounded_table_changes_nothing(vocabulary, library):
    book = bpe.Codebook(vocabulary, remembered=3)
    texts = [t for t in _texts() if len(t) < 400]
    assert bpe._encode_slice(book, texts) == [
        ",".join(map(str, library.encode(t, add_special_tokens=False).ids)) for t in texts]


def test_decoding_in_any_parts(vocabulary, library):
    table = {str(i): t for i, t in enumerate(vocabulary.tokens)}
    rng = random.Random(2)
    for _ in range(200):
        ids = [rng.randrange(len(vocabulary.tokens)) for _ in range(40)]
        for size in (1, 3, 100):
            got = "".join(bpe.decode_stream(map(str, ids), table, size))
            assert got == library.decode(ids, skip_special_tokens=False)


def test_query_rows(odd, library):
    out = bpe.encode(odd.select("doc_id", "text", "score", "n_tokens"), PATH, with_ids=True)
    assert out.columns == ["doc_id", "score", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    texts = {}
    for r in odd.collect():
        texts.setdefault(r.doc_id, set()).add(r.text or "")
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        possible = set()
        for t in texts[r.doc_id]:
            ids = library.encode(t, add_special_tokens=False).ids
            whole = library.decode(ids, skip_special_tokens=False)
            possible.add((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(whole.encode()).hexdigest(), tuple(ids)))
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) in possible


def test_round_trip(odd):
    out = bpe.decode(bpe.encode(odd.select("doc_id", "text"), PATH, with_ids=True), PATH)
    key = lambda p: (p[0] is None, p[0] or 0, p[1])
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=key)
    assert got == sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=key)


def test_no_rows(nothing):
    assert bpe.encode(nothing, PATH).count() == 0


def test_decoding_replaces_a_clashing_column(spark):
    docs = spark.createDataFrame([(1, [72, 105], "old")], "doc_id int, ids array<int>, text string")
    (r,) = bpe.decode(docs, PATH).collect()
    assert r.text != "old" and list(r.asDict()) == ["doc_id", "ids", "text"]


def test_little_memory_changes_nothing(spark, odd):
    key = lambda df: sorted(map(str, df.collect()))
    docs = odd.select("doc_id", "text")
    assert key(bpe.encode(docs, PATH, remembered=3, slice_bytes=100)) == key(bpe.encode(docs, PATH))
