import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import piece_tokens as pk

SP = sentencepiece.SentencePieceProcessor(model_file=pk.MODEL_PATH)


def cached(texts):
    ids, sizes, exact = pk.cache_of(pk.MODEL_PATH).encode(texts)
    out, at = [], 0
    for n in sizes.tolist():
        out.append(ids[at : at + n].tolist())
        at += n
    return out, exact.tolist()


@settings(deadline=None, max_examples=300)
@given(st.lists(st.text(), max_size=4))
def test_parity_on_any_text(texts):
    want = SP.encode(texts)
    assert pk.encode_texts(texts, pk.MODEL_PATH) == want
    assert cached(texts)[0] == want


def test_parity_and_round_trip_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] for r in docs.select("text").collect()]
    assert cached(texts)[0] == SP.encode(texts)
    out = pk.encode(docs)
    assert out.filter("not round_trip").count() == 0
    back = {r["doc_id"]: r["text"] for r in pk.decode(out).collect()}
    assert back == {r["doc_id"]: r["text"] for r in docs.collect()}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (2, "", 0), (None, "▁▁ <s> \x00 日本 🤖", 0), (3, "ab " * 60_000, 0)], "doc_id bigint, text string, ids int")
    rows = pk.encode(docs).collect()
    assert len(rows) == 5
    assert [r["ids"] for r in rows if r["doc_id"] == 1] == [None]
    assert [r["ids"] for r in rows if r["doc_id"] == 2] == [[], []]
    assert pk.encode(docs.limit(0)).collect() == []
    assert [r["text"] for r in pk.decode(pk.encode(docs.filter("doc_id = 1"))).collect()] == [None]


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(pk, "CACHED_WORDS", 10)
    for i in range(5):
        texts = [f"word{i}{j} and more" for j in range(30)]
        assert cached(texts)[0] == SP.encode(texts)


def test_a_difference_is_an_error():
    with pytest.raises(ValueError):
        pk.check_parity(["hello"], [[1, 2]], pk.MODEL_PATH)


def unigram_file(path):
    """A small model file of the unigram type, written field by field."""
    import struct

    def field(number, kind, body):
        return bytes([number << 3 | kind]) + body

    def text(number, value):
        return field(number, 2, bytes([len(value)]) + value)

    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("▁ab", -3.0, 1), ("a", -4.0, 1), ("b", -4.5, 1), ("abab", -5.0, 1), ("c", -6.0, 1)]
    data = b"".join(
        text(1, text(1, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, s, k in pieces
    )
    trainer = field(3, 0, b"\x01")
    norm = text(1, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x01") + field(5, 0, b"\x01")
    path.write_bytes(data + text(2, trainer) + text(3, norm))


def test_unigram_models(tmp_path):
    path = tmp_path / "u.model"
    unigram_file(path)
    sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
    model = pk.read_model(str(path))
    assert model.model_type == pk.UNIGRAM and model.remove_extra_whitespaces
    for text in ("ab", "abab  ab", " c ab ", "abababab c", ""):
        assert pk.encode_texts([text], str(path))[0] == sp.encode(text), text


def test_round_trip_is_of_the_text_itself(spark):
    docs = spark.createDataFrame([(1, "a▁b"), (2, "a b"), (3, " a  b "), (4, None), (5, ""), (6, "日本 🤖")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["round_trip"] for r in pk.encode(docs).collect()}
    assert got == {1: False, 2: True, 3: True, 4: None, 5: True, 6: True}


def test_every_word_of_every_text_is_held_against_the_library(monkeypatch):
    """Groups of words that were checked, cut again, hold every word of every text."""
    seen = []
    real = pk.check_parity
    monkeypatch.setattr(pk, "check_parity", lambda texts, ids, source: (seen.extend(zip(texts, ids)), real(texts, ids, source)))
    texts = [f"text {i}" for i in range(200)] * 2 + ["end  ", "  start", "a\u2581b", " ", "é日本 🤖"]
    cache = pk.WordCache(pk.MODEL_PATH)
    ids, sizes, _ = cache.encode(texts)
    assert all(SP.encode(text) == ids for text, ids in seen)
    checked = {word for text, _ in seen for word in cache.cut(cache.normal(text))}
    assert {word for text in texts for word in cache.cut(cache.normal(text))} - {pk.MARK} <= checked
    assert ids.tolist() == [i for text in SP.encode(texts) for i in text] and sizes.sum() == len(ids)


def test_blanks_at_the_end_of_texts():
    for texts in (["a ", "b", "c  ", " ", "d", "  "], [" ", "a"], ["a", " ", " b "]):
        pk.cache_of(pk.MODEL_PATH).clear()
        assert cached(texts)[0] == SP.encode(texts)


def test_columns_that_clash_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y"), (1, "a b", "x", "y"), (None, "a b", None, None)], "doc_id bigint, text string, round_trip string, n string")
    rows = pk.encode(docs).collect()
    assert [r["ids"] for r in rows] == [SP.encode("a b")] * 3 and all(r["round_trip"] for r in rows)


def test_whole_texts_are_checked_where_words_cannot_be_cut(tmp_path, monkeypatch):
    path = tmp_path / "u.model"
    unigram_file(path)
    seen = []
    real = pk.check_parity
    monkeypatch.setattr(pk, "check_parity", lambda texts, ids, source: (seen.extend(texts), real(texts, ids, source)))
    sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["ab", "abab  ab", " c ab ", "", "ab"]
    ids, sizes, exact = pk.WordCache(path.read_bytes()).encode(texts)
    assert ids.tolist() == [i for text in sp.encode(texts) for i in text] and set(seen) == set(texts) - {""}
    assert exact.tolist() == [sp.decode(sp.encode(t)) == t for t in texts]


def test_new_words_are_learnt_a_few_at_a_time(monkeypatch):
    """The library's results of a block with many new words are never held together, and ids stay the same."""
    text = " ".join(f"word{i}x{i * i}" for i in range(400)) + "   \n é"
    want = pk.WordCache(pk.MODEL_PATH).encode([text, "", "one two"])
    monkeypatch.setattr(pk, "LEARNT_AT_ONCE", 50)
    cache, sizes = pk.WordCache(pk.MODEL_PATH), []
    pieces_of = cache.pieces_of
    monkeypatch.setattr(cache, "pieces_of", lambda words: sizes.append(len(words)) or pieces_of(words))
    got = cache.encode([text, "", "one two"])
    assert all((a == b).all() for a, b in zip(got, want))
    assert len(sizes) > 8 and max(sizes) <= 50


def merge_file(path):
    """A small model file of the merge type whose texts can be cut: no byte pieces, so other characters are unknown."""
    import struct

    def field(number, kind, body):
        return bytes([number << 3 | kind]) + body

    def text(number, value):
        return field(number, 2, bytes([len(value)]) + value)

    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("▁a", -2.5, 1), ("▁ab", -3.0, 1), ("a", -4.0, 1), ("b", -4.5, 1), ("c", -6.0, 1)]
    data = b"".join(text(1, text(1, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, s, k in pieces)
    norm = text(1, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01")
    path.write_bytes(data + text(2, field(3, 0, b"\x02")) + text(3, norm))


class Counted:
    """Counts the id lists given to a tokenizer's decoder."""

    def __init__(self, tokenizer):
        self.tokenizer, self.lists = tokenizer, 0

    def decode_batch(self, ids, **options):
        self.lists += len(ids)
        return self.tokenizer.decode_batch(ids, **options)


def test_groups_of_words_are_decoded_whole():
    """Words with byte pieces as well; each has the ids that it has alone."""
    words = [f"word{i}{mark}{i * i}" for i, mark in zip(range(3000), ["", "\n", "é", "日本", "🤖", "\x00", "<0x41>"] * 500)]
    cache = pk.WordCache(pk.MODEL_PATH)
    cache.bare = Counted(cache.bare)
    ids, sizes, exact = cache.encode([" ".join(words), *words])
    assert ids.tolist() == [i for text in SP.encode([" ".join(words), *words]) for i in text] and exact.all()
    assert 0 < cache.bare.lists <= 10


def test_unknown_words_among_others_are_found(tmp_path):
    path = tmp_path / "m.model"
    merge_file(path)
    sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
    cache = pk.WordCache(path.read_bytes())
    assert cache.cuts
    texts = ["ab c", "ab 日本 c 日", "c日", "abab  c ", "<unk> ab", "日", " ", "a 日▁b"]
    ids, sizes, exact = cache.encode(texts)
    assert ids.tolist() == [i for text in sp.encode(texts) for i in text]
    assert sizes.tolist() == [len(x) for x in sp.encode(texts)]
    # an unknown word decodes to the name of its piece
    assert exact.tolist() == [True, False, False, True, True, False, True, False]
