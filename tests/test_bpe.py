import random

import pytest
from pyspark.sql import functions as F

from textloom.config import TokenizerConfig
from textloom.functions.text import keep_last
from textloom.operators import bpe_codec, bpe_train

VOCAB = 340


@pytest.fixture(scope="module")
def trained(spark, documents):
    english = documents.filter("lang = 'en'").select("doc_id", "text")
    return english, bpe_train.train(english, TokenizerConfig(vocab_size=VOCAB))


@pytest.fixture(scope="module")
def library(trained):
    tokenizers = pytest.importorskip("tokenizers")
    english, model = trained
    tok = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="<|unk|>"))
    tok.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = tokenizers.decoders.ByteLevel()
    trainer = tokenizers.trainers.BpeTrainer(
        vocab_size=VOCAB, min_frequency=2, special_tokens=model.roles.ordered(), show_progress=False
    )
    texts = [r.text for r in english.orderBy("doc_id").collect()]
    tok.train_from_iterator(texts, trainer=trainer)
    return tok


def test_vocabulary_equals_the_public_library(trained, library):
    _, model = trained
    assert model.vocab == library.get_vocab()
    assert len(model) == VOCAB


def test_ids_equal_the_public_library(spark, documents, trained, library):
    _, model = trained
    rows = documents.select("text", bpe_codec.encode(F.col("text"), model).alias("ids")).collect()
    odd = ["", "a<|eos|>b", "!<|pad|> <|pad|>x", "<|eos|><|eos|>", "  \n\n two  ", "日本語 ☃ 😀", "<|eos", "x" * 500]
    extra = spark.createDataFrame([(t,) for t in odd], "text string")
    rows += extra.select("text", bpe_codec.encode(F.col("text"), model).alias("ids")).collect()
    for row in rows:
        assert row.ids == library.encode(row.text, add_special_tokens=False).ids, row.text[:50]


def test_decode_equals_the_public_library(spark, trained, library):
    _, model = trained
    rng = random.Random(3)
    rows = [(i, [rng.randrange(VOCAB) for _ in range(40)]) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, ids array<int>")
    for skip in (True, False):
        got = {r.id: r.t for r in df.select("id", bpe_codec.decode(F.col("ids"), model, skip).alias("t")).collect()}
        assert got == {i: library.decode(ids, skip_special_tokens=skip) for i, ids in rows}


def test_round_trip(trained):
    english, model = trained
    ids = bpe_codec.encode(F.col("text"), model)
    back = english.select("text", bpe_codec.decode(ids, model).alias("back"))
    assert back.filter("text <> back").count() == 0


def test_save_load_and_added_tokens(spark, trained, tmp_path):
    _, model = trained
    path = str(tmp_path / "tok")
    assert bpe_codec.saved_vocab_size(spark, path) is None
    model.save(spark, path)
    again = bpe_codec.Tokenizer.load(spark, path)
    assert (again.vocab, again.merges, again.special) == (model.vocab, model.merges, model.special)
    assert bpe_codec.saved_vocab_size(spark, path) == VOCAB
    chat = again.with_special_tokens()
    assert chat.vocab["<|im_start|>"] == VOCAB and chat.vocab["<|im_end|>"] == VOCAB + 1
    assert chat.with_special_tokens().vocab == chat.vocab
    df = spark.createDataFrame([("a<|im_end|>\n<|im_start|>b",)], "t string")
    ids = df.select(bpe_codec.encode(F.col("t"), chat).alias("i")).first().i
    assert ids.count(VOCAB) == 1 and ids.count(VOCAB + 1) == 1


def one_at_a_time(words, alphabet_size, names, vocab, limit):
    """Plain BPE training: the best pair, over and over."""
    merges = []
    words = [(list(w), n) for w, n in words]
    while len(names) < limit:
        counts = {}
        for w, n in words:
            for pair in zip(w, w[1:]):
                counts[pair] = counts.get(pair, 0) + n
        best = min(((-n, p) for p, n in counts.items() if n >= 2), default=None)
        if best is None:
            break
        a, b = best[1]
        merges.append((names[a], names[b]))
        token = names[a] + names[b]
        if token not in vocab:
            vocab[token] = len(names)
            names.append(token)
        new = vocab[token]
        for w, _ in words:
            i = 0
            while i < len(w) - 1:
                if w[i] == a and w[i + 1] == b:
                    w[i : i + 2] = [new]
                i += 1
    return merges


@pytest.mark.parametrize("seed", [1, 2])
def test_batched_merges_equal_one_at_a_time(spark, seed):
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(12)) for _ in range(15)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = bpe_train.train(df, TokenizerConfig(vocab_size=40))
    counts = {r.piece: r.n for r in bpe_train.piece_counts(df).collect()}
    symbols = bpe_codec.byte_symbols()
    vocab = bpe_train.initial_vocab(bpe_train.byte_alphabet(bpe_train.piece_counts(df)))
    names = list(vocab)
    words = [([vocab[symbols[b]] for b in p.encode()], n) for p, n in counts.items()]
    assert model.merges == one_at_a_time(words, 0, names, vocab, 40)


def test_keep_last(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],)], "ids array<int>")
    assert [r.k for r in df.select(keep_last(F.col("ids"), 2).alias("k")).collect()] == [[2, 3], []]


def test_a_round_reads_touched_pieces_and_counts_differences(spark):
    """Counts after merges equal a recount, and come from a filtered scan of the index."""
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(30)) for _ in range(10)]
    words = spark.createDataFrame([(w, i % 5 + 1) for i, w in enumerate(sorted({w for t in texts for w in t.split()} | {"ab" * 60, "aaaa"}))], "symbols string, n long")
    table = bpe_train.PieceTable(words, 3)
    merges, touched_by = [("ab", "X"), ("aa", "Y"), ("Xc", "Z"), ("eX", "W")], ["ab", "aa", "bc", "ea"]
    for k in range(5):
        got = {r.pair: r.n for r in bpe_train.current_counts(table, merges[:k], touched_by[:k]).collect() if r.n}
        after = words.withColumn("symbols", bpe_train.apply_merges("symbols", merges[:k])) if k else words
        assert got == {r.pair: r.n for r in bpe_train.pair_counts(after).collect()}
    plan = bpe_train.current_counts(table, merges, touched_by)._jdf.queryExecution().executedPlan().toString()
    assert "In(pair, [aa,ab,bc,ea," in plan.split("PushedFilters: ")[-1]


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_both_ways_of_counting_learn_the_same(spark, monkeypatch, share):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(12)) for _ in range(15)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    want = bpe_train.train(df, TokenizerConfig(vocab_size=60)).merges
    monkeypatch.setattr(bpe_train, "RECOUNT_SHARE", share)
    assert bpe_train.train(df, TokenizerConfig(vocab_size=60)).merges == want


def test_counts_of_a_task_equal_the_grouped_ones(spark, monkeypatch):
    """Pairs and merged pieces by arrays of code points, with runs of one symbol, large counts and early hand-over."""
    rng = random.Random(11)
    pieces = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(300)} | {"a" * 7, "a" * 8, "b"})
    words = spark.createDataFrame([(w, (1 << 50) + i if i % 7 == 0 else i + 1) for i, w in enumerate(pieces)], "symbols string, n long")
    merges = [("ab", "X"), ("aa", "\U00010005"), ("Xc", "Z"), ("\U00010005a", "W"), ("cc", "c")]
    rows = lambda df: sorted(map(tuple, df.collect()))
    for kept in (1 << 20, 4):
        monkeypatch.setattr(bpe_train, "KEPT_PAIRS", kept)
        for k in range(len(merges) + 1):
            after = words.withColumn("symbols", bpe_train.apply_merges("symbols", merges[:k])) if k else words
            assert rows(bpe_train.summed_pairs(words, merges[:k])) == rows(bpe_train.pair_counts(after))
    table = bpe_train.PieceTable(words, 2).after(merges)
    assert rows(table.words.select("symbols", "n")) == rows(after.filter(F.char_length("symbols") > 1))


def test_a_round_of_training_counts_in_one_pass_over_arrays(spark):
    words = spark.createDataFrame([("abab", 3)], "symbols string, n long")
    plan = bpe_train.summed_pairs(words, [("ab", "X")])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_large_batches_are_encoded_by_slices(monkeypatch):
    """Whatever the batch, ids are gathered for a bounded part of its rows at a time."""
    import pyarrow as pa

    rng = random.Random(2)
    rows = [[rng.choice(["ab", " é", "x" * 30, ""]) for _ in range(rng.randint(0, 20))] for _ in range(400)] + [["y" * 500]]
    encode = bpe_codec.piece_encoder({s: i for i, s in enumerate(bpe_codec.byte_symbols())}, [], {}, None)
    monkeypatch.setattr(bpe_codec, "SLICE", 300)
    found, largest = [], 0
    for part, offsets, lengths, values in bpe_codec._by_slices(pa.array([["z"], *rows], pa.list_(pa.string())).slice(1), encode):
        ends = [0, *lengths.cumsum().tolist()]
        largest = max([largest, len(values)] if len(part) > 1 else [largest])
        found += [values[ends[a] : ends[b]].tolist() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
    assert found == [[i for piece in row for i in encode(piece)] for row in rows]
    assert 0 < largest <= 300


def test_texts_encoded_together_equal_those_encoded_alone(spark, trained):
    _, model = trained
    df = spark.createDataFrame([("one two", None, "three"), ("", "näïve text", " "), ("x" * 3000, "a", None)], "a string, b string, c string")
    texts = [F.col(c) for c in df.columns]
    alone = df.select(*[bpe_codec.encode(t, model).alias(c) for t, c in zip(texts, df.columns)]).collect()
    together = df.select(bpe_codec.encode_several(texts, model).alias("ids")).collect()
    assert [list(r) for r in alone] == [r.ids for r in together]
