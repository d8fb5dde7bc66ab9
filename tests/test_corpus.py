import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from textloom.config import CorpusConfig, TokenizerConfig
from textloom.operators import bpe_codec
from textloom.plans import corpus_prep, tokenizer_training


@pytest.fixture(scope="module")
def model(spark, documents, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tok"))
    cfg = TokenizerConfig(vocab_size=150, sample_bytes=20_000)
    trained = tokenizer_training.train_tokenizer(documents, cfg, save_to=path)
    assert bpe_codec.Tokenizer.load(spark, path).vocab == trained.vocab
    return trained


@pytest.mark.parametrize("max_docs,max_sequences", [(None, None), (90, None), (None, 40)])
def test_prepared_shards_equal_sequential_preparation(spark, documents, model, tmp_path, max_docs, max_sequences):
    cfg = CorpusConfig(seq_len=32, shard_sequences=64, val_fraction=0.2)
    prepared = corpus_prep.prepare(documents, model, cfg, max_docs=max_docs, max_sequences=max_sequences)
    path = tmp_path / "shards"
    corpus_prep.write_corpus(prepared, str(path), cfg)

    kept = {r.doc_id for r in corpus_prep.unique_ids(documents, cfg, max_docs=max_docs).collect()}
    encoded = documents.select("doc_id", bpe_codec.encode(F.col("text"), model).alias("ids"))
    buffer, sequences = [], []
    for row in encoded.orderBy("doc_id").collect():
        if row.doc_id not in kept:
            continue
        buffer += [*row.ids, model.eos_id]
        while len(buffer) >= 32:
            sequences.append(buffer[:32])
            buffer = buffer[32:]
        if max_sequences and len(sequences) >= max_sequences:
            break
    assert prepared.kept_docs == len(kept)
    assert prepared.n_sequences == len(sequences)
    split = {r.seq_id: r.split for r in prepared.sequences.select("seq_id", "split").collect()}
    for name in ("train", "val"):
        written = np.concatenate([np.fromfile(f, "<u2") for f in sorted(path.glob(f"{name}_*.bin"))])
        expected = [t for i, s in enumerate(sequences) if split[i] == name for t in s]
        assert written.tolist() == expected


def test_driver_contract(spark):
    names = driver.queries().keys()
    assert driver.oracle_sql().keys() <= names
    result = driver.entry(spark)
    assert result.columns == ["source", "docs", "first_doc", "id_sum"]
    assert result.count() > 0
