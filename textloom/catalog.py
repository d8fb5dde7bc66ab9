"""One query per operator over the driver's tables. All of them read whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import CorpusConfig, DedupConfig, EvalConfig, PreferenceConfig, SamplingConfig, SftConfig, TokenizerConfig
from textloom.functions import chatml, hashing
from textloom.functions import text as tx
from textloom.operators import batches, bpe_codec, bpe_train, chat, dedup, packing, preference, sampling, scores
from textloom.plans import corpus_prep, finetuning, tokenizer_training
from textloom.session import materialize, new_table_path
from textloom.sources import reports, text, tokenshard
from textloom.streaming import incremental

SEQ_LEN = 64
BYTE_SEQ_LEN = 256
SHARD = 16
PREFIX_BYTES = 500_000
PREFIX_DOCS = 150
MAX_SEQUENCES = 300
QUERY_VOCAB = 400
BATCH = 8
CHAT_LEN = 96


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt over ``textloom.spreadTasks`` tasks where the caller set that: a table of one small file is
    otherwise read by one task."""
    docs, tasks = read(spark, sf_dir, "documents"), spark.conf.get("textloom.spreadTasks", None)
    return docs.repartition(int(tasks)) if tasks else docs


def joined(values, separator: str = ",") -> F.Column:
    return F.concat_ws(separator, F.transform(values, lambda v: v.cast("string")))


# -- sources ---------------------------------------------------------------------------------


def text_source(spark, sf_dir):
    rows = text.text_rows(documents(spark, sf_dir), "content")
    return rows.select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"))


def source_fallback(spark, sf_dir):
    missing = text.table(f"{sf_dir}/no_such_table.parquet")
    no_text = text.table(f"{sf_dir}/events.parquet")
    rows = text.text_source(spark, [missing, no_text, text.table(f"{sf_dir}/documents.parquet")], language="fr")
    return rows.select("doc_id", F.md5("text").alias("text_md5"))


def chat_source(spark, sf_dir):
    reader = lambda s: text.conversation_messages(read(s, sf_dir, "conversations"))
    rows = text.chat_source(spark, [text.table(f"{sf_dir}/no_such_table.parquet"), reader], "conv_id", 50)
    return rows.select(
        "conv_id",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "|")).alias("content_md5"),
    )


def preference_source(spark, sf_dir):
    rows = text.preference_source(spark, [lambda s: preference_pairs(s, sf_dir)], "conv_id", 20)
    return rows.select("conv_id", F.md5("chosen").alias("chosen_md5"))


def token_shard_round_trip(spark, sf_dir):
    path = new_table_path(spark, "shards")
    tokenshard.write_token_shards(placed_sequences(spark, sf_dir), path, SEQ_LEN)
    rows = tokenshard.scan_token_shards(spark, path, SEQ_LEN)
    return rows.select(
        "split", F.col("shard_idx").cast("bigint").alias("shard_idx"), "local_idx", "global_idx", joined("tokens").alias("tokens")
    )


def token_shard_lookup(spark, sf_dir):
    path = new_table_path(spark, "shards")
    tokenshard.write_token_shards(placed_sequences(spark, sf_dir), path, SEQ_LEN)
    row = tokenshard.lookup(tokenshard.read_token_shards(spark, path, SEQ_LEN), "train", 33)
    return row.select("global_idx", joined("tokens").alias("tokens"))


# -- text ------------------------------------------------------------------------------------


def language_filter(spark, sf_dir):
    return tx.language_filter(read(spark, sf_dir, "documents"), "en").select("doc_id", "lang")


def metadata_value(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    known = F.when(F.col("n_chars") % 2 == 0, F.col("lang"))
    nested = docs.select("doc_id", known.alias("language"), F.struct(F.col("source").alias("lang")).alias("metadata"))
    return nested.select("doc_id", tx.first_present(nested.schema, ("language", "lang"), "none").alias("value"))


def blank_filter(spark, sf_dir):
    kept = read(spark, sf_dir, "documents").filter(tx.is_not_blank(F.col("text")))
    return kept.groupBy("source").agg(F.count("*").alias("docs"))


def word_tokens(spark, sf_dir):
    words = tx.with_words(documents(spark, sf_dir).select("doc_id", "text"))
    count, chars = tx.word_stats(F.col("words"))
    return words.select(
        "doc_id",
        count.cast("bigint").alias("n_words"),
        chars.cast("bigint").alias("word_chars"),
        F.md5(F.array_join("words", " ")).alias("words_md5"),
    )


def quality_filter(spark, sf_dir):
    rows = tx.with_words(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return rows.filter(tx.quality_ok(F.col("words"))).select("doc_id", "source")


def word_shingles(spark, sf_dir):
    rows = tx.with_words(documents(spark, sf_dir).select("doc_id", "text"))
    runs = rows.select("doc_id", F.explode(F.array(tx.shingles(F.col("words"), 5))).alias("runs"))
    ordered = F.array_join(F.sort_array("runs"), "|")
    return runs.select("doc_id", F.size("runs").cast("bigint").alias("n_shingles"), F.md5(ordered).alias("shingles_md5"))


def seeded_hash(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", *[hashing.permuted_hash(F.col("text"), s).alias(f"hash_{s}") for s in range(4)])


def end_of_text(spark, sf_dir):
    docs = int_token_docs(spark, sf_dir)
    return docs.select("doc_id", joined(tx.append_eos(F.col("tokens"), 2)).alias("tokens"))


def keep_last_tokens(spark, sf_dir):
    docs = int_token_docs(spark, sf_dir)
    return docs.select("doc_id", joined(tx.keep_last(F.col("tokens"), 32)).alias("tokens"))


# -- near-duplicates ---------------------------------------------------------------------------


def signed_documents(spark, sf_dir) -> DataFrame:
    rows = corpus_prep.quality_rows(documents(spark, sf_dir).select("doc_id", "text"))
    return dedup.signatures(rows.select("doc_id", "words"))


def minhash_signature(spark, sf_dir):
    return signed_documents(spark, sf_dir).select("doc_id", joined("sig").alias("signature"))


def band_keys(spark, sf_dir):
    bands = F.explode(dedup.band_slices(F.col("sig"), DedupConfig())).alias("b")
    rows = signed_documents(spark, sf_dir).select("doc_id", bands)
    return rows.select("doc_id", F.col("b.band").cast("bigint").alias("band"), joined(F.col("b.key")).alias("key"))


def bucket_leader_candidates(spark, sf_dir):
    pairs = dedup.leader_pairs(materialize(signed_documents(spark, sf_dir), "signed"))
    return pairs.select("leader_id", "doc_id", F.round("similarity", 6).alias("similarity"))


def near_duplicates_of_leader(spark, sf_dir):
    pairs = dedup.leader_pairs(materialize(signed_documents(spark, sf_dir), "signed"))
    return pairs.filter(F.col("similarity") >= DedupConfig().threshold).select("leader_id", "doc_id")


def near_duplicate_links(spark, sf_dir):
    """How many near-duplicates each document has."""
    return dedup.link_counts(materialize(signed_documents(spark, sf_dir), "signed"))


def signature_similarity(spark, sf_dir):
    """Documents with neighbouring ids against each other."""
    signed = signed_documents(spark, sf_dir)
    pair_id = F.floor(F.col("doc_id") / 2).alias("pair_id")
    both = signed.groupBy(pair_id).agg(F.min_by("sig", "doc_id").alias("a"), F.max_by("sig", "doc_id").alias("b"))
    return both.select("pair_id", F.round(hashing.signature_similarity(F.col("a"), F.col("b")), 6).alias("similarity"))


def dedup_first_kept(spark, sf_dir):
    """Near-duplicate removal over all languages."""
    return dedup.first_kept_wins(materialize(signed_documents(spark, sf_dir), "signed"))


def dropped_by(spark, sf_dir):
    """Each dropped document with the first kept one that drops it."""
    rows = dedup.dropped_by(materialize(signed_documents(spark, sf_dir), "signed"))
    return rows.select("doc_id", "kept_id", F.round("similarity", 6).alias("similarity"))


def clean_unique_by_source(spark, sf_dir):
    """Flagship: English documents that pass all filters, counted per source."""
    docs = documents(spark, sf_dir)
    kept = corpus_prep.unique_ids(docs)
    by_source = docs.select("doc_id", "source").join(kept, "doc_id", "left_semi").groupBy("source")
    return by_source.agg(F.count("*").alias("docs"), F.min("doc_id").alias("first_doc"), F.sum("doc_id").alias("id_sum"))


def incremental_dedup(spark, sf_dir):
    """The documents as a stream of four micro-batches in id order: each part arrives, and is worked off."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    top = docs.agg(F.max("doc_id")).first()[0] + 1
    feed, out, index, state = (new_table_path(spark, n) for n in ("feed", "stream", "index", "state"))
    for part in range(4):
        inside = (F.col("doc_id") >= top * part // 4) & (F.col("doc_id") < top * (part + 1) // 4)
        docs.filter(inside).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(docs.schema).parquet(feed)
        incremental.dedup_stream(stream, out, index, state).awaitTermination()
    return spark.read.parquet(out).select("doc_id")


# -- sampling, packing, splitting ----------------------------------------------------------------


def int_token_docs(spark, sf_dir) -> DataFrame:
    """Documents as arrays of their word lengths, in place of token ids."""
    rows = tx.with_words(documents(spark, sf_dir).select("doc_id", "text"))
    return rows.select("doc_id", F.transform("words", lambda w: F.char_length(w)).alias("tokens"))


def packed(spark, sf_dir, max_sequences=None) -> DataFrame:
    docs = materialize(int_token_docs(spark, sf_dir), "int_tokens")
    return packing.pack(docs, SEQ_LEN, max_sequences=max_sequences)


def placed_sequences(spark, sf_dir) -> DataFrame:
    return packing.assign_shards(materialize(packed(spark, sf_dir), "packed"), SHARD)


def byte_budget_prefix(spark, sf_dir):
    rows = sampling.byte_budget(read(spark, sf_dir, "documents"), "doc_id", PREFIX_BYTES)
    return rows.select("doc_id", "source")


def first_documents(spark, sf_dir):
    rows = corpus_prep.source_rows(documents(spark, sf_dir), max_docs=PREFIX_DOCS)
    return rows.select("doc_id", F.md5("text").alias("text_md5"))


def pack_sequences(spark, sf_dir):
    return packed(spark, sf_dir).select("seq_id", joined("tokens").alias("tokens"))


def pack_sequence_limit(spark, sf_dir):
    return packed(spark, sf_dir, MAX_SEQUENCES).select("seq_id", joined("tokens").alias("tokens"))


def train_val_split(spark, sf_dir):
    seqs = materialize(packed(spark, sf_dir), "packed")
    return seqs.select("seq_id", packing.split_of(F.col("seq_id"), 0.05, 1337).alias("split"))


def shard_assignment(spark, sf_dir):
    return placed_sequences(spark, sf_dir).select("seq_id", "split", "shard_id", "seq_in_shard")


def shard_statistics(spark, sf_dir):
    return packing.shard_statistics(placed_sequences(spark, sf_dir))


def corpus_to_shards(spark, sf_dir, model=None):
    """Everything from raw documents to shard files, read back and counted. ``model`` is a tokenizer learnt before,
    here and below; without one it is learnt first."""
    cfg = CorpusConfig(seq_len=SEQ_LEN, shard_sequences=512)
    prepared = corpus_prep.prepare(documents(spark, sf_dir), model or tokenizer(spark, sf_dir), cfg)
    path = new_table_path(spark, "shards")
    corpus_prep.write_corpus(prepared, path, cfg)
    rows = tokenshard.scan_token_shards(spark, path, SEQ_LEN)
    return rows.groupBy("split", "shard_idx").agg(
        F.count("*").alias("sequences"), F.sum(F.size("tokens")).alias("tokens"), F.lit(prepared.kept_docs).alias("kept_docs")
    )


def corpus_sequences(spark, sf_dir):
    """Raw documents to shard files with a vocabulary of single bytes, read back."""
    cfg = CorpusConfig(seq_len=BYTE_SEQ_LEN, shard_sequences=512)
    prepared = corpus_prep.prepare(documents(spark, sf_dir), byte_tokenizer(spark, sf_dir), cfg)
    path = new_table_path(spark, "shards")
    corpus_prep.write_corpus(prepared, path, cfg)
    rows = tokenshard.scan_token_shards(spark, path, BYTE_SEQ_LEN)
    return rows.select("split", "global_idx", joined("tokens").alias("tokens"))


# -- tokenizer ---------------------------------------------------------------------------------


def tokenizer(spark, sf_dir) -> bpe_codec.Tokenizer:
    """A small vocabulary learnt from all documents, saved and loaded."""
    path = new_table_path(spark, "tokenizer")
    bpe_train.train(documents(spark, sf_dir), TokenizerConfig(vocab_size=QUERY_VOCAB)).save(spark, path)
    return bpe_codec.Tokenizer.load(spark, path)


def byte_tokenizer(spark, sf_dir) -> bpe_codec.Tokenizer:
    """A vocabulary without merges, saved and loaded."""
    path = new_table_path(spark, "tokenizer")
    bpe_train.train(documents(spark, sf_dir), TokenizerConfig(vocab_size=0)).save(spark, path)
    return bpe_codec.Tokenizer.load(spark, path)


def piece_counts(spark, sf_dir):
    return bpe_train.piece_counts(documents(spark, sf_dir))


def byte_alphabet(spark, sf_dir):
    counts = bpe_train.piece_counts(documents(spark, sf_dir))
    found = bpe_train.byte_alphabet(counts)
    symbols = bpe_codec.byte_symbols()
    rows = [(i + 4, b, symbols[b]) for i, b in enumerate(found)]
    return spark.createDataFrame(rows, "id bigint, byte bigint, symbol string")


def bpe_merges(spark, sf_dir, model=None):
    return (model or tokenizer(spark, sf_dir)).merges_table(spark)


def english_tokenizer(spark, sf_dir):
    """Filters, byte budget and training in one go."""
    cfg = TokenizerConfig(vocab_size=QUERY_VOCAB // 2, sample_bytes=PREFIX_BYTES)
    return tokenizer_training.train_tokenizer(read(spark, sf_dir, "documents"), cfg).vocab_table(spark)


def chat_vocabulary(spark, sf_dir):
    """A saved vocabulary of single bytes, loaded and extended by the chat marks."""
    rows = byte_tokenizer(spark, sf_dir).with_special_tokens().vocab_table(spark)
    return rows.select("token", F.col("id").cast("bigint").alias("id"), "special")


def bpe_encode(spark, sf_dir, model=None):
    rows = documents(spark, sf_dir).select("doc_id", "text")
    ids = bpe_codec.tokenize_documents(rows, model or tokenizer(spark, sf_dir))
    return ids.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.md5(joined("tokens")).alias("tokens_md5"))


def bpe_round_trip(spark, sf_dir, model=None):
    model = model or tokenizer(spark, sf_dir)
    ids = bpe_codec.tokenize_documents(documents(spark, sf_dir).select("doc_id", "text"), model)
    return ids.select("doc_id", bpe_codec.decode(F.col("tokens"), model).alias("text"))


# -- chat and preference data --------------------------------------------------------------------


def messages(spark, sf_dir) -> DataFrame:
    turns = text.conversation_messages(read(spark, sf_dir, "conversations"))
    return chatml.normalize_messages(turns)


def normalized_messages(spark, sf_dir):
    rows = messages(spark, sf_dir).select("conv_id", F.posexplode("messages").alias("pos", "m"))
    return rows.select("conv_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content")


def chatml_segments(spark, sf_dir):
    cut = messages(spark, sf_dir).select("conv_id", F.posexplode(chatml.segments(F.col("messages"))).alias("pos", "s"))
    return cut.select("conv_id", F.col("pos").cast("bigint").alias("pos"), "s.text", "s.trainable")


def generation_prompt(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", chatml.generation_prompt(F.col("messages")).alias("prompt"))


def chat_encoding(spark, sf_dir, model=None):
    """Ids and unmasked labels, decoded again."""
    model = (model or tokenizer(spark, sf_dir)).with_special_tokens()
    rows = chat.encode_chat(messages(spark, sf_dir), model, 1 << 30)
    learnt = F.filter("labels", lambda i: i != -100)
    return rows.select(
        "conv_id",
        bpe_codec.decode(F.col("input_ids"), model, skip_special=False).alias("text"),
        bpe_codec.decode(learnt, model, skip_special=False).alias("learnt"),
    )


def chat_batches(spark, sf_dir):
    """Encoded with single bytes, truncated and padded per batch."""
    model = byte_tokenizer(spark, sf_dir).with_special_tokens()
    rows = materialize(chat.encode_chat(messages(spark, sf_dir), model, CHAT_LEN), "chat")
    padded = chat.pad_chat_batches(rows, "conv_id", BATCH, model.pad_id)
    return padded.select(
        "batch_id",
        "conv_id",
        *[F.size(c).cast("bigint").alias(f"n_{c}") for c in ("input_ids", "labels", "attention_mask")],
        F.md5(joined("input_ids")).alias("ids_md5"),
    )


def padded_batches(spark, sf_dir):
    """Word lengths of each conversation, truncated and padded per batch."""
    said = messages(spark, sf_dir).withColumn("text", F.array_join(F.transform("messages", lambda m: m["content"]), " "))
    lengths = F.transform("words", lambda w: F.char_length(w))
    rows = tx.with_words(said).select("conv_id", F.slice(lengths, 1, CHAT_LEN).alias("input_ids"))
    rows = materialize(rows.withColumn("labels", chat.masked(F.col("input_ids"))), "lengths")
    padded = chat.pad_chat_batches(rows, "conv_id", BATCH)
    return padded.select("batch_id", "conv_id", *[joined(c).alias(c) for c in ("input_ids", "labels", "attention_mask")])


def raw_pairs(spark, sf_dir) -> DataFrame:
    """Last assistant turn of a conversation as chosen, its first one as rejected, all before as prompt."""
    turns = read(spark, sf_dir, "conversations").filter(chatml_role("assistant"))
    last = turns.groupBy("conv_id").agg(F.max_by("text", "turn").alias("chosen"), F.max("turn").alias("last_turn"))
    first = turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("rejected"))
    said = read(spark, sf_dir, "conversations").join(last, "conv_id").filter("turn < last_turn")
    prompt = text.conversation_messages(said).withColumnRenamed("messages", "prompt")
    return last.drop("last_turn").join(first, "conv_id").join(prompt, "conv_id")


def chatml_role(name: str):
    return F.col("role") == name


def preference_pairs(spark, sf_dir) -> DataFrame:
    return chatml.normalize_pairs(raw_pairs(spark, sf_dir)).select("conv_id", "prompt", "chosen", "rejected")


def response_from_messages(spark, sf_dir):
    rows = messages(spark, sf_dir)
    return rows.select("conv_id", chatml.response_text(F.col("messages"), True).alias("response"))


def pair_encoding(spark, sf_dir, model=None):
    model = (model or tokenizer(spark, sf_dir)).with_special_tokens()
    rows = preference.encode_pairs(preference_pairs(spark, sf_dir), model, 1 << 30)
    learnt = F.filter("rejected_labels", lambda i: i != -100)
    return rows.select(
        "conv_id",
        bpe_codec.decode(F.col("chosen_input_ids"), model, skip_special=False).alias("chosen_text"),
        bpe_codec.decode(learnt, model, skip_special=False).alias("rejected_learnt"),
    )


def pair_batches(spark, sf_dir):
    model = byte_tokenizer(spark, sf_dir).with_special_tokens()
    rows = materialize(preference.encode_pairs(preference_pairs(spark, sf_dir), model, CHAT_LEN), "pairs")
    padded = preference.pad_pair_batches(rows, "conv_id", BATCH, model.pad_id)
    sizes = [F.size(c).cast("bigint").alias(c) for c in padded.columns if c.endswith(("_ids", "_labels"))]
    return padded.select("batch_id", "conv_id", *sizes)


def sft_training_batches(spark, sf_dir):
    """From conversations to the shuffled, padded batches of an epoch, with a vocabulary of single bytes."""
    turns = text.conversation_messages(read(spark, sf_dir, "conversations"))
    rows = finetuning.sft_batches(turns, byte_tokenizer(spark, sf_dir), SftConfig(BATCH, CHAT_LEN), epoch=1)
    return rows.select("batch_id", "conv_id", *[F.md5(joined(c)).alias(f"{c}_md5") for c in ("input_ids", "labels", "attention_mask")])


def preference_training_batches(spark, sf_dir):
    """From raw pairs to the shuffled, padded batches of an epoch."""
    cfg = PreferenceConfig(batch_size=BATCH, max_seq_len=4 * CHAT_LEN)
    rows = finetuning.preference_batches(raw_pairs(spark, sf_dir), byte_tokenizer(spark, sf_dir), cfg, epoch=1)
    columns = [f"{side}_{what}" for side in ("chosen", "rejected") for what in ("input_ids", "labels")]
    return rows.select("batch_id", "conv_id", *[F.md5(joined(c)).alias(f"{c}_md5") for c in columns])


def preference_objective(spark, sf_dir):
    """Preference loss from the scores of two models; the second one has the tokens in reverse order."""
    pair, side = F.floor(F.col("seq") / 2).alias("pair"), F.when(F.col("seq") % 2 == 0, "chosen").otherwise("rejected").alias("side")
    policy, labels = (t.select(pair, side, *t.columns[1:]) for t in position_scores(spark, sf_dir))
    reference = policy.withColumn("token", 63 - F.col("token"))
    return finetuning.preference_objective(policy, reference, labels).select(F.round("loss", 6).alias("loss"))


# -- training batches ----------------------------------------------------------------------------


def sequence_ids(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq_id"))


def epoch_batches(spark, sf_dir):
    """Ranks, batches and slots of the packed sequences, whose ids are numbered without gaps."""
    ids = materialize(packed(spark, sf_dir), "packed").select("seq_id")
    plan = batches.epoch_plan(ids, BATCH, world_size=3, epoch=1, total=ids.count())
    return plan.select("seq_id", "rank", "batch_idx", "slot")


def next_token_pairs(spark, sf_dir):
    inputs, labels = batches.next_token_pairs(F.col("tokens"))
    rows = packed(spark, sf_dir).select("seq_id", inputs.alias("i"), labels.alias("l"))
    return rows.select("seq_id", joined("i").alias("inputs"), joined("l").alias("labels"))


def token_budget_batches(spark, sf_dir):
    plan = batches.epoch_plan(sequence_ids(spark, sf_dir), BATCH, shuffle=False)
    return batches.within_token_budget(plan, 20_000, BATCH, SEQ_LEN).select("seq_id", "batch_idx", "slot")


# -- scores --------------------------------------------------------------------------------------


def logits(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("token", "value"))
    return rows.select("vec_id", "token", (F.round(F.col("value").cast("double"), 2) * 40).alias("logit"))


def position_scores(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Four vectors make the positions of a sequence; labels come from the table, some are masked."""
    seq, pos = F.floor(F.col("vec_id") / 4).alias("seq"), (F.col("vec_id") % 4).cast("int").alias("pos")
    label = F.when(F.col("vec_id") % 5 == 0, F.lit(-100)).otherwise(F.col("label") % 64)
    labels = read(spark, sf_dir, "embeddings").select(seq, pos, label.alias("label"))
    return logits(spark, sf_dir).select(seq, pos, "token", "logit"), labels


def sequence_log_probs(spark, sf_dir):
    rows = scores.sequence_scores(*position_scores(spark, sf_dir))
    return rows.select("seq", F.round("logp", 6).alias("logp"))


def cross_entropy(spark, sf_dir):
    return scores.cross_entropy(*position_scores(spark, sf_dir)).select(F.round("loss", 6).alias("loss"))


def pair_scores(spark, sf_dir) -> DataFrame:
    names = ("chosen", "rejected", "ref_chosen", "ref_rejected")
    at = lambda i: (F.get("embedding", F.lit(i)).cast("double") * 100 - 50)
    return read(spark, sf_dir, "embeddings").select("vec_id", *[at(i).alias(n) for i, n in enumerate(names)])


def preference_margins(spark, sf_dir):
    margin = scores.preference_margin(0.1)
    return pair_scores(spark, sf_dir).select(
        "vec_id", F.round(margin, 6).alias("margin"), F.round(scores.neg_log_sigmoid(margin), 6).alias("loss")
    )


def preference_loss(spark, sf_dir):
    return scores.preference_loss(pair_scores(spark, sf_dir), 0.1).select(F.round("loss", 6).alias("loss"))


def sampling_candidates(spark, sf_dir):
    rows = scores.candidates(logits(spark, sf_dir), SamplingConfig(0.7, 0.9, 20), "vec_id")
    return rows.select("vec_id", F.col("token").cast("bigint").alias("token"), F.round("prob", 6).alias("prob"))


def sampled_tokens(spark, sf_dir):
    rows = scores.candidates(logits(spark, sf_dir), SamplingConfig(0.7, 0.9, 20), "vec_id")
    return scores.draw(rows, 1337, "vec_id").select("vec_id", F.col("token").cast("bigint").alias("token"))


def nucleus_candidates(spark, sf_dir):
    """Top-p over whole vocabularies."""
    rows = scores.candidates(logits(spark, sf_dir), SamplingConfig(5.0, 0.8, 0), "vec_id")
    return rows.select("vec_id", F.col("token").cast("bigint").alias("token"), F.round("prob", 6).alias("prob"))


def greedy_tokens(spark, sf_dir):
    rows = scores.candidates(logits(spark, sf_dir), SamplingConfig(temperature=0.0), "vec_id")
    return rows.select("vec_id", F.col("token").cast("bigint").alias("token"))


EVAL = EvalConfig(tasks=("en", "fr", "xx"))


def eval_reports(spark, sf_dir) -> DataFrame:
    """Label averages per source and language, as nested JSON reports."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    labels = read(spark, sf_dir, "labels")
    means = docs.join(labels, "doc_id").groupBy("source", "lang").agg(F.avg("quality").alias("q"), F.avg("toxic").alias("t"))
    english = F.create_map(F.lit("acc"), F.col("q").cast("string"), F.lit("acc,none"), F.col("t").cast("string"))
    other = F.create_map(F.lit("alias"), F.col("lang"), F.lit("acc"), F.col("t").cast("string"), F.lit("acc_norm"), F.col("q").cast("string"))
    task = F.struct("lang", F.when(F.col("lang") == "en", english).otherwise(other).alias("m"))
    # a report has one entry per language
    rows = means.groupBy("source").agg(F.map_from_entries(F.collect_list(task)).alias("results"))
    config = F.struct(F.lit(5).alias("num_fewshot"), F.size("results").alias("languages"))
    return rows.select("source", F.to_json(F.struct("results", config.alias("config"))).alias("report"))


def eval_macro_average(spark, sf_dir):
    rows = scores.macro_average(eval_reports(spark, sf_dir), EVAL.tasks)
    return rows.select("source", F.round("macro_average", 6).alias("macro_average"))


def batch_losses(spark, sf_dir) -> DataFrame:
    loss = F.abs(F.get("embedding", F.lit(0)).cast("double")) * 10
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("batch_idx"), loss.alias("loss"))


def perplexity(spark, sf_dir):
    rows = scores.perplexity(batch_losses(spark, sf_dir), 100_000, 4, SEQ_LEN)
    return rows.select(F.round("val_perplexity", 6).alias("val_perplexity"))


def evaluation_report(spark, sf_dir):
    ppl = scores.perplexity(batch_losses(spark, sf_dir), 100_000, 4, SEQ_LEN)
    path = new_table_path(spark, "report")
    records = scores.evaluation_report("model-a", eval_reports(spark, sf_dir), ppl, EVAL)
    reports.write_report(records, path)
    back = spark.read.text(path, wholetext=True)
    one = F.explode(F.split("value", r"(?<=\n\})\n"))
    rows = back.select(one.alias("value")).filter(F.length(F.trim("value")) > 0)
    field = lambda p: F.get_json_object("value", p)
    number = lambda p: F.round(field(p).cast("double"), 6)
    return rows.select(
        field("$.model").alias("model"),
        field("$.tasks[1]").alias("task"),
        number("$.macro_average").alias("macro_average"),
        number("$.val_perplexity").alias("val_perplexity"),
        field("$.lm_eval.config.num_fewshot").cast("bigint").alias("num_fewshot"),
        field("$.lm_eval.config.languages").cast("bigint").alias("languages"),
        number("$.lm_eval.results.en['acc,none']").alias("en_acc_none"),
        field("$.lm_eval.results.fr.alias").alias("fr_alias"),
        number("$.lm_eval.results.fr.acc_norm").alias("fr_acc_norm"),
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        text_source, source_fallback, chat_source, preference_source, token_shard_round_trip, token_shard_lookup,
        language_filter, metadata_value, blank_filter, word_tokens, quality_filter, word_shingles, seeded_hash,
        end_of_text, keep_last_tokens,
        minhash_signature, band_keys, bucket_leader_candidates, near_duplicates_of_leader, near_duplicate_links,
        signature_similarity,
        dedup_first_kept, dropped_by, clean_unique_by_source, incremental_dedup,
        byte_budget_prefix, first_documents, pack_sequences, pack_sequence_limit, train_val_split,
        shard_assignment, shard_statistics, corpus_sequences, corpus_to_shards,
        piece_counts, byte_alphabet, bpe_merges, english_tokenizer, chat_vocabulary, bpe_encode, bpe_round_trip,
        normalized_messages, chatml_segments, generation_prompt, chat_encoding, chat_batches, padded_batches,
        preference_pairs, response_from_messages, pair_encoding, pair_batches,
        sft_training_batches, preference_training_batches, preference_objective,
        epoch_batches, next_token_pairs, token_budget_batches,
        sequence_log_probs, cross_entropy, preference_margins, preference_loss,
        sampling_candidates, nucleus_candidates, sampled_tokens, greedy_tokens, eval_macro_average, perplexity, evaluation_report,
    )
    return {f.__name__: f for f in found}
