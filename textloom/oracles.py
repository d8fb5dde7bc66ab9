"""DuckDB statements that answer the catalog's queries independently."""

from __future__ import annotations

from textloom import catalog as c
from textloom.functions.chatml import SYSTEM_TURN
from textloom.functions.hashing import PRIME, affine_parameters

WORD = r"[\p{L}\p{N}_]+"
L, SHARD = c.SEQ_LEN, c.SHARD

WORDS = f"w AS (SELECT doc_id, source, lang, text, regexp_extract_all(lower(text), '{WORD}') AS words FROM documents)"
QUALITY = """q AS (SELECT * FROM w WHERE regexp_matches(text, '\\S') AND len(words) >= 20
  AND len(array_to_string(words, '')) / len(words) BETWEEN 2.0 AND 10.0)"""
PARAMS = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(affine_parameters(64)))


def hash32(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 8))::BIGINT"


def minhash(source: str) -> str:
    return f"""{WORDS}, {QUALITY},
docs AS (SELECT * FROM q {source}),
params(i, a, b) AS (VALUES {PARAMS}),
runs AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(words) - 3),
  lambda i: array_to_string(words[i:i + 4], ' ')))) AS run FROM docs),
hashed AS (SELECT doc_id, {hash32('run')} % {PRIME} AS h FROM runs),
minima AS (SELECT doc_id, i, min((a * h + b) % {PRIME}) AS v FROM hashed, params GROUP BY ALL),
sigs AS (SELECT doc_id, list(v ORDER BY i) AS sig FROM minima GROUP BY doc_id),
bands AS (SELECT doc_id, sig, b AS band, array_to_string(sig[b * 4 + 1:b * 4 + 4], ',') AS key
  FROM sigs, range(16) t(b))"""


LEADERS = f"""leaders AS (SELECT band, key, min(doc_id) AS leader_id FROM bands GROUP BY band, key),
pairs AS (SELECT DISTINCT leader_id, doc_id FROM bands JOIN leaders USING (band, key) WHERE leader_id < doc_id),
scored AS (SELECT leader_id, p.doc_id,
  len(list_filter(list_zip(x.sig, y.sig), lambda z: z[1] = z[2])) / 64 AS similarity
  FROM pairs p JOIN sigs x ON x.doc_id = leader_id JOIN sigs y ON y.doc_id = p.doc_id)"""
# the sequential rule, one document with earlier neighbours per step
KEPT = """edges AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM bands x JOIN bands y USING (band, key)
  WHERE x.doc_id < y.doc_id AND len(list_filter(list_zip(x.sig, y.sig), lambda z: z[1] = z[2])) / 64 >= 0.85),
nodes AS (SELECT b, list(a) AS earlier, row_number() OVER (ORDER BY b) AS rn FROM edges GROUP BY b),
walk AS (SELECT 0::BIGINT AS rn, []::BIGINT[] AS dropped
  UNION ALL
  SELECT n.rn, CASE WHEN len(list_filter(n.earlier, lambda e: NOT list_contains(w.dropped, e))) > 0
    THEN list_append(w.dropped, n.b) ELSE w.dropped END
  FROM walk w JOIN nodes n ON n.rn = w.rn + 1),
gone AS (SELECT unnest(dropped) AS doc_id FROM (SELECT dropped FROM walk ORDER BY rn DESC LIMIT 1)),
kept AS (SELECT doc_id FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM gone))"""

DROPPED_BY = """by_first AS (SELECT b, min(a) AS kept_id FROM edges JOIN kept ON a = kept.doc_id
  WHERE b IN (SELECT doc_id FROM gone) GROUP BY b)"""
SHARED = "len(list_filter(list_zip(x.sig, y.sig), lambda z: z[1] = z[2]))"

INT_TOKENS = f"""{WORDS},
tok AS (SELECT doc_id, p, len(words[p]) AS t FROM w, unnest(range(1, len(words) + 1)) u(p)),
placed AS (SELECT doc_id, t, row_number() OVER (ORDER BY doc_id, p) - 1 AS n FROM tok),
seqs AS (SELECT n // {L} AS seq_id, list(t ORDER BY n) AS tokens FROM placed GROUP BY 1 HAVING count(*) = {L})"""
SPLIT = f"CASE WHEN {hash32(chr(39) + '1337:' + chr(39) + ' || seq_id')} % 1000000 < 50000 THEN 'val' ELSE 'train' END"
PLACED = f"""{INT_TOKENS},
split AS (SELECT seq_id, tokens, {SPLIT} AS split FROM seqs),
numbered AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY seq_id) - 1 AS n,
  CASE WHEN split = 'val' THEN {SHARD // 4} ELSE {SHARD} END AS size FROM split)"""

ALPHABET = r"""seen AS (SELECT DISTINCT unnest(regexp_extract_all(hex(encode(text)), '..')) AS h FROM documents),
found AS (SELECT ('0x' || h)::BIGINT AS byte FROM seen),
own AS (SELECT r AS byte, (r BETWEEN 33 AND 126 OR r BETWEEN 161 AND 172 OR r >= 174) AS printable FROM range(256) t(r)),
named AS (SELECT byte, CASE WHEN printable THEN byte
  ELSE 256 + count(*) FILTER (WHERE NOT printable) OVER (ORDER BY byte) - 1 END AS code FROM own),
alphabet AS (SELECT row_number() OVER (ORDER BY code) + 3 AS id, byte, chr(code::INTEGER) AS symbol
  FROM named JOIN found USING (byte))"""
# RE2 has no look-ahead: char 1 marks where a run of blanks gives its last one to the next piece
MARKED = r"regexp_replace(text, '(\s+)(\s)(\S)', '\1' || chr(1) || '\2\3', 'g')"
PIECES = rf"""regexp_extract_all({MARKED}, '''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}\x01]+|\s+')"""


def learnt(source: str, vocab_size: int) -> tuple[str, ...]:
    """Merges by the plain rule, the best pair of all pieces one at a time. A piece is a string of symbols, a symbol a
    code point: its id plus 256. ``final`` holds the symbols of each piece of the source after all merges."""
    bytes_of = "regexp_extract_all(hex(encode(piece)), '..')"
    return (
        ALPHABET.replace("FROM documents", f"FROM {source}"),
        f"""counted AS (SELECT row_number() OVER () AS k, piece, count(*) AS n
          FROM (SELECT unnest({PIECES}) AS piece FROM {source}) GROUP BY piece)""",
        f"""spelt AS (SELECT k, n, string_agg(chr((256 + id)::INTEGER), '' ORDER BY p) AS s
          FROM (SELECT k, n, unnest({bytes_of}) AS h, generate_subscripts({bytes_of}, 1) AS p FROM counted)
          JOIN alphabet ON byte = ('0x' || h)::BIGINT GROUP BY k, n)""",
        "ids AS (SELECT max(id) AS last FROM alphabet)",
        # a step's row 0 holds the pair that was merged; pieces of one symbol stay behind
        f"""bpe AS (SELECT 0::BIGINT AS step, k, n, s FROM spelt
          UNION ALL
          SELECT * FROM (WITH best AS (SELECT substr(s, i, 2) AS pair, sum(n) AS total FROM bpe, unnest(range(1, length(s))) t(i)
            WHERE k > 0 GROUP BY 1 HAVING sum(n) >= 2 ORDER BY total DESC, pair LIMIT 1)
          SELECT step + 1, k, n, replace(s, pair, chr((256 + last + step + 1)::INTEGER)) FROM bpe, best, ids
            WHERE last + step + 1 < {vocab_size} AND k > 0 AND length(s) > 1
          UNION ALL SELECT any_value(step) + 1, 0, 0, any_value(pair) FROM bpe, best, ids WHERE last + step + 1 < {vocab_size} HAVING count(*) > 0))""",
        "final AS MATERIALIZED (SELECT piece, f.s FROM counted JOIN (SELECT k, arg_max(s, step) AS s FROM bpe WHERE k > 0 GROUP BY k) f USING (k))",
        "merged_at AS (SELECT step, unicode(s[1]) - 256 AS l, unicode(s[2]) - 256 AS r FROM bpe WHERE k = 0)",
        """all_names AS (SELECT list_reduce(list_prepend(base, coalesce(merges, [])),
            lambda names, m: list_append(names, names[m[1]::INT + 1] || names[m[2]::INT + 1])) AS names
          FROM (SELECT ['<|pad|>', '<|bos|>', '<|eos|>', '<|unk|>'] || list(symbol ORDER BY id) AS base FROM alphabet),
            (SELECT list([l::VARCHAR, r::VARCHAR] ORDER BY step) AS merges FROM merged_at))""",
    )


ENGLISH = f"""english AS (SELECT text FROM (SELECT text, coalesce(sum(strlen(text)) OVER (ORDER BY doc_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM documents WHERE lang = 'en' AND regexp_matches(text, '\\S'))
  WHERE seen < {c.PREFIX_BYTES})"""
LEARNT = learnt("documents", c.QUERY_VOCAB)
ENCODED = f"""cut AS (SELECT doc_id, unnest({PIECES}) AS piece, unnest(range(len({PIECES}))) AS p FROM documents),
encoded AS (SELECT doc_id, string_agg(s, '' ORDER BY p) AS s FROM cut JOIN final USING (piece) GROUP BY doc_id)"""

# ids of a chat text with a vocabulary of single bytes: marks are one symbol each, unseen bytes are unknown
CHAT_MARKS = "replace(replace({}, '<|im_start|>', chr(57344)), '<|im_end|>', chr(57345))"


def chat_ids(source: str) -> str:
    """(key, part, p, id) of the characters of (key, part, text)."""
    chars = f"regexp_extract_all({CHAT_MARKS.format('text')}, '(?s).')"
    return f"""chars AS (SELECT key, part, unnest({chars}) AS ch, generate_subscripts({chars}, 1) AS p FROM {source}),
bytes AS (SELECT key, part, p, ch, unnest(regexp_extract_all(hex(encode(ch)), '..')) AS h,
  generate_subscripts(regexp_extract_all(hex(encode(ch)), '..'), 1) AS q FROM chars WHERE ch NOT IN (chr(57344), chr(57345))
  UNION ALL SELECT key, part, p, ch, NULL, 1 FROM chars WHERE ch IN (chr(57344), chr(57345))),
top AS (SELECT max(id) AS last FROM alphabet),
ids AS (SELECT key, part, p * 4 + q AS p, CASE WHEN ch = chr(57344) THEN last + 1 WHEN ch = chr(57345) THEN last + 2
  ELSE coalesce(id, 3) END AS id FROM top, bytes LEFT JOIN alphabet ON byte = ('0x' || h)::BIGINT)"""


BYTE_SEQS = f"""cut AS (SELECT doc_id, regexp_extract_all(hex(encode(text)), '..') AS hs FROM docs
  WHERE doc_id IN (SELECT doc_id FROM kept)),
byte_ids AS (SELECT doc_id, p, id AS t FROM (SELECT doc_id, unnest(range(1, len(hs) + 1)) AS p, unnest(hs) AS h FROM cut)
  JOIN alphabet ON byte = ('0x' || h)::BIGINT UNION ALL SELECT doc_id, 1000000000, 2 FROM cut),
placed AS (SELECT t, row_number() OVER (ORDER BY doc_id, p) - 1 AS n FROM byte_ids),
seqs AS (SELECT n // {c.BYTE_SEQ_LEN} AS seq_id, list(t ORDER BY n) AS tokens FROM placed GROUP BY 1
  HAVING count(*) = {c.BYTE_SEQ_LEN})"""

MESSAGES = """msgs AS (SELECT conv_id, role, text AS content,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos FROM conversations WHERE text <> '')"""
ROLE = "CASE WHEN role IN ('system', 'user', 'assistant') THEN role ELSE 'user' END"
STRIPPED = r"regexp_replace(content, '^\s+|\s+$', '', 'g')"
SYSTEM = f"'{SYSTEM_TURN}'"
SEGMENTS = f"""{MESSAGES},
roles AS (SELECT conv_id, pos, {ROLE} AS r, {STRIPPED} AS body FROM msgs),
parts AS (
  SELECT conv_id, -1 AS pos, 0 AS k, {SYSTEM} AS text, false AS trainable FROM msgs
    GROUP BY conv_id HAVING count(*) FILTER (WHERE role = 'system') = 0
  UNION ALL SELECT conv_id, pos, 0, '<|im_start|>assistant' || chr(10), false FROM roles WHERE r = 'assistant'
  UNION ALL SELECT conv_id, pos, 1, body || '<|im_end|>' || chr(10), true FROM roles WHERE r = 'assistant'
  UNION ALL SELECT conv_id, pos, 0, '<|im_start|>' || r || chr(10) || body || '<|im_end|>' || chr(10), false
    FROM roles WHERE r <> 'assistant')"""
PAIRS = f"""a AS (SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS chosen, arg_min(text, turn) AS rejected
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
said AS (SELECT c.*, a.chosen, a.rejected FROM conversations c JOIN a USING (conv_id) WHERE turn < last_turn),
pairs AS (SELECT conv_id,
  CASE WHEN count(*) FILTER (WHERE role = 'system') = 0 THEN {SYSTEM} ELSE '' END
  || coalesce(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn)
    FILTER (WHERE role <> 'assistant'), '') || '<|im_start|>assistant' || chr(10) AS prompt,
  any_value(chosen) || '<|im_end|>' AS chosen, any_value(rejected) || '<|im_end|>' AS rejected
  FROM said GROUP BY conv_id)"""



def mixed_number(rounds: int) -> str:
    """A sequence number x, split by ``wide`` and shifted in turn by hashes of its halves."""
    left, right = "(x // wide)", "(x % wide)"
    for i in range(rounds):
        if i % 2 == 0:
            left = f"(({left} + {hash32(f"'1337:1:{i}:' || {right}")}) % high)"
        else:
            right = f"(({right} + {hash32(f"'1337:1:{i}:' || {left}")}) % wide)"
    return f"{left} * wide + {right}"


def epoch_places(numbers: str) -> tuple[str, ...]:
    """(id, n): the place of each row of (id, n), numbered from 0, in the permutation of epoch 1."""
    return (
        f"total AS (SELECT count(*) AS n, floor(sqrt(greatest(count(*) - 1, 0)))::BIGINT + 1 AS wide FROM {numbers})",
        "borders AS (SELECT n, wide, (n + wide - 1) // wide AS high FROM total)",
        f"""walk AS (SELECT id, {mixed_number(6)} AS x FROM (SELECT id, n AS x FROM {numbers}), borders
          UNION ALL SELECT id, {mixed_number(6)} FROM walk, borders WHERE x >= n)""",
        "placed_at AS (SELECT id, x AS n FROM walk, borders WHERE x < borders.n)",
    )


EPOCH = (
    "numbers AS (SELECT seq_id AS id, seq_id AS n FROM seqs)",
    *epoch_places("numbers"),
    f"r AS (SELECT id AS seq_id, n % 3 AS rank, n // 3 // {c.BATCH} AS batch_idx, n // 3 % {c.BATCH} AS slot FROM placed_at)",
)
SHUFFLED = ("numbers AS (SELECT key AS id, row_number() OVER (ORDER BY key) - 1 AS n FROM whole)", *epoch_places("numbers"))


def padded(column: str, value: int, upto: str) -> str:
    return f"md5(array_to_string({column} || list_transform(range({upto} - len({column})), lambda x: {value}), ','))"


LOGITS = "logits AS (SELECT vec_id, p - 1 AS token, round(embedding[p]::DOUBLE, 2) * 40 AS logit FROM embeddings, range(1, 65) r(p))"
LOG_PROBS = f"""{LOGITS},
labels_at AS (SELECT vec_id // 4 AS seq, vec_id % 4 AS pos,
  CASE WHEN vec_id % 5 = 0 THEN -100 ELSE label % 64 END AS label FROM embeddings),
shifted AS (SELECT vec_id // 4 AS seq, vec_id % 4 AS pos, token, logit FROM logits),
peaks AS (SELECT seq, pos, max(logit) AS peak FROM shifted GROUP BY ALL),
norms AS (SELECT s.seq, s.pos, any_value(peak) + ln(sum(exp(logit - peak))) AS lse
  FROM shifted s JOIN peaks USING (seq, pos) GROUP BY s.seq, s.pos),
logps AS (SELECT l.seq, s.logit - n.lse AS logp FROM labels_at l
  JOIN norms n ON n.seq = l.seq AND n.pos = l.pos - 1
  JOIN shifted s ON s.seq = l.seq AND s.pos = l.pos - 1 AND s.token = l.label WHERE l.label <> -100)"""
MARGIN = " ".join(
    f"{sign} (embedding[{i}]::DOUBLE * 100 - 50)" for sign, i in (("", 1), ("-", 2), ("-", 3), ("+", 4))
)
CANDIDATES = f"""{LOGITS},
ranked AS (SELECT *, rank() OVER (PARTITION BY vec_id ORDER BY logit DESC) AS rk FROM logits),
top AS (SELECT *, exp(logit / 0.7 - max(logit / 0.7) OVER (PARTITION BY vec_id)) AS m FROM ranked WHERE rk <= 20),
probs AS (SELECT *, m / sum(m) OVER (PARTITION BY vec_id) AS p FROM top),
cumulative AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY vec_id ORDER BY logit DESC, token
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM probs),
cand AS (SELECT vec_id, token, p / sum(p) OVER (PARTITION BY vec_id) AS prob FROM cumulative WHERE before <= 0.9)"""
MACRO = """means AS (SELECT source, lang, avg(quality) AS q, avg(toxic) AS t
  FROM documents JOIN labels USING (doc_id) GROUP BY ALL),
macro AS (SELECT source, avg(CASE WHEN lang = 'en' THEN t WHEN lang = 'fr' THEN q END) AS macro_average
  FROM means GROUP BY source)"""
PERPLEXITY = f"SELECT exp(avg(abs(embedding[1]::DOUBLE) * 10)) FROM embeddings WHERE vec_id < ceil(100000 / (4 * {L}))"


def with_(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


def csv(values: str) -> str:
    return f"array_to_string({values}, ',')"


def all_oracles() -> dict[str, str]:
    out = {
        "text_source": "SELECT doc_id, strlen(text)::BIGINT AS bytes FROM documents WHERE lang = 'en' AND regexp_matches(text, '\\S')",
        "source_fallback": "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE lang = 'fr' AND regexp_matches(text, '\\S')",
        "chat_source": """SELECT conv_id, count(*) AS n_messages, md5(string_agg(text, '|' ORDER BY turn)) AS content_md5
            FROM conversations GROUP BY conv_id ORDER BY conv_id LIMIT 50""",
        "preference_source": with_(PAIRS) + "SELECT conv_id, md5(chosen) AS chosen_md5 FROM pairs ORDER BY conv_id LIMIT 20",
        "token_shard_round_trip": with_(PLACED)
        + f"SELECT split, n // size AS shard_idx, n % size AS local_idx, n AS global_idx, {csv('tokens')} AS tokens FROM numbered",
        "token_shard_lookup": with_(PLACED)
        + f"SELECT n AS global_idx, {csv('tokens')} AS tokens FROM numbered WHERE split = 'train' AND n = 33",
        "language_filter": "SELECT doc_id, lang FROM documents WHERE lang = 'en' OR lang IS NULL",
        "metadata_value": """SELECT doc_id, coalesce(CASE WHEN n_chars % 2 = 0 THEN lang END, source, 'none') AS value
            FROM documents""",
        "blank_filter": "SELECT source, count(*) AS docs FROM documents WHERE regexp_matches(text, '\\S') GROUP BY source",
        "word_tokens": with_(WORDS)
        + """SELECT doc_id, len(words)::BIGINT AS n_words, len(array_to_string(words, ''))::BIGINT AS word_chars,
            md5(array_to_string(words, ' ')) AS words_md5 FROM w""",
        "quality_filter": with_(WORDS, QUALITY) + "SELECT doc_id, source FROM q",
        "word_shingles": with_(
            WORDS,
            """runs AS (SELECT doc_id, CASE WHEN len(words) < 5 THEN [] ELSE list_sort(list_distinct(list_transform(
            range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))) END AS runs FROM w)""",
        )
        + "SELECT doc_id, len(runs)::BIGINT AS n_shingles, md5(array_to_string(runs, '|')) AS shingles_md5 FROM runs",
        "seeded_hash": "SELECT doc_id, "
        + ", ".join(
            f"(({hash32('text')} % {PRIME}) * {a} + {b}) % {PRIME} AS hash_{i}"
            for i, (a, b) in enumerate(affine_parameters(4))
        )
        + " FROM documents",
        "end_of_text": with_(WORDS)
        + f"SELECT doc_id, {csv('list_append(list_transform(words, lambda x: len(x)), 2)')} AS tokens FROM w",
        "keep_last_tokens": with_(WORDS)
        + f"SELECT doc_id, {csv('list_transform(words[greatest(len(words) - 31, 1):], lambda x: len(x))')} AS tokens FROM w",
        "minhash_signature": with_(minhash("")) + f"SELECT doc_id, {csv('sig')} AS signature FROM sigs",
        "band_keys": with_(minhash("")) + "SELECT doc_id, band, key FROM bands",
        "bucket_leader_candidates": with_(minhash(""), LEADERS)
        + "SELECT leader_id, doc_id, round(similarity, 6) AS similarity FROM scored",
        "near_duplicates_of_leader": with_(minhash(""), LEADERS)
        + "SELECT leader_id, doc_id FROM scored WHERE similarity >= 0.85",
        "signature_similarity": with_(
            minhash(""),
            """both_sides AS (SELECT doc_id // 2 AS pair_id, arg_min(sig, doc_id) AS a, arg_max(sig, doc_id) AS b
            FROM sigs GROUP BY 1)""",
        )
        + """SELECT pair_id, round(len(list_filter(list_zip(a, b), lambda z: z[1] = z[2])) / 64, 6) AS similarity
            FROM both_sides""",
        "near_duplicate_links": with_(minhash(""), KEPT.split("nodes AS")[0].rstrip(",\n "))
        + """SELECT s.doc_id, min(s.doc_id) OVER (PARTITION BY s.sig) AS class_id, count(e.a) AS n_links
            FROM sigs s LEFT JOIN (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges) e ON e.a = s.doc_id GROUP BY s.doc_id, s.sig""",
        "dropped_by": with_(minhash(""), KEPT, DROPPED_BY, recursive=True)
        + f"""SELECT b AS doc_id, kept_id, round({SHARED} / 64, 6) AS similarity FROM by_first
            JOIN sigs x ON x.doc_id = b JOIN sigs y ON y.doc_id = kept_id""",
        "dedup_first_kept": with_(minhash(""), KEPT, recursive=True) + "SELECT doc_id FROM kept",
        "clean_unique_by_source": with_(minhash("WHERE lang = 'en'"), KEPT, recursive=True)
        + """SELECT source, count(*) AS docs, min(doc_id) AS first_doc, sum(doc_id)::BIGINT AS id_sum
            FROM documents WHERE doc_id IN (SELECT doc_id FROM kept) GROUP BY source""",
        "incremental_dedup": with_(minhash("WHERE lang = 'en'"), KEPT, recursive=True) + "SELECT doc_id FROM kept",
        "byte_budget_prefix": f"""SELECT doc_id, source FROM (SELECT *, coalesce(sum(strlen(text)) OVER (ORDER BY doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM documents) WHERE seen < {c.PREFIX_BYTES}""",
        "first_documents": f"""SELECT doc_id, md5(text) AS text_md5 FROM documents
            WHERE lang = 'en' AND regexp_matches(text, '\\S') ORDER BY doc_id LIMIT {c.PREFIX_DOCS}""",
        "pack_sequences": with_(INT_TOKENS) + f"SELECT seq_id, {csv('tokens')} AS tokens FROM seqs",
        "pack_sequence_limit": with_(
            INT_TOKENS,
            """sizes AS (SELECT doc_id, sum(len(words)) OVER (ORDER BY doc_id) AS upto FROM w)""",
        )
        + f"""SELECT seq_id, {csv('tokens')} AS tokens FROM seqs WHERE seq_id <
            (SELECT coalesce(min(upto) FILTER (WHERE upto // {L} >= {c.MAX_SEQUENCES}), max(upto)) // {L} FROM sizes)""",
        "train_val_split": with_(PLACED) + "SELECT seq_id, split FROM split",
        "shard_assignment": with_(PLACED)
        + "SELECT seq_id, split, n // size AS shard_id, n % size AS seq_in_shard FROM numbered",
        "shard_statistics": with_(PLACED)
        + "SELECT split, n // size AS shard_id, count(*) AS sequences FROM numbered GROUP BY ALL",
        "corpus_sequences": with_(minhash("WHERE lang = 'en'"), KEPT, ALPHABET, BYTE_SEQS, recursive=True)
        + f"""SELECT split, row_number() OVER (PARTITION BY split ORDER BY seq_id) - 1 AS global_idx, {csv('tokens')} AS tokens
            FROM (SELECT *, {SPLIT} AS split FROM seqs)""",
        "piece_counts": f"SELECT piece, count(*) AS n FROM (SELECT unnest({PIECES}) AS piece FROM documents) GROUP BY piece",
        "bpe_merges": with_(*LEARNT, recursive=True)
        + """SELECT (step - 1)::INT AS rank, names[l + 1] AS left, names[r + 1] AS right, names[l + 1] || names[r + 1] AS merged
            FROM merged_at, all_names""",
        "english_tokenizer": with_(ENGLISH, *learnt("english", c.QUERY_VOCAB // 2), recursive=True)
        + """SELECT token, (row_number() OVER () - 1)::INT AS id, row_number() OVER () <= 4 AS special
            FROM (SELECT unnest(names) AS token FROM all_names)""",
        "bpe_encode": with_(*LEARNT, ENCODED, recursive=True)
        + """SELECT doc_id, (coalesce(length(s), 0) + 1)::BIGINT AS n_tokens, md5(array_to_string(list_append(
            list_transform(coalesce(string_split(s, ''), []), lambda x: (unicode(x) - 256)::VARCHAR), '2'), ',')) AS tokens_md5
            FROM documents LEFT JOIN encoded USING (doc_id)""",
        "corpus_to_shards": with_(*LEARNT, ENCODED, minhash("WHERE lang = 'en'"), KEPT, recursive=True)
        + f"""SELECT split, n // size AS shard_idx, count(*) AS sequences, count(*) * {L} AS tokens, any_value(kept_docs) AS kept_docs
            FROM (SELECT split, kept_docs, CASE WHEN split = 'val' THEN 128 ELSE 512 END AS size,
              row_number() OVER (PARTITION BY split ORDER BY seq_id) - 1 AS n
              FROM (SELECT seq_id, kept_docs, {SPLIT} AS split FROM (SELECT count(*) AS kept_docs, unnest(range((sum(length(s) + 1) // {L})::BIGINT)) AS seq_id
                FROM encoded WHERE doc_id IN (SELECT doc_id FROM kept))))
            GROUP BY split, n // size""",
        "chat_batches": with_(
            ALPHABET,
            SEGMENTS,
            "said AS (SELECT conv_id AS key, pos * 2 + k AS part, text FROM parts)",
            chat_ids("said"),
            f"""whole AS (SELECT key, [1] || list(id ORDER BY part, p) || [2] AS ids FROM ids GROUP BY key),
            cut_at AS (SELECT key, ids[:{c.CHAT_LEN}] AS ids, (row_number() OVER (ORDER BY key) - 1) // {c.BATCH} AS batch_id FROM whole),
            sized AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS n FROM cut_at)""",
        )
        + """SELECT batch_id, key AS conv_id, n AS n_input_ids, n AS n_labels, n AS n_attention_mask,
            md5(array_to_string(ids || list_transform(range(n - len(ids)), lambda x: 0), ',')) AS ids_md5 FROM sized""",
        "sft_training_batches": with_(
            ALPHABET,
            SEGMENTS,
            "said AS (SELECT conv_id AS key, pos * 2 + k AS part, text, trainable FROM parts)",
            chat_ids("said"),
            f"""whole AS (SELECT key, ([1] || list(id ORDER BY part, p) || [2])[:{c.CHAT_LEN}] AS ids,
              ([-100] || list(CASE WHEN trainable THEN id ELSE -100 END ORDER BY part, p) || [2])[:{c.CHAT_LEN}] AS labels
              FROM ids JOIN said USING (key, part) GROUP BY key)""",
            *SHUFFLED,
            f"""sized AS (SELECT key, ids, labels, list_transform(ids, lambda x: 1) AS mask, n // {c.BATCH} AS batch_id,
              max(len(ids)) OVER (PARTITION BY n // {c.BATCH}) AS upto FROM whole JOIN placed_at ON id = key)""",
            recursive=True,
        )
        + f"""SELECT batch_id, key AS conv_id, {padded('ids', 0, 'upto')} AS input_ids_md5, {padded('labels', -100, 'upto')} AS labels_md5,
            {padded('mask', 0, 'upto')} AS attention_mask_md5 FROM sized""",
        "preference_training_batches": with_(
            ALPHABET,
            PAIRS,
            """sides AS (SELECT conv_id AS key, 0 AS part, prompt AS text FROM pairs UNION ALL SELECT conv_id, 1, chosen FROM pairs
            UNION ALL SELECT conv_id, 2, rejected FROM pairs)""",
            chat_ids("sides"),
            f"""whole AS (SELECT key, list(id ORDER BY part, p) FILTER (part < 2) AS c, list(id ORDER BY part, p) FILTER (part <> 1) AS r,
              list(CASE WHEN part = 0 THEN -100 ELSE id END ORDER BY part, p) FILTER (part < 2) AS cl,
              list(CASE WHEN part = 0 THEN -100 ELSE id END ORDER BY part, p) FILTER (part <> 1) AS rl FROM ids GROUP BY key)""",
            *SHUFFLED,
            f"""cut_at AS (SELECT key, n // {c.BATCH} AS batch_id, c[:{4 * c.CHAT_LEN}] AS c, cl[:{4 * c.CHAT_LEN}] AS cl, r[:{4 * c.CHAT_LEN}] AS r,
              rl[:{4 * c.CHAT_LEN}] AS rl FROM whole JOIN placed_at ON id = key)""",
            "sized AS (SELECT *, max(len(c)) OVER w AS c_upto, max(len(r)) OVER w AS r_upto FROM cut_at WINDOW w AS (PARTITION BY batch_id))",
            recursive=True,
        )
        + f"""SELECT batch_id, key AS conv_id, {padded('c', 0, 'c_upto')} AS chosen_input_ids_md5, {padded('cl', -100, 'c_upto')} AS chosen_labels_md5,
            {padded('r', 0, 'r_upto')} AS rejected_input_ids_md5, {padded('rl', -100, 'r_upto')} AS rejected_labels_md5 FROM sized""",
        "preference_objective": with_(
            LOG_PROBS.replace("SELECT l.seq, s.logit - n.lse AS logp", "SELECT l.seq, s.logit - n.lse AS logp, t.logit - n.lse AS ref_logp")
            .replace("s.token = l.label WHERE", "s.token = l.label JOIN shifted t ON t.seq = l.seq AND t.pos = l.pos - 1 AND t.token = 63 - l.label WHERE"),
            """every AS (SELECT s.seq, coalesce(sum(logp), 0) AS logp, coalesce(sum(ref_logp), 0) AS ref_logp
              FROM (SELECT DISTINCT seq FROM labels_at) s LEFT JOIN logps p ON p.seq = s.seq GROUP BY s.seq)""",
            """margins AS (SELECT 0.1 * ((a.logp - b.logp) - (a.ref_logp - b.ref_logp)) AS x
              FROM every a JOIN every b ON b.seq = a.seq + 1 AND a.seq % 2 = 0)""",
        )
        + "SELECT round(avg(greatest(-x, 0) + ln(1 + exp(-abs(x)))), 6) AS loss FROM margins",
        "pair_batches": with_(
            ALPHABET,
            PAIRS,
            """sides AS (SELECT conv_id AS key, 0 AS part, prompt AS text FROM pairs UNION ALL SELECT conv_id, 1, chosen FROM pairs
            UNION ALL SELECT conv_id, 2, rejected FROM pairs)""",
            chat_ids("sides"),
            f"""lengths AS (SELECT key, least(count(*) FILTER (part < 2), {c.CHAT_LEN}) AS chosen,
              least(count(*) FILTER (part <> 1), {c.CHAT_LEN}) AS rejected, (row_number() OVER (ORDER BY key) - 1) // {c.BATCH} AS batch_id
              FROM ids GROUP BY key),
            sized AS (SELECT key, batch_id, max(chosen) OVER w AS a, max(rejected) OVER w AS b FROM lengths WINDOW w AS (PARTITION BY batch_id))""",
        )
        + """SELECT batch_id, key AS conv_id, a AS chosen_input_ids, a AS chosen_labels, b AS rejected_input_ids, b AS rejected_labels FROM sized""",
        "byte_alphabet": with_(ALPHABET) + "SELECT id, byte, symbol FROM alphabet",
        "chat_vocabulary": with_(ALPHABET)
        + """SELECT * FROM (VALUES ('<|pad|>', 0::BIGINT, true), ('<|bos|>', 1, true), ('<|eos|>', 2, true), ('<|unk|>', 3, true)) v(token, id, special)
            UNION ALL SELECT symbol, id, false FROM alphabet
            UNION ALL SELECT '<|im_start|>', max(id) + 1, true FROM alphabet
            UNION ALL SELECT '<|im_end|>', max(id) + 2, true FROM alphabet""",
        "bpe_round_trip": "SELECT doc_id, text FROM documents",
        "normalized_messages": with_(MESSAGES) + "SELECT conv_id, pos, role, content FROM msgs",
        "chatml_segments": with_(SEGMENTS)
        + """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos, k) - 1 AS pos, text, trainable FROM parts""",
        "generation_prompt": with_(MESSAGES)
        + f"""SELECT conv_id, CASE WHEN count(*) FILTER (WHERE role = 'system') = 0 THEN {SYSTEM} ELSE '' END
            || string_agg('<|im_start|>' || {ROLE} || chr(10) || content || '<|im_end|>' || chr(10), '' ORDER BY pos)
            || '<|im_start|>assistant' || chr(10) AS prompt FROM msgs GROUP BY conv_id""",
        "chat_encoding": with_(SEGMENTS)
        + """SELECT conv_id, '<|bos|>' || string_agg(text, '' ORDER BY pos, k) || '<|eos|>' AS text,
            coalesce(string_agg(text, '' ORDER BY pos, k) FILTER (WHERE trainable), '') || '<|eos|>' AS learnt
            FROM parts GROUP BY conv_id""",
        "padded_batches": with_(
            f"""said AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id)""",
            f"""ids AS (SELECT conv_id, list_transform(regexp_extract_all(lower(text), '{WORD}'), lambda x: len(x))[:{c.CHAT_LEN}] AS ids,
            (row_number() OVER (ORDER BY conv_id) - 1) // {c.BATCH} AS batch_id FROM said)""",
            """sized AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) - len(ids) AS pad FROM ids)""",
        )
        + """SELECT batch_id, conv_id,
            array_to_string(list_concat(ids, list_transform(range(pad), lambda x: 0)), ',') AS input_ids,
            array_to_string(list_transform(range(len(ids) + pad), lambda x: -100), ',') AS labels,
            array_to_string(list_transform(range(len(ids) + pad), lambda x: CASE WHEN x < len(ids) THEN 1 ELSE 0 END), ',')
            AS attention_mask FROM sized""",
        "preference_pairs": with_(PAIRS) + "SELECT conv_id, prompt, chosen, rejected FROM pairs",
        "response_from_messages": with_(MESSAGES)
        + "SELECT conv_id, string_agg(content, chr(10) ORDER BY pos) AS response FROM msgs GROUP BY conv_id",
        "pair_encoding": with_(PAIRS) + "SELECT conv_id, prompt || chosen AS chosen_text, rejected AS rejected_learnt FROM pairs",
        "epoch_batches": with_(INT_TOKENS, *EPOCH, recursive=True)
        + f"""SELECT seq_id, rank, batch_idx, slot FROM r
            QUALIFY count(*) OVER (PARTITION BY rank, batch_idx) = {c.BATCH}""",
        "next_token_pairs": with_(INT_TOKENS)
        + f"SELECT seq_id, {csv(f'tokens[1:{L - 1}]')} AS inputs, {csv('tokens[2:]')} AS labels FROM seqs",
        "token_budget_batches": with_(
            "n AS (SELECT doc_id AS seq_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents)",
            f"b AS (SELECT seq_id, n // {c.BATCH} AS batch_idx, n % {c.BATCH} AS slot FROM n)",
        )
        + f"""SELECT seq_id, batch_idx, slot FROM b WHERE batch_idx < ceil(20000 / ({c.BATCH} * {L}))
            QUALIFY count(*) OVER (PARTITION BY batch_idx) = {c.BATCH}""",
        "sequence_log_probs": with_(LOG_PROBS, "seqs AS (SELECT DISTINCT seq FROM labels_at)")
        + """SELECT s.seq, round(coalesce(sum(logp), 0), 6) AS logp FROM seqs s LEFT JOIN logps p ON p.seq = s.seq GROUP BY s.seq""",
        "cross_entropy": with_(LOG_PROBS) + "SELECT round(-avg(logp), 6) AS loss FROM logps",
        "preference_margins": f"""WITH m AS (SELECT vec_id, 0.1::DOUBLE * ({MARGIN}) AS x FROM embeddings)
            SELECT vec_id, round(x, 6) AS margin, round(greatest(-x, 0) + ln(1 + exp(-abs(x))), 6) AS loss FROM m""",
        "preference_loss": f"""WITH m AS (SELECT vec_id, 0.1::DOUBLE * ({MARGIN}) AS x FROM embeddings)
            SELECT round(avg(greatest(-x, 0) + ln(1 + exp(-abs(x)))), 6) AS loss FROM m""",
        "sampling_candidates": with_(CANDIDATES) + "SELECT vec_id, token, round(prob, 6) AS prob FROM cand",
        "nucleus_candidates": with_(
            LOGITS,
            """weighed AS (SELECT vec_id, token, logit, exp(logit / 5.0 - max(logit / 5.0) OVER (PARTITION BY vec_id)) AS w FROM logits)""",
            """shared AS (SELECT vec_id, token, w, coalesce(sum(w) OVER (PARTITION BY vec_id ORDER BY logit DESC, token
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(w) OVER (PARTITION BY vec_id) AS before FROM weighed)""",
        )
        + "SELECT vec_id, token, round(w / sum(w) OVER (PARTITION BY vec_id), 6) AS prob FROM shared WHERE before <= 0.8",
        "sampled_tokens": with_(
            CANDIDATES,
            f"""drawn AS (SELECT *, sum(prob) OVER (PARTITION BY vec_id ORDER BY prob DESC, token) AS upto,
            {hash32("'1337:' || vec_id")} / 4294967296.0::DOUBLE AS u FROM cand)""",
        )
        + "SELECT vec_id, arg_max(token, (prob, -token)) AS token FROM drawn WHERE upto > u GROUP BY vec_id",
        "greedy_tokens": with_(LOGITS) + "SELECT vec_id, arg_max(token, (logit, -token)) AS token FROM logits GROUP BY vec_id",
        "eval_macro_average": with_(MACRO) + "SELECT source, round(macro_average, 6) AS macro_average FROM macro",
        "perplexity": f"SELECT round(({PERPLEXITY}), 6) AS val_perplexity",
        "evaluation_report": with_(MACRO)
        + f"""SELECT 'model-a' AS model, 'fr' AS task, round(macro_average, 6) AS macro_average,
            round(({PERPLEXITY}), 6) AS val_perplexity, 5::BIGINT AS num_fewshot, count(*) AS languages,
            round(max(t) FILTER (lang = 'en'), 6) AS en_acc_none, max(lang) FILTER (lang = 'fr') AS fr_alias,
            round(max(q) FILTER (lang = 'fr'), 6) AS fr_acc_norm
            FROM macro JOIN means USING (source) GROUP BY source, macro_average""",
    }
    return out
