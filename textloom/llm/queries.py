"""The queries of this subpackage over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    chat_log,
    decontaminate,
    html_layout,
    language_mix,
    minhash,
    ngram_resample,
    periodic_runs,
    pii_tagger,
    piece_tokens,
    pivot_index,
    pivotal_mix,
    posting_lists,
    range_shards,
)
from textloom.llm.pii_spans import KINDS, joined

CONTROL_TEXT = "\\### Assistant: </turn> ok"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicate_classes(read(spark, sf_dir, "documents"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"),
    )
    extra = extra.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", F.lit(CONTROL_TEXT).alias("text"))
    events = chat_log.as_events(rows.unionByName(extra))
    return chat_log.read_back(chat_log.render(chat_log.fold_events(events)))


def op3_ann_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(read(spark, sf_dir, "embeddings"))


def op4_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.page_texts(read(spark, sf_dir, "pages"))


def op5_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii_tagger.find(docs, pii_tagger.train(docs))
    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, full = (
                [list(zip(flat[0::3], flat[1::3], flat[2::3])) for flat in column.to_pylist()] for column in batch.columns[1:]
            )
            n = [[sum(kind == k for kind, _, _ in spans) for spans in base] for k in range(len(KINDS))]
            sha = [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base]
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in n), pa.array(sha), pa.array([joined(s) for s in full], pa.string())]
            names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return found.mapInArrow(digest, f"doc_id bigint, {counts}, base_sha256 string, spans string")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_tokens.encode(read(spark, sf_dir, "documents"))
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", "round_trip")


def op7_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.search(read(spark, sf_dir, "embeddings"))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mix.identify(read(spark, sf_dir, "documents"))


def op9_range_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = range_shards.shard_documents(read(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotal_mix.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_items = F.size("items").cast("bigint").alias("n_items")
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", n_items, digest, (F.col("n_hit") > 0).alias("contaminated"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, told by the crc32 of the id, end in words that repeat with a period;
    documents without an id stay as they are."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                h = 1 if doc_id is None else crc32(str(doc_id).encode())
                words = (texts[i] or b"").split() if h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    texts[i] = b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)])
            column = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(plant, "doc_id bigint, text string")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(with_planted_periods(read(spark, sf_dir, "documents")))
    # fractions are compared by cross products; equal ones by start, then period
    order = """CASE WHEN x.length * y.period <> y.length * x.period
        THEN CASE WHEN x.length * y.period > y.length * x.period THEN -1 ELSE 1 END
        WHEN x.start <> y.start THEN CASE WHEN x.start < y.start THEN -1 ELSE 1 END
        WHEN x.period < y.period THEN -1 WHEN x.period > y.period THEN 1 ELSE 0 END"""
    top = F.get(F.expr(f"array_sort(runs, (x, y) -> {order})"), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    rows = found.select("doc_id", "runs", "collapsed", top.alias("top"), F.array_join(lines, "").alias("lines"))
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_minhash_near_dedup, op2_chat_formatting, op3_ann_posting_lists, op4_html_layout, op5_pii_tagger,
        op6_sentencepiece, op7_pivot_topk, op8_language_mixture, op9_range_shards, op10_pivotal_mix,
        op11_benchmark_decontamination, op12_importance_resampling, op13_periodic_runs, pipeline,
    ]
    return {f.__name__: f for f in found}


ESCAPE = r"regexp_replace({}, '([\\<>])', '\\\1', 'g')"
OP2 = rf"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn >') + length({ESCAPE.format('role')}) + 1 + length({ESCAPE.format('text')}) + 9)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id"""

OP7 = """WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM ok q JOIN ok c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


NORMAL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP11 = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {NORMAL_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {NORMAL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM b, unnest(range(1, len(w) - n + 2)) t(i)),
windows AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM d CROSS JOIN (SELECT DISTINCT n FROM patterns) s, unnest(range(1, len(w) - n + 2)) t(i)),
met AS (SELECT r, i, n, item_id FROM windows JOIN patterns USING (n, p)),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM met, unnest(range(i, i + n)) u(j) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""



def crc_sql(value: str) -> str:
    """The crc32 of a string: its table of bytes by the rule of the polynomial, then byte by byte."""
    table = [functools.reduce(lambda c, _: c >> 1 ^ (0xEDB88320 if c & 1 else 0), range(8), r) for r in range(256)]
    byte_list = f"list_transform(regexp_extract_all(hex(encode({value})), '..'), lambda h: ('0x' || h)::BIGINT)"
    step = f"lambda c, b: xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {byte_list}), {step}))"


OP12 = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {NORMAL_WORDS} AS w FROM documents),
b AS (SELECT -row_number() OVER () AS r, {NORMAL_WORDS} AS w FROM benchmark),
feats AS (SELECT r, array_to_string(w[i:i + n - 1], ' ') AS f FROM (SELECT r, w FROM d UNION ALL SELECT r, w FROM b),
  range(1, 4) s(n), unnest(range(1, len(w) - n + 2)) t(i)),
hashed AS (SELECT f, {crc_sql('f')} % 10000 AS bucket FROM (SELECT DISTINCT f FROM feats)),
counted AS (SELECT r, bucket, count(*) AS n FROM feats JOIN hashed USING (f) GROUP BY r, bucket),
sums AS (SELECT bucket, sum(n) FILTER (r > 0) AS s, sum(n) FILTER (r < 0) AS t FROM counted GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM sums),
gains AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE)
  / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain FROM sums, totals),
weighed AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM counted JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT doc_id, len(w) >= 20 AS enough, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
  / 4294967296::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN weighed USING (r)),
placed AS (SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id) AS place,
  5 * count(*) OVER (PARTITION BY enough) // 100 AS k FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN enough AND place <= k THEN place END AS rank FROM placed"""

OP13 = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {crc_sql('doc_id::VARCHAR')} AS h,
  regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
plan AS (SELECT r, doc_id, h, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM d),
own AS (SELECT r, unnest(w) AS word, unnest(range(n)) AS i FROM plan),
places AS (SELECT r, n, unnest(range(n)) AS i, a, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM plan),
words AS (SELECT x.r, x.n, x.i, word FROM places x JOIN own o ON o.r = x.r
  AND o.i = CASE WHEN x.i < a THEN x.i ELSE a + (x.i - a) % p END),
equal AS (SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word
  AND y.i > x.i AND y.i - x.i <= x.n // 4),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
by_doc AS (SELECT r, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS sha
  FROM runs GROUP BY r),
top AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  coalesce(sha, sha256('')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM d LEFT JOIN by_doc USING (r) LEFT JOIN top USING (r) LEFT JOIN kept USING (r)"""


def all_oracles() -> dict[str, str]:
    return {
        "op2_chat_formatting": OP2,
        "op7_pivot_topk": OP7,
        "op11_benchmark_decontamination": OP11,
        "op12_importance_resampling": OP12,
        "op13_periodic_runs": OP13,
    }
