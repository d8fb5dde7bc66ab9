"""Arithmetic over model scores and evaluation results that arrive as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.config import IGNORE_LABEL, EvalConfig, SamplingConfig
from textloom.functions.hashing import unit_hash
from textloom.operators.batches import within_token_budget
from textloom.plans.skew import BROADCAST_ROWS, join_narrow
from textloom.session import materialize

# Metric names in order of preference.
METRICS = ("acc_norm,none", "acc,none", "acc_norm", "acc")
# widths of score bins in nats: sums of a bin stay far from overflow; a token of a bin weighs nearly what its neighbours weigh
MASS_BIN = 16.0
NUCLEUS_BIN = 0.125


def macro_average(
    reports: DataFrame, tasks: Sequence[str] = EvalConfig().tasks, report: str = "report"
) -> DataFrame:
    """Add ``macro_average``: the mean over the requested tasks that a JSON report has a score for."""
    parsed = F.from_json(F.col(report), "struct<results: map<string, map<string, string>>>")["results"]

    def score(task: str) -> Column:
        metrics = parsed[task]
        found = F.coalesce(*[metrics[name] for name in METRICS])
        number = found.try_cast("double")
        wrong = F.raise_error(F.concat(F.lit(f"a score of task {task} is not a number: "), found)).cast("double")
        return F.when(found.isNotNull() & number.isNull(), wrong).otherwise(number)

    scores = F.filter(F.array(*[score(t) for t in tasks]), lambda s: s.isNotNull())
    total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s)
    return reports.withColumn("macro_average", F.when(F.size(scores) > 0, total / F.size(scores)))


def perplexity(losses: DataFrame | None, token_budget: int, batch_size: int, seq_len: int) -> DataFrame:
    """One row ``val_perplexity`` from (batch_idx, loss): the exponential of the mean batch loss.

    Null without a table (no shards), one for an empty table.
    """
    from pyspark.sql import SparkSession

    if losses is None:
        return SparkSession.active().range(1).select(F.lit(None).cast("double").alias("val_perplexity"))
    used = within_token_budget(losses, token_budget, batch_size, seq_len)
    return used.agg(F.exp(F.coalesce(F.avg("loss"), F.lit(0.0))).alias("val_perplexity"))


def binned_mass(logits: DataFrame, keys: Sequence[str], score: Column, width: float, *more: Column) -> DataFrame:
    """(keys, bin, mass, ...): the exponentials of a score, summed up per bin of ``width`` and scaled by the bin's lower
    edge, so that nothing overflows. Bins combine on the map side; a score of minus infinity has no mass."""
    finite = logits.withColumn("_score", score).filter(F.col("_score") > float("-inf"))
    binned = finite.withColumn("bin", F.floor(F.col("_score") / width).cast("bigint"))
    return binned.groupBy(*keys, "bin").agg(F.sum(F.exp(F.col("_score") - F.col("bin") * width)).alias("mass"), *more)


def label_log_probs(logits: DataFrame, labels: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(seq, pos, label, logp) from (seq, pos, token, logit) and (seq, pos, label).

    The scores at ``pos`` predict the label at ``pos + 1``; masked labels are left out. The log-sum-exp of
    a position is put together from bins, which combine before they are shuffled; the scores themselves stay where they
    are while the labels can be sent to them. A label without a score is an error.
    """
    wanted = labels.filter((F.col("label") != IGNORE_LABEL) & (F.col("pos") > 0)).select(
        "seq", (F.col("pos") - 1).alias("pos"), "label"
    )
    bins = binned_mass(logits, ["seq", "pos"], F.col("logit"), MASS_BIN)
    # few bins per position: the range of its scores by the width
    per_position = bins.groupBy("seq", "pos").agg(F.max("bin").alias("top"), F.collect_list(F.struct("bin", "mass")).alias("bins"))
    scaled = F.aggregate("bins", F.lit(0.0), lambda sum_, b: sum_ + b["mass"] * F.exp((b["bin"] - F.col("top")) * MASS_BIN))
    norms = per_position.select("seq", "pos", (F.col("top") * MASS_BIN + F.log(scaled)).alias("norm"))
    said = logits.withColumnRenamed("token", "label").select("seq", "pos", "label", "logit")
    found = join_narrow(said, wanted.distinct(), ["seq", "pos", "label"], broadcast_rows)
    missing = F.raise_error(F.concat_ws(" ", F.lit("no score for the label at"), F.col("seq").cast("string"), F.col("pos").cast("string"))).cast("double")
    score = F.when(F.col("logit").isNull(), missing).otherwise(F.col("logit") - F.col("norm"))
    return wanted.join(found, ["seq", "pos", "label"], "left").join(norms, ["seq", "pos"], "left").select("seq", "pos", "label", score.alias("logp"))


def sequence_scores(logits: DataFrame, labels: DataFrame) -> DataFrame:
    """(seq, logp): summed log probability of the unmasked labels; zero when all are masked."""
    scored = label_log_probs(logits, labels).groupBy("seq").agg(F.sum("logp").alias("logp"))
    every = labels.select("seq").distinct()
    return every.join(scored, "seq", "left").select("seq", F.coalesce("logp", F.lit(0.0)).alias("logp"))


def cross_entropy(logits: DataFrame, labels: DataFrame) -> DataFrame:
    """One row ``loss``: the mean negative log probability over all unmasked labels."""
    return label_log_probs(logits, labels).agg((-F.avg("logp")).alias("loss"))


def preference_margin(beta: float = 0.1) -> Column:
    """Scaled difference between the policy's and the reference model's preference."""
    policy = F.col("chosen") - F.col("rejected")
    baseline = F.col("ref_chosen") - F.col("ref_rejected")
    return F.lit(beta) * (policy - baseline)


def neg_log_sigmoid(x: Column) -> Column:
    """``-log(sigmoid(x))`` without overflow on either side."""
    return F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def preference_loss(pairs: DataFrame, beta: float = 0.1) -> DataFrame:
    """One row ``loss`` over (chosen, rejected, ref_chosen, ref_rejected) log probabilities."""
    return pairs.agg(F.avg(neg_log_sigmoid(preference_margin(beta))).alias("loss"))


def candidates(logits: DataFrame, cfg: SamplingConfig = SamplingConfig(), row: str = "row_id") -> DataFrame:
    """(row, token, prob): what remains after temperature, top-k and top-p, renormalised.

    Ties with the k-th score stay, and so does the row that crosses ``top_p``. A temperature of zero
    leaves the best token. With ``top_k`` every step shares one shuffle by row, and few tokens of a row
    get that far; without it ``nucleus`` avoids sorting whole vocabularies.
    """
    limited = cfg.top_k and cfg.top_k > 0
    if cfg.temperature > 0 and not limited and cfg.top_p and cfg.top_p < 1.0:
        return nucleus(logits, cfg, row)
    whole = Window.partitionBy(row)
    ranked = whole.orderBy(F.desc("logit"), "token")
    if cfg.temperature <= 0:
        best = logits.withColumn("_n", F.row_number().over(ranked)).filter("_n = 1")
        return best.select(row, "token", F.lit(1.0).alias("prob"))
    scaled = logits.withColumn("_x", F.col("logit") / cfg.temperature)
    if limited:
        scaled = scaled.withColumn("_rank", F.rank().over(whole.orderBy(F.desc("logit"))))
        scaled = scaled.filter(F.col("_rank") <= cfg.top_k)
    weighted = scaled.withColumn("_w", F.exp(F.col("_x") - F.max("_x").over(whole)))
    share = F.col("_w") / F.sum("_w").over(whole)
    kept = weighted.withColumn("_p", share)
    if cfg.top_p and cfg.top_p < 1.0:
        before = F.sum("_p").over(ranked.rowsBetween(Window.unboundedPreceding, -1))
        kept = kept.withColumn("_before", F.coalesce(before, F.lit(0.0))).filter(F.col("_before") <= cfg.top_p)
    return kept.select(row, "token", (F.col("_p") / F.sum("_p").over(whole)).alias("prob"), "logit").drop("logit")


def nucleus(logits: DataFrame, cfg: SamplingConfig, row: str = "row_id", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(row, token, prob): the most likely tokens until their mass exceeds ``top_p``, renormalised.

    A histogram of each row's scores, combined on the map side, tells the bin in which the mass is exceeded. Tokens of
    higher bins are in, those of lower bins are out, and only the tokens of that bin are put in order.
    """
    x = F.col("logit") / cfg.temperature
    bins = binned_mass(logits, [row], x, NUCLEUS_BIN)
    by_row = Window.partitionBy(row)
    # one row per bin that occurs
    weight = F.col("mass") * F.exp((F.col("bin") - F.max("bin").over(by_row)) * NUCLEUS_BIN)
    scaled = bins.select(row, "bin", F.max("bin").over(by_row).alias("top"), weight.alias("w"))
    falling = by_row.orderBy(F.desc("bin"))
    ahead = F.coalesce(F.sum("w").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    shares = scaled.select(row, "bin", "top", "w", ahead.alias("ahead"), F.sum("w").over(by_row).alias("total"))
    # the last bin that begins at or below the limit holds the crossing token
    last = shares.filter(F.col("ahead") <= F.col("total") * cfg.top_p).groupBy(row).agg(
        F.min("bin").alias("cut"), F.max("ahead").alias("ahead"), F.first("top").alias("top"), F.first("total").alias("total")
    )
    last = materialize(last, "crossing")
    met = join_narrow(logits.select(row, "token", x.alias("x")), last, [row], broadcast_rows)
    bin_ = F.floor(F.col("x") / NUCLEUS_BIN).cast("bigint")
    near = met.filter((F.col("x") > float("-inf")) & (bin_ >= F.col("cut")))
    near = near.withColumn("w", F.exp(F.col("x") - F.col("top") * NUCLEUS_BIN))
    inside = near.filter(bin_ == F.col("cut"))
    ranked = Window.partitionBy(row).orderBy(F.desc("x"), "token").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("ahead") + F.coalesce(F.sum("w").over(ranked), F.lit(0.0))
    crossing = inside.withColumn("before", before).filter(F.col("before") <= F.col("total") * cfg.top_p).drop("before")
    crossing = materialize(crossing, "crossing_tokens")
    sums = last.select(row, "ahead").join(crossing.groupBy(row).agg(F.sum("w").alias("inside")), row)
    sums = sums.select(row, (F.col("ahead") + F.col("inside")).alias("kept"))
    every = near.filter(bin_ > F.col("cut")).unionByName(crossing).select(row, "token", "w")
    return join_narrow(every, sums, [row], broadcast_rows).select(row, "token", (F.col("w") / F.col("kept")).alias("prob"))


def draw(candidate_rows: DataFrame, seed: int = 1337, row: str = "row_id") -> DataFrame:
    """(row, token): one candidate per row by inverse cumulative probability of a seeded hash."""
    ranked = Window.partitionBy(row).orderBy(F.desc("prob"), "token")
    upto = F.sum("prob").over(ranked.rowsBetween(Window.unboundedPreceding, 0))
    u = unit_hash(seed, F.col(row)) / F.lit(float(1 << 32))
    passed = candidate_rows.withColumn("_upto", upto).withColumn("_n", F.row_number().over(ranked))
    # the least likely candidate takes whatever rounding leaves over
    reached = passed.withColumn("_hit", F.when(F.col("_upto") > u, F.col("_n")))
    choice = F.coalesce(F.min("_hit").over(Window.partitionBy(row)), F.max("_n").over(Window.partitionBy(row)))
    return reached.withColumn("_choice", choice).filter("_n = _choice").select(row, "token")


def evaluation_report(model: str, reports: DataFrame, ppl: DataFrame, cfg: EvalConfig = EvalConfig()) -> DataFrame:
    """One row ``report`` per evaluation report: a JSON record with scores and perplexity.

    The evaluation's own result is passed through as it is, with all its fields and number types.
    """
    scored = macro_average(reports, cfg.tasks)
    value = ppl.first()  # one row
    record = F.struct(
        F.lit(model).alias("model"),
        F.array(*[F.lit(t) for t in cfg.tasks]).alias("tasks"),
        F.parse_json("report").alias("lm_eval"),
        F.col("macro_average"),
        F.lit(value[0] if value else None).cast("double").alias("val_perplexity"),
    )
    options = {"pretty": "true", "ignoreNullFields": "false"}
    return scored.select(F.to_json(record, options).alias("report"))
