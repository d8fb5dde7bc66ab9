"""Deduplicating a stream of documents against everything kept so far.

Each micro-batch looks up the kept documents that share a bucket with one of its own, and decides its
documents by the same rule as a batch run: the kept ones come first and stay, as they are no
near-duplicates of each other. So hot buckets are handled as in ``dedup``. The survivors go to the output
and to the signature store. Both are keyed by batch id and a replayed batch overwrites its own part, so a
restart neither loses nor repeats documents.

The result equals that of one batch run when ids do not go back from one micro-batch to the next; a batch
that begins before the last id seen is refused, unless ``ordered=False`` asks for arrival order: then the
documents of earlier micro-batches come first, whatever their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.config import CorpusConfig, DedupConfig
from textloom.operators import dedup
from textloom.plans.corpus_prep import quality_rows
from textloom.session import materialize
from textloom.sources.text import text_rows
from textloom.streaming.signature_store import SignatureStore


class KeptIndex:
    """The kept documents of earlier batches.

    Near-duplicates share several bands, so the first few bands are enough to meet every one of
    them; only those are stored.
    """

    def __init__(self, store: SignatureStore, cfg: DedupConfig, order: str = "doc_id") -> None:
        self.store, self.cfg, self.order = store, cfg, order
        self.bands = cfg.bands - dedup.shared_bands(cfg) + 1

    def _bands_of(self, signed: DataFrame) -> DataFrame:
        buckets = dedup.band_buckets("sig", self.cfg, self.bands)
        return signed.select(F.explode(buckets).alias("bucket"), F.col(self.order).alias("id"))

    def in_reach(self, signed: DataFrame, batch_id: int) -> DataFrame | None:
        """(id, sig) of the kept documents that share a bucket with one of ``signed``."""
        rows = self.store.find("buckets", self._bands_of(signed).select("bucket"), batch_id)
        if rows is None:
            return None
        ids = materialize(rows.select("id").distinct(), "met")
        return self.store.find("signatures", ids, batch_id)

    def survivors(self, signed: DataFrame, batch_id: int) -> DataFrame:
        """Ids of the documents of a batch that no kept document and no earlier one of the batch drops."""
        known = self.in_reach(signed, batch_id)
        fresh = signed.select(F.struct(F.lit(batch_id).alias("part"), F.col(self.order).alias("id")).alias("place"), "sig")
        if known is not None:
            old = known.select(F.struct(F.lit(-1).alias("part"), "id").alias("place"), "sig")
            fresh = materialize(old.unionByName(fresh), "in_reach")
        kept = dedup.first_kept_wins(fresh, self.cfg, "place")
        return kept.filter(F.col("place.part") == batch_id).select(F.col("place.id").alias(self.order))

    def add(self, signed: DataFrame, batch_id: int, last_id: int) -> None:
        rows = signed.select(F.col(self.order).alias("id"), "sig")
        n = rows.count()
        self.store.add(batch_id, {"buckets": (self._bands_of(signed), n * self.bands), "signatures": (rows, n)}, last_id)


def dedup_stream(
    stream: DataFrame,
    output: str,
    index: str,
    checkpoint: str,
    cfg: CorpusConfig = CorpusConfig(),
    order: str = "doc_id",
    ordered: bool = True,
    **trigger: object,
) -> StreamingQuery:
    """Start the query. Survivors (order, text) land in ``output/batch_id=N``."""
    kept_index = KeptIndex(SignatureStore(stream.sparkSession, index), cfg.dedup, order)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(
            text_rows(batch, cfg.text_field, cfg.language, cfg.language_score).select(order, "text"), "batch"
        )
        signed = materialize(
            dedup.signatures(quality_rows(rows, cfg).select(order, "words"), cfg.dedup), "signed"
        )
        first, last = rows.agg(F.min(order), F.max(order)).first()
        seen = kept_index.store.last_id(batch_id)
        if ordered and first is not None and seen is not None and first < seen:
            raise ValueError(f"batch {batch_id} begins with id {first}, after id {seen}: feed in id order, or set ordered=False")
        kept = kept_index.survivors(signed, batch_id)
        survivors = materialize(signed.join(kept, order, "left_semi"), "survivors")
        rows.join(survivors.select(order), order, "left_semi").write.mode("overwrite").parquet(
            f"{output}/batch_id={batch_id}"
        )
        # the index goes last: until its version is written, a replay sees the state before this batch
        kept_index.add(survivors, batch_id, -(1 << 63) if last is None else last)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
