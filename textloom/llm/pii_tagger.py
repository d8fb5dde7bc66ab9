"""Personal data by a character-level bidirectional LSTM with CRF transitions, in numpy.

**Model.** Characters become one of a few classes; the one-hot class feeds two LSTMs, one in each
direction, whose states give a score for each tag (outside, or begin/inside of a kind). Transitions
between tags are learnt with them, by the likelihood of the whole tag sequence.

**Training** windows come from a bounded sample of documents (``SAMPLE_DOCS`` with the smallest hash of
their id, whole texts): the spans of the patterns are the labels. Of the windows without spans, a fixed
share gets a labelled span of a made-up value written in, in the patterns' forms and in a few others (no
plus sign, other separators, spelled-out at signs), so that the tagger finds forms that the patterns
miss; the others stay empty of spans. Windows with spans take at most ``SPAN_SHARE`` of the sample where
there are enough others, and every text gives one: where spans stand in its way, from the text around them.

**Application.** Every text is cut into overlapping windows; all of them are scored and decoded. A
character's tag comes from the window in which it lies farthest from an edge, and spans are read off the
whole text's tags, so that nothing depends on where windows lie. Pattern spans always stay; a tagged
span is added when it overlaps none of them and passes its kind's check.

Decoding skips nothing: a window is decoded unless a bound proves that the all-outside path is its best.

Defined results: null counts as empty, without spans; spans are in code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import blocks as bl
from textloom.llm.pii_spans import KINDS, Span, base_spans, luhn, plausible
from textloom.session import materialize

SAMPLE_DOCS = 4000
MOST_WINDOWS = 2400
SPAN_SHARE, MADE_UP_SHARE = 1 / 3, 0.6  # of all windows; of those without spans
SPANS_PER_TEXT = 4
WINDOW, MARGIN = 256, 16
TRAIN_WINDOW = 64
HIDDEN = 8
TAGS = 1 + 2 * len(KINDS)
EPOCHS = 12
BATCH = 48
SEED = 7
FORBIDDEN = -30.0
LANES = 1024

# classes of characters; everything else is class 0
GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\t\r", "@", ".", "+", "-", "(", ")", "_%", "[", "]", ",;:!?", "/")
CLASSES = len(GROUPS) + 2
PAD = CLASSES - 1


def class_table() -> np.ndarray:
    table = np.zeros(bl.CODE_POINTS, np.uint8)
    for i, group in enumerate(GROUPS):
        table[[ord(c) for c in group]] = i + 1
    return table


@dataclass
class Tagger:
    """Weights: class -> gates (four of HIDDEN, for each direction), state -> gates, states -> tags."""

    w_in: np.ndarray  # (2, CLASSES, 4H)
    w_rec: np.ndarray  # (2, H, 4H)
    w_out: np.ndarray  # (2H + 1, TAGS)
    w_class: np.ndarray  # (CLASSES, TAGS), a character's own scores
    trans: np.ndarray  # (TAGS, TAGS)
    start: np.ndarray  # (TAGS,)

    def params(self) -> list[np.ndarray]:
        return [self.w_in, self.w_rec, self.w_out, self.w_class, self.trans, self.start]


def allowed() -> tuple[np.ndarray, np.ndarray]:
    """Added to transitions and starts: an inside tag only follows a begin or inside of its kind, and a
    begin only an outside."""
    trans, start = np.zeros((TAGS, TAGS), np.float32), np.zeros(TAGS, np.float32)
    for inside in range(2, TAGS, 2):
        start[inside] = FORBIDDEN
        trans[[t for t in range(TAGS) if t not in (inside, inside - 1)], inside] = FORBIDDEN
        trans[1:, inside - 1] = FORBIDDEN
    return trans, start


def new_tagger(rng: np.random.Generator) -> Tagger:
    h = HIDDEN
    w_in = rng.normal(0, 0.3, (2, CLASSES, 4 * h)).astype(np.float32)
    w_in[:, :, h : 2 * h] += 1.0  # keep the state at first
    return Tagger(
        w_in,
        rng.normal(0, 0.3, (2, h, 4 * h)).astype(np.float32),
        rng.normal(0, 0.3, (2 * h + 1, TAGS)).astype(np.float32),
        np.zeros((CLASSES, TAGS), np.float32),
        *allowed(),
    )


def states(model: Tagger, classes: np.ndarray):
    """Hidden states (T, B, 2H) of windows ``classes`` (T, B), and what training needs to go back."""
    t_len, b = classes.shape
    h = HIDDEN
    out = np.empty((t_len, b, 2 * h), np.float32)
    kept = []
    for d in (0, 1):
        hid, cell = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
        trail = []
        for t in range(t_len) if d == 0 else range(t_len - 1, -1, -1):
            z = model.w_in[d][classes[t]] + hid @ model.w_rec[d]
            gates = np.clip(z[:, : 3 * h] * np.float32(0.25) + np.float32(0.5), 0.0, 1.0)
            new = np.clip(z[:, 3 * h :], -1.0, 1.0)
            before, old = hid, cell
            cell = gates[:, :h] * new + gates[:, h : 2 * h] * old
            squeezed = np.clip(cell, -1.0, 1.0)
            hid = gates[:, 2 * h :] * squeezed
            out[t, :, d * h : (d + 1) * h] = hid
            trail.append((t, z, gates, new, before, old, cell, squeezed))
        kept.append(trail)
    return out, kept


def emissions(model: Tagger, classes: np.ndarray) -> np.ndarray:
    """Scores (T, TAGS, B) of windows ``classes`` (T, B): the states as in ``states``, in arrays whose
    rows are windows' lanes, with the gates' scaling folded into the weights."""
    t_len, b = classes.shape
    h = HIDDEN
    scale = np.ones(4 * h, np.float32)
    scale[: 3 * h] = 0.25
    shift = np.zeros(4 * h, np.float32)
    shift[: 3 * h] = 0.5
    out = np.empty((t_len, 2 * h, b), np.float32)
    z, part, other = np.empty((4 * h, b), np.float32), np.empty((4 * h, b), np.float32), np.empty((h, b), np.float32)
    for d in (0, 1):
        table = np.ascontiguousarray((model.w_in[d] * scale + shift).T)
        rec = np.ascontiguousarray((model.w_rec[d] * scale).T)
        cell, hid = np.zeros((h, b), np.float32), np.zeros((h, b), np.float32)
        for t in range(t_len) if d == 0 else range(t_len - 1, -1, -1):
            np.matmul(rec, hid, out=z)
            np.take(table, classes[t], axis=1, out=part, mode="clip")
            z += part
            gates, new = z[: 3 * h], z[3 * h :]
            np.clip(gates, 0.0, 1.0, out=gates)
            np.clip(new, -1.0, 1.0, out=new)
            np.multiply(gates[:h], new, out=other)
            cell *= gates[h : 2 * h]
            cell += other
            np.clip(cell, -1.0, 1.0, out=other)
            hid = out[t, d * h : (d + 1) * h]
            np.multiply(gates[2 * h :], other, out=hid)
    scores = np.matmul(np.ascontiguousarray(model.w_out[:-1].T), out)
    own = np.ascontiguousarray((model.w_class + model.w_out[-1]).T)
    for t in range(t_len):
        scores[t] += np.take(own, classes[t], axis=1, mode="clip")
    return scores


def crf_gradient(em: np.ndarray, tags: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Mean negative log-likelihood of ``tags`` (T, B) and its gradients, for scores (T, B, TAGS).

    Forward and backward run on probabilities scaled at every step.
    """
    t_len, b, k = em.shape
    em = em.astype(np.float64)
    top = em.max(axis=2)
    like = np.exp(em - top[:, :, None])
    jump, first = np.exp(trans.astype(np.float64)), np.exp(start.astype(np.float64))
    alpha, beta, scale = np.empty_like(em), np.ones_like(em), np.empty((t_len, b))
    for t in range(t_len):
        a = like[t] * (first if t == 0 else alpha[t - 1] @ jump)
        scale[t] = a.sum(axis=1)
        alpha[t] = a / scale[t][:, None]
    for t in range(t_len - 2, -1, -1):
        beta[t] = (like[t + 1] * beta[t + 1]) @ jump.T / scale[t + 1][:, None]
    total = (np.log(scale) + top).sum(axis=0)
    rows = np.arange(b)
    gold = start[tags[0]] + trans[tags[:-1], tags[1:]].sum(axis=0) + em[np.arange(t_len)[:, None], rows[None, :], tags].sum(axis=0)
    g_em = alpha * beta
    after = like[1:] * beta[1:] / scale[1:][:, :, None]
    g_trans = jump * np.einsum("tbi,tbj->ij", alpha[:-1], after, optimize=True)
    np.subtract.at(g_trans, (tags[:-1], tags[1:]), 1.0)
    np.subtract.at(g_em, (np.arange(t_len)[:, None], rows[None, :], tags), 1.0)
    return (total - gold).mean(), g_em / b, g_trans / b, g_em[0].sum(axis=0) / b


def gradients(model: Tagger, classes: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    h = HIDDEN
    out, kept = states(model, classes)
    em = out @ model.w_out[:-1] + model.w_out[-1] + model.w_class[classes]
    loss, g_em, g_trans, g_start = crf_gradient(em, tags, model.trans, model.start)
    flat = np.concatenate([out.reshape(-1, 2 * h), np.ones((out.shape[0] * out.shape[1], 1), np.float32)], axis=1)
    g_out = flat.T @ g_em.reshape(-1, TAGS)
    g_state = g_em @ model.w_out[:-1].T
    g_in, g_rec = np.zeros_like(model.w_in, np.float64), np.zeros_like(model.w_rec, np.float64)
    for d in (0, 1):
        g_hid_next, g_cell_next = 0.0, 0.0
        for t, z, gates, new, before, old, cell, squeezed in reversed(kept[d]):
            g_hid = g_state[t, :, d * h : (d + 1) * h] + g_hid_next
            open_gate = (np.abs(z[:, : 3 * h]) < 2.0) * 0.25
            g_cell = g_hid * gates[:, 2 * h :] * (np.abs(cell) < 1.0) + g_cell_next
            g_z = np.empty_like(z, np.float64)
            g_z[:, :h] = g_cell * new
            g_z[:, h : 2 * h] = g_cell * old
            g_z[:, 2 * h : 3 * h] = g_hid * squeezed
            g_z[:, : 3 * h] *= open_gate
            g_z[:, 3 * h :] = g_cell * gates[:, :h] * (np.abs(z[:, 3 * h :]) < 1.0)
            g_rec[d] += before.T @ g_z
            np.add.at(g_in[d], classes[t], g_z)
            g_hid_next = g_z @ model.w_rec[d].T
            g_cell_next = g_cell * gates[:, h : 2 * h]
    g_class = np.zeros_like(model.w_class, np.float64)
    np.add.at(g_class, classes, g_em)
    return loss, [g_in, g_rec, g_out, g_class, g_trans, g_start]


def fit(classes: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Tagger:
    """Train on windows (N, TRAIN_WINDOW) of character classes and tags, with Adam."""
    rng = np.random.default_rng(seed)
    model = new_tagger(rng)
    moments = [(np.zeros(p.shape), np.zeros(p.shape)) for p in model.params()]
    step = 0
    total_steps = epochs * -(-len(classes) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(classes))
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            _, grads = gradients(model, classes[pick].T, tags[pick].T.astype(np.int64))
            norm = np.sqrt(sum((g**2).sum() for g in grads))
            step += 1
            rate = 0.03 * (1 - 0.95 * step / total_steps)
            for p, g, (m, v) in zip(model.params(), grads, moments):
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def best_span_gain(model: Tagger, em: np.ndarray) -> np.ndarray:
    """What the best single span of each window gains over tagging nothing.

    Spans are of one kind and never touch, so a path's gain is the sum over its spans: where no single
    span gains, the all-outside path is the best one.
    """
    base = model.trans[0, 0]
    begins, insides = slice(1, TAGS, 2), slice(2, TAGS, 2)
    enter, leave = (model.trans[0, begins] - base)[:, None], (model.trans[1:, 0] - base)[:, None]
    go_on, stay = (np.diagonal(model.trans, 1)[1::2] - base)[:, None], (np.diagonal(model.trans)[2::2] - base)[:, None]
    first = np.full((len(KINDS), em.shape[2]), -1e30, np.float32)  # best span that is one character so far
    longer = first.copy()
    most = np.full(em.shape[2], -1e30, np.float32)
    for t in range(len(em)):
        longer = np.maximum(first + go_on, longer + stay) + (em[t, insides] - em[t, 0])
        first = (em[t, begins] - em[t, 0]) + (enter if t else (model.start[begins] - model.start[0])[:, None])
        # at the window's end nothing is left
        out = leave if t < len(em) - 1 else np.zeros_like(leave)
        np.maximum(most, (longer + out[1::2]).max(axis=0), out=most)
        np.maximum(most, (first + out[0::2]).max(axis=0), out=most)
    return most


def decode(model: Tagger, em: np.ndarray) -> np.ndarray:
    """Best tag path (T, B) of each window, from scores (T, TAGS, B)."""
    t_len, k, b = em.shape
    open_windows = np.flatnonzero(best_span_gain(model, em) > 0)
    out = np.zeros((t_len, b), np.uint8)
    if not len(open_windows):
        return out
    part = np.ascontiguousarray(em[:, :, open_windows])
    score = model.start[:, None] + part[0]
    back = np.empty((t_len, k, len(open_windows)), np.uint8)
    for t in range(1, t_len):
        options = score[:, None, :] + model.trans[:, :, None]
        back[t] = options.argmax(axis=0)
        score = options.max(axis=0) + part[t]
    rows = np.arange(len(open_windows))
    tag = score.argmax(axis=0)
    for t in range(t_len - 1, -1, -1):
        out[t, open_windows] = tag
        if t:
            tag = back[t, tag, rows]
    return out


def tag_texts(model: Tagger, texts: list[str], table: np.ndarray) -> list[np.ndarray]:
    """Tags of each text's characters: overlapping windows, each character tagged by its own window."""
    step = WINDOW - 2 * MARGIN
    codes, offsets = bl.code_points(texts)
    classes = table[codes]
    n_windows = -(-np.diff(offsets) // step)
    base = np.cumsum(n_windows * step + 2 * MARGIN) - (n_windows * step + 2 * MARGIN)
    padded = np.full(int((n_windows * step + 2 * MARGIN).sum()), PAD, np.uint8)
    for low, high, at in zip(offsets[:-1].tolist(), offsets[1:].tolist(), base.tolist()):
        padded[at + MARGIN : at + MARGIN + high - low] = classes[low:high]
    first_window = np.cumsum(n_windows) - n_windows
    nth = np.arange(int(n_windows.sum())) - np.repeat(first_window, n_windows)
    starts = (np.repeat(base, n_windows) + nth * step).astype(np.int32)
    own = np.zeros((len(starts), step), np.uint8)
    span = np.arange(WINDOW, dtype=np.int32)[:, None]
    for i in range(0, len(starts), LANES):
        window = padded[starts[None, i : i + LANES] + span]
        own[i : i + LANES] = decode(model, emissions(model, window))[MARGIN : WINDOW - MARGIN].T
    own = own.ravel()
    ends = np.diff(offsets)
    return [own[w * step : w * step + n] for w, n in zip(first_window.tolist(), ends.tolist())]


def tagged_spans(tags: np.ndarray) -> list[Span]:
    """Spans of one text's tags: a begin, or an inside of another kind, opens a span."""
    out = []
    at = np.flatnonzero(tags)
    if not len(at):
        return out
    kind, begins = (tags[at].astype(int) - 1) // 2, (tags[at] - 1) % 2 == 0
    opens = np.ones(len(at), bool)
    opens[1:] = begins[1:] | (at[1:] != at[:-1] + 1) | (kind[1:] != kind[:-1])
    starts = np.flatnonzero(opens)
    for i, j in zip(starts, np.append(starts[1:], len(at))):
        out.append((int(kind[i]), int(at[i]), int(at[j - 1]) + 1))
    return out


def merged(text: str, base: list[Span], tagged: list[Span]) -> list[Span]:
    """Base spans, and the tagged ones that are free of them and pass their check."""
    out = list(base)
    for kind, s, e in tagged:
        while s < e and text[s].isspace():
            s += 1
        while s < e and (text[e - 1].isspace() or text[e - 1] in ".,;:!?"):
            e -= 1
        if s < e and all(e <= bs or be <= s for _, bs, be in base) and plausible(kind, text[s:e]):
            # part of a longer number or word: not a value of its own
            if not (s and text[s - 1].isalnum()) and not (e < len(text) and text[e].isalnum()):
                out.append((kind, s, e))
    return out


# -- training windows ---------------------------------------------------------------------------


def made_up(rng: np.random.Generator) -> tuple[int, str]:
    """A kind and an invented value of it."""

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def word(low: int, high: int) -> str:
        return "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(low, high)))

    kind = int(rng.integers(0, len(KINDS)))
    form = rng.random()
    if kind == 0:
        name = word(2, 10) + rng.choice(["", ".", "_", "-"]) + rng.choice([word(1, 8), digits(2)])
        host, end = word(2, 10) + rng.choice(["", digits(1)]), rng.choice([".com", ".org", ".net", ".example.com", ".de"])
        at, dot = ("@", ".") if form < 0.75 else (str(rng.choice([" [at] ", "(at)", " @ "])), str(rng.choice([" [dot] ", "."])))
        return kind, name + at + host + end.replace(".", dot)
    if kind == 1:
        return kind, ".".join(str(x) for x in rng.integers(0, 256, 4))
    if kind == 2:
        body = digits(int(rng.choice([12, 14, 15, 15, 15, 18])))
        number = next(body + str(c) for c in range(10) if luhn(body + str(c)))
        sep = str(rng.choice(["", " ", "-"])) if form < 0.8 else str(rng.choice([".", "/", "  "]))
        return kind, sep.join(number[i : i + 4] for i in range(0, len(number), 4))
    area, a, b = digits(3), digits(3), digits(4)
    # half without a country code: these are the ones that no pattern finds
    if form < 0.3:
        return kind, f"+{rng.integers(1, 99)} ({area}) {a}-{b}"
    if form < 0.5:
        return kind, f"+{rng.integers(1, 99)}" + str(rng.choice([" ", "-", "."])) .join(["", area, a, b])
    return kind, str(rng.choice([f"({area}) {a}-{b}", f"{area}-{a}-{b}", f"{area}.{a}.{b}"]))


def chosen_spans(text: str, spans: list[Span]) -> list[Span]:
    """At most ``SPANS_PER_TEXT`` of a text's spans: those with the smallest hashes, kinds by turns."""
    if len(spans) <= SPANS_PER_TEXT:
        return spans
    turns: list[tuple[int, int, Span]] = []
    for kind in range(len(KINDS)):
        own = sorted((crc32(f"{s} {text[s:e]}".encode()), (k, s, e)) for k, s, e in spans if k == kind)
        turns += [(turn, place, span) for turn, (place, span) in enumerate(own)]
    return [span for *_, span in sorted(turns)[:SPANS_PER_TEXT]]


def without_spans(text: str, spans: list[Span]) -> str:
    """The text around the spans; no pattern goes over the line breaks in their place."""
    parts, at = [], 0
    for _, s, e in sorted(spans, key=lambda x: x[1:]):
        if s > at:
            parts.append(text[at:s])
        at = max(at, e)
    return "\n".join([*parts, text[at:]])


def labelled_windows(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[tuple[str, list[Span]]]:
    """Windows of sampled documents with their pattern spans: some around a span, and for each text one
    at any place, and one from the text around its spans if some lie in that place."""
    places = docs.select(F.xxhash64("doc_id").alias("place")).orderBy("place").limit(sample_docs)
    cut = places.agg(F.max("place")).first()[0]
    if cut is None:
        return []

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), bl.texts_of(batch.column(1))):
                spans = base_spans(text)
                rng = np.random.default_rng(abs(doc_id or 0))
                starts = [max(0, s - int(rng.integers(0, TRAIN_WINDOW // 2))) for _, s, _ in chosen_spans(text, spans)]
                starts.append(int(rng.integers(0, max(1, len(text) - TRAIN_WINDOW + 1))))
                for w in starts:
                    inside = [(k, s - w, e - w) for k, s, e in spans if w <= s and e <= w + TRAIN_WINDOW]
                    cut_through = any(s < w + TRAIN_WINDOW and e > w for _, s, e in spans) and not inside
                    if text and not cut_through:
                        rows.append((text[w : w + TRAIN_WINDOW], [x for span in inside for x in span]))
                if any(s < starts[-1] + TRAIN_WINDOW and e > starts[-1] for _, s, e in spans):
                    bare = without_spans(text, spans)
                    w = int(rng.integers(0, max(1, len(bare) - TRAIN_WINDOW + 1)))
                    bare = bare[w : w + TRAIN_WINDOW]
                    rows.append((bare, [x for span in base_spans(bare) for x in span]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.int32()))], ["window", "spans"]
            )

    sampled = docs.select("doc_id", "text").filter(F.xxhash64("doc_id") <= F.lit(cut))
    found = sampled.mapInArrow(windows, "window string, spans array<int>")
    found = materialize(found, "windows")

    def some(which: Column) -> list[tuple[str, list[Span]]]:
        ranked = found.filter(which).orderBy(F.xxhash64("window"), "window").limit(MOST_WINDOWS)
        return [(r["window"], [tuple(r["spans"][i : i + 3]) for i in range(0, len(r["spans"]), 3)]) for r in ranked.collect()]

    # one side takes more than its share only where the other has too few
    spanned, plain = some(F.size("spans") > 0), some(F.size("spans") == 0)
    spanned = spanned[: max(int(MOST_WINDOWS * SPAN_SHARE), MOST_WINDOWS - len(plain))]
    return spanned + plain[: MOST_WINDOWS - len(spanned)]


def training_arrays(windows: list[tuple[str, list[Span]]], seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags (N, TRAIN_WINDOW); ``MADE_UP_SHARE`` of the windows without spans get a made-up one."""
    rng = np.random.default_rng(seed)
    table = class_table()
    classes = np.full((len(windows), TRAIN_WINDOW), PAD, np.uint8)
    tags = np.zeros((len(windows), TRAIN_WINDOW), np.uint8)
    for i, (text, spans) in enumerate(windows):
        if not spans and rng.random() < MADE_UP_SHARE:
            kind, value = made_up(rng)
            at = int(rng.integers(0, max(1, min(len(text), TRAIN_WINDOW - len(value) - 1))))
            left = text[:at] + (" " if at else "")
            text = (left + value + " " + text[at:])[:TRAIN_WINDOW]
            spans = [(kind, len(left), min(TRAIN_WINDOW, len(left) + len(value)))]
        classes[i, : len(text)] = table[np.fromiter(map(ord, text), np.uint32, len(text))]
        for kind, s, e in spans:
            tags[i, s:e] = 2 + 2 * kind
            tags[i, s] = 1 + 2 * kind
    return classes, tags


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Tagger:
    """Train on a bounded sample; without any text the tagger stays untrained and finds nothing."""
    windows = labelled_windows(docs, sample_docs)
    if not windows:
        return Tagger(*[np.zeros(p.shape, np.float32) for p in new_tagger(np.random.default_rng(0)).params()])
    return fit(*training_arrays(windows))


# -- application --------------------------------------------------------------------------------


def find(docs: DataFrame, model: Tagger) -> DataFrame:
    """(doc_id, base, spans) for each row: flat arrays of kind, start, end."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    @bl.give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        for batch in batches:
            for start, texts in bl.text_blocks(batch.column(1), bl.BLOCK_CHARS // 2):
                base = [base_spans(text) for text in texts]
                tags = tag_texts(shared.value, texts, table)
                full = [merged(text, b, tagged_spans(t)) for text, b, t in zip(texts, base, tags)]
                flat = [[[x for span in sorted(spans) for x in span] for spans in side] for side in (base, full)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), *[pa.array(side, pa.list_(pa.int32())) for side in flat]],
                    ["doc_id", "base", "spans"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, base array<int>, spans array<int>")


def replaced(text: str, spans: list[Span]) -> str:
    """The text with spans replaced by their kind; where spans of several kinds overlap, their union by
    the kind that begins first."""
    parts, at, end = [], 0, 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], x[0], x[2])):
        if s >= end:
            parts += [text[at:s], f"<{KINDS[kind]}>"]
        at = end = max(end, e)
    return "".join([*parts, text[at:]])


def masked(docs: DataFrame, model: Tagger) -> DataFrame:
    """``docs`` with all spans of ``text`` replaced; other columns as they are, null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    @bl.give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        for batch in batches:
            column = batch.column(at)
            out = [pa.array([], pa.string())]
            for _, part in bl.text_blocks(column, bl.BLOCK_CHARS // 2):
                done = []
                for text, tags in zip(part, tag_texts(shared.value, part, table)):
                    done.append(replaced(text, merged(text, base_spans(text), tagged_spans(tags))))
                out.append(pa.array(done, pa.string()))
            kept = pc.if_else(column.is_null(), pa.scalar(None, pa.string()), pa.concat_arrays(out))
            yield pa.RecordBatch.from_arrays([kept if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
