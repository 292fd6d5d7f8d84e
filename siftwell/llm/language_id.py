"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

Its squashing function is x / (1 + |x|). It labels every byte of every text and pools the positions' probabilities into a document's. Texts are read whole, in windows
of ``WINDOW`` bytes whose states start at zero, so that all windows of a batch step together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_buffers

WINDOW = 128
HIDDEN = 6
#: The classifier is fitted on about SAMPLE_DOCS documents of each language and SAMPLE_WINDOWS windows of each of them; these
#: bounds hold for input of any size.
SAMPLE_DOCS = 300
SAMPLE_WINDOWS = 3
STEPS = 160
BATCH = 64
#: Windows that step together: 1,024 x 128 bytes.
ABREAST = 1024
ASCII_LETTER = re.compile("[A-Za-z]")
#: The classifier learns at most so many languages, those of the most documents: a bound of what is fitted, as a column of free text
#: may hold any number of values.
LANGUAGES = 200
#: Positions that count for the pool: ASCII letters and bytes of other characters.
POOLED = np.array([(65 <= b <= 90) or (97 <= b <= 122) or b >= 128 for b in range(256)])


def has_letter(text: str) -> bool:
    """Whether any character is in one of Unicode's letter categories: no digits, fractions or enclosed letters."""
    return ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    embed: np.ndarray  # (2, 256, 3H): a byte's share of reset, update and candidate, for each direction
    state: np.ndarray  # (2, H, 3H)
    out: np.ndarray  # (2, H, C)
    bias: np.ndarray  # (C,)


def _soft(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) in place: the squashing function, many times cheaper than tanh here."""
    below = np.abs(x)
    below += 1
    x /= below
    return x


def _forward(m: Model, windows: np.ndarray, valid: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Log-odds (L, B, C) for bytes (B, L). keep gets what the way back needs."""
    b, length = windows.shape
    hidden = m.state.shape[1]
    table = m.embed.reshape(512, 3 * hidden)
    # Row t: the bytes of step t, forward and then backward.
    steps = np.concatenate((windows.T, windows.T[::-1]), 1).astype(np.int64)
    steps[:, b:] += 256
    whole = bool(valid.all())
    on = None if whole else np.concatenate((valid.T, valid.T[::-1]), 1)[..., None].reshape(length, 2, b, 1).astype(np.float32)
    h = np.zeros((2, b, hidden), np.float32)
    states = np.empty((2, length, b, hidden), np.float32)
    for t in range(length):
        x = table.take(steps[t], axis=0).reshape(2, b, 3 * hidden)
        u = h @ m.state
        gates = _soft(x[..., : 2 * hidden] + u[..., : 2 * hidden])
        gates *= 0.5
        gates += 0.5
        r, z = gates[..., :hidden], gates[..., hidden:]
        n = r * u[..., 2 * hidden :]
        n += x[..., 2 * hidden :]
        _soft(n)
        new = h - n
        new *= z
        new += n
        if on is not None:
            new *= on[t]
        if keep is not None:
            keep.append((h, r, z, n, u[..., 2 * hidden :], 1.0 if on is None else on[t]))
        h = new
        states[0, t], states[1, length - 1 - t] = h[0], h[1]
    if keep is not None:
        keep.append(states)
    out = states[0].reshape(-1, hidden) @ m.out[0]
    out += states[1].reshape(-1, hidden) @ m.out[1]
    out += m.bias
    return out.reshape(length, b, -1)


def _probabilities(m: Model, windows: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Probabilities (L, C, B) of every position: the same network, laid out with windows along the rows and in place."""
    b, length = windows.shape
    hidden = m.state.shape[1]
    table = np.ascontiguousarray(m.embed.reshape(512, 3 * hidden))
    weights = np.ascontiguousarray(m.state.transpose(0, 2, 1))
    steps = np.concatenate((windows.T, windows.T[::-1]), 1).astype(np.int64)
    steps[:, b:] += 256
    on = None if valid.all() else np.stack((valid.T, valid.T[::-1]), 1)[:, :, None, :].astype(np.float32)
    states = np.empty((2, length, hidden, b), np.float32)
    found, x, u, below = np.empty((2 * b, 3 * hidden), np.float32), *(np.empty((2, 3 * hidden, b), np.float32) for _ in range(3))
    gates, r, z, x_n, u_n = x[:, : 2 * hidden], x[:, :hidden], x[:, hidden : 2 * hidden], x[:, 2 * hidden :], u[:, 2 * hidden :]
    n, h = np.empty((2, hidden, b), np.float32), np.zeros((2, hidden, b), np.float32)
    for t in range(length):
        table.take(steps[t], axis=0, out=found, mode="clip")
        np.copyto(x, found.reshape(2, b, 3 * hidden).transpose(0, 2, 1))
        np.matmul(weights, h, out=u)
        gates += u[:, : 2 * hidden]
        a = np.abs(gates, out=below[:, : 2 * hidden])
        a += 1
        gates /= a
        gates *= 0.5
        gates += 0.5
        np.multiply(r, u_n, out=n)
        n += x_n
        a = np.abs(n, out=below[:, 2 * hidden :])
        a += 1
        n /= a
        h -= n
        h *= z
        h += n
        if on is not None:
            h *= on[t]
        states[0, t], states[1, length - 1 - t] = h[0], h[1]
    p = np.matmul(m.out[0].T, states[0])
    p += np.matmul(m.out[1].T, states[1])
    p += m.bias[:, None]
    np.clip(p, -80, 80, out=p)
    np.exp(p, out=p)
    p /= p.sum(1, keepdims=True)
    return p


def _softmax(x: np.ndarray) -> np.ndarray:
    # States lie within -1 and 1, so the clip binds for absurd weights only.
    e = np.exp(np.clip(x, -80, 80))
    e /= e.sum(-1, keepdims=True)
    return e


def gradients(m: Model, windows: np.ndarray, valid: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """The mean cross-entropy over all valid positions, and its gradients by backpropagation through time."""
    keep: list = []
    p = _softmax(_forward(m, windows, valid, keep))
    states = keep.pop()
    length, b, _ = p.shape
    hidden = m.state.shape[1]
    weight = valid.T[..., None] / max(1.0, float(valid.sum()))
    loss = float(-(np.log(p[:, np.arange(b), label] + 1e-9) * weight[..., 0]).sum())
    p[:, np.arange(b), label] -= 1
    d_logit = (p * weight).astype(np.float32)
    d_out = np.stack([np.einsum("lbh,lbc->hc", states[k], d_logit) for k in (0, 1)])
    d_bias = d_logit.sum((0, 1))
    d_embed, d_state = np.zeros_like(m.embed), np.zeros_like(m.state)
    to_state = m.out.transpose(0, 2, 1)
    carry = np.zeros((2, b, hidden), np.float32)
    every = np.empty((2, length, b, 3 * hidden), np.float32)
    for t in range(length - 1, -1, -1):
        s = length - 1 - t
        h, r, z, n, un, on = keep[t]
        d_h = (carry + np.stack((d_logit[t] @ to_state[0], d_logit[s] @ to_state[1]))) * on
        d_n = d_h * (1 - z) * (1 - np.abs(n)) ** 2
        d_z = d_h * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        d_r = d_n * un * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        d_x = np.concatenate((d_r, d_z, d_n), -1)
        d_u = np.concatenate((d_r, d_z, d_n * r), -1)
        d_state += h.transpose(0, 2, 1) @ d_u
        carry = d_h * z + d_u @ m.state.transpose(0, 2, 1)
        every[0, t], every[1, s] = d_x[0], d_x[1]
    flat = windows.T.ravel()
    order = np.argsort(flat, kind="stable")
    cut_at = np.flatnonzero(np.r_[True, np.diff(flat[order].astype(np.int64)) != 0])
    for k in (0, 1):
        d_embed[k][flat[order[cut_at]]] = np.add.reduceat(every[k].reshape(len(flat), -1)[order], cut_at, axis=0)
    return loss, [d_embed, d_state, d_out, d_bias]


def fit(texts: list[bytes], labels: list[str], steps: int = STEPS, seed: int = 7) -> Model:
    """Adam over random batches of windows. Without texts the model knows no language."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    shape = max(1, len(languages))
    m = Model(
        languages,
        rng.normal(0, 0.3, (2, 256, 3 * HIDDEN)).astype(np.float32),
        rng.normal(0, 0.3, (2, HIDDEN, 3 * HIDDEN)).astype(np.float32),
        rng.normal(0, 0.3, (2, HIDDEN, shape)).astype(np.float32),
        np.zeros(shape, np.float32),
    )
    rows, target = [], []
    for text, lang in zip(texts, labels, strict=True):
        step = max(1, -(-len(text) // WINDOW) // SAMPLE_WINDOWS)
        for at in range(0, len(text), step * WINDOW):
            rows.append(text[at : at + WINDOW])
            target.append(languages.index(lang))
    if len(languages) < 2 or not rows:
        return m
    windows = np.zeros((len(rows), WINDOW), np.uint8)
    valid = np.zeros((len(rows), WINDOW), np.float32)
    for i, row in enumerate(rows):
        windows[i, : len(row)] = np.frombuffer(row, np.uint8)
        valid[i, : len(row)] = 1
    label = np.array(target)
    groups = [np.flatnonzero(label == k) for k in range(len(languages))]
    weights = [m.embed, m.state, m.out, m.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(g, max(1, BATCH // len(groups))) for g in groups])
        _, grads = gradients(m, windows[chosen], valid[chosen], label[chosen])
        size = float(np.sqrt(sum((g.astype(np.float64) ** 2).sum() for g in grads)))
        rate = 0.03 * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, a, v in zip(weights, grads, first, second, strict=True):
            g = g * min(1.0, 1.0 / (size + 1e-9))
            a *= 0.9
            a += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            w -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return m


def pooled(m: Model, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mean probability of each language over each row's pooled positions; every byte of every row is read."""
    total = np.zeros((len(begin), len(m.bias)), np.float64)
    count = np.zeros(len(begin), np.float64)
    n_windows = -(-(end - begin) // WINDOW)
    row = np.repeat(np.arange(len(begin)), n_windows)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    at = begin[row] + nth * WINDOW
    size = np.minimum(end[row] - at, WINDOW)
    # Windows of like length step together, so short texts bring little padding.
    order = np.argsort(-size, kind="stable")
    for k in range(0, len(order), ABREAST):
        part = order[k : k + ABREAST]
        longest = int(size[part].max())
        place = at[part][:, None] + np.arange(longest)
        valid = np.arange(longest) < size[part][:, None]
        windows = data[np.minimum(place, len(data) - 1)]
        on = valid & POOLED[windows]
        p = _probabilities(m, windows, valid)
        p *= on.T[:, None, :]
        np.add.at(total, row[part], p.sum(0).T)
        np.add.at(count, row[part], on.sum(1))
    return total / np.maximum(count, 1)[:, None]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learns from text and language of about ``sample_docs`` documents of each language, chosen by a hash of the id among those
    whose crc32(id as text) mod 3 is not 1. Counts come from all documents; the sample that reaches the driver is bounded by
    ``sample_docs`` and ``LANGUAGES``. Rows with a null id, text or language teach nothing; with none left, no language is learned."""
    learn = docs.filter((F.crc32(F.col(id_col).cast("string")) % 3 != 1) & F.col(lang_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))
    counts = learn.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    draw = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1_000_003)) / 1_000_003.0
    # Of a long text, SAMPLE_WINDOWS evenly spaced windows are learnt from.
    step = F.greatest(F.lit(1), (F.length("t") / F.lit(SAMPLE_WINDOWS)).cast("int"))
    piece = F.array(*[F.substring(F.col("t"), F.lit(1) + step * k, F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)])
    rows = learn.join(counts, "lang").filter((draw < F.least(F.lit(1.0), 1.3 * sample_docs / F.col("n"))) & F.col("t").isNotNull()).select("id", "lang", F.array_distinct(piece).alias("pieces")).collect()
    seen: dict[str, int] = {}
    texts, labels = [], []
    for r in sorted(rows, key=lambda r: (r.id, r.lang, r.pieces)):
        seen[r.lang] = seen.get(r.lang, 0) + 1
        if seen[r.lang] <= sample_docs:
            texts += [p.encode()[:WINDOW] for p in r.pieces]
            labels += [r.lang] * len(r.pieces)
    return fit(texts, labels)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, from its whole text alone.

    ``und`` with score 0 where the text is null or has no letter, or where no language was learned. Repeated rows give repeated
    results; a null id is carried through and is not held out. Extra columns are ignored,
    but for those named in keep, which are carried through.
    """

    keep = keep or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            text = batch.column("t")
            data, begin, end = text_buffers(text)
            p = pooled(model, data, begin, end)
            best = p.argmax(1) if len(p) else np.zeros(0, np.int64)
            score = p[np.arange(len(p)), best].clip(0, 1)
            none = np.array([not model.languages or t is None or not has_letter(t) for t in map(pa.StringScalar.as_py, text)], bool)
            best[none], score[none] = len(model.languages), 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names[best], pa.string()), pa.array(score, pa.float64()), *map(batch.column, keep)],
                names=["doc_id", "held_out", "lang_pred", "score", *keep],
            )

    ready = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("t"),
        *keep,
    )
    schema = T.StructType([ready.schema["doc_id"], ready.schema["held_out"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), *(ready.schema[name] for name in keep)])
    return ready.mapInArrow(run, schema)


def language_id(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
