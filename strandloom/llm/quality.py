"""A byte-level convolutional quality classifier in numpy.

A text is cut into overlapping chunks that cover all of it. Bytes are embedded, learned filters slide over each chunk,
their responses are max-pooled per chunk and pass a small hidden layer to a chunk's log-odds; the mean of these over
the chunks, scaled, gives one probability. The network is fitted on a bounded sample of labelled texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, fold, pick, place, slices
from .sampling import bounded, classes, spread

#: Bytes of a chunk, from one chunk to the next, numbers per byte, bytes a filter sees, from one place to the next, filters, hidden units.
CHUNK, STEP, DIM, WIDTH, STRIDE, FILTERS, HIDDEN = 512, 447, 8, 8, 2, 64, 24
#: Chunks that pass the network at a time.
AT_ONCE = 256


def chunks(text: bytes) -> np.ndarray:
    """Rows of CHUNK bytes that cover the text, the last one padded with zeros; one row of zeros for an empty text."""
    n = max(1, -(-(len(text) - (CHUNK - STEP)) // STEP))
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


class Network:
    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "embed": normal(256, DIM, scale=0.5), "filters": normal(WIDTH * DIM, FILTERS, scale=(WIDTH * DIM) ** -0.5), "shift": np.zeros(FILTERS, np.float32),
            "hidden": normal(FILTERS + 2, HIDDEN, scale=FILTERS**-0.5), "hidden_shift": np.zeros(HIDDEN, np.float32), "out": normal(HIDDEN, scale=HIDDEN**-0.5), "out_shift": np.zeros(1, np.float32),
        }
        self.p["embed"][0] = 0  # padding
        self.scale = np.array([1.0, 0.0])

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """(chunks, places, WIDTH * DIM) of embedded bytes."""
        x = self.p["embed"][rows].reshape(len(rows), CHUNK * DIM)
        return np.lib.stride_tricks.sliding_window_view(x, WIDTH * DIM, axis=1)[:, :: STRIDE * DIM]

    def forward(self, rows: np.ndarray) -> tuple:
        """Products are taken chunk by chunk: the last bits of a larger one depend on its shape, and with them a chunk's
        answer would depend on the chunks beside it."""
        x = np.ascontiguousarray(self.windows(rows))
        y = x @ self.p["filters"]
        top = y.max(1)
        # beside the pooled answers, how full the chunk is: few places give low maxima
        full = (rows != 0).sum(1, dtype=np.float32)[:, None] / CHUNK
        pooled = np.concatenate([np.maximum(top + self.p["shift"], 0), full, np.sqrt(full)], axis=1)
        hidden = np.tanh((pooled[:, None] @ self.p["hidden"])[:, 0] + self.p["hidden_shift"])
        return x, y, top, pooled, hidden, (hidden * self.p["out"]).sum(1) + self.p["out_shift"]

    def odds(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(rows[k : k + AT_ONCE])[-1] for k in range(0, len(rows), AT_ONCE)])

    def fit(self, rows: np.ndarray, goal: np.ndarray, weight: np.ndarray, epochs: int = 8, rate: float = 3e-3, seed: int = 5) -> None:
        rng, m, v, t = np.random.default_rng(seed), {}, {}, 0
        steps = epochs * -(-len(rows) // 128)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for k in range(0, len(order), 128):
                own = order[k : k + 128]
                few = rows[own].copy()
                # a third of the chunks are cut to a random length, so that short texts are learned too
                for i in np.flatnonzero(rng.random(len(own)) < 0.33):
                    few[i, int(8 * (CHUNK / 8) ** rng.random()) :] = 0
                x, y, top, pooled, hidden, z = self.forward(few)
                slope = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - goal[own]) * weight[own] / len(own)).astype(np.float32)
                back = np.outer(slope, self.p["out"]) * (1 - hidden**2)
                up = (back @ self.p["hidden"][:FILTERS].T) * (pooled[:, :FILTERS] > 0)
                at = y.argmax(1)  # where each filter answered most: only there does a gradient go
                seen = x[np.arange(len(own))[:, None], at]  # chunks, filters, WIDTH * DIM
                g = {"out": hidden.T @ slope, "out_shift": slope.sum(keepdims=True), "hidden": pooled.T @ back, "hidden_shift": back.sum(0), "shift": up.sum(0), "filters": np.einsum("cf,cfx->xf", up, seen)}
                per_byte = (up[:, :, None] * self.p["filters"].T).reshape(len(own), FILTERS, WIDTH, DIM)
                byte = few[np.arange(len(own))[:, None, None], (at * STRIDE)[:, :, None] + np.arange(WIDTH)]
                g["embed"] = np.stack([np.bincount(byte.ravel(), per_byte[..., d].ravel(), 256) for d in range(DIM)], axis=1).astype(np.float32)
                g["embed"][0] = 0
                t += 1
                now = rate * (1 - 0.9 * t / steps)
                for name, grad in g.items():
                    m[name] = m.get(name, 0) * 0.9 + 0.1 * grad
                    v[name] = v.get(name, 0) * 0.99 + 0.01 * grad * grad
                    self.p[name] = (self.p[name] - now * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)

    def calibrate(self, mean_odds: np.ndarray, goal: np.ndarray, weight: np.ndarray) -> None:
        """Scale and shift of a document's mean log-odds, by logistic regression; the scale stays positive."""
        a, b = 1.0, 0.0
        for _ in range(300):
            p = 1 / (1 + np.exp(-np.clip(a * mean_odds + b, -30, 30)))
            d = (p - goal) * weight
            a, b = max(0.1, a - 0.5 * ((d * mean_odds).mean() + 0.01 * (a - 1))), b - 0.5 * d.mean()
        self.scale = np.array([a, b])

    def probability(self, mean_odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * mean_odds + self.scale[1], -30, 30)))


def mean_odds(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean log-odds of all chunks of each text."""
    out, rows, counts = [], [], []
    for t in texts:
        rows.append(chunks(t))
        counts.append(len(rows[-1]))
        if sum(map(len, rows)) >= 4 * AT_ONCE:
            out.append(net.odds(np.concatenate(rows)))
            rows = []
    if rows:
        out.append(net.odds(np.concatenate(rows)))
    ends = np.cumsum(counts)
    return np.add.reduceat(np.concatenate(out).astype(np.float64), ends - counts) / counts


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = 4000, max_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Network:
    """Fits on at most ``max_rows`` labelled texts, as many of either label, with all chunks of each.

    Texts are taken in the order of their ids' hashes as long as they fit into ``max_bytes`` for each label, which
    bounds what the driver holds; one that does not fit is passed over whole. Of rows with one id one is taken. Labels other than 0 and 1 are left out; of several labels of a text the largest counts. Without both labels the
    score is that of an untrained network pulled to the only label, or 0.5 without any.
    """
    marks = pick(labels, **{id_col: "bigint", label_col: "int"}).filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marks = marks.groupBy(id_col).agg(F.max(label_col).alias(label_col))
    each = max_rows // 2
    spark, net = documents.sparkSession, Network()
    rows = pick(documents, **{id_col: "bigint", text_col: "string"}).withColumn("bytes", F.coalesce(F.octet_length(text_col), F.lit(0)))
    # twice as many, for labels without a text and texts that are passed over
    marked = spread(marks, id_col, label_col, classes(marks, label_col), 2 * each).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_goal"))
    sizes = rows.join(F.broadcast(marked), rows[id_col] == marked["_id"]).groupBy(id_col, "_goal").agg(F.min(F.struct("bytes", F.xxhash64(text_col).alias("h"))).alias("of"))
    sizes = sizes.orderBy(F.xxhash64(F.lit("order"), id_col)).limit(8 * each).collect()
    room, left, chosen = {0: max_bytes, 1: max_bytes}, {0: each, 1: each}, []
    for r in sizes:
        goal, size = r["_goal"], r["of"]["bytes"]
        if left[goal] and size <= room[goal]:
            room[goal] -= size
            left[goal] -= 1
            chosen.append((r[id_col], goal, r["of"]["h"]))
    if not chosen:
        return net
    few = spark.createDataFrame(chosen, "id bigint, goal int, h bigint")  # max_rows rows at most
    rows = rows.join(F.broadcast(few), (F.col(id_col) == F.col("id")) & (F.xxhash64(text_col) == F.col("h"))).select("id", text_col, "goal").dropDuplicates(["id"])

    def make():
        def each_batch(batch: pa.RecordBatch):
            at, data = slices(batch.column(1))
            kept = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                kept.append(chunks(bytes(data[a:b])).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(kept, pa.binary())], names=["id", "goal", "rows"])

        return each_batch

    found = bounded(arrow_map(rows, make, "id bigint, goal int, rows binary").collect(), 1, each)
    if not found:
        return net
    own = [np.frombuffer(r["rows"], np.uint8).reshape(-1, CHUNK) for r in found]
    goal = np.array([r["goal"] for r in found], np.float32)
    share = (len(goal) / 2 / np.bincount(goal.astype(int), minlength=2).clip(1))[goal.astype(int)].astype(np.float32)
    n = np.array([len(x) for x in own])
    rows, of = np.concatenate(own), np.repeat(np.arange(len(own)), n)
    per_chunk = share[of] / n[of]
    net.fit(rows, goal[of], per_chunk / per_chunk.mean())
    net.calibrate(np.add.reduceat(net.odds(rows), np.cumsum(n) - n) / n, goal, share)
    return net


def score(df: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """One row per input row: id (or with ``keep`` all columns as struct ``row``, by position) and score (0 to 1).

    Null and empty texts score as one empty chunk; texts of any length are read to their end; repeated rows stay
    repeated; null ids stay null; an empty table gives an empty one; other columns are left out.
    """
    plain = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    at_row = place(df, text_col) if keep else None
    if keep:  # the text is read out of the row, so it is sent once
        rows = plain.withColumn(f"_c{at_row}", F.col(f"_c{at_row}").cast("string")).select(F.struct("*").alias("row"))
    else:
        rows = pick(df, **{id_col: "bigint", text_col: "string"}).toDF("row", "text")
    sent = df.sparkSession.sparkContext.broadcast(net)

    def make():
        def each(batch: pa.RecordBatch):
            at, data = slices(batch.column(0).field(at_row) if keep else batch.column(1))
            odds = mean_odds(sent.value, [bytes(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sent.value.probability(odds))], names=["row", "score"])

        return each

    scored = arrow_map(rows, make, f"row {rows.schema['row'].dataType.simpleString()}, score double")
    return scored if keep else scored.withColumnRenamed("row", id_col)


def held_out(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from labels outside fold 1 of 3 and scores all documents: doc_id, held_out, score, predicted."""
    rows, marks = pick(documents, doc_id="bigint", text="string"), pick(labels, doc_id="bigint", quality="int")
    return score(rows, fit(rows, marks.filter(fold("doc_id", 3) != 1))).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good(df: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, all columns, that score at least ``least``."""
    rows = score(df, net, id_col, text_col, keep=True).filter(F.col("score") >= least)
    return rows.select(*(F.col("row")[f"_c{i}"].alias(c) for i, c in enumerate(df.columns)))
