"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

The inputs of a word are an embedding of its hash, and the mean embedding and the strongest evidence of its character
n-grams, so unseen forms of a known stem are recognised. The network reads overlapping windows of words; a text scores as
its most toxic window. Labels are given for whole texts, so each epoch trains on the window of a text that scores highest
at the time.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import coded_words, gather, hash_strings, mix, release_memory, slices, string_bytes, texts
from tidemark.llm.language import word_ngrams

WINDOW, STRIDE = 64, 48
HIDDEN, WORD_DIM, CHAR_DIM = 8, 6, 6
WORD_BUCKETS, CHAR_BUCKETS = 1 << 14, 1 << 14
# Character n-grams: all of one size, and the first bytes of a word.
CHAR_SIZE, STARTS = 5, (3, 4, 5, 6, 7, 8)
# The network is fitted on at most about this many toxic and clean rows, texts of any length.
TRAIN_TOXIC, TRAIN_CLEAN = 800, 1600
FOLDS, EPOCHS, PASSES, BATCH, RATE = 4, 8, 2, 64, 0.02
# Small samples are passed over more often, up to this many steps an epoch; embeddings learn slower than the rest.
MIN_STEPS, EMBEDDING_RATE = 25, 0.1
# Weight of the prior in the log-odds, in texts; the tables whose first column they fill and training leaves alone.
PRIOR, FROZEN = 8.0, ("words", "chars")
THRESHOLD = 0.3
CHUNK_WINDOWS, CHUNK_WORDS = 2048, 1 << 15
# A scoring task works on this many bytes of texts at a time, and runs this many windows with the words they hold.
SCORE_BYTES, SCORE_WINDOWS = 1 << 20, 8192
EDGES = r"^[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+|[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+$"


def read_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Lower-cased words without punctuation at their ends."""
    offsets, codes, distinct = coded_words(pc.ascii_split_whitespace(pc.utf8_lower(column)))
    return offsets, codes, pc.replace_substring_regex(distinct, EDGES, "")


def word_parts(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the character n-grams of all words, their number per word): inner ones and those at a word's start."""
    grams, counts = word_ngrams(words, CHAR_BUCKETS, (CHAR_SIZE,))
    raw, offsets = string_bytes(words)
    flat, owner = [grams.astype(np.int32)], [np.repeat(np.arange(len(words), dtype=np.int32), counts)]
    codes, sizes = np.zeros(len(words), np.uint64), np.diff(offsets)
    for n in range(1, max(STARTS) + 1):
        longer = np.flatnonzero(sizes >= n)
        codes[longer] = codes[longer] * np.uint64(257) + raw[offsets[longer] + n - 1] + np.uint64(1)
        if n in STARTS:
            flat.append((mix(codes[longer] ^ np.uint64(n << 56)) % np.uint64(CHAR_BUCKETS)).astype(np.int32))
            owner.append(longer.astype(np.int32))
    flat, owner = np.concatenate(flat), np.concatenate(owner)
    return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


class Vocabulary:
    """The buckets of distinct words: one by the whole word, several by its character n-grams."""

    def __init__(self, words: pa.Array):
        self.word = (hash_strings(words) % np.uint64(WORD_BUCKETS)).astype(np.int64)
        self.grams, self.counts = word_parts(words)
        self.owner = np.repeat(np.arange(len(words), dtype=np.int32), self.counts)

    def inputs(self, net: Network) -> np.ndarray:
        """The input vector of every word; the last row, all zero, stands for padding."""
        chars = np.zeros((len(self.word), CHAR_DIM + 1), np.float32)
        ends = np.cumsum(self.counts)
        for at in range(0, len(self.word), CHUNK_WORDS):
            full = at + np.flatnonzero(self.counts[at : at + CHUNK_WORDS])
            if len(full):
                first, last = ends[full[0]] - self.counts[full[0]], ends[full[-1]]
                begins = ends[full] - self.counts[full] - first
                rows = net.chars[self.grams[first:last]]
                chars[full, :-1] = np.add.reduceat(rows, begins, axis=0) / self.counts[full][:, None]
                chars[full, -1] = np.maximum.reduceat(rows[:, 0], begins)
        x = np.hstack([net.words[self.word], chars])
        return np.vstack([x, np.zeros((1, x.shape[1]), np.float32)])


def word_inputs(words: pa.Array, net: Network) -> np.ndarray:
    """The input vector of every word, some words at a time: the n-grams of all words are never held at once."""
    parts = [
        Vocabulary(words.slice(at, CHUNK_WORDS)).inputs(net)[:-1] for at in range(0, len(words), CHUNK_WORDS)
    ]
    return np.concatenate(parts) if parts else np.zeros((0, WORD_DIM + CHAR_DIM + 1), np.float32)


def windows(offsets: np.ndarray, codes: np.ndarray, padding: int) -> tuple[np.ndarray, np.ndarray]:
    """(word codes of every window, row of the text of each). Windows start every STRIDE words; all words are covered."""
    sizes = np.diff(offsets)
    counts = np.where(sizes == 0, 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE)))
    text = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = (offsets[text] + nth * STRIDE)[:, None] + np.arange(WINDOW)
    inside = place < offsets[text + 1][:, None]
    return np.where(inside, codes[np.minimum(place, max(len(codes) - 1, 0))], padding), text


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def summed(places: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The rows added up by place."""
    return np.stack([np.bincount(places, column, size) for column in rows.T], axis=1).astype(np.float32)


class Network:
    """Embeddings, two gated recurrent cells, attention and an output unit."""

    NAMES = ("words", "chars", "wf", "uf", "bf", "wb", "ub", "bb", "attend", "out", "bias")

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        small = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        d = WORD_DIM + CHAR_DIM + 1
        self.words, self.chars = small(WORD_BUCKETS, WORD_DIM, s=0.02), small(CHAR_BUCKETS, CHAR_DIM, s=0.02)
        self.wf, self.wb = small(d, 3 * HIDDEN, s=0.4), small(d, 3 * HIDDEN, s=0.4)
        self.uf, self.ub = small(HIDDEN, 3 * HIDDEN, s=0.3), small(HIDDEN, 3 * HIDDEN, s=0.3)
        self.bf, self.bb = np.zeros(3 * HIDDEN, np.float32), np.zeros(3 * HIDDEN, np.float32)
        self.attend, self.out = small(2 * HIDDEN, s=0.3), small(2 * HIDDEN, s=0.3)
        self.bias = np.full(1, -1.0, np.float32)

    def gates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The share of all gates that depends on the word alone, for both directions."""
        return x @ self.wf + self.bf, x @ self.wb + self.bb

    def run(self, gates: np.ndarray, u: np.ndarray, ids: np.ndarray, real: np.ndarray, steps, tape=None) -> np.ndarray:
        """Hidden states (step x window x HIDDEN) of one direction; padding leaves the state as it is."""
        n, h = len(ids), np.zeros((len(ids), HIDDEN), np.float32)
        states = np.zeros((WINDOW, n, HIDDEN), np.float32)
        for t in steps:
            gx, gh = gates[ids[:, t]], h @ u
            rz = sigmoid(gx[:, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN])
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            new = np.tanh(gx[:, 2 * HIDDEN :] + r * gh[:, 2 * HIDDEN :])
            if tape is not None:
                tape.append((t, h, r, z, new, gh[:, 2 * HIDDEN :]))
            step = new + z * (h - new)
            h = step if real is None else np.where(real[:, t : t + 1], step, h)
            states[t] = h
        return states

    def pool(self, both: np.ndarray, real: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(logits, attention, pooled states)"""
        logit = both @ self.attend
        if real is not None:
            logit = np.where(real.T, logit, np.float32(-1e9))
        weight = np.exp(logit - logit.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, both)
        return pooled @ self.out + self.bias[0], weight, pooled

    def logits(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Logits of windows; ``x`` holds the inputs of all words, padding last."""
        forward, backward = self.gates(x)
        out = np.zeros(len(ids), np.float32)
        padded = ids[:, -1] == len(x) - 1
        for part, masked in ((np.flatnonzero(~padded), False), (np.flatnonzero(padded), True)):
            for at in range(0, len(part), CHUNK_WINDOWS):
                rows = part[at : at + CHUNK_WINDOWS]
                own = ids[rows]
                real = own < len(x) - 1 if masked else None
                states = (
                    self.run(forward, self.uf, own, real, range(WINDOW)),
                    self.run(backward, self.ub, own, real, range(WINDOW - 1, -1, -1)),
                )
                out[rows] = self.pool(np.concatenate(states, axis=2), real)[0]
        return out

    def gradients(self, vocabulary: Vocabulary, ids: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy of the windows, by back-propagation through time."""
        x, n = vocabulary.inputs(self), len(ids)
        real = ids < len(x) - 1
        forward, backward = self.gates(x)
        tapes = ([], [])
        states = (
            self.run(forward, self.uf, ids, real, range(WINDOW), tapes[0]),
            self.run(backward, self.ub, ids, real, range(WINDOW - 1, -1, -1), tapes[1]),
        )
        both = np.concatenate(states, axis=2)
        logit, weight, pooled = self.pool(both, real)
        error = (sigmoid(logit) - target) / n
        dpooled = error[:, None] * self.out
        dweight = np.einsum("nh,tnh->tn", dpooled, both)
        dlogit = weight * (dweight - (weight * dweight).sum(axis=0))
        dboth = weight[:, :, None] * dpooled + dlogit[:, :, None] * self.attend
        out = {
            "out": error @ pooled,
            "bias": np.array([error.sum()]),
            "attend": np.einsum("tn,tnh->h", dlogit, both),
        }
        dx = np.zeros_like(x)
        for name, tape, u, w, dstates in (
            ("f", tapes[0], self.uf, self.wf, dboth[:, :, :HIDDEN]),
            ("b", tapes[1], self.ub, self.wb, dboth[:, :, HIDDEN:]),
        ):
            du, inputs = np.zeros_like(u), []
            dh = np.zeros((n, HIDDEN), np.float32)
            for t, h, r, z, new, ghn in reversed(tape):
                dh = dh + dstates[t]
                on = real[:, t : t + 1]
                dstep = np.where(on, dh, 0)
                dn = dstep * (1 - z) * (1 - new * new)
                dz = dstep * (h - new) * z * (1 - z)
                dr = dn * ghn * r * (1 - r)
                dgh = np.hstack([dr, dz, dn * r])
                inputs.append((ids[:, t], np.hstack([dr, dz, dn])))
                du += h.T @ dgh
                dh = np.where(on, dstep * z, dh) + dgh @ u.T
            dgates = summed(np.concatenate([i for i, _ in inputs]), np.concatenate([g for _, g in inputs]), len(x))
            out["u" + name], out["w" + name], out["b" + name] = du, x.T @ dgates, dgates.sum(axis=0)
            dx += dgates @ w.T
        dx = dx[:-1]
        share = dx[:, WORD_DIM:-1] / np.maximum(vocabulary.counts, 1)[:, None]
        out["words"] = summed(vocabulary.word, dx[:, :WORD_DIM], WORD_BUCKETS)
        out["chars"] = summed(vocabulary.grams, share[vocabulary.owner], CHAR_BUCKETS)
        return out


def log_odds(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Shrunken log-odds of standing in a toxic text rather than a clean one, from both counts of texts."""
    n0, n1 = np.maximum(sizes, 1)
    odds = np.log((counts[1] + PRIOR * n1 / (n1 + n0)) / n1) - np.log((counts[0] + PRIOR * n0 / (n1 + n0)) / n0)
    return np.clip(odds, -3, 3).astype(np.float32)


class Odds:
    """Log-odds of all buckets, over all texts or without the texts of one fold."""

    def __init__(self, vocabulary: Vocabulary, offsets: np.ndarray, codes: np.ndarray, toxic: np.ndarray, part: np.ndarray):
        groups = part * 2 + toxic
        self.sizes = np.bincount(groups, minlength=2 * FOLDS).reshape(FOLDS, 2)
        self.tables = [np.zeros((2 * FOLDS, size), np.int64) for size in (WORD_BUCKETS, CHAR_BUCKETS)]
        spans = np.cumsum(vocabulary.counts) - vocabulary.counts
        for text, group in enumerate(groups.tolist()):
            words = np.unique(codes[offsets[text] : offsets[text + 1]])
            grams = vocabulary.grams[gather(spans[words], vocabulary.counts[words])]
            for table, buckets in zip(self.tables, (vocabulary.word[words], grams), strict=True):
                table[group, np.unique(buckets)] += 1

    def put(self, net: Network, without: int | None = None) -> None:
        """Set the first coordinate of every embedding."""
        used = [f for f in range(FOLDS) if f != without]
        sizes = self.sizes[used].sum(axis=0)
        for table, counts in zip((net.words, net.chars), self.tables, strict=True):
            table[:, 0] = log_odds(counts.reshape(FOLDS, 2, -1)[used].sum(axis=0), sizes)


def train(texts_: list[str], toxic: np.ndarray) -> Network:
    """A network fitted to texts with labels 0 and 1.

    One coordinate of every embedding holds log-odds. While the network learns on one fold of the texts they come from
    the other folds, so it learns how far they can be trusted on texts they have not seen; at the end all texts count.
    """
    net, rng = Network(), np.random.default_rng(5)
    offsets, codes, distinct = read_words(pa.array(texts_, pa.string()))
    vocabulary = Vocabulary(distinct)
    ids, owner = windows(offsets, codes, len(distinct))
    if not len(ids):
        return net
    part = rng.permutation(len(texts_)) % FOLDS
    odds = Odds(vocabulary, offsets, codes, toxic, part)
    moments = {k: (np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))) for k in Network.NAMES}
    step = 0
    for epoch in range(EPOCHS):
        odds.put(net, without=epoch % FOLDS)
        mine = np.flatnonzero(part[owner] == epoch % FOLDS)
        if not len(mine):
            continue
        x = vocabulary.inputs(net)
        scores = net.logits(x, ids[mine]) if epoch else (x[:, 0] + x[:, -1])[ids[mine]].max(axis=1)
        order = mine[np.lexsort((-scores, owner[mine]))]
        first = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
        extra = rng.choice(mine, min(len(mine), len(first) // 2), replace=False)
        chosen = np.concatenate([first, extra[toxic[owner[extra]] == 0]])
        for _ in range(max(PASSES, MIN_STEPS * BATCH // max(len(chosen), 1))):
            rng.shuffle(chosen)
            for at in range(0, len(chosen), BATCH):
                rows = chosen[at : at + BATCH]
                used, local = np.unique(ids[rows], return_inverse=True)
                small = Vocabulary(distinct.take(pa.array(used[used < len(distinct)])))
                gradient = net.gradients(small, local.reshape(ids[rows].shape), toxic[owner[rows]].astype(np.float32))
                step += 1
                for k, g in gradient.items():
                    if k in FROZEN:
                        g[:, 0] = 0
                    m, s = moments[k]
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    change = (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
                    rate = RATE * 0.75**epoch * (EMBEDDING_RATE if k in FROZEN else 1)
                    getattr(net, k)[...] -= np.float32(rate) * change.astype(np.float32)
    odds.put(net)
    return net


def fit(labelled: DataFrame, docs: DataFrame, key: str, text: str, label: str) -> Network | float:
    """Fit on texts whose key has a label, or give the share of toxic rows if only one class is there.

    The sample of keys is bounded by TRAIN_TOXIC and TRAIN_CLEAN, so it is broadcast to the texts and one task trains, on
    all windows of the drawn texts. A key with several labels counts as toxic if one of them says so.
    """
    rows = labelled.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    rows = rows.groupBy(F.col(key).alias("_key")).agg((F.max(label) > 0).cast("int").alias("_toxic"))
    counts = {r["_toxic"]: r["n"] for r in rows.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return float(bool(counts.get(1)))
    draw = F.pmod(F.xxhash64("_key", F.lit("toxicity")), F.lit(1_000_000))
    bound = {1: TRAIN_TOXIC, 0: TRAIN_CLEAN}
    taken = [
        (F.col("_toxic") == c) & (draw < int(1_000_000 * min(1.0, bound[c] / counts[c])) + 1) for c in (0, 1)
    ]
    sample = rows.where(taken[0] | taken[1])
    found = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    held = found.join(F.broadcast(sample), "_key").repartition(1)
    rows = held.mapInPandas(learn, "share double, net binary").collect()
    if not rows or not rows[0]["net"]:
        return rows[0]["share"] if rows else 0.0
    row = rows[0]
    net = Network()
    net.__dict__.update(pickle.loads(row["net"]))
    return net


def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One task trains on the whole sample: the network, or the share of toxic rows if only one class has texts."""
    parts = [f for f in frames if len(f)]
    frame = pd.concat(parts).sort_values(["_key", "_text"]) if parts else pd.DataFrame({"_toxic": [0]})
    if frame["_toxic"].nunique() < 2:
        yield pd.DataFrame({"share": [float(frame["_toxic"].max())], "net": [None]})
    else:
        net = train(frame["_text"].tolist(), frame["_toxic"].to_numpy(np.int64))
        del frame, parts
        release_memory()
        yield pd.DataFrame({"share": [np.nan], "net": [pickle.dumps(net.__dict__)]})


def score_texts(column: pa.Array, net: Network | float) -> np.ndarray:
    """The highest window score of every text; a text without words scores 0."""
    if isinstance(net, float):
        return np.full(len(column), net)
    offsets, codes, distinct = read_words(column)
    ids, owner = windows(offsets, codes.astype(np.int32), np.int32(len(distinct)))
    out, x = np.zeros(len(column)), word_inputs(distinct, net)
    place = np.empty(len(distinct) + 1, np.int32)
    for at in range(0, len(ids), SCORE_WINDOWS):
        # The gates are computed for the words of these windows only; the last row is padding.
        own = ids[at : at + SCORE_WINDOWS]
        held = np.zeros(len(distinct), bool)
        held[own[own < len(distinct)]] = True
        used = np.flatnonzero(held)
        place[used], place[-1] = np.arange(len(used)), len(used)
        found = net.logits(np.concatenate([x[used], np.zeros((1, x.shape[1]), np.float32)]), place[own])
        np.maximum.at(out, owner[at : at + SCORE_WINDOWS], 1 / (1 + np.exp(-found.astype(np.float64))))
    return out


def with_score(df: DataFrame, text: str, net: Network | float, name: str = "score") -> DataFrame:
    """``df`` with the score of every whole text; a NULL text scores like an empty one.

    Repeated rows score alike. An empty table stays empty. Extra columns are kept; one called ``name`` is replaced.
    """

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            batch = pa.RecordBatch.from_arrays([part], names=["text"])
            found = [score_texts(texts(s, "text"), net) for s in slices(batch, "text", SCORE_BYTES)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0))
        release_memory()

    return df.withColumn(name, score(F.col(text)))
