"""Language identification with error-correcting output codes over character n-grams.

Every language has a codeword; one binary n-gram classifier predicts each bit of it. A text goes to the codeword with the
smallest weighted loss against the real-valued margins, so several wrong bits are outvoted. The weight of a bit for a
language is how often its classifier is right on texts of that language that it was not fitted on. A small distance to the
runner-up flags the text as ambiguous.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import coded_words, gather, mix, slices, string_bytes, texts

BUCKETS = 1 << 12
SIZES = (1, 2, 3, 4)
# The classifiers are fitted on at most about this many rows, spread evenly over the languages. Bound of the sample only.
TRAIN_ROWS = 4000
STEPS = 200
MAX_EXHAUSTIVE = 7
# One in so many of the learning rows is kept from a first fit, to weigh its bits; the final fit uses them too.
WEIGHING = 5
# A text whose best language leads the second by less, in shares that add up to 1, is ambiguous.
LEAST_LEAD = 0.5
UNKNOWN = "und"

# Everything in ASCII that is not a letter.
NOT_LETTERS = r"[\x00-\x40\x5b-\x60\x7b-\x7f]+"


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """One row of -1/+1 per class: the exhaustive code for few classes, else the best of random codes."""
    if classes < 2:
        return np.ones((classes, 1))
    if classes <= MAX_EXHAUSTIVE:
        columns = np.arange(1, 1 << (classes - 1))
        bits = (columns[None, :] >> np.arange(classes - 1)[:, None]) & 1
        return np.vstack([np.ones(len(columns)), 1 - 2 * bits]).astype(float)
    rng = np.random.default_rng(seed)
    width, best, far = 10 * int(np.ceil(np.log2(classes))), None, -1.0
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (classes, width))
        apart = float(((width - code @ code.T) / 2 + width * np.eye(classes)).min())
        if apart > far:
            best, far = code, apart
    return best


def word_ngrams(words: pa.Array, buckets: int = BUCKETS, sizes=SIZES) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the byte n-grams of all words, number of n-grams of each); words are marked at both ends."""
    marked = pc.binary_join_element_wise("\x02", words, "\x03", "")
    raw, offsets = string_bytes(marked)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    word = np.repeat(np.arange(len(words)), np.diff(offsets))
    place = np.arange(len(raw))
    codes, found, owner = np.zeros(len(raw), np.uint64), [], []
    for n in range(1, max(sizes) + 1):
        reach = np.minimum(place + n - 1, max(len(raw) - 1, 0))
        codes = codes * np.uint64(257) + raw[reach] + np.uint64(1)
        if n in sizes:
            inside = place + n <= ends
            found.append((mix(codes[inside] + np.uint64(n << 40)) % np.uint64(buckets)).astype(np.int64))
            owner.append(word[inside])
    flat, owners = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return flat[order], np.bincount(owners, minlength=len(words))


def text_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Lower-cased words of the texts, their ASCII letters and all that is not ASCII."""
    offsets, codes, distinct = coded_words(pc.ascii_split_whitespace(pc.utf8_lower(column)))
    return offsets, codes, pc.replace_substring_regex(distinct, NOT_LETTERS, "")


@dataclass
class Model:
    """Languages, their codewords, one weight per bucket and bit, and the trust in every bit of a language."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, confidence, lead over the second class) of every row of margins."""
        losses = (self.trust[None] * np.logaddexp(0, -margins[:, None, :] * self.code[None])).sum(axis=2)
        share = np.exp(-(losses - losses.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        ordered = np.sort(share, axis=1)
        lead = ordered[:, -1] - (ordered[:, -2] if share.shape[1] > 1 else 0)
        return share.argmax(axis=1), ordered[:, -1], lead


def margins(column: pa.Array, model: Model) -> np.ndarray:
    """Margins of all bits for every text: the mean weight of its n-grams. Distinct words are weighed once."""
    offsets, codes, distinct = text_words(column)
    out = np.tile(model.bias, (len(column), 1))
    if not len(codes):
        return out
    grams, counts = word_ngrams(distinct)
    real = pc.binary_length(distinct).to_numpy(zero_copy_only=False) > 0
    begins = np.cumsum(counts) - counts
    sums = np.add.reduceat(model.weights[grams], begins, axis=0) * real[:, None]
    text = np.repeat(np.arange(len(column)), np.diff(offsets))
    total = np.bincount(text, weights=(counts * real)[codes], minlength=len(column))
    for bit in range(sums.shape[1]):
        held = np.bincount(text, weights=sums[codes, bit], minlength=len(column))
        out[:, bit] += held / np.maximum(total, 1)
    return out


def profiles(df: DataFrame, text: str, label: str) -> DataFrame:
    """(label, profile): relative n-gram frequencies of every text as 32-bit floats."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                offsets, codes, distinct = text_words(texts(part, text))
                grams, counts = word_ngrams(distinct)
                begins = np.cumsum(counts) - counts
                real = pc.binary_length(distinct).to_numpy(zero_copy_only=False) > 0
                rows = []
                for i in range(len(part)):
                    own = codes[offsets[i] : offsets[i + 1]]
                    own = own[real[own]]
                    flat = grams[gather(begins[own], counts[own])]
                    seen = np.bincount(flat, minlength=BUCKETS) / max(len(flat), 1)
                    rows.append(seen.astype(np.float32).tobytes())
                columns = [part.column(label), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "profile"])

    return df.select(F.col(label).cast("string").alias(label), text).mapInArrow(profile, "label string, profile binary")


def fit(df: DataFrame, key: str, text: str, label: str) -> Model | None:
    """Fit on rows with a label and a text: all of them up to TRAIN_ROWS, else a sample by hash of the key.

    None if there is no such row. Counting the languages assumes that their names fit the driver.
    """
    labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    counts = {r[label]: r["n"] for r in labelled.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    wanted = TRAIN_ROWS / len(languages)
    draw = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1_000_000))
    taken = F.lit(False)
    for name in languages:
        taken |= (F.col(label) == name) & (draw < int(1_000_000 * min(1.0, wanted / counts[name])) + 1)
    rows = profiles(labelled.where(taken), text, label).toPandas()
    if rows.empty:
        return None
    x = np.frombuffer(b"".join(rows["profile"]), np.float32).reshape(len(rows), BUCKETS)
    y = np.array([languages.index(v) for v in rows["label"]])
    return train(x, y, languages)


def train(x: np.ndarray, y: np.ndarray, languages: list[str]) -> Model:
    """Classifiers of all rows, with the trust that those of most rows earn on the rest.

    Which rows are the rest depends on their profiles alone, not on their order.
    """
    code = codewords(len(languages))
    apart = np.array([zlib.crc32(row.tobytes()) % WEIGHING == 0 for row in x])
    trust = np.ones(code.shape)
    if apart.any() and len(set(y[~apart])) == len(languages):
        weights, bias = regressions(x[~apart], y[~apart], code)
        trust = bit_trust(x[apart] @ weights + bias, y[apart], code)
    return Model(languages, code, *regressions(x, y, code), trust)


def bit_trust(margins: np.ndarray, y: np.ndarray, code: np.ndarray) -> np.ndarray:
    """How often every bit is right on the rows of every class, with a mean of 1 per class; all 1 without such rows.

    One right and one wrong row are added to each count, so few rows weigh little.
    """
    trust = np.ones(code.shape)
    for c in range(len(code)):
        own = margins[y == c]
        right = ((own * code[c] > 0).sum(axis=0) + 1) / (len(own) + 2)
        trust[c] = right / right.mean()
    return trust


def regressions(x: np.ndarray, y: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of logistic regressions for all bits at once, by Adam on standardised profiles."""
    scale = 1 / (x.std(axis=0) + 1e-4)
    centre = x.mean(axis=0)
    z = (x - centre) * scale
    target = code[y]
    share = np.bincount(y, minlength=len(code))[y]
    row = (1 / share / len(code))[:, None]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1])
    moment, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        slope = -target * row / (1 + np.exp(np.clip(target * (z @ w + b), -30, 30)))
        grad = z.T @ slope.astype(np.float32) + 1e-4 * w
        moment = 0.9 * moment + 0.1 * grad
        square = 0.999 * square + 0.001 * grad * grad
        w -= 0.01 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        b -= 0.5 * slope.sum(axis=0)
    weights = w * scale[:, None]
    return weights.astype(np.float64), b - centre @ weights


def predict(df: DataFrame, text: str, model: Model | None, keep: list[Column], kept: str) -> DataFrame:
    """``keep`` columns with lang_pred, score (0 to 1), lead (over the second language) and ambiguous (lead too small).

    A NULL text or one without a letter is ``und`` with score and lead 0, and ambiguous. With no model all are ``und``.
    Repeated rows are predicted alike, an empty table gives no rows, and columns that are not kept are not looked at,
    whatever their names.
    """
    names = [f.strip().split(" ")[0] for f in kept.split(",")]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                letter = part.column("_letter").to_numpy(zero_copy_only=False)
                if model is None:
                    best, sure, lead = np.full(len(part), UNKNOWN), np.zeros(len(part)), np.zeros(len(part))
                else:
                    place, sure, lead = model.decode(margins(texts(part, "_text"), model))
                    best = np.where(letter, np.array(model.languages, object)[place], UNKNOWN)
                    sure, lead = np.where(letter, sure, 0.0), np.where(letter, lead, 0.0)
                columns = [part.column(n) for n in names]
                columns += [pa.array(best.tolist(), pa.string()), pa.array(sure), pa.array(lead)]
                columns.append(pa.array(lead < LEAST_LEAD))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score", "lead", "ambiguous"])

    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = df.select(*keep, F.col(text).alias("_text"), letter.alias("_letter"))
    return rows.mapInArrow(decide, f"{kept}, lang_pred string, score double, lead double, ambiguous boolean")
