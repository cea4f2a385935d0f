"""Language of whole texts by averaged embeddings of hashed subwords and a linear softmax.

Each pair and triple of neighbouring characters of a word, its ends included, is hashed into one of
BUCKETS rows. A text is the mean of the rows of its subwords; a linear layer and a softmax
give the languages' shares. Both are trained together by stochastic gradient descent in
numpy, on a bounded sample: about SAMPLE_PER_LANG labelled rows of each language, and SAMPLE_ROWS in all. A
part of the sample sets the temperature of the softmax, so that scores are probabilities,
and the score below which a prediction counts as rejected.

A null text and one without a letter are `und` with score 0. Rows with a null language teach nothing;
without any labelled row every text is `und`. Texts of any length are read whole. Ties go to the
language that sorts first. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.llm.common import column, crc_bucket

BUCKETS, DIMENSIONS = 1 << 15, 16
ORDERS = (2, 3)
SAMPLE_PER_LANG = 1_500
SAMPLE_ROWS = 300_000  # of all languages; with very many, fewer rows of each are learned, but no language is left out
FOLDS, HELD_OUT = 4, 2
EPOCHS, BATCH, RATE = 6, 32, 0.5
CALIBRATION_SHARE = 0.2
PRECISION = 0.99  # of accepted predictions in the calibration part
PIECE = 1 << 20  # characters that are hashed at once; a longer text is one piece
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_LETTERS = np.frompyfunc(lambda c: chr(c).isalpha(), 1, 1)(
    [c for c in range(0x10000) if not 0xD800 <= c < 0xE000]
).astype(bool)
_IS_LETTER = np.concatenate([_LETTERS[:0xD800], np.zeros(0x800, bool), _LETTERS[0xD800:]])


def subwords(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order: rows of all subwords of the texts, and the bounds of each text among them."""
    lowered = [t.lower() for t in texts]  # may lengthen a text, so bounds are taken after it
    points = np.frombuffer(
        " ".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32
    )
    letter = _IS_LETTER[np.minimum(points, 0xFFFF)] | (points > 0xFFFF)
    codes = np.where(letter, points, np.uint32(32)).astype(np.uint64)
    bounds = np.cumsum([0] + [len(t) + 1 for t in lowered])
    found = []
    for order in ORDERS:
        n = len(codes) - order + 1
        gram = codes[:n] + np.uint64(order)
        for i in range(1, order):
            gram = gram * np.uint64(0x100000001B3) + codes[i : i + n]
        # An end of a word may be in it, but not the ends of two.
        inside = letter[1 : 1 + n] if order > 2 else letter[:n] & letter[1 : 1 + n]
        keep = np.flatnonzero(inside)
        gram = (gram[keep] ^ (gram[keep] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        found.append(((gram >> np.uint64(40)).astype(np.int64) % BUCKETS, np.searchsorted(keep, bounds)))
    return found


def histogram(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a text's subwords and how often each occurs."""
    return np.unique(np.concatenate([rows for rows, _ in subwords([text])]), return_counts=True)


def _pieces(texts: list[str]) -> Iterator[list[str]]:
    piece, size = [], 0
    for text in texts:
        if piece and size + len(text) > PIECE:
            yield piece
            piece, size = [], 0
        piece.append(text)
        size += len(text)
    if piece:
        yield piece


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


@dataclass
class Model:
    """Languages, one row of class weights per bucket, and what calibration found."""

    langs: list[str] = field(default_factory=list)
    table: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0
    least_score: float = 0.0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and scores."""
        langs, scores = [], []
        for piece in _pieces([t or "" for t in texts]):
            totals, counts = np.zeros((len(piece), len(self.langs))), np.zeros(len(piece))
            for rows, bounds in subwords(piece):
                sums = np.zeros((len(rows) + 1, len(self.langs)))
                np.cumsum(self.table[rows], axis=0, out=sums[1:])
                totals += sums[bounds[1:]] - sums[bounds[:-1]]
                counts += np.diff(bounds)
            means = totals / np.maximum(1, counts)[:, None]
            known = [bool(self.langs) and bool(_LETTER.search(t)) for t in piece]
            if not self.langs:
                langs += [UNKNOWN] * len(piece)
                scores += [0.0] * len(piece)
                continue
            share = _softmax((means + self.bias) / self.temperature)
            best = share.argmax(axis=1)
            langs += [self.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            scores += np.where(known, share.max(axis=1), 0.0).tolist()
        return langs, np.array(scores, dtype=float)


def _dense(samples: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The rows that occur in the samples, and each sample's shares of them."""
    used, at = np.unique(np.concatenate([rows for rows, _ in samples]), return_inverse=True)
    out = np.zeros((len(samples), len(used)), dtype=np.float32)
    owner = np.repeat(np.arange(len(samples)), [len(rows) for rows, _ in samples])
    out[owner, at] = np.concatenate([counts / max(1, counts.sum()) for _, counts in samples])
    return used, out


def fit(samples: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, langs: list[str]) -> Model:
    """Stochastic gradient descent on mean log loss; samples: (rows, counts) per text."""
    random = np.random.default_rng(7)
    order = random.permutation(len(samples))
    held = order[: int(len(order) * CALIBRATION_SHARE)]
    taught = order[len(held) :]
    embedding = random.normal(0, 1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, len(langs)), dtype=np.float32)
    bias = np.zeros(len(langs), dtype=np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        taught = random.permutation(taught)
        for at in range(0, len(taught), BATCH):
            part = taught[at : at + BATCH]
            used, x = _dense([samples[i] for i in part])
            hidden = x @ embedding[used]
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(part)), targets[part]] -= 1
            error /= len(part)
            back = error @ weights.T
            weights -= rate * 10 * (hidden.T @ error)
            bias -= rate * error.sum(axis=0)
            embedding[used] -= rate * 100 * (x.T @ back)
    model = Model(langs, embedding @ weights, bias.astype(float))
    if len(held):
        parts = [_dense([samples[i] for i in held[a : a + 64]]) for a in range(0, len(held), 64)]
        logits = np.concatenate([x @ model.table[used] for used, x in parts]) + model.bias
        model.temperature, model.least_score = calibrated(logits, targets[held])
    return model


def calibrated(logits: np.ndarray, targets: np.ndarray) -> tuple[float, float]:
    """The temperature of the least log loss, and the least score from which on the accepted
    predictions have the wanted precision."""
    rows = np.arange(len(targets))
    losses = {
        t: -np.log(np.maximum(_softmax(logits / t)[rows, targets], 1e-12)).mean()
        for t in np.geomspace(0.05, 20, 61)
    }
    best = float(min(losses, key=losses.get))
    share = _softmax(logits / best)
    score, right = share.max(axis=1), share.argmax(axis=1) == targets
    order = np.argsort(-score, kind="stable")
    precision = np.cumsum(right[order]) / (rows + 1)
    good = np.flatnonzero(precision >= PRECISION)
    return best, float(score[order][good[-1]]) if len(good) else 1.0


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """A model from the labelled rows outside the held-out fold."""
    rows = docs.select(
        column(docs, id_col).alias("id"),
        column(docs, text_col).alias("text"),
        column(docs, lang_col).cast("string").alias("lang"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.where(crc_bucket(F.col("id"), FOLDS) != HELD_OUT)
    counts = {
        r.lang: r.n
        for r in rows.groupBy("lang")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    if not counts:
        return Model()
    lot = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    each = min(SAMPLE_PER_LANG, max(1, SAMPLE_ROWS // len(counts)))
    rate = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, each / n)])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [histogram(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "lang": batch["lang"],
                    "rows": [r.astype("int32") for r, _ in found],
                    "counts": [c.astype("int32") for _, c in found],
                }
            )

    sample = (
        rows.where(lot < rate[F.col("lang")])
        .select("lang", "text")
        .mapInPandas(counted, "lang string, rows array<int>, counts array<int>")
        .collect()
    )
    langs = sorted({r.lang for r in sample})
    if not langs:
        return Model()
    targets = np.array([langs.index(r.lang) for r in sample])
    return fit([(np.array(r.rows, int), np.array(r.counts, float)) for r in sample], targets, langs)


def identify(model: Model, text: Column) -> Column:
    """A struct of lang, score and accepted for a text."""

    @F.pandas_udf("lang string, score double, accepted boolean")
    def identified(texts: pd.Series) -> pd.DataFrame:
        langs, scores = model.predict(texts.tolist())
        accepted = [x != UNKNOWN and s >= model.least_score for x, s in zip(langs, scores, strict=True)]
        return pd.DataFrame(
            {"lang": pd.Series(langs, dtype=object), "score": scores, "accepted": pd.Series(accepted, dtype=bool)}
        )

    return identified(text)
