"""Compression classifier: zstandard dictionaries of good and bad text against each other.

A text is compressed with a dictionary trained on good labelled text and with one trained on bad
text; the difference of the two sizes over the larger one says which kind it resembles. This is done for
two views of the whole text: the bytes themselves and their shape (words reduced to letter case and
punctuation, a repeated word to one mark). A logistic curve, fitted on labelled rows that the
dictionaries have not seen, turns the differences into a probability of the good label.

Labelled rows are a bounded sample (``per_label`` rows of each label, chosen by a hash of their text, texts of
at most ``sample_bytes``); scoring covers every row and whole texts. NULL and empty texts have
differences of zero and get the curve's value there. Without rows of both labels every score is the
share of good labels (0.5 without labels). Repeated rows are scored one by one.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .base import arrow_map, held, share, text_chunks
from .sampling import fitted_on_sample

PER_LABEL = 4000
SAMPLE_BYTES = 200_000
PIECE = 4096

# Each view: level and dictionary size.
RAW, SHAPE = (3, 112_640), (9, 32_768)

_CLASSES = bytes(
    ord("A") if 65 <= i < 91 else ord("9") if 48 <= i < 58 else ord("a") if 97 <= i < 123 or i >= 128 else i
    for i in range(256)
)
_RUN = re.compile(rb"(?<![^ \n])([^ \n]+)(?:[ \n]\1(?![^ \n]))+")
_LOWER, _UPPER = re.compile(rb"a+"), re.compile(rb"A+")


def shape(text: bytes) -> bytes:
    """Letters as runs of one class, digits as 9, a run of one word as its first word and a mark of its length."""
    runs = _UPPER.sub(b"A", _RUN.sub(_marked, text).translate(_CLASSES))
    return _LOWER.sub(b"a", runs).replace(b"a ", b"a").replace(b"Aa", b"B")


def _marked(run: re.Match) -> bytes:
    word = run.group(1)
    return word + b" " + b"=" * (len(run.group()) // (len(word) + 1)).bit_length() + b" "


@dataclass
class Model:
    dictionaries: tuple[bytes, bytes, bytes, bytes] | None  # raw good, raw bad, shape good, shape bad
    weights: tuple[float, ...]


def pieces(texts: list[bytes]) -> list[bytes]:
    return [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]


def train_dictionaries(good: list[bytes], bad: list[bytes]) -> tuple[bytes, bytes, bytes, bytes] | None:
    import zstandard

    out = []
    for view, (level, size) in ((bytes, RAW), (shape, SHAPE)):
        for texts in (good, bad):
            samples = pieces([view(t) for t in texts])
            room = sum(map(len, samples)) // 4
            try:
                out.append(zstandard.train_dictionary(min(size, max(256, room)), samples, level=level).as_bytes())
            except zstandard.ZstdError:  # too little text for a trained one: the text itself serves
                out.append(b"".join(samples)[:size] or b" " * 8)
    return tuple(out)


def compressors(dictionaries: tuple[bytes, ...]):
    import zstandard

    made = []
    for content, (level, _) in zip(dictionaries, (RAW, RAW, SHAPE, SHAPE)):
        data = zstandard.ZstdCompressionDict(content)
        data.precompute_compress(level=level)
        made.append(zstandard.ZstdCompressor(
            level=level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
        ))
    return made


def features(made: list, texts: list[bytes]) -> np.ndarray:
    """Per text: 1, the two normalised differences, their product and both again by the length of the text."""
    raw_good, raw_bad, shape_good, shape_bad = made
    out = np.zeros((len(texts), 6))
    out[:, 0] = 1
    for i, text in enumerate(texts):
        if not text:
            continue
        form = shape(text)
        a, b = len(raw_good.compress(text)), len(raw_bad.compress(text))
        c, d = len(shape_good.compress(form)), len(shape_bad.compress(form))
        raw, kind = (b - a) / max(a, b), (d - c) / max(c, d)
        surer = math.log1p(len(text) / 200)
        out[i, 1:] = raw, kind, raw * kind, raw * surer, kind * surer
    return out


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(texts: list[bytes], labels: list[int], share_good: float | None = None) -> Model:
    """``share_good``: share of label 1 among all labelled rows, when the sample is balanced."""
    y = np.array(labels, dtype=float)
    share = float(y.mean()) if len(y) and share_good is None else (0.5 if share_good is None else share_good)
    if len(set(labels)) < 2:
        return Model(None, (logit(share),))
    half = np.zeros(len(y), dtype=bool)
    for label in (0, 1):  # every other row of each label trains the dictionaries
        half[np.flatnonzero(y == label)[::2]] = True
    dictionaries = train_dictionaries(
        [t for t, h, v in zip(texts, half, y) if h and v], [t for t, h, v in zip(texts, half, y) if h and not v]
    )
    rest = ~half if len(set(y[~half])) == 2 else np.ones(len(y), dtype=bool)
    x = features(compressors(dictionaries), [t for t, r in zip(texts, rest) if r])
    w = fit_curve(x, y[rest])
    w[0] += logit(share) - logit(float(y[rest].mean()))  # back to the true share of the labels
    return Model(dictionaries, tuple(w))


def logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def scores(model: Model, made: list | None, texts: list[bytes]) -> np.ndarray:
    if made is None:
        return np.full(len(texts), 1 / (1 + math.exp(-model.weights[0])))
    z = features(made, texts) @ np.array(model.weights)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text",
          per_label: int = PER_LABEL, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on a bounded sample of the labelled rows of ``docs``; NULL labels and keys are left out."""
    return fitted_on_sample(docs, labels, label, key, text, per_label, sample_bytes, fit)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each row; ``out`` replaces a column of that name."""
    shared = share(docs, model)
    base = docs.drop(out) if out in docs.columns else docs
    at = base.columns.index(text)

    def run(batches):
        model = held(shared)
        made = compressors(model.dictionaries) if model.dictionaries else None
        for batch in batches:
            name = batch.schema.names[at]
            for part, raw in text_chunks(batch, name):
                values = pa.array(scores(model, made, raw), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, values], names=[*part.schema.names, out])

    return arrow_map(base, run, T.StructType([*base.schema.fields, T.StructField(out, T.DoubleType())]))
