"""Language identification: the family first, then one-versus-one linear SVMs within it.

A text becomes the logarithms of its counts of hashed byte trigrams (lower-cased; digits and
punctuation count as blanks), scaled to length one. One linear SVM per family tells it from the
others; within the chosen family one linear SVM per pair of languages votes. A language that
FAMILIES does not name is a family of its own.

The SVMs are fitted on at most `max_rows` labelled rows, chosen by a hash of their id in the same
share for every size and dealt evenly to the languages; all texts are predicted, whole. One
task fits them on that bounded sample, and the driver gets the weights alone.

Defined results: a null text and one without letters give `und` and score 0. Rows without a
label or an id are never learned from. With no labelled rows all texts are `und`; with one
language every text with letters is of that language. Each input row gives one output row.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import slices

#: ISO 639-1 codes of closely related languages.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic",
}
UNKNOWN = "und"
BITS = 12
DIMENSIONS = 1 << BITS
MAX_ROWS = 4000
TEXTS_AT_ONCE = 256
BLANK = 0x20
_LETTERS = np.full(256, BLANK, np.uint8)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def _vectors(texts: list[bytes]) -> np.ndarray:
    """One row per text, all texts lower-cased."""
    # Three blanks between texts: trigrams with two blanks or more are not counted.
    data = _LETTERS[np.frombuffer(b"   ".join([*texts, b"   "]), np.uint8)]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 3)
    blank = (data == BLANK).astype(np.uint8)
    counted = blank[:-2] + blank[1:-1] + blank[2:] < 2
    place = np.flatnonzero(counted)
    code = (
        data[place].astype(np.uint32) << 16
        | data[place + 1].astype(np.uint32) << 8
        | data[place + 2]
    )
    with np.errstate(over="ignore"):
        slot = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    owner = np.searchsorted(ends, place, side="right")
    counts = np.bincount(
        owner * DIMENSIONS + slot.astype(np.int64), minlength=len(texts) * DIMENSIONS
    )
    logs = np.log1p(counts.reshape(len(texts), DIMENSIONS)).astype(np.float32)
    length = np.linalg.norm(logs, axis=1, keepdims=True)
    return logs / np.maximum(length, 1e-9)


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, has letters, vectors) of some rows at a time."""
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    letters = np.asarray(pc.match_substring_regex(lowered, r"\pL"))
    values = lowered.cast(pa.binary()).to_pylist()
    for at in range(0, len(values), TEXTS_AT_ONCE):
        part = values[at : at + TEXTS_AT_ONCE]
        yield at, letters[at : at + TEXTS_AT_ONCE], _vectors(part)


def fit_svm(x: np.ndarray, positive: np.ndarray, cost: float = 10.0, steps: int = 150):
    """(weights, bias) of a linear SVM with squared hinge loss, classes weighed alike."""
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, 0.5 / positive.sum(), 0.5 / (~positive).sum()).astype(np.float32)
    x = np.hstack((x, np.ones((len(x), 1), np.float32)))
    weigh = 2 * cost * share
    # Vectors have length one and the bias adds one: the curvature is at most this.
    rate = 1.0 / (1.0 + 2 * cost * 2)
    w = ahead = np.zeros(x.shape[1], np.float32)
    for step in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (x @ ahead))
        new = ahead - rate * (ahead - x.T @ (weigh * slack * y))
        ahead = new + (step / (step + 3)) * (new - w)
        w = new
    return w[:-1], w[-1]


class Model:
    """One SVM per family and one per pair of languages within a family."""

    def __init__(self, x: np.ndarray, langs: np.ndarray, families: Mapping[str, str]):
        self.families: dict[str, list[str]] = {}
        for lang in sorted(set(langs.tolist())):
            self.families.setdefault(families.get(lang, f"only {lang}"), []).append(lang)
        self.names = list(self.families)
        family = np.array([families.get(k, f"only {k}") for k in langs.tolist()], object)
        self.tops = []
        if len(self.names) > 1:
            self.tops = [fit_svm(x, family == name) for name in self.names]
        self.pairs = {}
        for members in self.families.values():
            for a, b in combinations(members, 2):
                rows = (langs == a) | (langs == b)
                self.pairs[a, b] = fit_svm(x[rows], langs[rows] == a)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, score) of each row; the score is a product of two squashed margins."""

        def squash(margin: np.ndarray) -> np.ndarray:
            return 1.0 / (1.0 + np.exp(-4.0 * np.clip(margin, -50, 50)))

        chosen, score = np.zeros(len(x), int), np.ones(len(x))
        if self.tops:
            margins = np.stack([x @ w + b for w, b in self.tops], axis=1)
            chosen = margins.argmax(axis=1)
            score = squash(margins.max(axis=1))
        lang = np.empty(len(x), object)
        for place, name in enumerate(self.names):
            rows, members = np.flatnonzero(chosen == place), self.families[name]
            votes = np.zeros((len(rows), len(members)))
            surest = np.full((len(rows), len(members)), np.inf)
            for (i, a), (j, b) in combinations(enumerate(members), 2):
                w, bias = self.pairs[a, b]
                margin = x[rows] @ w + bias
                votes[:, i] += margin > 0
                votes[:, j] += margin <= 0
                surest[:, i] = np.minimum(surest[:, i], margin)
                surest[:, j] = np.minimum(surest[:, j], -margin)
            # Most votes; ties go to the language whose weakest duel is the best.
            best = np.lexsort((-surest, -votes), axis=1)[:, 0] if len(members) > 1 else 0
            lang[rows] = np.array(members, object)[best]
            if len(members) > 1:
                score[rows] *= squash(surest[np.arange(len(rows)), best])
        return lang, score


def sample(labelled: DataFrame, max_rows: int) -> DataFrame:
    """(text, lang): about equally many rows per language, together near `max_rows` at most."""
    # One entry per language; no more languages than rows can be learned.
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    counts = counts.orderBy(F.desc("n"), "lang").limit(max_rows)
    sizes = dict(counts.agg(F.collect_list(F.struct("lang", "n"))).first()[0])
    each = max_rows // max(1, len(sizes))
    spread = 1 << 30
    share = F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(spread, spread * each // n)).otherwise(share)
    return labelled.where(F.pmod(F.xxhash64("id"), F.lit(spread)) < share).select("text", "lang")


def train(
    docs: DataFrame, learn: Column, families: Mapping[str, str] = FAMILIES,
    max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> Model | None:
    """The model of the rows where `learn` holds; none if there are no labelled ones."""
    labelled = docs.where(learn).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs = batch.column("lang")
            for at, letters, vectors in features(batch.column("text")):
                found = np.flatnonzero(letters)
                yield pa.RecordBatch.from_arrays(
                    [langs.slice(at, len(letters)).take(pa.array(found)),
                     pa.array([vectors[i].astype(np.float16).tobytes() for i in found],
                              pa.binary())],
                    ["lang", "x"],
                )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, parts = [], []
        for batch in batches:
            langs.extend(batch.column("lang").to_pylist())
            parts.extend(np.frombuffer(v, np.float16) for v in batch.column("x").to_pylist())
        if langs:
            x = np.stack(parts, dtype=np.float32)
            model = Model(x, np.array(langs, object), families)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)])], ["model"])

    rows = sample(labelled, max_rows).mapInArrow(run, "lang string, x binary")
    # A fixed order, so that sums come out alike in every run.
    ordered = rows.repartition(1).sortWithinPartitions("lang", "x")
    fitted = ordered.mapInArrow(fit, "model binary").first()
    return pickle.loads(fitted[0]) if fitted else None


def identify(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score) per row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs, scores = [], []
            for _, letters, vectors in features(batch.column("text")):
                if model is None:
                    lang, score = np.full(len(letters), UNKNOWN, object), np.zeros(len(letters))
                else:
                    lang, score = model.predict(vectors)
                langs.extend(np.where(letters, lang, UNKNOWN).tolist())
                scores.extend(np.where(letters, score, 0.0).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))
