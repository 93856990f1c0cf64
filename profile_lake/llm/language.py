"""Language identification with a string kernel.

Two texts are compared by the character n-grams (one to three letters, words apart)
that both contain: the blended-spectrum presence kernel, normalised by the number of
n-grams in each. A bounded sample of labelled texts gives the n-grams and the Nyström
landmarks; kernel ridge regression, one machine per language against the rest, gives
the weights. Texts are scored whole, a slice at a time, by matrix products: presence x
landmarks, then landmark map x weights.

The sample: at most ``per_language`` texts of each language, of each at most
``train_chars`` characters. Which texts are in it depends on a hash of doc_id and text;
equal rows count once, and no group of rows is gathered or ranked whole.

Null text or text without a letter: `und`, score 0. No labelled rows at all: every text
is `und`. Ties go to the first language in alphabetical order. Repeated rows: each gets
its result. Null doc_id: never learned from. Empty table: empty result. Other columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profile_lake.llm.batches import bound_batches, give_back, map_texts, slices

UNDETERMINED = "und"
_BITS = 20


@dataclass(frozen=True)
class Settings:
    """``per_language`` and ``train_chars`` bound the labelled sample."""

    per_language: int = 200
    train_chars: int = 4000
    longest_gram: int = 3
    features: int = 4096
    landmarks: int = 128
    ridge: float = 0.05


def _letter_table() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


_letters: list[np.ndarray] = []


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case code points with 0 for all but letters, the text of each, and letters per text."""
    if not _letters:
        _letters.append(_letter_table())
    lowered = [t.as_py().lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lowered], np.int64)
    # A separator after each text: n-grams do not cross texts.
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    text_of = np.repeat(np.arange(len(lowered)), sizes)
    letter = _letters[0][points]
    counts = np.bincount(text_of[letter], minlength=len(lowered))
    return np.where(letter, points, 0).astype(np.uint32), text_of, counts


def gram_codes(points: np.ndarray, longest: int) -> list[np.ndarray]:
    """For n = 1..longest the hashed n-gram that begins at each place.

    A run of separators is one separator's n-gram for presence, as repeats do not count.
    """
    out, code = [], np.zeros(len(points), np.uint32)
    for n in range(longest):
        code = code[: len(points) - n] * np.uint32(0x01000193) + points[n:] + np.uint32(n + 1)
        mixed = code ^ (code >> np.uint32(15))
        mixed = mixed * np.uint32(0x2C1B3C6D)
        out.append(((mixed ^ (mixed >> np.uint32(13))) >> np.uint32(32 - _BITS)).astype(np.int32))
    return out


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    longest_gram: int
    #: Feature of each hashed n-gram, or -1.
    feature: np.ndarray
    #: Landmark texts as normalised presence rows.
    landmarks: np.ndarray
    #: From kernel values to one score per language.
    weights: np.ndarray
    n_features: int

    def presence(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Normalised presence rows, and the number of letters of each text."""
        points, text_of, letters = code_points(texts)
        out = np.zeros((len(texts), self.n_features), np.float32)
        flat = out.reshape(-1)
        for code in gram_codes(points, self.longest_gram):
            feature = self.feature[code]
            known = np.flatnonzero(feature >= 0)
            flat[text_of[known] * self.n_features + feature[known]] = 1
        norm = np.sqrt(out.sum(axis=1, keepdims=True))
        return out / np.maximum(norm, 1), letters

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """A language and a score (0 to 1; over a half: its own machine says yes) per text."""
        labels, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return labels, scores
        for first in range(0, len(texts), 512):
            part = texts.slice(first, 512)
            rows, letters = self.presence(part)
            values = (rows @ self.landmarks.T) @ self.weights
            best = values.argmax(axis=1)
            for i in np.flatnonzero(letters):
                labels[first + i] = self.languages[best[i]]
                scores[first + i] = float(np.clip((values[i, best[i]] + 1) / 2, 0, 1))
        return labels, scores


def fit(texts: list[str], languages: list[str], settings: Settings = Settings()) -> LanguageModel:
    """Kernel ridge regression on Nyström features of labelled texts."""
    names = sorted(set(languages))
    feature = np.full(1 << _BITS, -1, np.int32)
    if not names:
        return LanguageModel([], settings.longest_gram, feature, np.zeros((0, 1)), np.zeros((0, 0)), 1)
    points, text_of, _ = code_points(pa.array(texts, pa.string()))
    pairs = [
        np.unique(text_of[: len(code)].astype(np.int64) << _BITS | code)
        for code in gram_codes(points, settings.longest_gram)
    ]
    frequency = np.bincount(np.unique(np.concatenate(pairs)) & ((1 << _BITS) - 1), minlength=1 << _BITS)
    chosen = np.argsort(-frequency, kind="stable")[: settings.features]
    chosen = chosen[frequency[chosen] > 0]
    feature[chosen] = np.arange(len(chosen))
    blank = LanguageModel(names, settings.longest_gram, feature, np.zeros((0, 1)), np.zeros((0, 0)), len(chosen))
    rows, _ = blank.presence(pa.array(texts, pa.string()))

    label = np.array([names.index(x) for x in languages])
    each = max(1, settings.landmarks // len(names))
    picked = np.concatenate([np.flatnonzero(label == k)[:each] for k in range(len(names))])
    landmarks = rows[picked]
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    large = values > 1e-6 * values.max()
    nystroem = vectors[:, large] / np.sqrt(values[large])
    mapped = (rows @ landmarks.T).astype(np.float64) @ nystroem
    targets = np.where(label[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
    # Each machine's two sides weigh alike, however many texts a language has.
    weights = np.zeros((mapped.shape[1], len(names)))
    for k in range(len(names)):
        yes = label == k
        weight = np.where(yes, 0.5 / max(1, yes.sum()), 0.5 / max(1, (~yes).sum()))
        left = (mapped * weight[:, None]).T @ mapped + settings.ridge / len(label) * np.eye(mapped.shape[1])
        weights[:, k] = np.linalg.solve(left, (mapped * weight[:, None]).T @ targets[:, k])
    return LanguageModel(
        names, settings.longest_gram, feature, landmarks, (nystroem @ weights).astype(np.float32), len(chosen)
    )


def labelled_sample(docs: DataFrame, usable: Column, settings: Settings = Settings()) -> list[tuple[str, str]]:
    """At most ``per_language`` (text, lang) of each language, the same in every run.

    Of each language the rows of least hash. An estimate of its distinct rows gives a limit
    that about twice as many are below; equal rows of these are one, and the least stay. So
    ``per_language`` texts of each language, cut to ``train_chars``, come to the driver.
    """
    labelled = usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}")
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 4)
    cut = F.substring("text", 1, settings.train_chars)
    rows = docs.filter(labelled).select("lang", place.alias("place"), cut.alias("text"))
    inside = F.lit(False)
    for lang, n in sorted(rows.groupBy("lang").agg(F.approx_count_distinct("place")).collect()):
        limit = int((1 << 60) * min(1.0, 2 * settings.per_language / max(1, n)))
        inside = inside | ((F.col("lang") == lang) & (F.col("place") < limit))
    distinct = rows.filter(inside).groupBy("lang", "place").agg(F.min("text").alias("text"))
    nth = F.row_number().over(W.partitionBy("lang").orderBy("place"))
    taken = distinct.withColumn("nth", nth).filter(F.col("nth") <= settings.per_language)
    return [(r["text"], r["lang"]) for r in sorted(taken.collect(), key=lambda r: (r["lang"], r["place"]))]


def trained(docs: DataFrame, usable: Column, settings: Settings = Settings()) -> LanguageModel:
    """A model learned from the labelled rows for which ``usable`` holds."""
    sample = labelled_sample(docs, usable, settings)
    return fit([t for t, _ in sample], [x for _, x in sample], settings)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of ``docs`` with lang_pred and score; only `text` is looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the settings

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        labels, scores = sent.value.predict(part.column("text"))
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(labels), pa.array(scores)], list("dls"))

    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return map_texts(narrow, work, "doc_id long, lang_pred string, score double")


def rejects_unknown(docs: DataFrame, model: LanguageModel, min_score: float = 0.25) -> DataFrame:
    """The rows of ``docs`` in a learned language; a null `lang` becomes the predicted one.

    Rejected are rows without a letter and rows whose best machine scores below
    ``min_score``. Other columns pass unchanged.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the settings
    at, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                labels, scores = sent.value.predict(part.column(at))
                named = pc.coalesce(part.column(lang), pa.array(labels, pa.string()))
                keep = pc.and_(pc.not_equal(pa.array(labels), UNDETERMINED), pc.greater_equal(pa.array(scores), min_score))
                yield part.set_column(lang, "lang", named).filter(keep)
        give_back()

    bound_batches(docs)
    return docs.mapInArrow(run, docs.schema)
