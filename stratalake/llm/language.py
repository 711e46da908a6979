"""Language identification: the family first, then one linear machine for each pair of its languages."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import in_training_part, table
from stratalake.llm.hashing import LOWER, mix
from stratalake.llm.packs import text_buffers
from stratalake.llm.registry import query

#: Hashed features, longest byte n-gram, labelled documents read for a language, and languages times documents.
FEATURES = 4096
LONGEST = 4
SAMPLE_ROWS = 250
SAMPLE_TOTAL = 4000

#: Families of languages by code; a code that is not here is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "indo-iranian": "hi bn ur fa mr ne pa gu",
    "semitic": "ar he mt am",
    "turkic": "tr az kk uz ky",
}


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), lang)


def features(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Rows of hashed byte n-grams of letters, with spaces for all else, of unit length."""
    low = LOWER[data]
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    capital = after & (low >= 0x80) & (low <= 0x9E) & (low != 0x97)
    low = np.where(capital, low + 0x20, low).astype(np.uint8)
    letter = ((low >= 97) & (low <= 122)) | (low >= 0x80)
    low = np.where(letter, low, 32)
    n_docs = len(offsets) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(offsets))
    sums = np.zeros(n_docs * FEATURES)
    for n in range(1, LONGEST + 1):
        code = _grams(low, n)
        inside = np.zeros(len(low), bool)
        inside[n - 1 :] = doc[n - 1 :] == doc[: len(low) - n + 1]
        blank = (low == 32) & np.r_[False, low[:-1] == 32]
        keep = inside & ~blank
        at = (mix(code[keep] + np.uint64(n << 40)) >> np.uint64(64 - 12)).astype(np.int64)
        sums += np.bincount(doc[keep] * FEATURES + at, minlength=n_docs * FEATURES)
    rows = np.sqrt(sums.reshape(n_docs, FEATURES))
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _grams(low: np.ndarray, n: int) -> np.ndarray:
    """The n bytes that end at each position, as one number."""
    code = np.zeros(len(low), np.uint64)
    for j in range(n):
        code[j:] |= low[: len(low) - j].astype(np.uint64) << np.uint64(8 * j)
    return code


@dataclass
class Machines:
    """One-versus-rest linear machines, and the temperature that makes probabilities of their margins."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        margins = (rows @ self.weights + self.bias) * self.temperature
        p = np.exp(margins - margins.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


@dataclass
class PairMachines:
    """One linear machine for each pair of names, in the order of ``pairs_of``, and their temperature."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Pairwise probabilities r coupled as 1 / (sum of 1 / r over the others - (k - 2)), set to sum to 1.

        As r is logistic in the margin, that is 1 / (1 + sum of exp(-margin) over the others).
        """
        margins = np.clip((rows @ self.weights + self.bias) * self.temperature, -50, 50).astype(np.float64)
        against = np.ones((len(rows), len(self.names)))
        for p, (i, j) in enumerate(pairs_of(len(self.names))):
            against[:, i] += np.exp(-margins[:, p])
            against[:, j] += np.exp(margins[:, p])
        p = 1 / against
        return p / p.sum(axis=1, keepdims=True)


def pairs_of(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i + 1, n)]


def fit_machines(rows: np.ndarray, names: list[str], steps: int = 200, penalty: float = 1e-4) -> Machines:
    """Squared-hinge machines of each name against all others, with a fitted temperature."""

    def fit(rows: np.ndarray, place: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
        sign = np.where(place[:, None] == np.arange(n_classes), 1.0, -1.0).astype(np.float32)
        return _hinge(rows, sign, steps, penalty)

    return _tempered(Machines, fit, rows, names)


def fit_pairs(rows: np.ndarray, names: list[str], steps: int = 200, penalty: float = 1e-4) -> PairMachines:
    """Squared-hinge machines, one for each pair of names on the rows of these two, with a fitted temperature."""

    def fit(rows: np.ndarray, place: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for i, j in pairs_of(n_classes):
            both = (place == i) | (place == j)
            sign = np.where(place[both, None] == i, 1.0, -1.0).astype(np.float32)
            found.append(_hinge(rows[both], sign, steps, penalty))
        return np.hstack([w for w, _ in found]), np.concatenate([b for _, b in found])

    return _tempered(PairMachines, fit, rows, names)


def _tempered(kind, fit, rows: np.ndarray, names: list[str]):
    """Machines of the names, with the temperature fitted on every fifth row left out."""
    classes = sorted(set(names))
    place = np.array([classes.index(n) for n in names])
    if len(classes) == 1:
        n = 1 if kind is Machines else 0
        return kind(classes, np.zeros((rows.shape[1], n), np.float32), np.zeros(n, np.float32))
    aside = np.arange(len(rows)) % 5 == 4
    found = fit(rows[~aside], place[~aside], len(classes))
    held, truth = rows[aside], place[aside]
    losses = []
    for t in 2.0 ** np.arange(-2, 7):
        trial = kind(classes, *found, t)
        losses.append((-np.log(trial.probabilities(held)[np.arange(len(held)), truth] + 1e-12).mean(), t))
    return kind(classes, *fit(rows, place, len(classes)), min(losses)[1])


def _hinge(rows: np.ndarray, sign: np.ndarray, steps: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """A machine for each column of signs."""
    # Each machine weighs both of its sides the same.
    share = np.maximum((sign > 0).mean(axis=0), 1e-6)
    weight = np.where(sign > 0, 0.5 / share, 0.5 / np.maximum(1 - share, 1e-6)).astype(np.float32)
    w, b = np.zeros((rows.shape[1], sign.shape[1]), np.float32), np.zeros(sign.shape[1], np.float32)
    m = [np.zeros_like(w), np.zeros_like(b), np.zeros_like(w), np.zeros_like(b)]
    for t in range(1, steps + 1):
        slack = np.maximum(0, 1 - sign * (rows @ w + b)) * weight
        push = -2 * sign * slack / len(rows)
        for i, (value, slope) in enumerate(((w, rows.T @ push + penalty * w), (b, push.sum(axis=0)))):
            m[i] = 0.9 * m[i] + 0.1 * slope
            m[i + 2] = 0.999 * m[i + 2] + 0.001 * slope**2
            value -= 0.1 * (m[i] / (1 - 0.9**t)) / (np.sqrt(m[i + 2] / (1 - 0.999**t)) + 1e-8)
    return w, b


@dataclass
class LanguageModel:
    """Machines of each family against the others, and between each two languages of a family."""

    families: Machines
    members: Mapping[str, PairMachines] = field(default_factory=dict)

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        by_family = self.families.probabilities(rows)
        best = by_family.argmax(axis=1)
        names, score = np.empty(len(rows), object), by_family[np.arange(len(rows)), best]
        for i, family in enumerate(self.families.names):
            mine = np.flatnonzero(best == i)
            if len(mine):
                within = self.members[family].probabilities(rows[mine])
                top = within.argmax(axis=1)
                names[mine] = [self.members[family].names[j] for j in top]
                score[mine] *= within[np.arange(len(mine)), top]
        return names.tolist(), score.astype(np.float64)


def fit_languages(docs: DataFrame, may_learn: Column, sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """A model of the labelled rows that may be learned from; None if there are none.

    At most ``sample_rows`` documents of a language are read (those of least hash of their text), fewer if
    there are many languages; each as a whole and as three short pieces, so that short texts are known too.
    """
    labelled = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    labelled = labelled.select("text", "lang", F.xxhash64("text").alias("luck"))
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE_TOTAL).collect()}
    if not counts:
        return None
    each = max(1, min(sample_rows, SAMPLE_TOTAL // len(counts)))
    # Three times the share that is needed, since equal texts have equal luck; the rank then cuts.
    share = F.least(F.lit(1.0), F.lit(3.0 * each) / F.col("n"))
    sizes = docs.sparkSession.createDataFrame(list(counts.items()), "lang string, n long")
    drawn = labelled.join(F.broadcast(sizes), "lang").where(F.col("luck") / (2.0**64) + 0.5 <= share)
    order = Window.partitionBy("lang").orderBy("luck")
    sample = drawn.dropDuplicates(["lang", "luck"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= each)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, rows = [], []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = len(text)
                pieces = [text, text[n // 4 : n // 4 + 120], text[n // 2 : n // 2 + 50], text[: 25]]
                raw = [p.encode() for p in pieces if any(c.isalpha() for c in p)]
                offsets = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
                made = features(offsets, np.frombuffer(b"".join(raw), np.uint8))
                langs += [lang] * len(raw)
                rows += [r.astype(np.float16).tobytes() for r in made]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(rows, pa.binary())], names=["lang", "row"])

    read_rows = sample.orderBy("lang", "rank").select("text", "lang").mapInArrow(read, "lang string, row binary").collect()
    names = [r.lang for r in read_rows]
    rows = np.stack([np.frombuffer(r.row, np.float16) for r in read_rows]).astype(np.float32)
    families = [family_of(n) for n in names]
    members = {}
    for family in sorted(set(families)):
        mine = [i for i, f in enumerate(families) if f == family]
        members[family] = fit_pairs(rows[mine], [names[i] for i in mine])
    return LanguageModel(fit_machines(rows, families), members)


def identify(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of every whole text and the probability of it: ``doc_id``, ``lang_pred``, ``score``.

    The likeliest family is chosen first, then the likeliest language among its own; the score is the
    product of both probabilities. Null text, text without a letter, and all texts where there was
    nothing to learn from are ``und`` with score 0. Rows that repeat each have a row; an empty table has
    none. Only the two named columns are read.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            guesses, scores = [], []
            for a, z in slices(offsets):
                part = offsets[a : z + 1]
                names, p = model.predict(features(part - part[0], data[part[0] : part[-1]]))
                guesses += names
                scores.append(p)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(guesses, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64()), batch.column(2)],
                names=["doc_id", "guess", "score", "letters"],
            )

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), letters.alias("letters"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, guess string, score double, letters boolean"
    return rows.mapInArrow(score, schema).select(
        "doc_id",
        F.when(F.col("letters"), F.col("guess")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letters"), F.least("score", F.lit(1.0))).otherwise(0.0).alias("score"),
    )


def slices(offsets: np.ndarray, max_bytes: int = 1 << 19, max_rows: int = 256) -> Iterator[tuple[int, int]]:
    """Ranges of rows of bounded bytes; a longer document is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        z = int(np.searchsorted(offsets, offsets[a] + max_bytes, side="right")) - 1
        z = min(max(a + 1, z), a + max_rows, n)
        yield a, z
        a = z


@query("op4_language_machines")
def op4_language_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs, in_training_part(F.col("doc_id")))
    return identify(docs, model).select(
        "doc_id", (~in_training_part(F.col("doc_id"))).alias("held_out"), "lang_pred", "score"
    )
