"""Quality by pairwise ranking: a Bradley-Terry model of document features, cut at a quantile of the scores."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import stored, table
from stratalake.llm.hashing import ALNUM, NOT_SPACE, words
from stratalake.llm.language import slices
from stratalake.llm.packs import text_buffers
from stratalake.llm.registry import query

#: Labelled documents of either label that pairs are made of, at most, and the partners of each.
SAMPLE = 6000
PARTNERS = 8
#: Strength of the penalty on weights, per pair.
PENALTY = 1e-3
#: Quantiles of all scores that are tried as the cut, and the score a document at the cut gets.
LEVELS = 1000
CUT_SCORE = 0.3

#: What is measured of a text; each is a feature as it stands and by its square root.
MEASURES = (
    "capitals", "capital words", "marks", "words with a mark twice running", "words without a letter or digit",
    "words like the one before", "words like the one before that", "words met before", "commonest word", "digits",
    "bytes beyond ASCII", "line ends", "sentence ends", "short words", "long words", "length of words", "length", "empty",
)
FEATURES = 2 * len(MEASURES)

_KIND = np.zeros((6, 256), bool)
_KIND[0, 65:91] = True
_KIND[1, 97:123] = True
_KIND[2, 48:58] = True
_KIND[3, 128:] = True
_KIND[4, 10] = True
#: Marks: signs that prose has few of; fixed values.
_KIND[5, list(b"!#$%&*+/<=>@\\^_`{|}~[]")] = True
_END = np.zeros(256, bool)
_END[list(b".!?")] = True


def features(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` numbers between 0 and 1 for each text."""
    n = len(offsets) - 1

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(flags)][offsets])

    upper, lower, digit, beyond, newline, mark = (kind[data] for kind in _KIND)
    n_upper, n_lower, n_digit, n_beyond, n_newline, n_mark = map(per_text, (upper, lower, digit, beyond, newline, mark))
    size = np.maximum(np.diff(offsets), 1)
    h, doc, starts, ends = words(offsets, data, NOT_SPACE)
    count = np.bincount(doc, minlength=n)
    total = np.maximum(count, 1)

    def of_words(flags: np.ndarray) -> np.ndarray:
        return np.bincount(doc, flags, n) / total

    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(flags)]
        return sums[ends] - sums[starts]

    twice = np.zeros(len(data), bool)
    twice[1:] = mark[1:] & (data[1:] == data[:-1])
    like = [np.zeros(len(h), bool), np.zeros(len(h), bool)]
    for k in (1, 2):
        like[k - 1][k:] = (h[k:] == h[:-k]) & (doc[k:] == doc[:-k])
    capital = within(upper)
    # Runs of one word in the order of documents and words: how often each occurs.
    order = np.lexsort((h, doc))
    first = np.ones(len(h), bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    heads = np.flatnonzero(first)
    times = np.diff(np.r_[heads, len(h)])
    commonest = np.zeros(n)
    np.maximum.at(commonest, doc[order][heads], times)
    kinds = np.bincount(doc[order][heads], minlength=n)
    length = ends - starts
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    measured = np.stack([
        n_upper / np.maximum(n_upper + n_lower, 1),
        of_words((capital >= 2) & (within(lower) == 0)),
        np.minimum(1, 2 * n_mark / size),
        of_words(within(twice) > 0),
        of_words(within(ALNUM[data]) == 0),
        of_words(like[0]),
        of_words(like[1]),
        1 - kinds / total,
        commonest / total * (count > 1),
        n_digit / size,
        n_beyond / size,
        np.minimum(1, 10 * n_newline / size),
        of_words(_END[last]),
        of_words(length <= 2),
        of_words(length >= 12),
        np.minimum(1, np.bincount(doc, length, n) / total / 20),
        np.minimum(1, np.log1p(count) / 12),
        count == 0,
    ]).T.astype(np.float64)
    return np.hstack([measured, np.sqrt(measured)])


@dataclass
class RankingModel:
    """Weights of the centred and scaled features; ``utility`` is the Bradley-Terry score of a text."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def utilities(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        # Row by row: a product of matrices would depend on the texts that come along.
        return ((features(offsets, data) - self.center) / self.scale * self.weights).sum(axis=1)


def pairs_from_labels(labels: DataFrame, may_learn: Column, label: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """Pairs of ids, ``better`` and ``worse``: documents of label 1 and of label 0.

    Of either label at most some ``SAMPLE`` documents (those of least hash) take part, and each meets ``PARTNERS`` of
    the other label, drawn by hash, so there are 2 * ``SAMPLE`` * ``PARTNERS`` pairs at most. Labels that are null, other than 0 and 1, or not
    the same in all rows of a document make no pair.
    """
    marks = labels.where(may_learn & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    marks = marks.agg(F.min(label).alias("mark"), F.max(label).alias("most"))
    marks = marks.where("mark = most AND mark IN (0, 1)").withColumn("luck", F.xxhash64("id", F.lit(11)) / (2.0**64) + 0.5)
    marks = stored(marks, "quality-labels")
    counts = {r.mark: r.n for r in marks.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    shares = F.when(F.col("mark") == 1, min(1.0, SAMPLE / max(1, counts.get(1, 0)))).otherwise(
        min(1.0, SAMPLE / max(1, counts.get(0, 0)))
    )
    # Some SAMPLE rows of either label: they are numbered in one window each.
    place = F.row_number().over(Window.partitionBy("mark").orderBy("luck", "id")) - 1
    chosen = stored(marks.where(F.col("luck") < shares).select("id", "mark", place.alias("place")), "quality-chosen")
    sizes = {r.mark: r.n for r in chosen.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return chosen.select(F.col("id").alias("better"), F.col("id").alias("worse")).limit(0)
    other = F.when(F.col("mark") == 1, sizes[0]).otherwise(sizes[1])
    drawn = chosen.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(PARTNERS))))
    drawn = drawn.select("id", "mark", F.pmod(F.xxhash64("place", "mark", "k"), other).alias("at"))
    met = drawn.join(
        chosen.select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), F.col("place").alias("_place")),
        (F.col("at") == F.col("_place")) & (F.col("mark") != F.col("_mark")),
    )
    good = F.col("mark") == 1
    return met.select(
        F.when(good, F.col("id")).otherwise(F.col("_id")).alias("better"),
        F.when(good, F.col("_id")).otherwise(F.col("id")).alias("worse"),
    ).distinct()


def fit_ranking(
    docs: DataFrame, pairs: DataFrame, most_pairs: int = 4 * SAMPLE * PARTNERS, id_col: str = "doc_id", text_col: str = "text"
) -> RankingModel:
    """The Bradley-Terry model of preference pairs (ids ``better`` and ``worse``).

    The logarithm of the odds that one document is better than another is the difference of their scores, and a
    score is linear in the features of the whole text; the logistic loss on feature differences is minimised by
    Newton steps. Of more than ``most_pairs`` pairs, that many, those of least hash, are used. A document of
    several rows counts with the mean of their features. Without pairs all scores are equal.
    """
    total = pairs.count()
    if total > most_pairs:
        pairs = pairs.where(F.xxhash64("better", "worse") / (2.0**64) + 0.5 < most_pairs / total)
    pairs = stored(pairs.select("better", "worse"), "quality-pairs")
    ids = pairs.select(F.col("better").alias("_id")).union(pairs.select("worse")).distinct()

    @F.arrow_udf("array<double>")
    def measured(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            offsets, data = text_buffers(column)
            parts = [np.zeros((0, FEATURES))]
            for a, z in slices(offsets):
                parts.append(features(offsets[a : z + 1] - offsets[a], data[offsets[a] : offsets[z]]))
            flat = np.concatenate(parts)
            yield pa.ListArray.from_arrays(np.arange(0, flat.size + 1, FEATURES, dtype=np.int32), flat.ravel())

    # At most two ids a pair.
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids), F.col("id") == F.col("_id")
    )
    rows = sorted(read.select("id", measured("text").alias("x")).collect(), key=lambda r: (r.id, r.x))
    if not rows:
        return RankingModel(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES))
    names, place = np.unique(np.array([r.id for r in rows]), return_inverse=True)
    x = np.zeros((len(names), FEATURES))
    np.add.at(x, place, np.array([r.x for r in rows]))
    x /= np.bincount(place)[:, None]
    at = {name: i for i, name in enumerate(names.tolist())}
    met = sorted((at[p.better], at[p.worse]) for p in pairs.collect() if p.better in at and p.worse in at)
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    x = (x - center) / scale
    met = np.array(met, np.int64).reshape(-1, 2)
    return RankingModel(center, scale, _bradley_terry(x[met[:, 0]] - x[met[:, 1]]))


def _bradley_terry(differences: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights that minimise the logistic loss on differences, by damped Newton steps."""
    n, w = max(1, len(differences)), np.zeros(differences.shape[1])

    def loss(w: np.ndarray) -> float:
        return np.logaddexp(0, -differences @ w).sum() / n + PENALTY / 2 * w @ w

    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(differences @ w, -500, 500)))
        slope = PENALTY * w - differences.T @ p / n
        curve = (differences * (p * (1 - p))[:, None]).T @ differences / n + PENALTY * np.eye(len(w))
        step, rate = np.linalg.solve(curve, slope), 1.0
        while rate > 1e-4 and loss(w - rate * step) > loss(w):
            rate /= 2
        w = w - rate * step
        if np.abs(step).max() < 1e-7:
            break
    return w


def utility_column(model: RankingModel):
    """A function of a text column: its Bradley-Terry score."""

    @F.arrow_udf("double")
    def utility(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            offsets, data = text_buffers(column)
            parts = [np.zeros(0)]
            for a, z in slices(offsets):
                parts.append(model.utilities(offsets[a : z + 1] - offsets[a], data[offsets[a] : offsets[z]]))
            yield pa.array(np.concatenate(parts), pa.float64())

    return utility


def ranked_documents(docs: DataFrame, model: RankingModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``utility`` of every whole text, stored; null and empty texts have the score of no words."""
    return stored(docs.select(F.col(id_col).alias("doc_id"), utility_column(model)(text_col).alias("utility")), "quality")


def quantile_cut(scored: DataFrame, labels: DataFrame, may_learn: Column, label: str = "quality") -> float | None:
    """The quantile of all scores that parts the labelled rows best.

    A score of ``CUT_SCORE`` states that chance of label 1: rejecting a row of label 1 weighs 1 - ``CUT_SCORE``, keeping one
    of label 0 weighs ``CUT_SCORE``, and the least sum wins. ``LEVELS`` quantiles are taken over all documents, and the labelled ones that may be learned from are counted
    between them; in a tie the middle one of the best is the cut. None without labels of both kinds.
    """
    shares = [F.lit((i + 0.5) / LEVELS) for i in range(LEVELS)]
    found = scored.agg(F.percentile_approx("utility", F.array(*shares), F.lit(10 * LEVELS)).alias("q")).first().q
    levels = np.unique(np.array(found or [], float))

    @F.arrow_udf("int")
    def level(scores: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in scores:
            yield pa.array(np.searchsorted(levels, column.to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    marks = labels.where(may_learn).groupBy(F.col("doc_id").alias("_id")).agg(F.min(label).alias("mark"), F.max(label).alias("most"))
    marks = marks.where("mark = most AND mark IN (0, 1)").select("_id", "mark")
    known = scored.join(marks, F.col("doc_id") == F.col("_id")).select(F.col("mark"), level("utility").alias("level"))
    counts = np.zeros((2, len(levels) + 1))
    for r in known.groupBy("mark", "level").agg(F.count("*").alias("n")).collect():
        counts[r.mark, r.level] = r.n
    if not counts.sum(axis=1).all():
        return None
    # Level i as the cut rejects the rows counted in front of it.
    below = np.cumsum(counts, axis=1)[:, :-1]
    cost = (1 - CUT_SCORE) * below[1] + CUT_SCORE * (counts[0].sum() - below[0])
    best = np.flatnonzero(cost <= cost.min() + 1e-9)
    return float(levels[best[len(best) // 2]])


def score_quality(
    docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``utility`` and ``score`` of every document.

    Pairs of documents of different labels teach a Bradley-Terry model (:func:`fit_ranking`), every whole text gets its
    score, and the scores are cut at a quantile (:func:`quantile_cut`). ``score`` is the chance, under the model, that the document is better than one
    at the cut, shifted so that the cut itself has ``CUT_SCORE``. Null and empty texts have the score of no words, equal texts
    have equal scores, rows that repeat each have a row, an empty table has none. Without labels of both
    kinds every score is the share of label 1 among them, 0.5 if there are none. Only the named columns are read.
    """
    model = fit_ranking(docs, pairs_from_labels(labels, may_learn, label), id_col=id_col, text_col=text_col)
    scored = ranked_documents(docs, model, id_col, text_col)
    cut = quantile_cut(scored, labels, may_learn, label)
    if cut is None:
        share = labels.where(may_learn & F.col(label).isin(0, 1)).agg(F.avg(label)).first()[0]
        return scored.withColumn("score", F.lit(0.5 if share is None else float(share)))
    shift = math.log(CUT_SCORE / (1 - CUT_SCORE)) + 1e-9 - cut
    return scored.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.col("utility") + shift)))))


def in_quality_part(doc_id: Column) -> Column:
    """Rows that quality labels may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 != 0


@query("op11_pairwise_quality")
def op11_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_quality(docs, labels, in_quality_part(F.col("doc_id")))
    return scored.select(
        "doc_id",
        (~in_quality_part(F.col("doc_id"))).alias("held_out"),
        "score",
        F.when(F.col("score") >= CUT_SCORE, 1).otherwise(0).alias("predicted"),
        "utility",
    )
