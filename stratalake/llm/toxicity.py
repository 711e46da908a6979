"""Toxicity: disguised words restored by a noisy-channel decoder, then the restored text scored."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import in_training_part, stored, table
from stratalake.llm.hashing import ALNUM, LOWER, NOT_SPACE, PrefixHash, distinct, mix, words
from stratalake.llm.language import slices
from stratalake.llm.packs import text_buffers
from stratalake.llm.registry import query

#: Symbols of the character model: 0 between words, 1-26 letters, 27-58 accented Latin letters,
#: 59 digits, 60 other letters, 61 marks.
SYMBOLS = 62
#: What a sign may stand for in disguise; fixed values.
DISGUISES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "€": "e", "£": "l",
}
#: Costs in nats: a sign read as a letter, a repeated letter dropped, a separator dropped, a space kept.
SIGN, REPEAT, DROP, SPACE = 1.0, 0.3, 0.1, 4.0
#: The same where plain text has much of it: a letter written twice, a space between short pieces dropped or kept.
TWICE, JOIN, APART = 3.0, 2.0, 0.0
#: What a letter of an unknown word costs: a doubled letter is dropped only from words likelier than that.
UNKNOWN = math.log(26)

#: Bits of a feature, and labelled documents read at most, of either label.
BITS = 20
SAMPLE_TOXIC = 4000
SAMPLE_CLEAN = 10000
#: Evidence, as twice a log likelihood ratio, that a feature must give of toxic documents.
LEAST_EVIDENCE = 15.0


# --- Character model -------------------------------------------------------------------------------


def symbol_of(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 96
    if "à" <= char <= "ÿ":
        return 27 + ord(char) - 0xE0
    if char.isdigit():
        return 59
    if char.isspace():
        return 0
    return 60 if char.isalpha() else 61


def _symbols(data: np.ndarray) -> np.ndarray:
    """The symbols of UTF-8 text, lower-cased; marks are left out at the edges of words by the caller."""
    low = LOWER[data]
    table_ = np.full(256, 61, np.int64)
    table_[~NOT_SPACE] = 0
    table_[48:58] = 59
    table_[97:123] = np.arange(1, 27)
    table_[0x80:] = 60
    out = table_[low]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = data[lead + 1].astype(np.int64)
    second = np.where((second >= 0x80) & (second <= 0x9E) & (second != 0x97), second + 0x20, second)
    out[lead + 1] = np.where(second >= 0xA0, 27 + second - 0xA0, 60)
    keep = (data & 0xC0) != 0x80
    keep[lead], keep[lead + 1] = False, True
    return out[keep]


def count_trigrams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of symbol trigrams over all words of all documents: at most 62^3 sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            offsets, data = text_buffers(batch.column(0))
            for a, z in slices(offsets):
                part = data[offsets[a] : offsets[z]]
                if len(part):
                    s = np.r_[0, 0, _symbols(part), 0, 0]
                    # A mark between letters and a space belongs to neither.
                    s = s[s != 61]
                    s = s[np.r_[True, (s[1:] != 0) | (s[:-1] != 0)]]
                    s = np.r_[0, s]
                    sums += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["gram", "n"])

    counted = docs.select(text_col).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    sums = counted.toArrow()
    found = np.zeros(SYMBOLS**3)
    found[sums.column("gram").to_numpy()] = sums.column("n").to_numpy()
    return found.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probabilities of a symbol after two others, smoothed by bigrams and symbols."""
    one = counts.sum(axis=(0, 1)) + 0.1
    one /= one.sum()
    pairs = counts.sum(axis=0)
    two = (pairs + 5 * one) / (pairs.sum(axis=1, keepdims=True) + 5)
    three = (counts + 5 * two[None]) / (counts.sum(axis=2, keepdims=True) + 5)
    return -np.log(three).astype(np.float32)


# --- Decoder ---------------------------------------------------------------------------------------


def lattice(token: str, twice: float = REPEAT, drop: float = DROP, space: float = SPACE) -> list[list[tuple[str, float]]]:
    """For each run of a character, the letters it may stand for and what that costs."""
    steps: list[list[tuple[str, float]]] = []
    for run in re.finditer(r"(.)\1*", token, re.S):
        char, length = run[1], len(run[0])
        if char.isalpha():
            reads = [(char, (0.0, twice)[length - 1] if length < 3 else REPEAT * min(length - 1, 3))]
            if length > 1:
                # Letters of one symbol tell nothing of each other; stretched, they are read once.
                blind = length > 2 and symbol_of(char) == 60
                reads.append((char * 2, 0.0 if length == 2 else 4 * REPEAT + SIGN if blind else REPEAT))
        elif char in DISGUISES:
            reads = [(letter * n, SIGN + (math.log(len(DISGUISES[char])) if n == 1 else SIGN)) for letter in DISGUISES[char] for n in ((1, 2) if length > 1 else (1,))]
            if not char.isdigit() and char not in "@$":
                reads.append(("", SIGN))
        elif char.isspace():
            reads = [("", drop), (" ", space)]
        else:
            reads = [("", DROP)]
        steps.append(reads)
    return steps


def decode(token: str, costs: np.ndarray, *prices: float) -> str:
    """The likeliest letters behind a disguised token: Viterbi over the lattice and the trigram model.

    A state is the last two symbols. Ties go to the state and reading met first, so reruns agree. The
    ``prices`` are those of ``lattice``.
    """
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for reads in lattice(token, *prices):
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (x, y), (cost, path) in best.items():
            for letters, price in reads:
                total, a, b = cost + price, x, y
                for char in letters:
                    s = symbol_of(char)
                    total += float(costs[a, b, s])
                    a, b = b, s
                if (a, b) not in new or total < new[a, b][0]:
                    new[a, b] = (total, (path, letters) if letters else path)
        best = new
    _, path = min(((cost + float(costs[x, y, 0]), p) for (x, y), (cost, p) in best.items()), key=lambda c: c[0])
    parts = []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts))


class Restorer:
    """Puts decoded words in place of the disguised tokens of a text."""

    def __init__(self, costs: np.ndarray, remembered: int = 50_000) -> None:
        self.costs, self.limit, self.known = costs, remembered, {}

    def word(self, token: bytes) -> bytes:
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            text = token.decode("utf-8", "replace").lower()
            read = self.read(text)
            # What is read as it stands keeps its capitals and spaces.
            found = token if read.split() == text.split() else read.encode()
            self.known[token] = found
        return found

    def read(self, text: str) -> str:
        pieces = text.split()
        if max(map(len, pieces), default=0) > 1 < len(pieces):
            return decode(text, self.costs, REPEAT, JOIN, APART)
        if _TWIN.search(text) and not _TRIPLE.search(text) and DISGUISES.keys().isdisjoint(text):
            # Nothing but letters written twice: the marks between the words of the token stay.
            return _LETTERS.sub(lambda m: self.undoubled(m[0]) if _TWIN.search(m[0]) else m[0], text)
        return decode(text, self.costs)

    def undoubled(self, word: str) -> str:
        found = decode(word, self.costs, TWICE)
        symbols = [0, 0, *map(symbol_of, found), 0]
        price = TWICE * (len(word) - len(found)) + sum(self.costs[at] for at in zip(symbols, symbols[1:], symbols[2:]))
        return found if price < UNKNOWN * len(word) else word

    def batch(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts with their disguised tokens restored."""
        starts, ends, doc = disguised(offsets, data)
        if not len(starts):
            return offsets, data
        raw, parts, at = data.tobytes(), [], 0
        grown = np.zeros(len(offsets) - 1, np.int64)
        for a, z, d in zip(starts.tolist(), ends.tolist(), doc.tolist()):
            word = self.word(raw[a:z])
            parts += [raw[at:a], word]
            grown[d] += len(word) - (z - a)
            at = z
        parts.append(raw[at:])
        return offsets + np.r_[0, np.cumsum(grown)], np.frombuffer(b"".join(parts), np.uint8)


_LETTERS = re.compile(r"[^\W\d_]+")
_TWIN = re.compile(r"([^\W\d_])\1")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")

_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in DISGUISES if ord(c) < 128]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
#: Signs that are plain sentence marks at the end of a token.
_END_MARK = ord("!")
#: Longest run of pieces of up to two letters that is read as one.
PIECES = 16


def _kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of letters, and bytes of signs that may stand for one."""
    letter, sign = _LETTER[data], _SIGN[data]
    for char in DISGUISES:
        raw = char.encode()
        if len(raw) > 1:
            at = np.flatnonzero(data[: max(0, len(data) - len(raw) + 1)] == raw[0])
            for k in range(1, len(raw)):
                at = at[data[at + k] == raw[k]]
            for k in range(len(raw)):
                letter[at + k], sign[at + k] = False, True
    return letter, sign


def _twins(data: np.ndarray, letter: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """First bytes of letters, of any alphabet, that repeat the letter before."""
    chars = np.flatnonzero(lead)
    code = LOWER[data[chars]].astype(np.uint32)
    if len(chars) < len(data):
        wide = np.flatnonzero(np.diff(np.r_[chars, len(data)]) > 1)
        latin = data[chars[wide]] == 0xC3
        for k in (1, 2, 3):
            at = chars[wide] + k
            more = (at < len(data)) & ~lead[np.minimum(at, len(data) - 1)]
            wide, latin, at = wide[more], latin[more], at[more]
            byte = data[at].astype(np.uint32)
            capital = latin & (byte >= 0x80) & (byte <= 0x9E) & (byte != 0x97)
            code[wide] = (code[wide] << 8) | np.where(capital, byte + 0x20, byte)
    twin = np.zeros(len(data), bool)
    twin[chars[1:]] = letter[chars[1:]] & (code[1:] == code[:-1])
    return twin


def _ends(data: np.ndarray, letter: np.ndarray, sign: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where tokens end without sentence marks, and without a sign three times running; at least their start."""
    place = np.arange(len(data))
    part = np.maximum.accumulate(np.where(letter | (sign & (data != _END_MARK)), place, -1))
    same = np.zeros(len(data), bool)
    same[1:] = data[1:] == data[:-1]
    run = np.maximum.accumulate(np.where(same, 0, place))
    last = ends
    for _ in range(3):
        last = np.maximum(part[np.maximum(last, starts + 1) - 1] + 1, starts)
        tip = np.maximum(last, starts + 1) - 1
        head = np.maximum(run[tip], starts)
        last = np.where((last > starts) & sign[tip] & (data[tip] < 128) & (tip - head >= 2), head, last)
    return np.where(last > starts, np.maximum(part[np.maximum(last, starts + 1) - 1] + 1, starts), starts)


def disguised(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges that may hold a disguised word, and their documents.

    These are tokens with a sign that can stand for a letter, other than sentence marks and a sign repeated
    three times or more at their end; tokens with a letter twice running or more; tokens of single letters
    between marks; and three or more tokens in a row of one letter each, or of one or two.
    """
    _, doc, starts, ends = words(offsets, data, NOT_SPACE)
    if not len(starts):
        return starts, ends, doc
    letter, sign = _kinds(data)
    sums = {}
    lead = (data & 0xC0) != 0x80

    def number(flags: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        key = id(flags)
        if key not in sums:
            # The flags are kept, so that no others get their id.
            sums[key] = flags, np.r_[0, np.cumsum(flags)]
        return sums[key][1][z] - sums[key][1][a]

    last = _ends(data, letter, sign, starts, ends)
    n_letters = number(letter & lead, starts, last)
    n_signs = number(sign & lead, starts, last)
    leet = (n_signs > 0) & (n_letters > 0) & (n_letters + n_signs >= 3)
    # The first letter of a token repeats none of its own.
    repeated = number(_twins(data, letter, lead), np.minimum(starts + 1, last), last) > 0
    n_other = number(lead & ~letter & ~sign, starts, last)
    split = (n_other >= 2) & (n_other + 1 == n_letters)
    found = leet | repeated | split
    # Runs of single letters, then of pieces; only the last of a run has marks after it.
    n_chars = number(lead, starts, last)
    plain = (n_chars > 0) & (n_other == 0)
    taken = np.zeros(len(starts), bool)
    heads, tails = [], []
    for longest, most in ((1, None), (2, PIECES)):
        piece = plain & (n_chars <= longest) & ~taken
        new_run = np.ones(len(starts), bool)
        new_run[1:] = ~(piece[1:] & piece[:-1] & (doc[1:] == doc[:-1]) & (last[:-1] == ends[:-1]))
        head = np.flatnonzero(new_run)
        size = np.diff(np.r_[head, len(starts)])
        n_read, n_signed = np.add.reduceat(n_letters, head), np.add.reduceat(n_signs, head)
        good = piece[head] & (size >= 3) & (n_read >= 2) & (n_read >= n_signed)
        if most is not None:
            good &= size <= most
        taken |= np.repeat(good, size)
        heads.append(head[good])
        tails.append((head + size - 1)[good])
    heads, tails = np.concatenate(heads), np.concatenate(tails)
    found &= ~taken
    # Only the letters and signs up to the last are restored; marks after it stay.
    a, z, d = np.r_[starts[found], starts[heads]], np.r_[last[found], last[tails]], np.r_[doc[found], doc[heads]]
    order = np.argsort(a, kind="stable")
    return a[order], z[order], d[order]


# --- Scorer ----------------------------------------------------------------------------------------


def word_features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed words and word beginnings of each document, and the document of each."""
    h, doc, starts, ends = words(offsets, data, ALNUM)
    keep = ends - starts >= 3
    h, doc, starts, ends = h[keep], doc[keep], starts[keep], ends[keep]
    hashes = PrefixHash(LOWER[data])
    parts, docs = [h], [doc]
    for size in (4, 5, 6, 7):
        long_ = np.flatnonzero(ends - starts > size)
        parts.append(mix(hashes.raw(starts[long_], starts[long_] + size) + np.uint64(1000 + size)))
        docs.append(doc[long_])
    h, doc = np.concatenate(parts) >> np.uint64(64 - BITS), np.concatenate(docs)
    return distinct(h, doc)


@dataclass
class ToxicityModel:
    """A character model, and the weight of every hashed feature."""

    costs: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, offsets: np.ndarray, data: np.ndarray, restorer: Restorer) -> np.ndarray:
        n = len(offsets) - 1
        h, doc = word_features(*restorer.batch(offsets, data))
        margin = self.bias + np.bincount(doc, self.weights[h.astype(np.int64)], n)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, may_learn: Column) -> ToxicityModel:
    """A model of the labelled rows that may be learned from.

    The character model counts all documents. The scorer is a logistic regression on distinct words and
    word beginnings, fitted on at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` documents (those of least hash);
    its bias is set back to the share of toxic documents among all that may be learned from. Labels
    that are null, or not the same in all rows of a document, teach nothing. Without labels of both
    kinds every score is that share, or 0.
    """
    costs = trigram_costs(count_trigrams(docs))
    marks = labels.where(may_learn).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    marks = marks.where("toxic = most AND toxic IN (0, 1)").select(F.col("doc_id").alias("_id"), "toxic")
    marks = stored(marks.withColumn("luck", F.xxhash64("_id", F.lit(10)) / (2.0**64) + 0.5), "toxic-labels")
    counts = {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        share = float(np.clip(toxic / max(1, toxic + clean), 1e-9, 1 - 1e-9))
        return ToxicityModel(costs, np.zeros(1 << BITS), math.log(share / (1 - share)))
    shares = F.when(F.col("toxic") == 1, min(1.0, SAMPLE_TOXIC / toxic)).otherwise(min(1.0, SAMPLE_CLEAN / clean))
    # At most 14,000 ids, give or take what a hash leaves to luck.
    chosen = F.broadcast(marks.where(F.col("luck") < shares))
    sample = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(costs)
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            rows = []
            for a, z in slices(offsets):
                part = offsets[a : z + 1] - offsets[a]
                h, doc = word_features(*restorer.batch(part, data[offsets[a] : offsets[z]]))
                edges = np.searchsorted(doc, np.arange(z - a + 1))
                rows += [h[x:y].astype(np.uint32).tobytes() for x, y in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())], names=["doc_id", "toxic", "row"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, toxic long, row binary"
    read_rows = sample.withColumn("toxic", F.col("toxic").cast("long")).mapInArrow(read, schema)
    got = read_rows.dropDuplicates(["row", "toxic"]).orderBy("doc_id", "toxic", "row").select("row", "toxic").toArrow()
    offsets, data = text_buffers(got.column("row").combine_chunks())
    y = got.column("toxic").to_numpy().astype(float)
    del got
    weights, bias = _logistic(data.view(np.uint32), offsets // 4, y)
    drawn = y.mean() if 0 < y.mean() < 1 else 0.5
    bias += math.log(toxic / clean) - math.log(drawn / (1 - drawn))
    return ToxicityModel(costs, weights, bias)


def _parts(entries: np.ndarray, size: int = 1 << 20) -> Iterator[slice]:
    return (slice(a, a + size) for a in range(0, len(entries), size))


def _telling(at: np.ndarray, of: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Features that toxic documents have more often than chance: the likelihood ratio must reach ``LEAST_EVIDENCE``.

    Long texts are full of rare words, each of which may fall to a few toxic documents by luck; a word of four toxic
    documents and no other, where one in eight is toxic, is the least that counts.
    """
    n = sum((np.bincount(at[p], minlength=1 << BITS) for p in _parts(at)), np.zeros(1 << BITS))
    t = sum((np.bincount(at[p], y[of[p]], 1 << BITS) for p in _parts(at)), np.zeros(1 << BITS))
    share = t / np.maximum(n, 1)
    toxic = t * np.log(np.maximum(share, 1e-12) / y.mean())
    clean = (n - t) * np.log(np.maximum(1 - share, 1e-12) / (1 - y.mean()))
    return (share > y.mean()) & (2 * (toxic + clean) >= LEAST_EVIDENCE)


def _logistic(
    at: np.ndarray, offsets: np.ndarray, y: np.ndarray, steps: int = 600, expected: float = 2.0, penalty: float = 0.5
) -> tuple[np.ndarray, float]:
    """Logistic regression on the telling features of sparse binary rows, by Adam over all rows.

    A weight is drawn to the one ``expected`` of a feature that was chosen for telling, with the strength of a normal prior
    of variance 1/``penalty``: the same pull whatever the number of rows, so that a word seen in a few toxic documents
    is not shrunk to nothing.
    """
    weights = np.zeros(1 << BITS)
    if not 0 < y.mean() < 1:
        return weights, math.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))
    of = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(offsets))
    keep = _telling(at, of, y)[at]
    chosen, at = np.unique(at[keep], return_inverse=True)
    of = of[keep]
    w, b = np.full(len(chosen), expected), math.log(y.mean() / (1 - y.mean()))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        margin = b + np.bincount(of, w[at], len(y))
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        slope = np.append(np.bincount(at, error[of], len(w)) + penalty * (w - expected), error.sum())
        m += 0.1 * (slope - m)
        v += 0.001 * (slope**2 - v)
        move = 0.1 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w -= move[:-1]
        b -= move[-1]
    weights[chosen] = w
    return weights, float(b)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every whole text; null and empty texts have the score of no words.

    Disguised tokens (signs for letters, stretched or doubled letters, letters or pairs of them set apart) are decoded to the likeliest
    letters under the character model, and the restored text is scored. Rows that repeat each have a
    row; an empty table has none; only the two named columns are read.
    """

    return docs.select(F.col(id_col).alias("doc_id"), score_column(model)(text_col).alias("score"))


def score_column(model: ToxicityModel):
    """A function of a text column: its score."""

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restorer = Restorer(model.costs)
        for column in texts:
            offsets, data = text_buffers(column)
            parts = [np.zeros(0)]
            for a, z in slices(offsets):
                parts.append(model.scores(offsets[a : z + 1] - offsets[a], data[offsets[a] : offsets[z]], restorer))
            yield pa.array(np.concatenate(parts), pa.float64())

    return score


@query("op10_noisy_channel_toxicity")
def op10_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), in_training_part(F.col("doc_id")))
    return score_toxicity(docs, model).select(
        "doc_id",
        (~in_training_part(F.col("doc_id"))).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )
