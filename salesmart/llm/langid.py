"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a language label.  A word's score for a language sums
learned weights of its features (affixes, character n-grams, membership in a
language's lexicon); learned transitions between neighbouring labels let the
labels of code-switched text change where the words say so.  Forward-backward
gives each word's label distribution; a text's distribution is their mean.

Training reads a bounded sample of labelled rows (``Sample``); everything else,
prediction included, covers every word of every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

_WORDS = re.compile(r"[^\W\d_]+").findall
UNKNOWN = "und"


def WORDS(text: str) -> list[str]:
    """Runs of letters; numerals and other signs that are no letters (``½``, ``²``, ``Ⅷ``) divide them."""
    words = _WORDS(text)
    if text.isascii() or all(map(str.isalpha, words)):
        return words
    return [w for word in words for w in "".join(c if c.isalpha() else " " for c in word).split()]


@dataclass(frozen=True)
class Sample:
    """The rows that training may read: for each language at most ``rows`` texts of at most ``chars`` characters, by id hash."""

    rows: int = 150
    chars: int = 20_000
    languages: int = 200


@dataclass(frozen=True)
class Training:
    buckets: int = 1 << 16  # of hashed features
    lexicon: int = 500  # frequent words per language
    share: float = 0.8  # of a word's uses that a lexicon's language must have
    span: int = 24  # words per training sequence
    switched: float = 0.3  # of the sequences change language inside
    words: int = 600  # training words per text, drawn as whole spans
    epochs: int = 4
    batch: int = 128
    rate: float = 0.2
    decay: float = 1e-6
    seed: int = 7


@dataclass
class Crf:
    languages: list[str]
    weight: np.ndarray  # (buckets + languages, languages): hashed features, then lexicon membership
    step: np.ndarray  # (languages, languages): from, to
    start: np.ndarray
    lexicon: dict[str, int]  # word -> language number

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return word_features(words, len(self.weight) - len(self.languages), self.lexicon)


def word_features(words: list[str], buckets: int, lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, where each word's begin): n-grams of 2 and 3 letters of the word between two marks,
    which include the affixes of 1 and 2, the affixes of 3 and, last, the lexicon that has the word."""
    lowered = [w.lower() for w in words]
    text = "".join([f"\x02{w}\x03" for w in lowered])
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    of = np.cumsum(code == 2) - 1
    ids, owners = [], []
    for n in (2, 3, 4):
        if len(code) < n:
            continue
        at = np.arange(len(code) - n + 1)
        whole = of[at] == of[at + n - 1]
        if n == 4:
            whole &= (code[at] == 2) | (code[at + 3] == 3)
        at = at[whole]
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + code[at + k]
        h ^= h >> np.uint64(29)
        ids.append(((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.int64) % buckets)
        owners.append(of[at])
    known = [(k, buckets + lexicon[w]) for k, w in enumerate(lowered) if w in lexicon]
    ids.append(np.array([f for _, f in known], np.int64))
    owners.append(np.array([k for k, _ in known], np.int64))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(ids)[order], np.searchsorted(owner[order], np.arange(len(words)))


def training_rows(df: DataFrame, id_col: str, text_col: str, label_col: str, usable: Column, sample: Sample) -> list[tuple[str, str]]:
    """(text, language) of the sample: the rows with the smallest id hashes of each language, within ``Sample``.

    Equal rows count once.  A language with longer texts only is learned from their beginnings; more languages than
    ``Sample`` allows are an error."""
    text = F.col(text_col)
    rows = df.where(usable & F.col(label_col).isNotNull() & text.isNotNull()).select(
        F.col(label_col).alias("lang"), F.col(id_col).cast("string").alias("id"), text.alias("text"), F.xxhash64(F.col(id_col).cast("string"), text, label_col).alias("key")
    )
    # Ranked without the texts, repeated rows once; a partial rank runs before the shuffle.
    keyed = rows.select("lang", "id", "key", (F.length("text") > sample.chars).alias("long")).distinct().withColumn("h", F.xxhash64("id"))
    ranked = keyed.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("long", "h", "id", "key"))).where(F.col("nth") <= sample.rows)
    chosen = ranked.groupBy("lang").agg(F.collect_list(F.struct("long", "key")).alias("rows")).limit(sample.languages + 1).collect()
    if len(chosen) > sample.languages:
        raise ValueError(f"labels of more than {sample.languages} languages: raise Sample.languages to learn them all")
    keys = sorted({r["key"] for c in chosen for r in c["rows"] if not r["long"] or all(x["long"] for x in c["rows"])})
    found = rows.where(F.col("key").isin(keys)).groupBy("lang", "key").agg(F.first("id").alias("id"), F.first(F.substring("text", 1, sample.chars)).alias("text"))
    return [(r["text"], r["lang"]) for r in sorted(found.collect(), key=lambda r: (str(r["lang"]), str(r["id"]), r["text"]))]


def train(rows: list[tuple[str, str]], how: Training = Training()) -> Crf:
    """Fit the field on labelled texts: each word has its text's label, some sequences are spliced from two languages."""
    rng = np.random.default_rng(how.seed)
    languages = sorted({lang for _, lang in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    spans: list[tuple[list[str], int]] = []
    counts: dict[str, np.ndarray] = {}
    for text, lang in rows:
        words = WORDS(text)
        for w in words:
            counts.setdefault(w.lower(), np.zeros(len(languages)))[number[lang]] += 1
        cut = [words[i : i + how.span] for i in range(0, len(words), how.span)]
        order = rng.permutation(len(cut))[: how.words // how.span]
        spans += [(cut[i], number[lang]) for i in order]
    lexicon: dict[str, int] = {}
    for i in range(len(languages)):
        own = sorted((w for w, c in counts.items() if c[i] >= 3 and c[i] >= how.share * c.sum()), key=lambda w: (-counts[w][i], w))
        lexicon.update(dict.fromkeys(own[: how.lexicon], i))
    crf = Crf(languages, np.zeros((how.buckets + len(languages), len(languages))), np.zeros((len(languages),) * 2), np.zeros(len(languages)), lexicon)
    if not spans:
        return crf
    # Sequences: a span, or the halves of two spans.
    sequences = []
    for k in rng.permutation(len(spans)):
        words, lang = spans[k]
        if rng.random() < how.switched:
            other, lang2 = spans[rng.integers(len(spans))]
            a, b = rng.integers(len(words) + 1), rng.integers(len(other) + 1)
            sequences.append((words[:a] + other[b:], [lang] * a + [lang2] * (len(other) - b)))
        else:
            sequences.append((words, [lang] * len(words)))
    sequences = [s for s in sequences if s[0]]
    numbers = {w: i for i, w in enumerate(sorted({w for words, _ in sequences for w in words}))}
    features = crf.features(list(numbers))
    sequences = [([numbers[w] for w in words], labels) for words, labels in sequences]
    squares = [np.full_like(a, 1e-8) for a in (crf.weight, crf.step, crf.start)]
    for _ in range(how.epochs):
        order = rng.permutation(len(sequences))
        for at in range(0, len(order), how.batch):
            _fit(crf, [sequences[i] for i in order[at : at + how.batch]], features, squares, how)
    return crf


def _fit(crf: Crf, batch: list, features: tuple[np.ndarray, np.ndarray], squares: list[np.ndarray], how: Training) -> None:
    """One AdaGrad step on the log-likelihood of a batch."""
    size, most, n = len(batch), max(len(w) for w, _ in batch), len(crf.languages)
    flat = np.array([w for words, _ in batch for w in words])
    begin = features[1][flat]
    count = np.append(features[1], len(features[0]))[flat + 1] - begin
    of = np.repeat(np.arange(len(flat)), count)
    ids = features[0][np.repeat(begin - np.cumsum(count) + count, count) + np.arange(len(of))]
    scores = np.zeros((len(flat), n))
    np.add.at(scores, of, crf.weight[ids])
    lengths = np.array([len(w) for w, _ in batch])
    inside = np.arange(most)[None, :] < lengths[:, None]
    emit = np.zeros((size, most, n))
    emit[inside] = scores
    gold = np.zeros((size, most), np.int64)
    gold[inside] = [y for _, ys in batch for y in ys]
    marginal, pair = posteriors(emit, lengths, crf.step, crf.start, pairs=True)
    error = -marginal
    error[np.arange(size)[:, None], np.arange(most)[None, :], gold] += 1
    gradient = np.zeros_like(crf.weight)
    np.add.at(gradient, ids, error[inside][of])
    step = -pair
    both = inside[:, 1:] & inside[:, :-1]
    np.add.at(step, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    start = error[:, 0].sum(axis=0)
    for value, grad, square in zip((crf.weight, crf.step, crf.start), (gradient, step, start), squares, strict=True):
        grad = grad / size - how.decay * value
        square += grad * grad
        value += how.rate * grad / np.sqrt(square)


def posteriors(emit: np.ndarray, lengths: np.ndarray, step: np.ndarray, start: np.ndarray, pairs: bool = False, sums: bool = False):
    """Forward-backward over sequences (sequence, word, label) of scores.

    Returns each word's label distribution (0 beyond a sequence's end) or, with
    ``sums``, their sum over each sequence, and, if asked, the expected number of
    label pairs.
    """
    size, most, n = emit.shape
    order = np.argsort(-lengths, kind="stable")
    e, long = emit[order], lengths[order]
    e -= e.max(axis=2, keepdims=True)
    np.exp(e, out=e)
    move = np.exp(step - step.max()).astype(e.dtype)
    live = np.searchsorted(-long, -np.arange(most), side="left")  # sequences longer than t
    ahead = np.zeros_like(e)
    now = e[:, 0] * np.exp(start - start.max()).astype(e.dtype)
    now /= now.sum(axis=1, keepdims=True)
    ahead[:, 0] = now
    for t in range(1, most):
        k = live[t]
        now = (now[:k] @ move) * e[:k, t]
        now /= now.sum(axis=1, keepdims=True)
        ahead[:k, t] = now
    result = np.zeros((size, n) if sums else (size, most, n))
    total = np.zeros((n, n))
    back = np.ones((size, n), e.dtype)
    for t in range(most - 1, -1, -1):
        k = live[t]
        if t + 1 < most and live[t + 1]:
            m = live[t + 1]
            after = back[:m] * e[:m, t + 1]
            if pairs:
                joint = ahead[:m, t, :, None] * move[None] * after[:, None, :]
                total += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            came = after @ move.T
            back[:m] = came / came.sum(axis=1, keepdims=True)
        both = ahead[:k, t] * back[:k]
        both /= both.sum(axis=1, keepdims=True)
        if sums:
            result[:k] += both
        else:
            result[:k, t] = both
    unsorted = np.empty_like(result)
    unsorted[order] = result
    return unsorted, total


class _Numbers(dict):
    """Numbers of words in the order they are first seen; ``new`` lists those without a score."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


CELLS = 1 << 20  # words of one forward-backward run


class Tagger:
    """Label distributions of texts; word scores are kept in a table of bounded size."""

    def __init__(self, crf: Crf, known: int = 300_000):
        self.crf, self.known = crf, known
        self._forget()

    def _forget(self) -> None:
        self._numbers = _Numbers()
        self._scores = np.zeros((1024, len(self.crf.languages)), np.float32)

    def word_scores(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The scores of the words of each text, by language."""
        numbered = [np.fromiter(map(self._numbers.__getitem__, words), np.int64, len(words)) for words in texts]
        new, self._numbers.new = self._numbers.new, []
        first = len(self._numbers) - len(new)
        if len(self._numbers) > len(self._scores):
            self._scores = np.resize(self._scores, (2 * len(self._numbers), self._scores.shape[1]))
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            ids, begin = self.crf.features(part)
            self._scores[first + at : first + at + len(part)] = np.add.reduceat(self.crf.weight[ids], begin, axis=0)
        scores = [self._scores[numbers] for numbers in numbered]
        if len(self._numbers) > self.known:
            self._forget()
        return scores

    def mean_labels(self, texts: list[str]) -> list[np.ndarray | None]:
        """The mean label distribution of each text; None where there is no word or nothing was learned."""
        out: list[np.ndarray | None] = [None] * len(texts)
        if not self.crf.languages:
            return out
        worded = [(i, words) for i, t in enumerate(texts) if (words := WORDS(t))]
        scored = [(i, s) for (i, _), s in zip(worded, self.word_scores([w for _, w in worded]), strict=True)]
        scored.sort(key=lambda x: len(x[1]))
        at = 0
        while at < len(scored):  # texts of similar length go together, within a bounded number of cells
            upto = at
            while upto < len(scored) and (upto == at or len(scored[upto][1]) * (upto - at + 1) <= CELLS):
                upto += 1
            part = scored[at:upto]
            lengths = np.array([len(s) for _, s in part])
            emit = np.zeros((len(part), int(lengths.max()), len(self.crf.languages)), np.float32)
            for row, (_, s) in zip(emit, part, strict=True):
                row[: len(s)] = s
            total, _ = posteriors(emit, lengths, self.crf.step, self.crf.start, sums=True)
            for (i, _), row, n in zip(part, total, lengths, strict=True):
                out[i] = row / n
            at = upto
        return out


_TAGGERS: dict[str, Tagger] = {}  # the model in use, one per Python worker


def predict_udf(spark, crf: Crf):
    """Column function: text to (lang_pred, score)."""
    shared = spark.sparkContext.broadcast(crf)  # buckets x languages weights: a fixed size
    name = f"{shared._jbroadcast.id()}"

    @arrow_udf("lang_pred string, score double")
    def predicted(texts: pa.Array) -> pa.Array:
        if name not in _TAGGERS:
            _TAGGERS.clear()
            _TAGGERS[name] = Tagger(shared.value)
        tagger = _TAGGERS[name]
        labels, scores = [], []
        for at in range(0, len(texts), 4096):
            for mean in tagger.mean_labels([t.as_py() or "" for t in texts[at : at + 4096]]):
                if mean is None:
                    labels.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    best = int(mean.argmax())
                    labels.append(tagger.crf.languages[best])
                    scores.append(min(1.0, float(mean[best])))
        return pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predicted


def identify(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", held_out: Column | None = None, sample: Sample = Sample(), training: Training = Training()
) -> DataFrame:
    """One row per row of ``df``: id, held_out, lang_pred and score (mean probability of the label).

    The field learns from text and label of rows that are not ``held_out``
    (default: crc32 of the id as text, mod 4, is 2; false for a null id) and
    whose label is not null; predictions use the text alone.  A null text, or
    one without a letter, gives ``und`` with score 0, as do all texts where no
    row can be learned from.  Every word of a text of any length counts; of
    equally likely languages the first by name is told.  Rows repeat as they
    come; other columns are not read; an empty table gives an empty result.
    """
    if held_out is None:
        held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    crf = train(training_rows(df, id_col, text_col, label_col, ~held_out, sample), training)
    rows = df.select(F.col(id_col), held_out.alias("held_out"), predict_udf(df.sparkSession, crf)(F.col(text_col)).alias("_p"))
    return rows.select(id_col, "held_out", "_p.*")
