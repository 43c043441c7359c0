"""Language identification (operator 4): multinomial naive Bayes over hashed character n-grams.

Training counts hashed 2- and 3-grams of all labelled documents per language
(one sparse count row per task, language and bucket before the shuffle) and
keeps a log-probability matrix of languages x buckets, which is broadcast.
Its size is fixed by the two parameters: `buckets` and, checked when fitting,
`max_languages`.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import unused, written

BUCKETS = 1 << 15
MAX_LANGUAGES = 256
UNKNOWN = "und"
#: A text is untypical of a language that is more than so many spreads below its labelled texts' median.
FAR = 4.5
#: Least spread of the mean log-likelihood among a language's texts.
LEAST_SPREAD = 0.3
_PAD = "   "
_NO_WORD = re.compile(r"\S*[0-9@]\S*\s*")


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def ngram_codes(texts: list[str], buckets: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Bucket codes of the 2- and 3-grams that start at each character of the lower-cased
    texts, the characters' text numbers, the texts' first characters and whether each has a letter.

    Texts are padded with three spaces, so a code depends on its own text alone.
    """
    texts = [t.lower() for t in texts]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer((_PAD.join(texts) + _PAD).encode("utf-32-le"), np.uint32)
    begin = np.cumsum(lengths + len(_PAD)) - lengths - len(_PAD)
    inside = np.ones(len(points), bool)
    for k in range(len(_PAD)):
        inside[begin + lengths + k] = False
    at = np.flatnonzero(inside)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    c0 = points * np.uint32(0x85EBCA6B)
    c1 = points * np.uint32(0xC2B2AE35)
    c2 = points * np.uint32(0x27D4EB2F)
    two = (c0[:-2] + (c1[1:-1] ^ (c1[1:-1] >> np.uint32(15)))) * np.uint32(0x9E3779B1)
    three = (two ^ (two >> np.uint32(13))) + c2[2:] * np.uint32(0x165667B1)
    three = (three ^ (three >> np.uint32(16))) * np.uint32(0x9E3779B1)
    codes = [(two >> shift)[at].astype(np.int64), (three >> shift)[at].astype(np.int64)]
    first = np.cumsum(lengths) - lengths
    letter = _letters()[points[at]]
    has = np.zeros(len(texts), bool)
    full = lengths > 0
    if full.any():
        has[full] = np.logical_or.reduceat(letter, first[full])
    return codes, np.repeat(np.arange(len(texts)), lengths), first, has


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_probs: np.ndarray  # languages x buckets
    log_priors: np.ndarray
    sums: np.ndarray | None = None  # per language, of its smoothed counts

    def likelihood(self, text: str, language: str, labelled: bool) -> tuple[float, float, int] | None:
        """Mean and variance of the log-likelihood per n-gram under a language, and the number of
        n-grams. Words with a digit or an @ (numbers, keys, addresses) are of no language and left
        out; None for a text without another letter. The counts of a text that taught the language
        (`labelled`) are taken out: it does not vouch for itself."""
        codes, _, _, has = ngram_codes([_NO_WORD.sub("", text)], self.log_probs.shape[1])
        if not has[0] or language not in self.languages:
            return None
        k = self.languages.index(language)
        seen, own = np.unique(np.concatenate(codes), return_counts=True)
        values = self.log_probs[k][seen]
        if labelled:  # n-grams across a word that is left out may be new
            left = np.maximum(np.exp(values) * self.sums[k] - own, np.exp(self.log_probs[k].min()) * self.sums[k])
            values = np.log(left) - np.log(self.sums[k] - own.sum())
        mean = float((values * own).sum() / own.sum())
        return mean, float(((values - mean) ** 2 * own).sum() / own.sum()), int(own.sum())

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its posterior probability.

        `und` with score 0 for a null text, one without a letter, or a model
        without languages. Ties: the language that sorts first.
        """
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages or not texts:
            return names, scores
        codes, _, first, has = ngram_codes([t or "" for t in texts], self.log_probs.shape[1])
        live = np.flatnonzero(has)
        if not len(live):
            return names, scores
        # texts without a letter may be empty; sums are taken from running totals, not reduceat over empty runs
        lengths = np.diff(np.append(first, len(codes[0])))
        total = np.empty((len(self.languages), len(live)))
        for i, row in enumerate(self.log_probs):
            grams = row[codes[0]] + row[codes[1]]
            full = lengths > 0
            sums = np.zeros(len(texts))
            sums[full] = np.add.reduceat(grams, first[full])
            total[i] = sums[live] + self.log_priors[i]
        best = total.argmax(axis=0)
        weight = np.exp(total - total.max(axis=0))
        scores[live] = (weight.max(axis=0) / weight.sum(axis=0))
        for i, b in zip(live.tolist(), best.tolist(), strict=True):
            names[i] = self.languages[b]
        return names, scores


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", buckets: int = BUCKETS,
        smoothing: float = 0.5, max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Counts over all rows with a text and a label; other rows teach nothing.

    More than `max_languages` different labels raise ValueError. No labelled
    row gives a model that answers `und`.
    """

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for a in range(0, batch.num_rows, 256):
                own = labels[a:a + 256]
                names = sorted(set(own))
                number = {x: i for i, x in enumerate(names)}
                codes, doc, _, _ = ngram_codes(batch.column(0).slice(a, 256).to_pylist(), buckets)
                base = np.array([number[x] for x in own])[doc] * buckets
                sums = sum(np.bincount(base + c, minlength=len(names) * buckets) for c in codes).reshape(len(names), buckets)
                for x, i in number.items():
                    mine = held.setdefault(x, np.zeros(buckets + 1, np.int64))
                    mine[:buckets] += sums[i]
                    mine[buckets] += own.count(x)  # the last bucket counts documents
        for x, c in held.items():
            hit = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(hit)), pa.array(hit.astype(np.int32)), pa.array(c[hit])],
                                             ["lang", "bucket", "n"])

    rows = labelled.select(F.col(text).alias("text"), F.col(label).alias("lang")).dropna()
    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = written(counts, "languages")
    names = sorted(r["lang"] for r in counts.select("lang").distinct().limit(max_languages + 1).collect())
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    table = np.zeros((len(names), buckets + 1))
    got = counts.toArrow()  # at most max_languages x (buckets + 1) rows
    index = {x: i for i, x in enumerate(names)}
    if got.num_rows:
        table[[index[x] for x in got["lang"].to_pylist()], got["bucket"].to_numpy()] = got["n"].to_numpy()
    grams, priors = table[:, :buckets] + smoothing, table[:, buckets]
    log_probs = np.log(grams / grams.sum(axis=1, keepdims=True)) if names else grams
    return LanguageModel(names, log_probs, np.log(priors / max(priors.sum(), 1)), grams.sum(axis=1))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", name: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of `docs`, plus the language and its score (0 to 1).

    Columns of the same two names are replaced. See `LanguageModel.predict`
    for null, empty and letterless texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in (name, score)]
    schema = docs.select(*keep).schema.add(name, "string").add(score, "double")

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text))
            names, scores = [], []
            for a in range(0, len(texts), 256):  # so many texts at a time as Python strings
                n, s = shared.value.predict(texts.slice(a, 256).to_pylist())
                names += n
                scores.append(s)
            scores = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             [*keep, name, score])

    return docs.select(*keep).mapInArrow(run, schema)


def _with_likelihood(docs: DataFrame, model: LanguageModel, text: str, label: str, language: str, name: str = "_fit") -> DataFrame:
    """All columns, plus `name` (mean, variance and number) under the column `language`; null without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    fit_type = StructType().add("mean", "double").add("variance", "double").add("n", "long")
    schema = docs.select("*").schema.add(name, fit_type)

    def run(batches):
        for batch in batches:
            found = []
            for a in range(0, batch.num_rows, 256):  # so many texts at a time as Python strings
                columns = [batch.column(names.index(c)).slice(a, 256).to_pylist() for c in (text, label, language)]
                found += [shared.value.likelihood(t, x, own == x) if t is not None and x is not None else None
                          for t, own, x in zip(*columns, strict=True)]
            fits = pa.array([None if f is None else dict(zip(("mean", "variance", "n"), f, strict=True)) for f in found],
                            pa.struct([("mean", pa.float64()), ("variance", pa.float64()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, fits], [*names, name])

    return docs.mapInArrow(run, schema)


def drop_untypical(judged: DataFrame, model: LanguageModel, language: str, text: str = "text", label: str = "lang") -> DataFrame:
    """Rows whose text is typical of the language that `predict` gave in column `language`; others and `und` go.

    Posteriors compare languages with each other and say nothing of a text in
    none of them. Here a text's mean log-likelihood per n-gram is held against
    that of the texts labelled with the language, each without its own
    counts: their median, their lower spread (from the 5 % quantile) and the
    variance of so short a text's mean. `model` must be fitted on the rows of
    `judged` with a label. A language without labelled n-grams keeps nothing.
    """
    labelled = (_with_likelihood(judged.select(F.col(text).alias("text"), F.col(label).alias("own")).dropna(), model, "text", "own", "own")
                .filter("_fit IS NOT NULL"))
    known = labelled.groupBy("own").agg(F.percentile_approx("_fit.mean", [0.05, 0.5], 10_000).alias("q"), F.avg("_fit.variance").alias("v")).collect()
    known = {r["own"]: (r["q"][1], max(LEAST_SPREAD, (r["q"][1] - r["q"][0]) / 1.645), r["v"]) for r in known}  # at most max_languages rows

    if not known:
        return judged.limit(0)

    def of(k: int) -> Column:
        pairs = F.create_map(*(F.lit(x) for name, numbers in known.items() for x in (name, float(numbers[k]))))
        return F.try_element_at(pairs, F.col(language))

    # neighbouring n-grams overlap: four of them count as one
    fit = unused(judged, "_fit")[0]
    spread = F.sqrt(F.pow(of(1), 2) + of(2) * 4 / F.col(f"{fit}.n"))
    fits = _with_likelihood(judged, model, text, label, language, fit)
    return fits.filter(F.col(f"{fit}.mean") >= of(0) - FAR * spread).select(*judged.columns)
