"""Language identification by word-first backoff.

A known word adds its log frequency in every learned language. An unknown word
falls back to its character n-grams, longest first: the first length with a
known n-gram decides, down to single characters.

Words of a text are no independent witnesses, so their summed evidence counts as
that of ``witnesses`` words at most: the score of a long text stays a probability
one can rank by instead of running into 1.

Defined results: null texts and texts without a letter are ``und`` with score 0;
ties go to the language first in order of name; repeated rows are judged each;
with nothing to learn from, every text is ``und``. Only the named columns are
read, so other columns may have any name.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.styles import small
from .common import arrow_map, arrow_schema, batch_of, held_out, id_and_text, learnable, slices, words_of, written


@dataclass(frozen=True)
class Backoff:
    """``sample_rows`` and ``sample_bytes`` bound the labelled rows learned from, in expectation: equal shares of them go to each language.

    All words of the sample are known, and all their n-grams, so these bounds
    also bound what is broadcast. A worker remembers words of texts up to
    ``remembered`` numbers, one a word and language.
    """

    sample_rows: int = 20_000
    sample_bytes: int = 64 << 20
    longest: int = 5
    witnesses: int = 20
    remembered: int = 4_000_000


def grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass(frozen=True)
class Model:
    """Languages in order of name, and log frequencies by word and by n-gram: a row an entry, a column a language."""

    langs: list[str]
    words: list[str]
    word_rows: np.ndarray
    grams: list[str]
    gram_rows: np.ndarray

    @staticmethod
    def of(lang: np.ndarray, entry: np.ndarray, n: np.ndarray) -> Model:
        """From counts (language, entry, n): words as they are, n-grams behind a tab."""
        langs, at = np.unique(lang.astype(str), return_inverse=True) if len(lang) else (np.zeros(0, str), np.zeros(0, int))
        gram = np.array([e[:1] == "\t" for e in entry], bool)
        made = []
        for which, cut in ((~gram, 0), (gram, 1)):
            names, row = np.unique(np.array([e[cut:] for e in entry[which]], object), return_inverse=True) if which.any() else (np.zeros(0,
                object), np.zeros(0, int))
            counts = np.zeros((len(names), len(langs)))
            np.add.at(counts, (row, at[which]), n[which])
            made += [names.tolist(), np.log(counts + 0.5) - np.log(counts.sum(axis=0) + 0.5 * max(1, len(names)))]
        return Model(langs.tolist(), *made)


def sample(docs: DataFrame, p: Backoff = Backoff(), lang_col: str = "lang") -> DataFrame:
    """(lang, text) of labelled rows, the same ones every time: of each language those whose hash is within its share of the bounds.

    A language of few rows keeps all of them, however many rows others have. No
    rows are gathered for it: sizes are counted by language, and a row decides by
    its own hash.
    """
    columns = {"doc_id": "long", "text": "string", lang_col: "string"}
    rows = docs.select(*[F.col(c).cast(t).alias("lang" if c == lang_col else c) for c, t in columns.items()])
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & learnable())
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")), "sizes")
    languages = max(1, sizes.count())
    share = F.least(F.lit(1.0), F.lit(p.sample_rows / languages) / F.col("n"), F.lit(p.sample_bytes / languages) / F.greatest("bytes", F.lit(1)))
    shares = small(sizes.select(F.col("lang").alias("of"), share.alias("share")))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(1 << 30)
    return rows.join(shares, F.col("lang") == F.col("of")).filter(place < F.col("share")).select("lang", "text")


def fit(docs: DataFrame, p: Backoff = Backoff(), lang_col: str = "lang") -> Model:
    """Counts of all words of the sample and of their n-grams, by language."""
    out = arrow_schema(lang=pa.string(), entry=pa.string(), n=pa.int64())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for b in slices(batches):
            for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True):
                counts.setdefault(lang, Counter()).update(w for w in words_of(text) if not w.isdigit())
        for lang, words in counts.items():
            yield batch_of(out, [lang] * len(words), [w.decode("utf-8", "replace") for w in words], list(words.values()))

    counts = arrow_map(sample(docs, p, lang_col), counted, "lang string, entry string, n long")
    words = written(counts.groupBy("lang", "entry").agg(F.sum("n").alias("n")), "words")
    padded = F.concat(F.lit("^"), "entry", F.lit("$"))
    places = lambda n: F.sequence(F.lit(1), F.length(padded) - n + 1)
    cut = lambda n: F.when(F.length(padded) >= n, F.transform(places(n), lambda i: F.substring(padded, i, n)))
    every = F.flatten(F.filter(F.array(*[cut(n) for n in range(1, p.longest + 1)]), lambda a: a.isNotNull()))
    found = words.select("lang", "n", F.explode(every).alias("entry")).groupBy("lang", "entry").agg(F.sum("n").alias("n"))
    table = words.unionByName(found.withColumn("entry", F.concat(F.lit("\t"), "entry"))).toArrow()
    return Model.of(*(table[c].to_numpy() for c in ("lang", "entry", "n")))


class Scorer:
    def __init__(self, m: Model, p: Backoff):
        self.langs, self.p, self.m = m.langs, p, m
        self.words, self.grams = ({name: i for i, name in enumerate(names)} for names in (m.words, m.grams))
        self.at: dict[bytes, int] = {}
        self.rows = np.zeros((p.remembered // max(1, len(self.langs)), len(self.langs)))

    def word(self, word: str) -> np.ndarray:
        """Log frequency of a word in each language, by backoff where it is unknown."""
        if (known := self.words.get(word)) is not None:
            return self.m.word_rows[known]
        for n in range(min(self.p.longest, len(word) + 2), 0, -1):
            found = [i for g in grams(word, n) if (i := self.grams.get(g)) is not None]
            if found:
                return self.m.gram_rows[found].mean(axis=0)
        return np.zeros(len(self.langs))

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0
        words = [w for w in words_of(text) if not w.isdigit()]
        distinct = set(words)
        if len(self.at) + len(distinct) > len(self.rows):
            self.at.clear()
            if len(distinct) > len(self.rows):
                self.rows = np.zeros((2 * len(distinct), len(self.langs)))
        for w in distinct.difference(self.at):
            self.rows[len(self.at)] = self.word(w.decode("utf-8", "replace"))
            self.at[w] = len(self.at)
        sums = self.rows[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))].sum(axis=0) * min(1.0,
            self.p.witnesses / max(1, len(words)))
        best = int(sums.argmax())
        return self.langs[best], float(1 / np.exp(sums - sums[best]).sum())


_SCORERS: dict[str, Scorer] = {}


def _scorer(name: str, shared: Broadcast, p: Backoff) -> Scorer:
    """The scorer of a model, made once a worker."""
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = Scorer(shared.value, p)
    return _SCORERS[name]


def identify(docs: DataFrame, model: Model, p: Backoff = Backoff()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every whole text."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    out = arrow_schema(doc_id=pa.int64(), lang_pred=pa.string(), score=pa.float64())

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(name, shared, p)
        for b in slices(batches):
            found = list(map(scorer, b["text"].to_pylist()))
            yield batch_of(out, b["doc_id"], [x[0] for x in found], [x[1] for x in found])

    return arrow_map(id_and_text(docs), judged, "doc_id long, lang_pred string, score double").select("doc_id",
        held_out().alias("held_out"), "lang_pred", "score")


def language(docs: DataFrame, p: Backoff = Backoff()) -> DataFrame:
    return identify(docs, fit(docs, p), p)
