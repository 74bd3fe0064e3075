"""Toxicity by a weighted lexicon.

Texts are folded (look-alike letters, digits that stand for letters, accents of disguise), matched
against all lexicon terms at once by an Aho-Corasick automaton, and the summed weights are
normalised by the number of words. Exception phrases cancel the terms they contain.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Staging

# Letters of other scripts that look like Latin ones, and digits that stand for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ʟ": "l",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s"}
#: Terms known beforehand with their weights; what labels teach is added to them.
SEED_TERMS = {"idiot": 1.0, "moron": 1.0, "scum": 1.0, "loser": 0.8, "stupid": 0.8, "worthless": 0.7, "pathetic": 0.7, "disgusting": 0.7}
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "pathetic fallacy", "pond scum", "sore loser")

#: Labelled rows the lexicon is learned from at most (those with the smallest hashes of their ids).
MAX_LABELLED = 20_000
#: Terms learned at most, and the least log-likelihood ratio of a term.
MAX_TERMS = 4_000
LEAST_EVIDENCE = 20.0
#: Least log-odds of a term, and the log-odds that weigh 1.
LEAST_ODDS = 1.5
FULL_ODDS = 4.0
#: Lengths of word beginnings that may become terms.
STEMS = (5, 6)
#: Texts whose features a Python worker holds at once.
TAUGHT_ROWS = 64
#: Words added to every length, so that a very short text needs more than its first match.
PRIOR_WORDS = 8
#: The score at which a text counts as toxic.
CUT = 0.7

_SPECIAL = str.maketrans(LOOK_ALIKES | DIGITS)
_BETWEEN = re.compile(r"(?<=[^\W\d_])[@$](?=[^\W\d_])")
_OTHER = re.compile(r"[\W_]+")
# Starts at a whole run of digits and never gives one back, so that long runs are read once.
_MIXED = re.compile(r"(?<![0-9])[0-9]*+[^\W\d_]\w*")


def fold(text: str) -> str:
    """Words in one plain form, single spaces around each; digits fold only inside words that have letters."""
    text = unicodedata.normalize("NFKC", text).lower()
    if "@" in text or "$" in text:
        text = _BETWEEN.sub(lambda m: SIGNS[m[0]], text)
    if any(d in text for d in "01345789"):
        text = _MIXED.sub(lambda m: m[0].translate(_SPECIAL), text)
    elif not text.isascii():
        text = text.translate(_SPECIAL)
    return f" {_OTHER.sub(' ', text).strip()} "


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights; a term is matched at a word's start, and to its end if it closes with a space."""

    terms: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: Weight per word that scores ``CUT``.
    middle: float = 0.005
    _automaton: list = field(default_factory=list, repr=False, compare=False)

    def rate(self, text: str | None) -> float:
        """Summed weights of the matches outside exceptions, per word."""
        import ahocorasick

        if not text:
            return 0.0
        if not self._automaton:
            built = ahocorasick.Automaton()
            for term, weight in self.terms.items():
                built.add_word(f" {term}", (len(term), weight))
            for phrase in self.exceptions:
                built.add_word(f" {phrase} ", (len(phrase) + 1, None))
            built.make_automaton()
            self._automaton.append(built)
        folded = fold(text)
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (length, weight) in self._automaton[0].iter(folded):
            start = end - length + 1
            if weight is None:
                spared.append((start, end))
            else:  # a word counts once, with its heaviest term
                best[start] = max(weight, best.get(start, 0.0))
        if spared:
            best = {s: w for s, w in best.items() if not any(a <= s <= b for a, b in spared)}
        return sum(best.values()) / (folded.count(" ") - 1 + PRIOR_WORDS) if best else 0.0

    def score(self, text: str | None) -> float:
        """0 to 1; ``CUT`` at ``middle``. Texts without matches, empty or NULL ones have 0."""
        rate = self.rate(text)
        return rate / (rate + self.middle * (1 - CUT) / CUT) if rate else 0.0


def features(text: str) -> set[str]:
    """What a text may teach: its folded words and their beginnings."""
    words = set(fold(text).split())
    return {f"{w} " for w in words if len(w) > 1} | {w[:n] for n in STEMS for w in words if len(w) > n}


def _taught(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(term, toxic)`` for each feature of each text, of a few texts at once: a worker's memory outlasts its task."""
    for batch in batches:
        for at in range(0, batch.num_rows, TAUGHT_ROWS):
            part = batch.slice(at, TAUGHT_ROWS)
            rows = [(term, toxic) for t, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for term in features(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], type=pa.string()), pa.array([r[1] for r in rows], type=pa.int32())], names=["term", "toxic"]
            )


def learn(
    documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, key: str = "doc_id", text: str = "text"
) -> Lexicon:
    """A lexicon from ``labels(key, toxic)``.

    A stated bound: of the labelled documents at most about ``max_labelled`` are read, those with
    the smallest hashes of their ids; their ids are the only rows that are broadcast. NULL ids and
    labels are ignored, of contradicting labels the larger holds, texts that repeat count once.
    Without labels (or with one class only) the seed terms and the default middle are used.
    """
    staging = Staging(documents.sparkSession)
    known = labels.where(f"{key} IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col(key).alias("k")).agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("ord", F.expr("pmod(xxhash64(k), 1000000)"))
    share = math.ceil(1_000_000 * min(1.0, max_labelled / max(1, known.count())))
    sample = known.where(f"ord < {share}").select("k", F.expr("CAST(toxic >= 1 AS INT) AS toxic"))
    rows = documents.where(f"length({text}) > 0").select(F.col(key).alias("k"), F.col(text).alias("t"))
    rows = rows.join(F.broadcast(sample), "k").withColumn("h", F.expr("xxhash64(t)")).dropDuplicates(["h"])
    texts = staging.keep(rows.select("t", "toxic"), "labelled")
    all_n, all_toxic = texts.selectExpr("count(1)", "coalesce(sum(toxic), 0)").first()
    seeds = {f"{t} ": w for t, w in SEED_TERMS.items()}
    if not all_toxic or all_toxic == all_n:
        return Lexicon(seeds)

    counts = texts.mapInArrow(_taught, "term string, toxic int").groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("y")
    )
    # Log-likelihood ratio of a term's share among toxic texts against its share among all.
    rate, n0 = all_toxic / all_n, all_n - all_toxic
    cells = (("y", f"n * {rate}"), ("(n - y)", f"n * {1 - rate}"), (f"({all_toxic} - y)", f"({all_n} - n) * {rate}"), (f"({n0} - n + y)", f"({all_n} - n) * {1 - rate}"))
    ratio = " + ".join(f"(CASE WHEN {o} > 0 THEN {o} * ln({o} / ({e})) ELSE 0 END)" for o, e in cells)
    odds = f"ln((y + 0.5) / (n - y + 0.5) * {(n0 + 1) / (all_toxic + 1)})"
    strong = counts.where("y >= 3").selectExpr("term", f"2 * ({ratio}) AS evidence", f"{odds} AS odds")
    strong = strong.where(f"evidence >= {LEAST_EVIDENCE} AND odds >= {LEAST_ODDS}")
    terms = {r["term"]: min(1.0, r["odds"] / FULL_ODDS) for r in strong.orderBy(F.desc("evidence"), "term").limit(MAX_TERMS).collect()}
    lexicon = Lexicon({**seeds, **terms})

    @F.pandas_udf("double")
    def rated(t: pd.Series) -> pd.Series:
        return t.map(lexicon.rate)

    return Lexicon(lexicon.terms, middle=_middle([(r[0], r[1]) for r in texts.select(rated("t"), "toxic").collect()]))


def _middle(rated: list[tuple[float, int]]) -> float:
    """The rate that parts toxic from clean texts with the fewest errors; the middle of the best gap, in logarithms."""
    rated = sorted(rated)
    errors, best, ends = sum(1 - y for _, y in rated), None, []
    for i, (rate, y) in enumerate(rated):  # texts from i on count as toxic
        if rate > 0 and (i == 0 or rated[i - 1][0] < rate):
            if best is None or errors < best:
                best, ends = errors, []
            if errors == best:
                ends.append((max(rated[i - 1][0] if i else 0.0, 1e-4), rate))
        errors += 1 if y else -1
    if not ends:
        return Lexicon.middle
    low, high = max(ends, key=lambda e: e[1] / e[0])
    return max(1e-4, math.sqrt(low * max(high, low)))


def score_toxicity(documents: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score, predicted)`` for every row of ``documents``, from its whole text.

    NULL and empty texts and texts without a term score 0. Repeated rows score alike, NULL keys are
    kept, other columns are not read; an empty table gives no rows.
    """

    @F.pandas_udf("double")
    def scored(t: pd.Series) -> pd.Series:
        return t.map(lexicon.score).astype("float64")

    rows = documents.select(F.col(key), scored(F.coalesce(F.col(text), F.lit(""))).alias("score"))
    return rows.select(key, "score", F.expr(f"CAST(score >= {CUT} AS INT)").alias("predicted"))


def drop_toxic(documents: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Rows whose text scores below ``CUT``, columns unchanged."""

    @F.pandas_udf("boolean")
    def clean(t: pd.Series) -> pd.Series:
        return t.map(lambda x: lexicon.score(x) < CUT).astype("bool")

    return documents.where(clean(F.coalesce(F.col(text), F.lit(""))))
