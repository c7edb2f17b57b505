"""Reading level of documents.

Boosted regression trees over distributions of length (words, sentences), vocabulary (how hard the words
and word pairs of a sentence are, learned from the graded passages), syntax (commas, subordinate and
passive marks, address of the reader) and cohesion (words shared by neighbouring sentences). Predictions
are calibrated: cut points between levels are placed where out-of-fold predictions agree best with the
given levels. ``profile`` reports levels by source.

The model is fitted on the driver on at most ``Settings.sample`` graded passages and is broadcast.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Boosted
from tidemark.llm.sampling import sample_rows

#: Frequent function words of English; their share tells running English from other languages and lists.
FUNCTION_WORDS = set("the of and to a in is for that on it with be are as by or at this which not from an was will you if we can has have".split())
_SUBORDINATE = set("although because since unless whereas while whether albeit notwithstanding insofar irrespective whereupon thereby lest if when where which that who whom whose provided".split())
_ADDRESS = {"you", "your", "we", "us", "our"}
_VOWELS = re.compile(r"[aeiouy]+")
_CONNECT = set("however therefore moreover thus hence accordingly consequently furthermore nevertheless also then but and so first next finally".split())
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_THREE_WORDS = re.compile(r"(?:[^\W\d_]+[^\w]+[\W\d_]*){2}[^\W\d_]")
_BULLET = re.compile(r"^\s*(?:[•*–-]|\(?\d{1,3}[.)]|\(?[a-z][.)])\s+")
_DIGIT = re.compile(r"\d")
_END = re.compile(r"(?<=[.!?])[\"'”’)]*\s+|(?<=[.!?])$")


@dataclass(frozen=True)
class Settings:
    """``sample``: most graded passages fitted on; ``folds``: parts for out-of-fold predictions;
    ``least_words``: shortest text graded; ``english``: least share of function words."""

    sample: int = 5_000
    folds: int = 5
    least_words: int = 40
    english: float = 0.13


def sentences_of(text: str) -> list[list[str]]:
    """Sentences as lower-case words. Broken lines are joined, items of a list are sentences of their own,
    page furniture (short lines without an ending, figures) is left out."""
    blocks: list[str] = []
    open_block = False
    lines = text.lower().replace("&", " and ").replace("’", "'").split("\n")
    width = 0.6 * max(map(len, lines), default=0)
    for line in lines:
        bare = line.strip()
        if not bare:
            open_block = False
            continue
        body, items = _BULLET.subn("", line, 1)
        body = body.strip()
        if items or not open_block:
            if _THREE_WORDS.search(body) and len(_DIGIT.findall(body)) * 4 < len(body):
                blocks.append(body)
                open_block = not items
        else:
            blocks[-1] += " " + body
        # a line that ends a sentence well short of the margin ends its block
        if open_block and len(line) < width and bare[-1] in ".!?":
            open_block = False
    out = []
    for block in blocks:
        for part in _END.split(block):
            words = _WORD.findall(part)
            if len(words) >= 3:
                out.append(words)
    return out


def is_english(sentences: list[list[str]], settings: Settings) -> bool:
    """Whether sentences are running English, by the share of function words among ten words or more."""
    size = sum(map(len, sentences))
    return size >= 10 and sum(sum(map(FUNCTION_WORDS.__contains__, s)) for s in sentences) >= settings.english * size


def terms(words: list[str]) -> list[str]:
    """Words and pairs of neighbours, with the sentence's start marked."""
    return words + [f"{a} {b}" for a, b in zip(["^", *words], words)]


@dataclass
class Vocabulary:
    """Log odds of the levels by term; ``seen`` keeps the terms of sentences met again and again."""

    index: dict[str, int]
    odds: np.ndarray
    seen: dict[tuple[str, ...], list[int]] = field(default_factory=dict)

    def known(self, words: list[str]) -> list[int]:
        """Numbers of a sentence's distinct terms that have odds."""
        key = tuple(words)
        found = self.seen.get(key)
        if found is None:
            index = self.index
            found = [index[t] for t in dict.fromkeys(terms(words)) if t in index]
            if len(self.seen) > 50_000:
                self.seen.clear()
            self.seen[key] = found
        return found


def _grades(passages: list[list[list[str]]], levels: np.ndarray) -> Vocabulary:
    """Log odds of each level for each term, from how often it stands in sentences of passages of a level.

    Passages hold sentences of other levels too, so sentences are weighed again by the level they
    themselves look like, three times over.
    """
    kinds = sorted(set(levels.tolist()))
    rows = [(s, kinds.index(int(y))) for p, y in zip(passages, levels) for s in p]
    soft = np.zeros((len(rows), len(kinds)))
    soft[np.arange(len(rows)), [k for _, k in rows]] = 1
    table: dict[str, np.ndarray] = {}
    for turn in range(4):
        counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(kinds)))
        for (words, _), weight in zip(rows, soft):
            for t in dict.fromkeys(terms(words)):
                counts[t] += weight
        size = soft.sum(axis=0)
        table = {}
        for t, c in counts.items():
            if c.sum() >= 2:
                p = (c + 0.25) / (size + 1)
                table[t] = np.log(p) - np.log(p).mean()
        if turn == 3:
            break
        for i, (words, k) in enumerate(rows):
            near = [table[t] for t in dict.fromkeys(terms(words)) if t in table]
            logit = (np.sum(near, axis=0) if near else np.zeros(len(kinds))) * 0.5
            logit[k] += 1.5
            e = np.exp(logit - logit.max())
            soft[i] = e / e.sum()
    return Vocabulary({t: i for i, t in enumerate(table)}, np.array(list(table.values())).reshape(len(table), len(kinds)))


def _measures(word: str) -> tuple[float, ...]:
    """Length, syllables, long, very long, subordinator, connective, address, abstract noun, past form."""
    syllables = max(1, len(_VOWELS.findall(word)) - (word.endswith("e") and not word.endswith("le")))
    return (
        len(word), syllables, syllables >= 3, syllables >= 5, word in _SUBORDINATE, word in _CONNECT, word in _ADDRESS,
        word.endswith(("tion", "ment", "ity", "ance", "ence")), word.endswith("ed"),
    )


class Words:
    """Words numbered as they are met, with their measures in one array; forgets all when it grows large."""

    def __init__(self, most: int = 500_000):
        self.most, self.numbers, self.rows = most, {}, np.zeros((1024, 9))

    def __call__(self, sentences: list[list[str]]) -> list[list[int]]:
        if len(self.numbers) > self.most:
            self.numbers.clear()
        known = self.numbers
        for s in sentences:
            for w in s:
                if w not in known:
                    if len(known) == len(self.rows):
                        self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                    self.rows[len(known)] = _measures(w)
                    known[w] = len(known)
        return [[known[w] for w in s] for s in sentences]


_WORDS = Words()


def _places(values: np.ndarray, parts: tuple[float, ...]) -> list[float]:
    """Order statistics at parts of the length, without interpolation."""
    ordered = np.sort(values)
    return [float(ordered[int(p * (len(ordered) - 1) + 0.5)]) for p in parts]


def features(sentences: list[list[str]], text: str, table: Vocabulary) -> np.ndarray:
    """One row of length, vocabulary, syntax and cohesion measures."""
    lengths = np.array([len(s) for s in sentences], dtype=float)
    numbered = _WORDS(sentences)
    every = [w for s in numbered for w in s]
    measures = _WORDS.rows[every]
    n = len(every)
    sets = [set(s) for s in numbered]
    row = [*_places(lengths, (0.1, 0.25, 0.5, 0.75, 0.9)), lengths.mean(), *_places(measures[:, 0], (0.5, 0.75, 0.9)), *measures.mean(axis=0)]
    row += [len(set(every)) / n, sum(len(x) / len(s) for x, s in zip(sets, sentences)) / len(sentences), text.count(",") / n, text.count(";") / n]
    shared = [len(a & b) / min(len(a), len(b)) for a, b in zip(sets, sets[1:])]
    row += [sum(shared) / len(shared) if shared else 0.0]
    # vocabulary: each sentence's leaning to the levels, as a distribution over sentences
    kinds = table.odds.shape[1]
    known = [table.known(s) for s in sentences]
    ids = [i for k in known for i in k]
    owner = np.repeat(np.arange(len(sentences)), [len(k) for k in known])
    odds = table.odds[ids] if ids else np.zeros((0, kinds))
    logit = 0.5 * np.stack([np.bincount(owner, odds[:, k], len(sentences)) for k in range(kinds)], axis=1)
    e = np.exp(logit - logit.max(axis=1, keepdims=True))
    lean = e / e.sum(axis=1, keepdims=True)
    mean = (lengths / lengths.sum()) @ lean
    scale = np.arange(1, kinds + 1)
    expected = lean @ scale
    best = np.bincount(lean.argmax(axis=1), minlength=kinds) / len(sentences)
    row += [*mean, *best, *lean.mean(axis=0), float(mean @ scale), float(expected.mean()), *_places(expected, (0.25, 0.5, 0.75))]
    return np.nan_to_num(np.array(row, dtype=float))


@dataclass
class Model:
    """Trees, the cut points between levels, the vocabulary table and the out-of-fold agreement, in all and
    by source where sources were given."""

    levels: list[int]
    trees: Boosted
    cuts: list[float]
    table: Vocabulary | None
    agreement: float = 0.0
    settings: Settings = field(default_factory=Settings)
    by_group: dict[str, float] = field(default_factory=dict)

    def grade(self, texts: list[str | None]) -> list[int | None]:
        """Level of each text; None where it is no running English of the least length."""
        rows, at = [], []
        for i, text in enumerate(texts if self.levels else []):
            if isinstance(text, str) and len(text.split()) >= self.settings.least_words:
                sentences = sentences_of(text)
                if is_english(sentences, self.settings):
                    rows.append(features(sentences, text, self.table))
                    at.append(i)
        out: list[int | None] = [None] * len(texts)
        if rows:
            for i, level in zip(at, np.searchsorted(self.cuts, self.trees.score(np.array(rows)))):
                out[i] = self.levels[int(level)]
        return out


def _cut_points(score: np.ndarray, levels: np.ndarray, kinds: list[int]) -> list[float]:
    """Between neighbouring levels, the cut with the fewest scores on the wrong side (of ties the one nearest the middle)."""
    cuts = []
    for low, high in zip(kinds, kinds[1:]):
        places = np.linspace(low, high, 41)
        wrong = [((score[levels <= low] > c).sum() + (score[levels >= high] <= c).sum()) for c in places]
        best = np.flatnonzero(np.array(wrong) == min(wrong))
        cuts.append(float(places[best[np.abs(places[best] - (low + high) / 2).argmin()]]))
    return list(np.maximum.accumulate(cuts))


def _halved(passages: list[list[list[str]]], texts: list[str], levels: np.ndarray) -> np.ndarray:
    """Features of passages, the vocabulary of each half measured on the other half."""
    half = np.random.default_rng(5).permutation(len(passages)) % 2
    rows: list[np.ndarray | None] = [None] * len(passages)
    for h in (0, 1):
        table = _grades([p for p, k in zip(passages, half) if k != h], levels[half != h])
        for i in np.flatnonzero(half == h):
            rows[i] = features(passages[i], texts[i], table)
    return np.array(rows)


def fit(samples: list[tuple[str, int]], settings: Settings = Settings(), groups: list[str | None] | None = None, strict: bool = False) -> Model:
    """Fit on graded passages of two levels at least (else no text gets a level); vocabulary seen by the trees comes from other folds than the passage's own.

    ``groups``: the source of each passage; a source then lies in one fold as a whole and the agreement is
    kept by source too. Fewer than two sources are an error, as nothing could be held out. ``strict``: for
    reports, the trees that predict a fold are fitted without its vocabulary as well, at twice the work."""
    passages = [sentences_of(t) for t, _ in samples]
    levels = np.array([y for _, y in samples], dtype=float)
    usable = [i for i, p in enumerate(passages) if p]
    if not usable or len(set(levels[usable])) < 2:
        return Model([], Boosted(), [], None, 0.0, settings)  # nothing to tell apart: no text gets a level
    kinds = sorted({int(x) for x in levels[usable]})
    folds, fold = settings.folds, np.random.default_rng(3).permutation(len(samples)) % settings.folds
    if groups is not None:
        names = [g or "" for g in groups]
        inside = sorted({names[i] for i in usable})
        if len(inside) < 2:
            raise ValueError("at least two sources are needed to validate by source")
        folds = min(folds, len(inside))
        part = dict(zip(inside, np.random.default_rng(3).permutation(len(inside)) % folds))
        fold = np.array([part.get(g, 0) for g in names])
    x: dict[int, np.ndarray] = {}
    for f in range(folds):
        table = _grades([passages[i] for i in usable if fold[i] != f], levels[[i for i in usable if fold[i] != f]])
        for i in usable:
            if fold[i] == f:
                x[i] = features(passages[i], samples[i][0], table)
    matrix, y = np.array([x[i] for i in usable]), levels[usable]
    parts = fold[usable]
    outside = np.zeros(len(y))
    for f in range(folds):
        train = matrix[parts != f]
        if strict:  # no passage of the fold may have a say in the vocabulary the trees are fitted on
            train = _halved([passages[i] for i, p in zip(usable, parts) if p != f], [samples[i][0] for i, p in zip(usable, parts) if p != f], y[parts != f])
        outside[parts == f] = Boosted("squared", trees=80, depth=3, rate=0.1).fit(train, y[parts != f]).score(matrix[parts == f])
    cuts = _cut_points(outside, y, kinds)
    hits = np.array(kinds)[np.searchsorted(cuts, outside)] == y
    right = np.mean(hits)
    by_group = {} if groups is None else {g: float(np.mean(hits[[names[i] == g for i in usable]])) for g in inside}
    table = _grades([passages[i] for i in usable], y)
    return Model(kinds, Boosted("squared", trees=80, depth=3, rate=0.1).fit(matrix, y), cuts, table, float(right), settings, by_group)


def fitted(samples: DataFrame, text: str, level: str, settings: Settings = Settings(), group: str | None = None, strict: bool = False) -> Model:
    """Fit on at most ``settings.sample`` distinct graded rows, the first by a hash of the text; ``group``
    names the column of sources, by which the predictions are then validated."""
    rows = samples.where(F.col(text).isNotNull() & F.col(level).isNotNull()).select(text, level, *([F.col(group).cast("string")] if group else []))
    sample = sample_rows(rows, text, settings.sample)
    return fit([(r[0], int(r[1])) for r in sample], settings, [r[2] for r in sample] if group else None, strict)


def grade(docs: DataFrame, text: str, model: Model, into: str = "reading_level") -> DataFrame:
    """``docs`` with a level, null for null, short, foreign and figure-only texts. No shuffle."""
    @F.pandas_udf("bigint")
    def level(texts: pd.Series) -> pd.Series:
        return pd.Series(model.grade(texts.tolist()), dtype="Int64")

    return docs.withColumn(into, level.asNondeterministic()(F.col(text)))


def profile(graded: DataFrame, source: str, level: str = "reading_level") -> DataFrame:
    """By source and level the number of documents, for choosing what to keep."""
    return graded.where(F.col(level).isNotNull()).groupBy(source, level).agg(F.count(F.lit(1)).alias("n_docs"))

