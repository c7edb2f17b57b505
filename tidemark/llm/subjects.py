"""Subject areas of the parts of a document.

Documents become vectors of weighted terms (words and word pairs; the weight is the inverse document
frequency times how much a term tells about the subject) and are embedded by a truncated singular value
decomposition. Each subject starts at the mean of its seed documents; then the lines of the seed
documents are assigned by cosine similarity and the centroids moved to the lines assigned, until
nothing changes. A document has every subject to which enough of its lines belong.

The model is fitted on the driver on a bounded sample of labelled documents, drawn evenly by subject
(``Settings.sample``), and is a few megabytes at any size of the corpus; in how many documents a term of
the sample stands is counted over the whole corpus. Every document is then assigned where it lies.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sampling import sample_groups

_WORD = re.compile(r"[a-z]+")
#: Function words; they separate nothing and break no word pair.
STOP = set(
    "a an and any are as at be been but by can for from has have if in into is it its may more no not of on only or our out over per "
    "so such than that the their them then there these they this those to under up us was we were when where which while who will with within you your".split()
)


@dataclass(frozen=True)
class Settings:
    """``sample``: most labelled documents the model is fitted on. ``terms``: most terms kept, the most
    telling first. ``rank``: dimensions of the embedding. ``rounds``: most refinements."""

    sample: int = 12_000
    terms: int = 20_000
    rank: int = 400
    rounds: int = 10
    least_docs: int = 3


def terms_of(line: str) -> list[str]:
    """Content words of a line and pairs of neighbours among them."""
    found = [w for w in _WORD.findall(line.lower()) if w not in STOP and len(w) > 1]
    return found + [f"{a} {b}" for a, b in zip(found, found[1:])]


def lines_of(text: str) -> list[str]:
    """The distinct lines of a text."""
    return list(dict.fromkeys(" ".join(line.lower().split()) for line in text.split("\n") if line.strip()))


@dataclass
class Model:
    """``vectors``: weighted embedding by term; ``bar`` and ``margin``: the least cosine similarity and
    the least lead over the next subject; ``mass``: the least summed weight of a line's known terms."""

    subjects: list[str]
    index: dict[str, int]
    vectors: np.ndarray
    weights: np.ndarray
    centroids: np.ndarray
    bar: float = 0.15
    margin: float = 0.05
    mass: float = 1.0

    def embed(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Unit vectors of lines (zero where no term is known) and the weight of their known terms."""
        out = np.zeros((len(lines), self.vectors.shape[1]), dtype=np.float32)
        mass = np.zeros(len(lines), dtype=np.float32)
        for i, line in enumerate(lines):
            ids = [self.index[t] for t in dict.fromkeys(terms_of(line)) if t in self.index]
            if ids:
                out[i] = self.vectors[ids].sum(axis=0)
                mass[i] = self.weights[ids].sum()
            if mass[i] > 0 and (norm := np.linalg.norm(out[i])) > 0:
                out[i] /= norm
        return out, mass

    def assign(self, lines: list[str]) -> np.ndarray:
        """Number of the subject of each line, -1 for none."""
        return self.lean(lines)[0]

    def lean(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the subject of each line, -1 for none, and the two nearest subjects of lines that have
        none only because these lie too close to each other (else -1)."""
        if not lines or not self.index:
            return np.full(len(lines), -1, dtype=int), np.full((len(lines), 2), -1, dtype=int)
        embedded, mass = self.embed(lines)
        near = embedded @ self.centroids.T
        at = np.arange(len(lines))
        first = near.argmax(axis=1)
        best = near[at, first]
        near[at, first] = -1  # with one subject the lead is over this
        second = near.argmax(axis=1)
        strong = (best >= self.bar) & (mass >= self.mass)
        clear = best - near[at, second] >= self.margin
        return np.where(strong & clear, first, -1), np.where((strong & ~clear)[:, None], np.column_stack([first, second]), -1)


def document_frequencies(docs: DataFrame, doc: str, text: str, terms: set[str]) -> tuple[dict[str, int], int]:
    """In how many documents each of ``terms`` stands, and how many documents there are.

    Every distinct document is counted once. Workers count by batch, so a row for each term and batch is
    summed and one for each term reaches the driver.
    """
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted, seen = shared.value, Counter({"": 0})
        cached: dict[str, list[str]] = {}
        for batch in batches:
            for value in batch["text"]:
                found: set[str] = set()
                for line in lines_of(value):
                    if line not in cached:
                        if len(cached) >= 100_000:
                            cached.clear()
                        cached[line] = [t for t in terms_of(line) if t in wanted]
                    found.update(cached[line])
                seen.update(found)
                seen[""] += 1  # no term is empty
        yield pd.DataFrame(list(seen.items()), columns=["term", "n"])

    distinct = docs.where(F.col(text).isNotNull()).select(F.col(doc), F.col(text).alias("text")).distinct().select("text")
    sums = distinct.mapInPandas(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in sums.collect()}  # at most as many rows as terms
    return found, found.pop("", 0)


def fit(docs: list[tuple[str, str]], settings: Settings = Settings(), corpus: Callable[[set[str]], tuple[dict[str, int], int]] | None = None) -> Model:
    """Fit on ``(text, subject)`` pairs. Without any pair the model knows no term and assigns nothing.

    Terms of at least ``settings.least_docs`` documents count, and all terms of a subject with fewer
    documents. ``corpus`` gives, for a set of terms, documents by term and documents in all, for the
    inverse document frequency; without it those of the pairs are taken."""
    subjects = sorted({s for _, s in docs})
    number = {s: i for i, s in enumerate(subjects)}
    sizes = np.bincount([number[s] for _, s in docs], minlength=len(subjects)).astype(float)
    numbers: dict[str, int] = {}  # terms are held once, documents as arrays of their numbers
    per_doc = []
    for text, _ in docs:
        found = {t for line in lines_of(text) for t in terms_of(line)}
        per_doc.append(np.array(sorted(numbers.setdefault(t, len(numbers)) for t in found), dtype=np.int32))
    counts = np.zeros((len(numbers), len(subjects)))
    for found, (_, subject) in zip(per_doc, docs):
        counts[found, number[subject]] += 1
    enough = (counts.sum(axis=1) >= settings.least_docs) | (counts[:, sizes < settings.least_docs] > 0).any(axis=1)
    names = sorted(t for t, k in numbers.items() if enough[k])
    if not names:
        return Model(subjects, {}, np.zeros((0, 1), np.float32), np.zeros(0, np.float32), np.zeros((len(subjects), 1), np.float32))
    counts = counts[[numbers[t] for t in names]]
    # how far the subjects of a term are from the subjects at large, shrunk where a term is rare
    prior = sizes / sizes.sum()
    share = (counts + 2 * prior) / (counts.sum(axis=1, keepdims=True) + 2) / prior
    share = share / share.sum(axis=1, keepdims=True)
    telling = 1 + (share * np.log(share)).sum(axis=1) / np.log(max(2, len(subjects)))
    everywhere, n_docs = corpus(set(names)) if corpus else (dict(zip(names, counts.sum(axis=1))), len(docs))
    idf = np.log((1 + n_docs) / (1 + np.array([everywhere.get(t, 0) for t in names])))
    weight = np.where(telling > 0.25, telling * idf, 0)
    keep = np.argsort(-weight * np.log1p(counts.sum(axis=1)), kind="stable")[: settings.terms]
    keep = np.sort(keep[weight[keep] > 0])
    index = {names[k]: i for i, k in enumerate(keep)}
    weight = weight[keep]

    # truncated SVD by subspace iteration on the document-by-term matrix
    size = len(index)
    place = np.full(len(numbers), -1, dtype=np.int32)
    place[[numbers[t] for t in index]] = list(index.values())
    of_doc = [ids[ids >= 0] for ids in (place[found] for found in per_doc)]
    of_doc = [ids for ids in of_doc if len(ids)]
    entries = np.concatenate([(weight[ids] / np.linalg.norm(weight[ids])).astype(np.float32) for ids in of_doc] or [np.zeros(0, np.float32)])
    term = np.concatenate(of_doc or [np.zeros(0, np.int32)])
    row = np.repeat(np.arange(len(of_doc), dtype=np.int32), [len(ids) for ids in of_doc])
    by_term = np.argsort(term, kind="stable")
    rank = min(settings.rank, size)
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((size, rank)).astype(np.float32))[0]
    for _ in range(6):
        left = _summed(row, term, entries, basis, len(of_doc))
        basis = np.linalg.qr(_summed(term[by_term], row[by_term], entries[by_term], left, size))[0]
    del per_doc, of_doc, entries, term, row, by_term, left
    vectors = (weight[:, None] * basis).astype(np.float32)

    model = Model(subjects, index, vectors, weight.astype(np.float32), np.zeros((len(subjects), rank), np.float32))
    lines: dict[str, int] = {}
    pairs: Counter = Counter()
    for text, subject in docs:
        pairs.update((lines.setdefault(line, len(lines)), number[subject]) for line in lines_of(text))
    every = list(lines)
    embedded, mass = model.embed(every)
    seeds = np.zeros((len(every), len(subjects)), dtype=np.float32)
    for (i, k), n in pairs.items():
        seeds[i, k] = n
    often = seeds.sum(axis=1)
    model.centroids = _unit((seeds.T / np.maximum(sizes[:, None], 1)).astype(np.float32) @ embedded)
    before = None
    for _ in range(settings.rounds):
        near = embedded @ model.centroids.T
        first = near.argmax(axis=1)
        strong = (near.max(axis=1) >= model.bar) & (mass >= model.mass)
        if before is not None and np.array_equal(before, np.where(strong, first, -1)):
            break
        before = np.where(strong, first, -1)
        for s in range(len(subjects)):
            mine = strong & (first == s)
            if mine.any():  # the seeds keep a part of the say
                model.centroids[s] = _unit((np.where(mine, often, 0) @ embedded + 0.2 * often[mine].sum() * model.centroids[s])[None])[0]
    return model


def _summed(into: np.ndarray, of: np.ndarray, entries: np.ndarray, x: np.ndarray, size: int, chunk: int = 4_000) -> np.ndarray:
    """``entries`` times rows ``of`` of ``x``, summed by ``into`` (ascending): a sparse product that never
    holds more than ``chunk`` rows beside its result."""
    out = np.zeros((size, x.shape[1]), dtype=np.float32)
    for a in range(0, len(into), chunk):
        part = into[a : a + chunk]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        out[part[starts]] += np.add.reduceat(entries[a : a + chunk, None] * x[of[a : a + chunk]], starts, axis=0)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def calibrate(model: Model, docs: list[tuple[str, set[str]]], least_lines: int) -> Model:
    """Set the bars where the subjects found on documents not fitted on agree best with the known ones."""
    best = (-1.0, model.bar, model.margin, model.mass)
    if not docs or not model.index or len(model.subjects) < 2:
        return model
    cached = []
    for text, known in docs:
        lines = lines_of(text)
        embedded, mass = model.embed(lines)
        near = np.sort(embedded @ model.centroids.T, axis=1) if lines else np.zeros((0, 2))
        first = (embedded @ model.centroids.T).argmax(axis=1) if lines else np.zeros(0, int)
        cached.append((near, first, mass, known))
    for bar in (0.05, 0.1, 0.15, 0.2, 0.3, 0.4):
        for margin in (0.02, 0.05, 0.1, 0.2):
            for least in (0.5, 1.0, 2.0, 3.0):
                hit = wrong = missed = 0
                for near, first, mass, known in cached:
                    if len(near) == 0:
                        missed += len(known)
                        continue
                    good = (near[:, -1] >= bar) & (near[:, -1] - near[:, -2] >= margin) & (mass >= least)
                    found = {model.subjects[s] for s, n in Counter(first[good].tolist()).items() if n >= least_lines}
                    hit, wrong, missed = hit + len(found & known), wrong + len(found - known), missed + len(known - found)
                score = 2 * hit / max(1, 2 * hit + wrong + missed)
                if score > best[0] + 1e-9:
                    best = (score, bar, margin, least)
    model.bar, model.margin, model.mass = best[1:]
    return model


def fitted(
    labelled: DataFrame, text: str, subject: str, second: str | None, order: str, settings: Settings = Settings(), least_lines: int = 2, every: DataFrame | None = None
) -> Model:
    """Fit and calibrate on at most ``settings.sample`` labelled rows, of each subject the first by a hash
    of ``order``; every fifth row of a subject is kept for calibration.

    ``every``: all documents, labelled or not, over which document frequencies are counted (without it
    the labelled ones). Rows with a null text or subject are left out; exact copies of a row count once.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(subject).isNotNull())
    rows = rows.select(text, subject, F.col(second).alias("_second") if second else F.lit(None).cast("string").alias("_second"), order)
    sample = sample_groups(rows, order, subject, settings.sample)
    docs, held, place = [], [], Counter()
    for r in sample:
        place[r[1]] += 1
        if place[r[1]] % 5:
            docs.append((r[0], r[1]))
        else:
            held.append((r[0], {r[1], r[2]} - {None}))
    if not docs:
        return fit(docs, settings)
    everywhere = rows if every is None else every
    return calibrate(fit(docs, settings, lambda terms: document_frequencies(everywhere, order, text, terms)), held, least_lines)


def assign_subjects(docs: DataFrame, doc: str, text: str, model: Model, least_lines: int = 2, title: str | None = None) -> DataFrame:
    """``(doc, subject, lines)``: each subject to which at least ``least_lines`` lines of a text belong.

    ``title``: column of a title that is no line of the text but decides for lines that lie between two
    subjects, one of them the title's own. Equal lines of one text count once. Null, empty and unknown texts
    give no row, null and unknown titles decide nothing; a document given twice gives its rows twice. The
    model is broadcast; its size is bounded by its settings.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = shared.value
        for batch in batches:
            split = [lines_of(t) if isinstance(t, str) else [] for t in batch["text"]]
            titles = [" ".join(t.lower().split()) if isinstance(t, str) else "" for t in batch["title"]]
            distinct = list(dict.fromkeys([line for lines in split for line in lines] + titles))
            sure, between = tool.lean(distinct)
            of = dict(zip(distinct, sure.tolist()))
            open_ = {line: pair for line, pair in zip(distinct, between.tolist()) if pair[0] >= 0}
            rows = []
            for key, lines, head in zip(batch["doc"], split, titles):
                decides = of[head]
                found = Counter(decides if decides >= 0 and decides in open_.get(x, ()) else of[x] for x in lines)
                rows += [(key, tool.subjects[s], n) for s, n in found.items() if s >= 0 and n >= least_lines]
            yield pd.DataFrame(rows, columns=["doc", "subject", "lines"])

    kind = docs.schema[doc].dataType.simpleString()
    head = F.col(title) if title else F.lit(None)
    narrow = docs.select(F.col(doc).cast("string").alias("doc"), F.col(text).alias("text"), head.cast("string").alias("title"))
    found = narrow.mapInPandas(assign, "doc string, subject string, lines bigint")
    return found.withColumn("doc", F.col("doc").cast(kind))
