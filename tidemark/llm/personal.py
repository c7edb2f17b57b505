"""Personal information in free text.

Generators with high recall propose overlapping spans (e-mail addresses, telephone and identity numbers,
addresses, names of people). Boosted trees score each span by its format and its surroundings, one
model per kind, and a span is taken where its probability reaches the kind's threshold; of overlapping
spans the more probable one stays. Thresholds are calibrated on examples not fitted on.

There are no labelled texts, so the models are fitted on examples made in ``llm.examples``: lines of a
general grammar with invented names and numbers, whose planted spans are positive and every other proposed
span is negative. Thresholds are calibrated on forms of sentences that are not fitted on. Whether a word is a
common one, one written with a capital only, or rare, comes from the ranks of a public vocabulary
(``llm.lexicon``). The models are fitted once on the driver and broadcast (with the vocabulary about 1 MB).
Texts are handled line by line, and a line that occurs again in a task is handled once.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Boosted
from tidemark.llm.examples import example_lines
from tidemark.llm.lexicon import RARE, ranks_of, word_ranks
from tidemark.llm.tokens import TOKENIZER

KINDS = ("EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME")

_AT = r"(?:\s?@\s?|\s?[\[(]\s?at\s?[\])]\s?|\sat\s)"
_DOT = r"(?:\.|\s?[\[(]\s?dot\s?[\])]\s?|\sdot\s)"
_EMAIL = re.compile(rf"(?<![\w.+%’'-])[A-Za-z0-9][\w.+%’'-]*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I)
_STREET_WORDS = "Street|St|Road|Rd|Avenue|Ave|Av|Terrace|Tce|Drive|Dr|Parade|Pde|Lane|Ln|Crescent|Cres|Cr|Way|Place|Pl|Court|Ct|Highway|Hwy|Boulevard|Blvd|Bvd|Esplanade|Esp|Close|Cl|Circuit|Cct|Quay|Square|Sq|Grove|Gr|Rise|Walk|Row|Mews|Track"
_STATES = r"(?:NSW|VIC|Vic|Qld|QLD|SA|WA|Tas|TAS|ACT|NT|New South Wales|Victoria|Queensland|South Australia|Western Australia|Tasmania|Northern Territory)"
_PLACE = rf"(?!(?:{_STREET_WORDS})\b)[A-Z][\w’'-]+(?:\s(?:[A-Z][\w’'-]+|on|upon|of|the)){{0,3}}?"
_TAIL = rf"(?:,?\s+{_PLACE}(?:,?\s+{_STATES}\b)?(?:,?\s+\d{{4}}\b)?)"
_ENTRY = r"(?:(?:Unit|Lot|Level|Suite|Shop|Flat|Apt|Floor|Villa|Room)\s+\d+[A-Za-z]?(?:\s*[,/]\s*|\s+))?"
_ADDRESSES = [
    re.compile(rf"(?<![\w/]){_ENTRY}(?:\d+[A-Za-z]?\s*/\s*)?\d+[A-Za-z]?(?:\s?-\s?\d+)?\s+(?:[A-Z][\w’'-]+\s+){{1,3}}?(?:{_STREET_WORDS})\b\.?{_TAIL}(?=\W|$)"),
    re.compile(rf"(?<![\w/])(?:Unit|Lot|Level|Suite|Shop)\s+\d+[A-Za-z]?,?\s+(?:[A-Z][\w’'-]+\s+){{1,3}}?(?:{_STREET_WORDS})\b\.?{_TAIL}(?=\W|$)"),
    re.compile(rf"\b(?:(?:G\.?P\.?O\.?|P\.?O\.?)\s?Box|Locked Bag|Private Bag|Reply Paid)\s+\d+[A-Za-z]?{_TAIL}(?=\W|$)", re.I),
]
_DIGITS = r"(?:[ .-]?\d)"
_PHONES = [
    re.compile(rf"(?:\+|(?<!\d)0011[ .-]?)\d{{1,3}}[ .-]?(?:\(0\)[ .-]?)?\d{_DIGITS}{{6,9}}(?!\d)"),
    re.compile(r"\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"),
    re.compile(rf"(?<![\d/+.-])0\d{_DIGITS}{{8}}(?!\d)"),
    re.compile(rf"(?<![\d/+.-])1[38]00{_DIGITS}{{6}}(?!\d)"),
    re.compile(rf"(?<![\d/+.-])13{_DIGITS}{{4}}(?!\d)"),
    re.compile(r"(?<![\d/+.-])\d{4}[ .-]?\d{4}(?![\d/-])"),
]
_IDS = [
    re.compile(r"(?<![\w/.-])[A-Z]{1,3}[-/ ]?\d{5,9}(?![\w/])"),
    re.compile(r"(?<![\w/.+-])\d{3}[ -]?\d{3}[ -]?\d{3}(?![\w/]|[ -]\d)"),
    re.compile(r"(?<![\w/.+-])\d{4}[ -]?\d{5}[ -]?\d(?![\w/])"),
    re.compile(r"(?<![\w/.+-])\d{4}[ -]?\d{4}(?![\w/]|[ -]\d)"),
    re.compile(r"(?<![\w/.+-])\d{5,10}(?![\w/])"),
    re.compile(r"(?<![\w/.+-])\d{2}[ -]?\d{3}[ -]?\d{3}(?:[ -]?\d{3})?(?![\w/]|[ -]\d)"),
]
_PARTICLES = {"de", "van", "von", "der", "den", "la", "le", "di", "da", "del", "bin", "al", "ten", "ter", "du", "st"}
_TITLES = {"mr", "ms", "mrs", "miss", "mx", "dr", "prof", "professor", "sir", "dame", "rev", "hon", "captain", "capt", "major", "sgt"}
#: Small classes of words that tell what stands beside or in a span.
CLASSES = {
    "title": _TITLES, "particle": _PARTICLES,
    "reach": set("contact call ring phone telephone email mail write ask speak talk see meet reach thank thanks text message consult notify inform tell visit chat refer report regards sincerely".split()),
    "lead": set("by with to from for of via through about and or".split()), "where": set("at in on near under over within between across".split()),
    "role": set(
        "manager director officer chair chairperson convenor convener secretary supervisor coordinator delegate author editor engineer analyst nurse judge member president minister owner "
        "lead leader head recruiter executive assistant adviser advisor specialist consultant teacher doctor clerk inspector commissioner chief principal lecturer scientist occupant attention attn referee "
        "administrator technician lawyer accountant architect designer developer planner registrar ranger curator".split()
    ),
    "body": set(
        "department office agency bureau authority commission council tribunal panel board service services institute museum archive archives observatory branch division section group directorate unit team company "
        "ltd pty limited inc corporation university school college hospital bank committee association society union foundation ministry government parliament court centre center network".split()
    ),
    "place": set(
        "street st road rd avenue ave terrace drive parade lane way court highway boulevard crescent river bay creek lake mount mountain hill park bridge island beach valley port north south east west upper lower new old "
        "city town state region flat vale mill point cape reef harbour springs falls ridge plains precinct square gardens shire".split()
    ),
    "thing": set(
        "act acts regulation regulations law prize award medal scholarship fellowship library building house hall room theatre wing lecture theorem theory method principle effect scale test report review inquiry plan program "
        "project scheme fund day week cup trophy policy strategy framework agreement code charter standard system oration collection archive site campus".split()
    ),
    "article": set("the a an this that these those our your their his her its my any each every all no some".split()),
    "verb": set("is was has have had will would can could may might must should who said says wrote leads led joined joins runs manages managed answers handles works worked chairs sits takes signed approved".split()),
    "date": set("monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december".split()),
}
_NAMES_OF_CLASSES = list(CLASSES)
_TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|[’'-](?=[^\W\d_]))*\.?|\d+|\S")
_TWO_CAPITALS = re.compile(r"[A-ZÀ-Þ][\w’'.-]*,? [A-ZÀ-Þ]")
_NAME_BEFORE = re.compile(r"[A-ZÀ-Þ][\w’'-]*\.? ?[,(:|–-]? ?(?:\w+ )?$")
_DIGIT, _UPPER = re.compile(r"\d"), re.compile(r"[A-ZÀ-ÖØ-Þ]")
#: What a line must hold for any generator to propose something.
_TRIGGER = re.compile(r"@|\d(?:\D{0,3}\d){4}|\d.{0,12}[A-ZÀ-Þ]|\bbox\b|\bbag\b|(?i:\bdot\b|[(\[]\s?at\s?[)\]]|\bat\s\S+\.\w)|[A-ZÀ-Þ][\w’'.-]*,?\s+(?:[a-z]{1,3}\s+){0,2}[A-ZÀ-Þ]", re.UNICODE)
_CUES = {
    "PHONE": re.compile(r"(phone|tel|call|ring|contact|fax|mobile|mob|enquir|number|line|reached|hotline|on$|or$)", re.I),
    "ID_NUMBER": re.compile(r"(tfn|tax file|medicare|passport|travel document|licen[cs]e|ags|payroll|employee|staff|service n|personnel|driver|crn|customer ref|member)", re.I),
    "NOT": re.compile(r"(abn|acn|position|notice|vacancy|vn|file|budget|record|reference|ref\b|invoice|business|week|act\b|copyright|manages|order|asset|cost centre|po number|purchase|contract|room|page|form|clause|section|tender|case|ticket|serial|version|isbn|batch|item|account|job|project|receipt|barcode|grant|policy|parcel|lot\b|chapter|build|meter|code|quote|id=)", re.I),
}


@dataclass(frozen=True)
class Span:
    """A proposed span of a line, the generator that proposed it, and its tokens for names."""

    kind: str
    start: int
    end: int
    form: int


class Words:
    """Tokens numbered as they are met, each with what is known of it in one row of an array, and its part in
    the mask of a line: name-like, title, particle, comma or other. Forgets all when it grows large."""

    WIDTH = 15 + len(_NAMES_OF_CLASSES)

    def __init__(self, ranks: dict[str, tuple[float, float]], most: int = 300_000):
        self.ranks, self.most = ranks, most
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[str, int] = {"": 0}
        self.masks = ["x"]
        self.rows = np.zeros((4096, self.WIDTH), dtype=np.float32)
        self.rows[0, :2] = 1, RARE  # an edge of the line
        self.rows[0, 2] = RARE

    def __call__(self, token: str) -> int:
        at = self.numbers.get(token)
        if at is None:
            at = self.numbers[token] = len(self.masks)
            if at == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[at], mask = self._measure(token)
            self.masks.append(mask)
        return at

    def _measure(self, token: str) -> tuple[list[float], str]:
        word = token.rstrip(".")
        if word.endswith(("'s", "’s")):
            word = word[:-2]
        low = word.lower()
        alpha = word[:1].isalpha()
        cap = alpha and word[0].isupper()
        small, capital = ranks_of(low, self.ranks) if len(low) > 1 else (RARE, RARE)
        one = alpha and len(word) == 1
        row = [
            0, small, capital, cap, alpha and word.isupper() and len(word) > 1, cap and one, alpha and not cap, token[:1].isdigit(), token == ",", token in ":-–—|/•*>", token == "(", token == ")",
            token in ".!?;", token.endswith(".") and alpha, len(word), *[low in CLASSES[c] for c in _NAMES_OF_CLASSES],
        ]
        mask = "t" if low in _TITLES else "p" if word in _PARTICLES else "n" if cap else "," if token == "," else "x"
        return row, mask


@dataclass
class Line:
    """A line's tokens as numbers, with their places, and the proposed names as pairs of tokens."""

    numbers: list[int]
    starts: list[int]
    ends: list[int]
    names: list[tuple[int, int, int, int, int]]  # first token, last token, start, end, commas


def _name_spans(line: str, words: Words) -> Line:
    """Two to four capitalised words running on, with particles and one comma, as spans of tokens."""
    numbers, starts, ends, texts = [], [], [], []
    for m in _TOKEN.finditer(line):
        numbers.append(words(m[0]))
        starts.append(m.start())
        ends.append(m.end())
        texts.append(m[0])
    masks = [words.masks[k] for k in numbers]
    spans = []
    for i, mask in enumerate(masks):
        if mask not in "np":
            continue
        real = commas = particles = 0
        for j in range(i, min(len(masks), i + 6)):
            mask = masks[j]
            if mask == ",":
                commas += 1
                if commas > 1 or starts[j] != ends[j - 1] or real == 0:
                    break
                continue
            if mask == "p":
                particles += 1
                if particles > 2:
                    break
                continue
            if mask != "n":
                break
            real += 1
            if real > 4:
                break
            text = texts[j]
            full = text.endswith(".") and len(text) > 2  # a sentence ends here
            owner = text.rstrip(".").endswith(("'s", "’s"))
            if real >= 2:
                spans.append((i, j, starts[i], ends[j] - full - 2 * owner, commas))
            if full or owner:
                break
    return Line(numbers, starts, ends, spans)


def name_features(lines: list[Line], words: Words) -> np.ndarray:
    """One row for each proposed name of all lines: what is known of the words in it and around it."""
    flat, first, last, commas, sizes, base = [], [], [], [], [], 0
    for line in lines:
        flat += [0, 0, 0, *line.numbers, 0, 0, 0, 0]
        for i, j, _, _, comma in line.names:
            first.append(base + 3 + i)
            last.append(base + 3 + j)
            commas.append(comma)
        sizes += [(base + 3, base + 3 + len(line.numbers))] * len(line.names)
        base += len(line.numbers) + 7
    if not first:
        return np.zeros((0, 1), dtype=np.float32)
    info = words.rows[np.array(flat)]
    i, j = np.array(first), np.array(last)
    ends = np.array(sizes)
    sums = np.concatenate([np.zeros((1, info.shape[1]), dtype=np.float64), info.cumsum(axis=0, dtype=np.float64)])
    inside = sums[j + 1] - sums[i]
    whole = sums[ends[:, 1]] - sums[ends[:, 0]]
    size = (j - i + 1)[:, None]
    ranks = np.stack([np.where(k <= j - i, info[np.minimum(i + k, j), 1], np.nan) for k in range(6)], axis=1)
    capital = np.stack([np.where(k <= j - i, info[np.minimum(i + k, j), 2], np.nan) for k in range(6)], axis=1)
    real = np.stack([np.where((k <= j - i) & (info[np.minimum(i + k, j), 3] > 0), 1, np.nan) for k in range(6)], axis=1)
    ranks, capital = ranks * real, capital * real
    letters = whole[:, 3] + whole[:, 6]
    near_digits = (sums[np.minimum(j + 5, ends[:, 1])] - sums[np.minimum(j + 1, ends[:, 1])])[:, 7]
    body, lead = 15 + _NAMES_OF_CLASSES.index("body"), 15 + _NAMES_OF_CLASSES.index("lead")
    within_body = info[i - 2][:, body] * info[i - 1][:, lead]  # as in "Department of ..."
    listed = info[j + 1][:, lead] * info[j + 2][:, 3]  # as in "..., X and Y"
    return np.column_stack([
        within_body, listed, within_body * np.array(commas), within_body * listed, info[i - 2][:, [0, 3, 6, *range(15, info.shape[1])]], info[i - 1], info[i][:, 1:], info[j][:, 1:], info[j + 1], info[j + 2][:, [0, 3, 6, 7, *range(15, info.shape[1])]],
        inside[:, [3, 4, 5, 6, *range(15, info.shape[1])]], size, commas, np.nanmin(ranks, axis=1), np.nanmax(ranks, axis=1), np.nanmin(capital, axis=1), np.nanmax(capital, axis=1),
        np.nanmin(ranks - capital, axis=1), np.nanmax(ranks - capital, axis=1), whole[:, 3] / np.maximum(letters, 1), whole[:, 4] / np.maximum(letters, 1), letters, near_digits, i - ends[:, 0], ends[:, 1] - 1 - j,
    ]).astype(np.float32)


def propose(line: str) -> list[Span]:
    """All spans of a line that may be personal information, names aside."""
    found: list[Span] = []
    if "@" in line or "dot" in line.lower() or re.search(r"\bat\b", line, re.I) and "." in line:
        found += [Span("EMAIL", m.start(), m.end(), 0) for m in _EMAIL.finditer(line)]
    digits = len(_DIGIT.findall(line))
    if digits >= 5:
        for form, pattern in enumerate(_PHONES):
            found += [Span("PHONE", m.start(), m.end(), form) for m in pattern.finditer(line)]
        for form, pattern in enumerate(_IDS):
            found += [Span("ID_NUMBER", m.start(), m.end(), form) for m in pattern.finditer(line)]
    if digits:
        for form, pattern in enumerate(_ADDRESSES):
            for m in pattern.finditer(line):
                whole = _stretch(line, m.start(), m.end())
                found.append(Span("ADDRESS", *whole, form))
    return found


_MORE_PLACE = re.compile(rf"(?:\s[A-Z][\w’'-]+(?!\.\w)){{1,3}}(?=\s*(?:[,.;)]|$|\s{_STATES}\b|\s\d{{4}}\b|\s+[a-z(]))")
_STATE_TAIL = re.compile(rf",?\s+{_STATES}\b(?:,?\s+\d{{4}}\b)?|,?\s+\d{{4}}\b")


def _stretch(line: str, start: int, end: int) -> tuple[int, int]:
    """The match to the last of place, state and postcode, as the place may have several words."""
    for _ in range(3):
        if m := _STATE_TAIL.match(line, end):
            end = m.end()
            if line[end - 1].isdigit():
                break
            continue
        if re.search(rf"(?:{_STATES}|\d)$", line[start:end]) and re.search(rf"{_STATES}(?:,?\s+\d{{4}})?$", line[start:end]):
            break
        if m := _MORE_PLACE.match(line, end):
            end = m.end()
            continue
        break
    return start, end


def features(line: str, span: Span) -> list[float]:
    """Format and surroundings of a span."""
    text = line[span.start : span.end]
    left, right = line[max(0, span.start - 40) : span.start], line[span.end : span.end + 24]
    before = re.findall(r"[A-Za-z]+", left)
    after = re.findall(r"[A-Za-z]+", right)
    last = before[-1].lower() if before else ""
    first = after[0].lower() if after else ""
    digits = len(_DIGIT.findall(text))
    row = [
        span.form, len(text), digits, len(_UPPER.findall(text)), text.count(" "), text.count("-"), text.count("."), text.count(","),
        float(last in CLASSES["reach"]), float(last in CLASSES["lead"] or last in CLASSES["where"]), float(first in CLASSES["verb"]), float(span.start == 0), float(not right.strip(" .!")),
        float(left.rstrip().endswith(("-", "–", ":"))), float(left.rstrip().endswith("(")), float(right.lstrip().startswith((",", "(", ")"))),
    ]
    near = " ".join(before[-3:])
    if span.kind in ("PHONE", "ID_NUMBER"):
        bare = re.sub(r"\D", "", text)
        row += [
            float(bool(_CUES["PHONE"].search(near))), float(bool(_CUES["ID_NUMBER"].search(" ".join(before[-4:])))), float(bool(_CUES["NOT"].search(near.replace("ACT", "")))),
            float(text.startswith("+")), float(text.startswith("(")), float(bare.startswith("0")), float(bare.startswith("04") or bare.startswith("614")),
            float(bare.startswith(("1300", "1800"))), float(len(bare) == 10), float(len(bare) == 8), float(len(bare) == 9), float(text[0].isalpha()),
            float(bool(re.search(r"\d{3}[ -]\d{3}[ -]\d{3}$", text))), float(bool(re.match(r"[\w/=?&#-]", line[span.start - 1 : span.start] or " "))),
            float(bool(re.search(r"@|/\d|www|\d[.,]\d*$", left[-8:]))), float(bool(re.match(r"\s?\d|[-/]\d", right))), float("number" in near.lower() or "no" in near.lower().split()),
            float(bool(re.search(r"\d[)\s.-]*$", left))), float(bool(re.search(r"\)\s?$", left))), float(bool(_NAME_BEFORE.search(left))), float("@" in right),
            float(bool(_TWO_CAPITALS.search(left))), float(bool(_CUES["PHONE"].search(line[max(0, span.start - 60) : span.start]))), float(bool(_CUES["NOT"].search(line[max(0, span.start - 24) : span.start]))),
        ]
    elif span.kind == "ADDRESS":
        row += [float(bool(re.search(rf"{_STATES}", text))), float(bool(re.search(r"\d{4}$", text))), float(text[0].isdigit()), float(bool(re.search(r"box|bag", text, re.I)))]
    else:
        row += [float("@" in text), float(bool(re.search(r"dot", text, re.I))), float(bool(re.search(r"\.\w{2,8}$", text)))]
    return row


@dataclass
class Tools:
    """The model and threshold of each kind, and the ranks of words."""

    models: dict[str, tuple[Boosted, float]]
    ranks: dict[str, tuple[float, float]]


def _proposed(lines: list[str], words: Words) -> tuple[dict[str, list[tuple[int, int, int]]], dict[str, np.ndarray]]:
    """By kind the proposed spans ``(line, start, end)`` and their features."""
    if len(words.numbers) > words.most:
        words.reset()
    where: dict[str, list[tuple[int, int, int]]] = {k: [] for k in KINDS}
    rows: dict[str, list] = {k: [] for k in KINDS}
    named = []
    for i, line in enumerate(lines):
        for span in dict.fromkeys(propose(line)):
            where[span.kind].append((i, span.start, span.end))
            rows[span.kind].append(features(line, span))
        if len(_UPPER.findall(line)) >= 2:
            found = _name_spans(line, words)
            where["NAME"] += [(i, a, b) for _, _, a, b, _ in found.names]
            named.append(found)
    arrays = {k: np.array(v, dtype=float) for k, v in rows.items()}
    arrays["NAME"] = name_features(named, words)
    return where, arrays


def _labelled(count: int, seed: int, ranks: dict[str, tuple[float, float]]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Features, labels and groups (the forms of sentences) of the spans proposed in made lines."""
    made = example_lines(count, seed, ranks)
    truth = {(i, *t) for i, (_, spans, _) in enumerate(made) for t in spans}
    where, arrays = _proposed([line for line, *_ in made], Words(ranks))
    labels = {k: np.array([(i, a, b, k) in truth for i, a, b in where[k]], dtype=float) for k in KINDS}
    groups = {k: np.array([made[i][2] for i, *_ in where[k]]) for k in KINDS}
    return arrays, labels, groups


@lru_cache(maxsize=2)
def models(count: int = 9000, seed: int = 11, path: str = TOKENIZER) -> Tools:
    """A model and a threshold for each kind from ``count`` made lines. The threshold is calibrated on one
    form of sentence in five with a model fitted on the other forms; the model kept is fitted on all.
    ``path``: the vocabulary the ranks of words come from."""
    ranks = word_ranks(path)
    arrays, labels, groups = _labelled(count, seed, ranks)
    out = {}
    for kind in KINDS:
        x, y, held = arrays[kind], labels[kind], groups[kind] % 5 == 4
        small = kind in ("ADDRESS", "EMAIL")  # few of their proposals are wrong, so little can be learnt
        trees, depth = (30, 2) if small else (80, 5)
        part = {"rows": 0.4, "columns": 0.4} if kind == "NAME" else {"rows": 0.5}
        p, true = Boosted("logistic", trees=trees // 2, depth=depth, rate=0.3, **part).fit(x[~held], y[~held]).probability(x[held]), y[held]
        bars = np.linspace(0.1, 0.9, 33)
        f1 = [2 * ((p >= b) & (true == 1)).sum() / max(1, (p >= b).sum() + (true == 1).sum()) for b in bars]
        best = [b for b, f in zip(bars, f1) if f >= max(f1) - 0.01]  # within the error of some hundred held-out spans
        model = Boosted("logistic", trees=trees, depth=depth, rate=0.2, **part).fit(x, y)
        out[kind] = (model, float(min(best, key=lambda b: abs(b - 0.5)) if kind != "ADDRESS" else best[0]))
    return Tools(out, ranks)


def find(lines: list[str], tools: Tools, words: Words | None = None) -> list[list[tuple[int, int, str]]]:
    """The accepted spans of each line, in order."""
    where, arrays = _proposed(lines, words or Words(tools.ranks))
    taken: list[list[tuple[float, int, int, str]]] = [[] for _ in lines]
    for kind in KINDS:
        if where[kind]:
            model, bar = tools.models[kind]
            p = model.probability(arrays[kind])
            for k in np.flatnonzero(p >= bar):
                i, a, b = where[kind][k]
                taken[i].append((round(float(p[k]), 0 if kind == "ADDRESS" else 2), a, b, kind))
    out = []
    for spans in taken:
        kept: list[tuple[int, int, str]] = []  # in order, as no two overlap
        for _, a, b, kind in sorted(spans, key=lambda x: (-x[0], x[1] - x[2], x)):
            at = bisect_left(kept, (a, b, kind))
            if (at == 0 or kept[at - 1][1] <= a) and (at == len(kept) or b <= kept[at][0]):
                kept.insert(at, (a, b, kind))
        out.append(kept)
    return out


class Finder:
    """Finds in texts, each distinct line once while it is remembered."""

    def __init__(self, tools: Tools, most: int = 100_000):
        self.tools, self.most = tools, most
        self.words, self.known = Words(tools.ranks), {}

    def __call__(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        if len(self.known) > self.most:
            self.known.clear()
        known, fresh = self.known, {}
        split = [text.split("\n") if text else [] for text in texts]
        for lines in split:
            for line in lines:
                if line not in known and _TRIGGER.search(line):
                    fresh[line] = None
        known.update(zip(fresh, find(list(fresh), self.tools, self.words)))
        out = []
        for lines in split:
            spans, at = [], 0
            for line in lines:
                if found := known.get(line):
                    spans += [(a + at, b + at, k) for a, b, k in found]
                at += len(line) + 1
            out.append(spans)
        return out


def find_personal(docs: DataFrame, doc: str, fields: list[str], tools: Tools | None = None) -> DataFrame:
    """``(doc, field_name, pii_type, pii_text)``: each distinct piece of a row's fields, as written.

    Null and empty fields give nothing; whole texts are searched, a piece never runs over a line break;
    a row given twice gives its pieces twice, a row without a key has a null one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tools or models())
    kind = docs.schema[doc].dataType.simpleString()

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(shared.value)
        for batch in batches:
            rows = []
            texts = [t if isinstance(t, str) else None for name in fields for t in batch[name]]
            keys = [(key, name) for name in fields for key in batch["__doc"]]
            for key, text, spans in zip(keys, texts, finder(texts)):
                for piece in dict.fromkeys((k, text[a:b]) for a, b, k in spans):
                    rows.append((*key, *piece))
            yield pd.DataFrame(rows, columns=["doc", "field_name", "pii_type", "pii_text"])

    # keys pass through Python as text, so that nulls beside large numbers change nothing
    found = docs.select(F.col(doc).cast("string").alias("__doc"), *fields).mapInPandas(search, "doc string, field_name string, pii_type string, pii_text string")
    return found.withColumn("doc", F.col("doc").cast(kind))


def redact(text: Column, tools: Tools | None = None) -> Column:
    """``text`` with each piece replaced by its type in square brackets, all else kept; null stays null."""
    tools = tools or models()

    @F.pandas_udf("string")
    def replace(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(tools)
        for texts in parts:
            values = [t if isinstance(t, str) else None for t in texts]
            out = []
            for value, spans in zip(values, finder(values)):
                if value is not None:
                    for a, b, kind in reversed(spans):
                        value = f"{value[:a]}[{kind}]{value[b:]}"
                out.append(value)
            yield pd.Series(out, dtype=object)

    return replace(text)
