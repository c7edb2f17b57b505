"""Free-entered names to entries of a reference list.

A symmetric-delete dictionary over the words of the reference names (and their short and known forms)
gives, for each word of an entered text, the reference words within two edits; entries sharing enough
words become candidates and are ranked by weighted Damerau-Levenshtein distance, then by how often the
reference name is used. Texts that no candidate fits are reported as misses.

A text broken off at its end is looked up by its first letters in a second symmetric-delete dictionary, of
the beginnings of entries, and in sorted lists of them.

Only distinct texts are resolved. A dictionary holds at most ``MAX_BLOCK`` entries; a longer list is taken in
blocks, each of which gives its best entry for every step of a resolution, and the decision is taken over the
best of all blocks by the same order, so the answers do not depend on the blocks.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut

UNMATCHED = "UNMATCHED"
#: Largest number of reference names one broadcast dictionary may hold.
MAX_BLOCK = 2_000
#: Letters of a beginning that are indexed with up to two of them taken out; shorter texts are only read literally.
HEAD = 12
#: Words that carry no weight in a name.
LINKS = {"of", "the", "and", "for", "a", "an"}
#: Common shortenings of words in names of bodies (fixed values).
SHORTENINGS = {
    "dept": "department", "dpt": "department", "dep": "department", "dep't": "department", "auth": "authority", "authy": "authority",
    "svc": "service", "svcs": "services", "serv": "service", "off": "office", "ofc": "office", "comm'ner": "commissioner",
    "commr": "commissioner", "comm'n": "commission", "commn": "commission", "cmsn": "commission", "comm": "commission",
    "agcy": "agency", "agy": "agency", "nat'l": "national", "natl": "national", "nat": "national", "inst": "institute",
    "trib": "tribunal", "obs": "observatory", "lab": "laboratory", "bur": "bureau", "bd": "board", "cncl": "council",
    "mus": "museum", "arch": "archive", "c'wealth": "commonwealth", "cwlth": "commonwealth", "fed": "federal", "ombud": "ombudsman",
}
#: Last words of the names of parts of a body.
PART_WORDS = ["branch", "division", "group", "section", "directorate", "team", "unit"]
#: Entries that name no body.
NOTHING = {"", "n a", "na", "nil", "none", "various", "see below", "multiple agencies", "multiple", "agency to be confirmed", "tba", "tbc", "unknown", "other"}
_LEAD = re.compile(r"^\W*(?:agency\s*:|australian government\b|commonwealth of australia\b|aust\.? govt\b|cth\b|the\b)[\s\-–—:,]*", re.I)
_BROKEN = re.compile(r"(?:…|\.\.+|\w-)\s*$")
_DOTTED = re.compile(r"\b(?:[A-Za-z]\.){2,}[A-Za-z]?(?!\w)")


def edit_cost(a: str, b: str, most: float) -> float:
    """Weighted Damerau-Levenshtein distance (swaps and doubled letters cost less, a changed first
    letter more); stops above ``most``."""
    if a == b:
        return 0.0
    if abs(len(a) - len(b)) > most / 0.7 + 1:
        return most + 1
    before: list[float] = []
    last = [0.0]
    for j in range(len(b)):
        last.append(last[-1] + (0.7 if j and b[j] == b[j - 1] else 1.0))
    for i, x in enumerate(a):
        drop = 0.7 if i and x == a[i - 1] else 1.0
        row = [last[0] + drop]
        for j, y in enumerate(b):
            add = 0.7 if j and y == b[j - 1] else 1.0
            change = 0.0 if x == y else 1.2 if i == j == 0 else 0.9 if x in "aeiou" and y in "aeiou" else 1.0
            cost = min(last[j + 1] + drop, row[j] + add, last[j] + change)
            if i and j and x == b[j - 1] and a[i - 1] == y and x != y:
                cost = min(cost, before[j - 1] + 0.7)
            row.append(cost)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


def deletes(word: str, most: int) -> set[str]:
    """``word`` with up to ``most`` letters taken out."""
    found = level = {word}
    for _ in range(most):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        found = found | level
    return found


def reach(length: int) -> int:
    """Edits looked for in a word of this length."""
    return 0 if length < 4 else 1 if length < 6 else 2


def plain(text: str) -> str:
    """Lower case without accents, entities or leading phrases; ``&`` and ``+`` spelt out."""
    text = html.unescape(text)
    text = _DOTTED.sub(lambda m: m[0].replace(".", ""), text)
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    text = re.sub(r"\s+", " ", text.replace("’", "'")).strip()
    while (cut := _LEAD.sub("", text)) != text:
        text = cut
    head, mark, tail = re.match(r"([^-–—:]*)([-–—:]?)(.*)", text, re.S).groups()
    if mark and (edit_cost(head.strip().lower(), "australian government", 3) <= 3 or edit_cost(head.strip().lower(), "agency", 1.2) <= 1.2):
        text = tail  # a misspelt lead
    text = re.sub(r"\([^)]*\)?", " ", text)
    return re.sub(r"\s+", " ", re.sub(r"\s*[&+]\s*", " and ", text.lower())).strip(" •*>-–—:;,./|")


@lru_cache(maxsize=100_000)
def words(text: str) -> tuple[str, ...]:
    """Words of a plain text, shortenings written out."""
    found = re.findall(r"[a-z0-9]+(?:'[a-z]+)?", text)
    return tuple(SHORTENINGS.get(w, w.replace("'", "")) for w in found)


#: How good an entry is, the lowest first: cost, less its length, whether it is only a known form, less its use, target ("" for none).
Rank = tuple[float, int, bool, float, str]


@dataclass
class Entry:
    """One way to write a reference name."""

    target: str | None
    text: str
    words: tuple[str, ...] = ()
    core: str = ""
    full: str = ""
    weight: float = 0.0
    known: bool = False

    def __post_init__(self) -> None:
        self.text = plain(self.text)
        self.words = words(self.text)
        self.core = "".join(w for w in self.words if w not in LINKS)
        self.full = "".join(self.words)

    def rank(self, cost: float) -> Rank:
        return (round(cost, 3), -len(self.core), self.known, -self.weight, self.target or "")


@dataclass
class Matcher:
    """Resolves pairs of texts against a list of entries."""

    entries: list[Entry]
    acronyms: dict[str, str]
    groups: set[str]
    by_delete: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))
    by_piece: dict[str, set[int]] = field(default_factory=lambda: defaultdict(set))

    def __post_init__(self) -> None:
        for k, entry in enumerate(self.entries):
            n = len(entry.words)
            for i in range(n):
                for j in range(i + 1, n + 1):  # joined words, as where a blank was lost
                    piece = "".join(entry.words[i:j])
                    if j - i > 1 or piece not in LINKS:
                        self.by_piece[piece].add(k)
        for piece in self.by_piece:
            for short in deletes(piece, reach(len(piece)) if len(piece) < 18 else 1):
                self.by_delete[short].add(piece)
        self.by_core: dict[str, list[int]] = defaultdict(list)
        for k, entry in enumerate(self.entries):
            if entry.core:
                self.by_core[entry.core].append(k)
        self.by_text = sorted((e.text, k) for k, e in enumerate(self.entries) if e.target)
        self.by_start = sorted((e.core, k) for k, e in enumerate(self.entries) if e.target)
        self.by_head: dict[str, list[int]] = defaultdict(list)
        for k, entry in enumerate(self.entries):
            if entry.target and len(entry.core) >= HEAD:
                for short in deletes(entry.core[:HEAD], 2):
                    self.by_head[short].append(k)
        self.longest = max(map(len, self.by_piece), default=0)
        self.parts = [(w, deletes(w, 2)) for w in PART_WORDS]

    @lru_cache(maxsize=200_000)
    def near(self, word: str) -> frozenset[int]:
        """Entries with a word, or words run together, within reach of ``word``."""
        found: set[int] = set()
        if len(word) > self.longest + 2:
            return frozenset()
        for short in deletes(word, reach(len(word)) if len(word) < 18 else 1):
            for piece in self.by_delete.get(short, ()):
                found |= self.by_piece[piece]
        return frozenset(found)

    def __hash__(self) -> int:
        return id(self)

    @staticmethod
    @lru_cache(maxsize=100_000)
    def mend(word: str) -> str:
        """A misspelt shortening written out."""
        close = [long for short, long in SHORTENINGS.items() if len(short) > 2 and edit_cost(word, short, 1.2) <= 1.2]
        return close[0] if close and len(word) > 2 else word

    def is_part(self, tail: tuple[str, ...]) -> bool:
        """Whether these words name a part of a body."""
        return 1 < len(tail) <= 5 and any(tail[-1] in near or deletes(tail[-1], 2) & near for _, near in self.parts if len(tail[-1]) > 3)

    def variants(self, text: str, most_cut: int = 5) -> Iterator[tuple[tuple[str, ...], float]]:
        """Readings of a plain text with a small cost each: as it is, turned at a comma, cut before a part
        (of at most ``most_cut`` words)."""
        found = words(text)
        yield found, 0.0
        mended = tuple(w if len(w) > 5 else self.mend(w) for w in found)
        if mended != found:
            yield mended, 0.5
        for comma in {text.find(","), text.rfind(",")} - {-1}:
            yield words(text[comma + 1 :] + " " + text[:comma]), 0.05
        for cut in re.finditer(r"\s[-–—/|]\s|,\s", text):
            yield words(text[: cut.start()]), 0.1
            head = text[: cut.start()]
            if "," in head:
                yield words(head[head.rfind(",") + 1 :] + " " + head[: head.rfind(",")]), 0.15
        for k in range(2, min(most_cut + 1, 6, len(found))):
            if self.is_part(found[-k:]):
                yield found[:-k], 0.02 * k
                head = found[:-k]
                for turn in range(1, min(3, len(head))):
                    yield head[turn:] + head[:turn], 0.02 * k + 0.2

    def best(self, text: str, most_cut: int = 5) -> Rank | None:
        """The best entry for a plain text."""
        choice = None
        readings = [(found, extra, [w for w in found if w not in LINKS]) for found, extra in self.variants(text, most_cut)]
        for _, extra, content in readings:
            for k in self.by_core.get("".join(content), ()):
                rank = self.entries[k].rank(extra)
                choice = rank if choice is None else min(rank, choice)
        if choice and choice[0] < 0.7:  # the least cost of any edit
            return choice
        for found, extra, content in readings:
            if not content:
                continue
            votes: dict[int, int] = defaultdict(int)
            for w in content:
                for k in self.near(w):
                    votes[k] += len(w)
            core, full = "".join(content), "".join(found)
            size = sum(map(len, content))
            most = 0.0 if size < 6 else 1.0 if size < 9 else 2.0 if size < 12 else 3.0 if size < 16 else 4.4
            for k, covered in votes.items():
                if covered * 2 < size:
                    continue
                entry = self.entries[k]
                cost = min(edit_cost(core, entry.core, most), edit_cost(full, entry.full, most))
                if cost <= most:
                    rank = entry.rank(cost + extra)
                    choice = rank if choice is None else min(rank, choice)
        return choice

    def _beginning(self, places: list[tuple[str, int]], start: str) -> Iterator[Entry]:
        """Entries of a sorted list that go on after ``start``."""
        for k in range(bisect_left(places, (start, -1)), len(places)):
            if not places[k][0].startswith(start):
                break
            if places[k][0] != start:
                yield self.entries[places[k][1]]

    def cut_off(self, raw: str) -> tuple[float, float, str, Rank] | None:
        """The entry that a text broken off at its end begins, literally if possible: cost, less its use and
        letters, by which such entries are ordered, and its rank."""
        text = re.sub(r"\s*(?:…|\.\.+|-)\s*$", "", raw.strip())
        marked = text != raw.strip()
        text = plain(text)
        core = "".join(w for w in words(text) if w not in LINKS)
        if len(core) < 9:
            return None
        order = lambda e: (-e.weight, e.core, e.known, e.target)
        if entry := min(self._beginning(self.by_text, text), key=order, default=None):
            cost = -0.5 if marked else 0.6
        elif entry := min(self._beginning(self.by_start, core), key=order, default=None):
            cost = 1.5
        elif len(core) >= HEAD:
            most, cost = (1.2 if len(core) < 16 else 2.0), 3.0
            near = {k for short in deletes(core[:HEAD], 2) for k in self.by_head.get(short, ()) if len(self.entries[k].core) > len(core)}
            entry = min((e for e in (self.entries[k] for k in near) if edit_cost(core, e.core[: len(core)], most) <= most), key=order, default=None)
        return (cost, -entry.weight, entry.core, entry.rank(cost)) if entry else None

    def acronym(self, raw: str) -> tuple[int, str] | None:
        """The name a short form stands for, alone (0) or before a part (1)."""
        text = _DOTTED.sub(lambda m: m[0].replace(".", ""), html.unescape(raw)).strip(" •*.:")
        text = re.sub(r"^(?:agency\s*:|the|cth|australian government\s*[-–—:]?)\s+", "", text, flags=re.I)
        head = re.split(r"\s[-–—/|]\s|,\s", text)[0].strip()
        for place, part in enumerate((head, head.split(" ")[0] if self.is_part(words(plain(" ".join(head.split(" ")[1:])))) else "")):
            if name := self.acronyms.get(part.upper()):
                return place, name
        return None

    def step(self, name: str, first: str, second: str) -> tuple | None:
        """The best this list has for one step of ``decided``."""
        if name == "nothing":
            text = " ".join(words(plain(first)))
            return (0,) if text in NOTHING or text in self.groups else None
        if name == "own":
            return self.best(one) if (one := plain(first)) else None
        if name == "joined":
            one, two = plain(first), plain(second)
            return self.best(f"{one} {two}", len(words(two))) if one and two else None
        if name == "other":
            return self.best(two) if (two := plain(second)) else None
        raw = first if name.endswith("_own") else second
        return self.acronym(raw) if name.startswith("short") else self.cut_off(raw)

    def resolve(self, first: str | None, second: str | None) -> tuple[str, float]:
        """Target and cost for what two fields mean together; the target is UNMATCHED where they mean none."""
        first, second = first or "", second or ""
        return decided(first, second, lambda name: self.step(name, first, second))


STEPS = ("nothing", "own", "joined", "other", "short_own", "short_other", "cut_own", "cut_other")


def decided(first: str, second: str, best: Callable[[str], tuple | None]) -> tuple[str, float]:
    """What two fields mean together, given the best entry of each step (asked for only where needed)."""
    empty = best("nothing") is not None
    tries: list[Rank] = []
    if not empty:
        if found := best("own"):
            tries.append(tuple(found))
        if found := best("joined"):
            tries.append((found[0] + 0.01, *found[1:]))
        if not tries and (short := best("short_own")):
            return short[1], 0.0
    elif short := best("short_other"):
        return short[1], 0.0
    if not tries and (found := best("other")):
        tries.append(tuple(found))
    if not tries or min(t[0] for t in tries) > 0.05 or _BROKEN.search(second if empty else first):
        found = best("cut_other" if empty else "cut_own")
        if found and (not tries or found[0] < min(t[0] for t in tries)):
            tries = [tuple(found[3])]
    if not tries and (short := best("short_other")):
        return short[1], 0.0
    if not tries:
        return UNMATCHED, -1.0
    # a joined reading that uses up more of the text beats a shorter one of like cost
    least = min(t[0] for t in tries)
    chosen = min(tries, key=lambda t: (t[0] > least + 0.5, t[1], t[0], *t[2:]))
    return chosen[4] or UNMATCHED, chosen[0]


def matcher(names: Iterable[tuple], known: Iterable[tuple], counts: dict[str, int], total: int | None = None) -> Matcher:
    """``names``: (name, short name, group); ``known``: (printed form, name or None); ``total``: of the counts
    of all names, where these are only some of them."""
    entries, acronyms, groups = [], {}, set()
    total = (sum(counts.values()) if total is None else total) + 1
    for name, short, group in sorted(names, key=str):
        if short and name:
            key = short.strip().upper()
            acronyms[key] = min(name, acronyms.get(key, name))
        if group:
            groups.add(" ".join(words(plain(group))))
        if name:
            entries.append(Entry(name, name, weight=counts.get(name, 0) / total))
    for printed, name in sorted(known, key=str):
        if printed and plain(printed):
            entries.append(Entry(name, printed, weight=counts.get(name, 0) / total if name else 0.0, known=True))
    return Matcher(entries, acronyms, groups)


_READY: dict[str, Matcher] = {}


def _ready(digest: str, rules: tuple) -> Matcher:
    """The matcher of these rules, built once in a worker; the one used longest ago is forgotten."""
    tool = _READY.pop(digest, None) or matcher(*rules)
    while len(_READY) >= 2:
        _READY.pop(next(iter(_READY)))
    _READY[digest] = tool
    return tool


_RANK = "struct<cost: double, length: bigint, known: boolean, weight: double, target: string>"
_SHAPES = {
    "nothing": "struct<place: bigint>", "own": _RANK, "joined": _RANK, "other": _RANK, "short_own": "struct<place: bigint, name: string>", "short_other": "struct<place: bigint, name: string>",
    "cut_own": f"struct<cost: double, weight: double, core: string, rank: {_RANK}>", "cut_other": f"struct<cost: double, weight: double, core: string, rank: {_RANK}>",
}


def map_names(pairs: DataFrame, names: DataFrame, known: DataFrame, counts: DataFrame, block: int = MAX_BLOCK) -> DataFrame:
    """Resolve distinct ``(first, second)`` pairs: adds ``target`` (a name or UNMATCHED) and ``cost``.

    ``names(name, short, group)``, ``known(printed, name)`` with a null name for forms known to mean
    none, ``counts(name, n)``. Null and blank fields mean nothing; both null is UNMATCHED. Repeated
    pairs give one row. Only the reference side is gathered, one block of about ``block`` names and known
    forms at a time; answers are the same for any ``block``.
    """
    spark = pairs.sparkSession
    # pairs are few bytes but much work each, so they are spread by count, not by size
    tasks = 4 * spark.sparkContext.defaultParallelism
    distinct = pairs.select("first", "second").distinct().repartition(tasks, "first", "second")
    often = counts.where("name is not null").groupBy("name").agg(F.sum("n").alias("n"))
    entries = names.select("name", "short", "group", F.lit(None).cast("string").alias("printed"), F.lit(False).alias("form"), F.xxhash64("name", "short", "group").alias("key"))
    forms = known.where("printed is not null").select("name", F.lit(None).cast("string").alias("short"), F.lit(None).cast("string").alias("group"), "printed", F.lit(True).alias("form"), F.xxhash64("printed").alias("key"))
    every = entries.unionByName(forms).distinct().join(often, "name", "left")
    size, total = every.count(), often.agg(F.sum("n")).first()[0] or 0
    blocks = -(-size // block) or 1
    if blocks > 1:
        every, distinct = cut(every), cut(distinct)

    def gathered(b: int) -> tuple[str, Broadcast]:
        rows = every.where(F.pmod("key", F.lit(blocks)) == b).collect()
        own = sorted(((r["name"], r["short"], r["group"]) for r in rows if not r["form"]), key=str)
        known_forms = sorted(((r["printed"], r["name"]) for r in rows if r["form"]), key=str)
        rules = (own, known_forms, {r["name"]: r["n"] for r in rows if r["n"]}, total)
        return hashlib.sha256(repr((own, known_forms, sorted(rules[2].items()), total)).encode()).hexdigest(), spark.sparkContext.broadcast(rules)

    if blocks == 1:
        digest, shared = gathered(0)

        def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tool = _ready(digest, shared.value)
            for batch in batches:
                found = [tool.resolve(x, y) for x, y in zip(batch["first"], batch["second"])]
                batch["target"], batch["cost"] = [t for t, _ in found], [c for _, c in found]
                yield batch

        return distinct.mapInPandas(resolve, "first string, second string, target string, cost double")

    parts = []
    for b in range(blocks):
        digest, shared = gathered(b)

        def steps(batches: Iterator[pd.DataFrame], digest: str = digest, shared: Broadcast = shared) -> Iterator[pd.DataFrame]:
            tool = _ready(digest, shared.value)
            for batch in batches:
                for name in STEPS:
                    found = [tool.step(name, x or "", y or "") for x, y in zip(batch["first"], batch["second"])]
                    batch[name] = pd.Series([_record(name, x) for x in found], dtype=object, index=batch.index)
                yield batch

        schema = "first string, second string, " + ", ".join(f"{n} {_SHAPES[n]}" for n in STEPS)
        parts.append(cut(distinct.mapInPandas(steps, schema)))  # one block after the other, so the driver holds one
        shared.unpersist()
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    best = union.groupBy("first", "second").agg(*[F.min(n).alias(n) for n in STEPS])

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.to_dict("records"):
                first, second = row["first"] or "", row["second"] or ""
                rows.append((row["first"], row["second"], *decided(first, second, lambda name, row=row: _values(row[name]))))
            yield pd.DataFrame(rows, columns=["first", "second", "target", "cost"])

    return best.mapInPandas(decide, "first string, second string, target string, cost double")


def _record(name: str, found: tuple | None) -> dict | None:
    """A step's result by field names."""
    rank = lambda r: dict(zip(("cost", "length", "known", "weight", "target"), r))
    if found is None:
        return None
    if name == "nothing":
        return {"place": found[0]}
    if name.startswith("short"):
        return {"place": found[0], "name": found[1]}
    return {"cost": found[0], "weight": found[1], "core": found[2], "rank": rank(found[3])} if name.startswith("cut") else rank(found)


def _values(found) -> tuple | None:  # noqa: ANN001
    """A step's result as a tuple again."""
    if found is None or (isinstance(found, float) and found != found):
        return None
    values = found.values() if isinstance(found, dict) else found
    return tuple(_values(v) if isinstance(v, dict) or hasattr(v, "asDict") else v for v in values)
