"""How common words are, from the ranks of a public tokenizer's vocabulary.

A vocabulary of merged pieces lists frequent words whole, so the rank of a word in small letters and of the
same word with a capital tells common words, words written with a capital only (names of people and places)
and rare ones apart. The table is bounded by the vocabulary (some 30,000 words, below 1 MB).
"""

from __future__ import annotations

import base64
import math
from functools import lru_cache

from tidemark.llm.tokens import TOKENIZER

#: Stands for the rank of words the vocabulary does not hold.
RARE = 17.0


@lru_cache(maxsize=4)
def word_ranks(path: str = TOKENIZER) -> dict[str, tuple[float, float]]:
    """By lower-case word the binary logarithms of the ranks in small letters and with a capital."""
    small: dict[str, float] = {}
    capital: dict[str, float] = {}
    with open(path, "rb") as file:
        for piece, rank in map(bytes.split, file):
            text = base64.b64decode(piece)
            if text[:1] != b" " or not text[1:].isalpha() or len(text) < 3:
                continue
            word = text[1:].decode("ascii", "ignore")
            if word.islower():
                small[word] = math.log2(int(rank) + 2)
            elif word[1:].islower():
                capital[word.lower()] = math.log2(int(rank) + 2)
    return {w: (small.get(w, RARE), capital.get(w, RARE)) for w in small.keys() | capital.keys()}


_ENDINGS = (("ies", "y"), ("es", ""), ("s", ""), ("ing", ""), ("ing", "e"), ("ed", ""), ("ers", ""), ("er", ""))


def ranks_of(word: str, ranks: dict[str, tuple[float, float]]) -> tuple[float, float]:
    """Ranks of a lower-case word; a form of a common word that the vocabulary lacks counts as a little rarer."""
    if found := ranks.get(word):
        return found
    for end, instead in _ENDINGS:
        if word.endswith(end) and len(word) > len(end) + 2 and (found := ranks.get(word[: -len(end)] + instead)) and found[0] < found[1] + 1:
            return min(found[0] + 1, RARE), RARE
    return RARE, RARE


def common_words(ranks: dict[str, tuple[float, float]], most: int = 16_000) -> list[str]:
    """The most frequent words that are written small more often than not, most frequent first."""
    found = sorted((low, w) for w, (low, up) in ranks.items() if low < up and len(w) > 2)
    return [w for _, w in found[:most]]


def capital_words(ranks: dict[str, tuple[float, float]]) -> list[str]:
    """Words written with a capital only, most frequent first: names of people, places and bodies."""
    found = sorted((up, w) for w, (low, up) in ranks.items() if low >= RARE and len(w) > 2)
    return [w.capitalize() for _, w in found]
