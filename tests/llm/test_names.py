import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.names import LINKS, UNMATCHED, deletes, edit_cost, map_names, matcher, plain, words

NAMES = [
    ("Coastal Lights and Beacons Authority", "CLBA", "Shores and Passage"), ("Bureau of Inland Tides", "BIT", "Shores and Passage"), ("Bureau of Island Tides", None, "Shores and Passage"),
    ("Department of Ores and Quarries", "DOQ", "Earth Resources"), ("Department of Ores, Quarries and Salts", "DOQS", "Earth Resources"), ("National Map Archive", "NMA", "Records"),
    ("Department of Arrivals", None, "Borders"), ("Department of Arrivals and Skills", "DAS", "Borders"), ("Wool, Hide and Fibre Board", "WHFB", "Fields"),
]
KNOWN = [("The Beacon Office", "Coastal Lights and Beacons Authority"), ("Holsby City Council", None), ("Various", None)]
CASES = [
    ("Coastal Lights & Beacons Auth.", None, 0), ("COASTAL LIGHTS AND BEACONS AUTHORITY INSPECTION BRANCH", "x", 0), ("CoastalLightsandBeacons Authority", None, 0), ("C.L.B.A.", "Group", 0),
    ("CLBA - Finance Division", None, 0), ("Cosatal Ligts and Becons Authortiy", None, 0), ("the beacon office", None, 0), ("Shores and Passage", "Bureau Inland Tides", 1), ("Bureau of Ilsand Tides", None, 2),
    ("Inland Tides, Bureau of", "Digital Group", 1), ("Bureau of", "Inland Tides Digital Branch", 1), ("Department of Ores, Qua", None, 4), ("Various", "Dept. of Ores &amp; Quarries", 3), ("Officé", None, None),
    ("Department of Arrivals", "and Skills Corporate Directorate", 7), ("Department of Arrivals", "Corporate Directorate", 6), ("Department of Arrivals an…", None, 7), ("National Map Shop", "Archive Branch", None),
    ("Holsby City Council", "Finance Group", None), ("Earth Resources", "Finance Group", None), (None, None, None), ("", "", None), ("N/A", "Board, Wool, Hide and Fibre", 8), ("Agncy: National Map Archive", None, 5),
    ("x" * 20_000, "y", None), ("Agency to be confirmed", "BIT", 1),
]


@pytest.fixture(scope="module")
def tool():
    return matcher(NAMES, KNOWN, {"Bureau of Inland Tides": 5})


@pytest.mark.parametrize(("first", "second", "want"), CASES)
def test_readings(tool, first, second, want):
    assert tool.resolve(first, second)[0] == (UNMATCHED if want is None else NAMES[want][0])


def plain_distance(a, b):
    rows = {(-1, -1): 0}
    for i in range(len(a)):
        rows[i, -1] = i + 1
    for j in range(len(b)):
        rows[-1, j] = j + 1
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i, j] = min(rows[i - 1, j] + 1, rows[i, j - 1] + 1, rows[i - 1, j - 1] + (x != y))
            if i and j and x == b[j - 1] and a[i - 1] == y:
                rows[i, j] = min(rows[i, j], rows[i - 2, j - 2] + 1)
    return rows[len(a) - 1, len(b) - 1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", max_size=8), st.text("abcd", max_size=8))
def test_weights_only_shade_the_distance(a, b):
    plain = plain_distance(a, b)
    assert 0.7 * plain - 1e-9 <= edit_cost(a, b, 99) <= 1.2 * plain + 1e-9


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=4, max_size=8), st.text("abc", min_size=4, max_size=8))
def test_symmetric_deletes_lose_nothing_within_two_edits(a, b):
    if plain_distance(a, b) <= 2:
        assert deletes(a, 2) & deletes(b, 2)


def test_broken_off_texts_are_found_as_by_trying_every_entry(tool):
    rng = random.Random(9)

    def tried(raw):
        core = "".join(w for w in words(plain(raw)) if w not in LINKS)
        most = 1.2 if len(core) < 16 else 2.0
        return {e.target for e in tool.entries if e.target and len(e.core) > len(core) and edit_cost(core, e.core[: len(core)], most) <= most}

    for _ in range(400):
        name = rng.choice(NAMES)[0]
        text = list(name[: rng.randint(14, max(15, len(name) - 2))])
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(text) - 1)
            how = rng.randrange(4)
            if how == 0:
                text[k], text[k + 1] = text[k + 1], text[k]
            elif how == 1:
                del text[k]
            elif how == 2:
                text.insert(k, rng.choice("aeiorst"))
            else:
                text[k] = rng.choice("aeiorst")
        raw = "".join(text)
        found = tool.cut_off(raw)
        if found and found[0] == 3.0:
            assert found[3][4] in tried(raw)
        if found is None and sum(len(w) for w in words(plain(raw)) if w not in LINKS) >= 12:
            assert not tried(raw)


def test_planted_edits_are_undone(tool):
    rng = random.Random(5)
    wrong = 0
    for _ in range(200):
        name = NAMES[rng.choice([0, 3, 5, 8])][0]
        text = list(name)
        for _ in range(2):
            k = rng.randrange(1, len(text) - 1)
            how = rng.randrange(3)
            if how == 0:
                text[k], text[k + 1] = text[k + 1], text[k]
            elif how == 1:
                del text[k]
            else:
                text.insert(k, rng.choice("aeiorst"))
        wrong += tool.resolve("".join(text), "Data Branch")[0] != name
    assert wrong <= 4


def test_column_form_in_blocks(spark):
    pairs = spark.createDataFrame([(f, s, i) for i, (f, s, _) in enumerate(CASES * 2)], "first string, second string, target int")
    names = spark.createDataFrame(NAMES, "name string, short string, `group` string")
    known = spark.createDataFrame(KNOWN, "printed string, name string")
    counts = spark.createDataFrame([("Bureau of Inland Tides", 5)], "name string, n long")
    one = {(r["first"], r["second"]): r["target"] for r in map_names(pairs, names, known, counts).collect()}
    assert len(one) == len({(f, s) for f, s, _ in CASES})
    assert all(one[f, s] == (UNMATCHED if w is None else NAMES[w][0]) for f, s, w in CASES)
    for block in (5, 16):
        assert {(r["first"], r["second"]): r["target"] for r in map_names(pairs, names, known, counts, block=block).collect()} == one
    assert map_names(pairs.limit(0), names, known, counts).count() == 0
    assert {r["target"] for r in map_names(pairs, names.limit(0), known.limit(0), counts.limit(0)).collect()} == {UNMATCHED}
