import datetime as dt
import random
import re

from tidemark.operators.asof import intervals, join_as_known

D = dt.date
LINEAGE = "predecessor_canonical string, successor_canonical string, effective_date date, relation string"


def brute(name, day, edges):
    if ahead := [b for a, b, d in edges if a == name and d <= day]:
        return set().union(*[brute(b, day, edges) for b in ahead])
    births = [d for a, b, d in edges if b == name]
    if births and min(births) > day:
        return set().union(*[brute(a, day, edges) for a, b, d in edges if b == name])
    return {name}


def test_against_walks(spark):
    rng = random.Random(1)
    rows = [
        ("A", "B", D(2020, 1, 1)), ("B ", "C", D(2021, 1, 1)), ("B", "D", D(2021, 1, 1)), ("X", "Y", D(2020, 5, 1)), ("Z", "Y", D(2020, 5, 1)), ("Y", "W  V", D(2023, 1, 1)),
        ("A", "B", D(2020, 1, 1)), ("Q", "R", None), (None, "R", D(2020, 1, 1)), ("S", "S", D(2020, 1, 1)),
    ]
    lineage = spark.createDataFrame([(*r, "x") for r in rows], LINEAGE)
    clean = lambda x: re.sub(r"\s+", " ", x).strip()
    edges = {(clean(a), clean(b), d) for a, b, d in rows if a and b and d and a.strip() != b.strip()}
    events = [(i, rng.choice("A B C D X Y Z Q R S T".split() + ["W V"]), D(2019, 1, 1) + dt.timedelta(rng.randrange(2000))) for i in range(300)]
    events += [(900, None, D(2020, 1, 1)), (901, "A", None), (902, " ", D(2020, 1, 1))] + [(i, "A", D(2020, 1, 1)) for i in range(1000, 1005)]
    df = spark.createDataFrame(events, "event_id int, agency string, day date")
    got = {}
    for r in join_as_known(df, lineage, "agency", "day").collect():
        got.setdefault(r["event_id"], set()).add(r["canonical_in_force"])
    for i, name, day in events:
        want = brute(clean(name), day, edges) if name and name.strip() and day else {None}
        assert got[i] == want, (name, day)


def test_no_lineage_no_events_and_clashing_names(spark):
    none = spark.createDataFrame([], LINEAGE)
    df = spark.createDataFrame([(1, "A", D(2020, 1, 1), "v", "f", "n")], "id int, agency string, day date, version string, in_force string, canonical_in_force string")
    row = join_as_known(df, none, "agency", "day").first()
    assert row["canonical_in_force"] == "A" and row["version"] == "v" and row["in_force"] == "f"
    assert join_as_known(df.limit(0), none, "agency", "day").count() == 0 and intervals(none).count() == 0


def test_repeated_events_stay(spark):
    lineage = spark.createDataFrame([("A", "B", D(2020, 1, 1), "rename")], LINEAGE)
    df = spark.createDataFrame([(1, "A", D(2021, 1, 1))] * 3, "id int, agency string, day date")
    assert [r["canonical_in_force"] for r in join_as_known(df, lineage, "agency", "day").collect()] == ["B"] * 3


def test_loop_in_lineage_ends(spark):
    lineage = spark.createDataFrame([("A", "B", D(2020, 1, 1), "x"), ("B", "A", D(2020, 1, 1), "x")], LINEAGE)
    df = spark.createDataFrame([(1, "A", D(2021, 1, 1))], "id int, agency string, day date")
    assert join_as_known(df, lineage, "agency", "day").count() >= 1
