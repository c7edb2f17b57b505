import random

import numpy as np
import pytest

from tidemark.llm import reading as R
from tidemark.llm import subjects as S
from tidemark.llm.boosting import Boosted
from tidemark.llm.sampling import quotas, sample_groups, sample_rows

TOPICS = {
    "tides": ["tide gauges", "harbour depth charts", "sea ice edges", "reef surveys", "salt samples"], "coins": ["coin presses", "token moulds", "mint ledgers", "silver bars", "medal dies"],
    "songs": ["choir scores", "drum lessons", "song books", "flute repairs", "dance halls"],
}
VERBS = ["check", "record", "mend", "sort", "list"]


def documents(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        topic = rng.choice(list(TOPICS))
        lines = [f"{rng.choice(VERBS)} {rng.choice(TOPICS[topic])} with care" for _ in range(3)] + [f"{rng.choice(VERBS)} meeting notes for the branch", "Keep good order at all times"]
        rng.shuffle(lines)
        out.append(("\n".join(lines), topic))
    return out


def test_subjects_of_held_out_documents():
    model = S.fit(documents(400, 1), S.Settings(rank=40))
    held = documents(200, 2)
    model = S.calibrate(model, [(t, {y}) for t, y in held[:100]], 2)
    right = 0
    for text, topic in held[100:]:
        lines = S.lines_of(text)
        found = {model.subjects[k] for k in model.assign(lines) if k >= 0}
        right += found == {topic}
    assert right >= 97
    assert model.assign(["keep good order at all times", ""]).tolist() == [-1, -1]


def test_subject_columns(spark):
    docs = documents(300, 3)
    labelled = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(docs)] + [(999, None, "tides"), (998, "x", None)], "doc long, text string, subject string")
    model = S.fitted(labelled, "text", "subject", None, "doc", S.Settings(rank=40))
    rows = [(1, "check tide gauges daily\nsort reef surveys\nsort reef surveys", "x"), (2, None, "x"), (3, "", "x"), (4, "check tide gauges", "x"), (5, "a " * 100_000, "x")]
    df = spark.createDataFrame(rows, "id long, text string, subject string")
    assert [(r["doc"], r["subject"], r["lines"]) for r in S.assign_subjects(df, "id", "text", model).collect()] == [(1, "tides", 2)]
    empty = S.fitted(labelled.limit(0), "text", "subject", None, "doc")
    assert S.assign_subjects(df, "id", "text", empty).count() == 0


def test_titles_decide_only_between_two_near_subjects():
    class Fixed(S.Model):
        def embed(self, lines):
            of = {"reefs": [1, 0], "hives": [0, 1], "either": [0.71, 0.70], "": [0, 0]}
            return np.array([of.get(x, [0, 0]) for x in lines], dtype=np.float32), np.array([9.0 if x in of and x else 0.0 for x in lines])

    model = Fixed(["tides", "bees"], {"x": 0}, np.zeros((1, 2)), np.zeros(1), np.eye(2, dtype=np.float32))
    sure, between = model.lean(["reefs", "either", "hives", "unknown"])
    assert sure.tolist() == [0, -1, 1, -1] and between.tolist() == [[-1, -1], [0, 1], [-1, -1], [-1, -1]]


def test_titles_of_documents(spark):
    docs = documents(300, 3)
    labelled = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(docs)], "doc long, text string, subject string")
    model = S.fitted(labelled, "text", "subject", None, "doc", S.Settings(rank=40))
    rows = [(1, "check tide gauges daily\nsort reef surveys", "Keeper of hives"), (2, "check tide gauges daily", "sort reef surveys"), (3, None, "sort reef surveys"), (4, "check tide gauges daily\nsort reef surveys", None)]
    df = spark.createDataFrame(rows, "id long, text string, head string")
    assert sorted((r["doc"], r["subject"]) for r in S.assign_subjects(df, "id", "text", model, title="head").collect()) == [(1, "tides"), (4, "tides")]


def test_sample_is_even_over_groups(spark):
    assert quotas({"a": 2, "b": 900, "c": 900}, 100) == {"a": 2, "b": 49, "c": 49}
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 1000 = 7 THEN 'rare' WHEN id % 2 = 0 THEN 'even' ELSE 'odd' END AS g")
    one = sample_groups(df.union(df).union(spark.createDataFrame([(None, "odd"), (1, None)], "id long, g string")), "id", "g", 203)
    assert {g: sum(r["g"] == g for r in one) for g in ("rare", "even", "odd")} == {"rare": 3, "even": 100, "odd": 100}
    assert one == sample_groups(df.repartition(7), "id", "g", 203) and sample_groups(df.limit(0), "id", "g", 5) == []
    with pytest.raises(ValueError, match="groups"):
        sample_groups(df, "id", "g", 9, most_groups=2)


def test_rare_subject_is_assigned_and_terms_count_over_all_documents(spark):
    docs = documents(1200, 5) + [("grow bee hives\nsmoke honey combs\nKeep good order at all times", "bees")] * 2
    labelled = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(docs)], "doc long, text string, subject string")
    model = S.fitted(labelled, "text", "subject", None, "doc", S.Settings(sample=200, rank=40))
    df = spark.createDataFrame([(1, "grow bee hives\nsmoke honey combs")], "id long, text string")
    assert [(r["subject"], r["lines"]) for r in S.assign_subjects(df, "id", "text", model).collect()] == [("bees", 2)]
    every = labelled.select("doc", "text").union(spark.createDataFrame([(5000, "bee\nbee"), (5000, "bee\nbee"), (5001, None), (5002, "other things")], "doc long, text string"))
    assert S.document_frequencies(every, "doc", "text", {"bee", "grow bee", "none"}) == ({"bee": 3, "grow bee": 2}, 1204)


def test_boosting_learns_and_predicts_alike():
    rng = np.random.default_rng(0)
    x = rng.random((800, 4))
    y = (x[:, 0] > 0.5).astype(float) + 2 * (x[:, 1] > 0.3)
    model = Boosted("squared", trees=60).fit(x[:600], y[:600])
    assert np.mean((model.score(x[600:]) - y[600:]) ** 2) < 0.05
    z = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert np.mean((Boosted("logistic", trees=60, depth=4).fit(x[:600], z[:600]).probability(x[600:]) > 0.5) == z[600:]) > 0.93


@pytest.fixture(scope="module")
def samples(folder):
    import pandas as pd

    table = pd.read_parquet(f"{folder}/reading_samples.parquet")
    return list(zip(table["text"], table["reading_level"]))


def test_validation_by_source_holds_whole_sources_out(samples):
    few = sorted(samples)[:150]
    model = R.fit(few, groups=[f"s{i % 3}" for i in range(len(few))])
    assert set(model.by_group) == {"s0", "s1", "s2"} and min(model.by_group.values()) > 0.8
    sizes = [sum(i % 3 == k for i in range(len(few))) for k in range(3)]
    assert np.isclose(np.average([model.by_group[f"s{k}"] for k in range(3)], weights=sizes), model.agreement)
    with pytest.raises(ValueError, match="two sources"):
        R.fit(few, groups=["one"] * len(few))


def test_strict_validation_keeps_a_fold_out_of_everything(samples):
    few = sorted(samples)[:120]
    model = R.fit(few, strict=True)
    assert model.agreement > 0.8 and model.levels == R.fit(few).levels


def test_levels_of_held_out_passages(samples):
    rng = random.Random(1)
    rng.shuffle(samples)
    model = R.fit(samples[:160])
    got = model.grade([t for t, _ in samples[160:]])
    short = [len(t.split()) < 40 for t, _ in samples[160:]]
    right = [g == y or s for g, (_, y), s in zip(got, samples[160:], short)]
    assert np.mean(right) >= 0.95 and model.agreement > 0.95


def test_what_gets_a_level(samples, spark):
    model = R.fit(samples)
    english = samples[0][0] * 3
    texts = [english, None, "", " ", "too short", "VN-1 | APS4 | $5 | 9/11/2025\n" * 40, "Le salaire dépend de votre expérience et du poste. " * 20, english.replace(" ", "\n", 30), "- " + english]
    levels = model.grade(texts)
    assert levels[0] is not None and levels[1:7] == [None] * 6 and levels[7] is not None and levels[8] == levels[0]
    df = spark.createDataFrame([(t, 9) for t in texts], "text string, reading_level int")
    assert [r["reading_level"] for r in R.grade(df, "text", model).collect()] == levels
    assert R.profile(R.grade(df.limit(0), "text", model), "text").count() == 0
    assert R.fit([]).grade([english]) == [None] and R.fit([(english, 2)]).grade([english]) == [None]


def test_broken_lines_make_the_same_sentences():
    text = "The cat sat on the mat and slept. The dog ran off to the far green hill again."
    assert R.sentences_of(text) == R.sentences_of("The cat sat on the mat\nand slept. The dog ran off\nto the far green hill again.")
    assert R.sentences_of("Page 3 of 9\n1. The cat sat down\n(b) The dog & bone ran\n• It was fun to go") == [["the", "cat", "sat", "down"], ["the", "dog", "and", "bone", "ran"], ["it", "was", "fun", "to", "go"]]


def test_samples_do_not_depend_on_layout(spark):
    df = spark.range(20_000).selectExpr("id", "id % 7 AS v")
    one = sample_rows(df.repartition(13), "id", 500)
    assert len(one) == 500 and one == sample_rows(df.union(df).coalesce(1), "id", 500)[: len(one)] or {r["id"] for r in one} >= {r["id"] for r in sample_rows(df.union(df), "id", 400)}
    assert len(sample_rows(df.limit(30), "id", 500)) == 30 and sample_rows(df.limit(0), "id", 5) == []
