import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.repeats import chunks, cut_lines, repeated_lines, with_repeated


def key(line):
    return re.sub(r"[^a-z]+", " ", line.lower()).strip()


def brute(rows, least=5, share=0.1, words=5):
    docs, lines = defaultdict(set), defaultdict(set)
    for doc, source, text in rows:
        if source is None:
            continue
        docs[source].add(doc)
        for line in (text or "").split("\n"):
            if len(key(line).split()) >= words:
                lines[source, key(line)].add(doc)
    good = {k for k, d in lines.items() if len(d) >= least and len(d) * 10 >= len(docs[k[0]]) * share * 10}
    return {(doc, key(line)) for doc, source, text in rows if source for line in (text or "").split("\n") if (source, key(line)) in good}


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc long, source string, text string")
    lines, repeated = repeated_lines(df, "doc", "source", "text")
    marked = with_repeated(lines, repeated, "source").where("repeated is not null")
    kept = marked.select("doc", F.explode(F.filter("keys", lambda k: F.array_contains("repeated", F.xxhash64(k)))).alias("key"))
    return {(r["doc"], r["key"]) for r in kept.collect()}, df, repeated


def test_against_counting(spark):
    rng = random.Random(4)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}ord" for i in range(80)]
    common = [" ".join(rng.choices(vocabulary, k=rng.randrange(4, 14))) for _ in range(12)]
    rows = []
    for doc in range(240):
        source = rng.choice(["hot"] * 6 + ["a", "b", None])
        lines = [rng.choice(common) if rng.random() < 0.4 else " ".join(rng.choices(vocabulary, k=rng.randrange(3, 12))) for _ in range(rng.randrange(0, 9))]
        lines = [x.upper() + "!" if rng.random() < 0.2 else x.replace(" ", "  ") if rng.random() < 0.1 else x for x in lines]
        rows.append((doc, source, "\n".join(lines) if rng.random() < 0.95 else None))
    rows += rows[:20] + [(900, "a", ""), (901, "a", "é" * 100_000), (902, "a", " ".join(common) * 200)]
    got, df, repeated = found(spark, rows)
    assert got == brute(rows) and got
    clean = with_repeated(df, repeated, "source").select("doc", "source", "text", cut_lines(F.col("text"), F.col("repeated")).alias("clean"))
    for r in clean.collect():
        want = r["text"] if r["text"] is None or r["source"] is None else "\n".join(x for x in r["text"].split("\n") if (r["doc"], key(x)) not in got)
        assert r["clean"] == want


def test_exactly_a_tenth_counts(spark):
    rows = [(i, "s", "this line is long enough here" if i < 5 else f"other words {'abcdefghij'[i % 10]} are in this") for i in range(50)]
    assert {k for _, k in found(spark, rows)[0]} >= {"this line is long enough here"}
    rows = [(i, "s", "this line is long enough here" if i < 4 else None) for i in range(6)]
    assert found(spark, rows)[0] == set()


def test_empty(spark):
    assert found(spark, [(1, None, "a b c d e f")])[0] == set()


def test_chunks_depend_on_content_alone():
    rng = np.random.default_rng(1)
    core = rng.integers(97, 123, 2000).astype(np.uint8)
    a = np.concatenate([rng.integers(97, 123, 77).astype(np.uint8), core])
    b = np.concatenate([rng.integers(97, 123, 300).astype(np.uint8), core, core[:50]])
    (sa, ea, ha), (sb, eb, hb) = chunks(a), chunks(b)
    inside_a = set(ha[(sa >= 77 + 12) & (ea <= 2077)].tolist())
    assert inside_a and inside_a <= set(hb.tolist()) and 8 < np.mean(ea - sa) < 32
    assert all(len(x) == 0 for x in chunks(np.zeros(3, np.uint8)))
