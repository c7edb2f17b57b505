import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing as M
from tidemark.llm import packing as K
from tidemark.llm import queries as Q
from tidemark.llm.sums import sums_before
from tidemark.llm.tokens import TOKENIZER, counter, with_token_counts

ITEMS = "doc long, source string, n_tokens long"


def items(n, seed, top=400):
    rng = random.Random(seed)
    return [(i, rng.choice(["hot"] * 4 + ["a", "b", None]), rng.choice([0, rng.randrange(1, 60), rng.randrange(1, top), 5 * top if rng.random() < 0.05 else 9])) for i in range(n)]


def test_every_token_once_and_whole_items(spark):
    rows = items(1500, 1)
    df = spark.createDataFrame(rows, ITEMS)
    for shard_tokens in (10**9, 20_000):
        placed = K.pack(df, 512, shard_tokens=shard_tokens).toPandas()
        placed["n"] = placed["token_end"] - placed["token_start"]
        used = placed.groupby("container")["n"].sum()
        assert used.max() <= 512 and used.sum() == sum(r[2] for r in rows)
        pieces = placed.groupby("doc")["n"].agg(["sum", "count"])
        for doc, _, size in rows:
            if size:
                assert pieces.loc[doc, "sum"] == size and pieces.loc[doc, "count"] == -(-size // 512)
        assert not placed.duplicated(["doc", "piece"]).any() and not placed.duplicated(["container", "position"]).any()
        if shard_tokens == 10**9:
            assert used.sum() / (len(used) * 512) > 0.98
    report = K.fill_report(K.pack(df, 512), 512).first()
    assert report["fullest"] <= 512 and report["containers"] >= report["least_containers"]


def test_shares_are_kept_window_by_window():
    rng = random.Random(2)
    queues = {s: sorted((rng.randrange(5, 40), 10_000 * k + i) for i in range(n)) for k, (s, n) in enumerate((("a", 3000), ("b", 1000)))}
    total = {s: sum(x for x, _ in q) for s, q in queues.items()}
    shares = {s: n / sum(total.values()) for s, n in total.items()}
    size = {row: x for q in queues.values() for x, row in q}
    seen, off = dict.fromkeys(total, 0), []
    for window in K.fill({s: list(q) for s, q in queues.items()}, 1000, shares, dict.fromkeys(total, 0.0)):
        for s, row in window:
            seen[s] += size[row]
        off.append(max(abs(seen[s] - shares[s] * sum(seen.values())) for s in seen))
    assert sum(seen.values()) == sum(total.values()) and max(off[:-1]) < 120


def test_report_tells_deviation_from_targets(spark):
    rows = [("c1", "a", 0, 6), ("c1", "b", 0, 2), ("c2", "a", 0, 8)]
    placed = spark.createDataFrame(rows, "container string, source string, token_start long, token_end long")
    got = K.fill_report(placed, 8, {"a": 0.5, "b": 0.5}).first()
    assert (got["mean_deviation"], got["largest_deviation"]) == (0.375, 0.5)
    got = K.fill_report(placed, 8).first()  # overall shares 7/8 and 1/8
    assert (got["mean_deviation"], got["largest_deviation"]) == (0.125, 0.125)


def test_full_pieces_count_in_the_mixture(spark):
    # a's two full pieces use up what a is owed, so b goes first in the windows left
    df = spark.createDataFrame([(1, "a", 200)] + [(i, s, 10) for i, s in enumerate("abababab", 10)], "doc long, source string, n_tokens long")
    placed = K.pack(df, 100, {"a": 0.5, "b": 0.5}).orderBy("position").where("token_end = 10").collect()
    assert [r["source"] for r in placed[:4]].count("b") >= 3


def test_any_number_of_kinds_is_packed(spark, tmp_path):
    spark.range(101).selectExpr("concat('k', id) AS container_kind", "id + 1 AS capacity_tokens").write.parquet(f"{tmp_path}/container_sizes.parquet")
    kinds = Q._containers(spark, str(tmp_path))
    assert len(kinds) == 101
    placed = K.pack_kinds(spark.createDataFrame([(1, "a", 70), (2, "b", 30)], ITEMS), kinds)
    used = {r["container_kind"]: r["n"] for r in placed.selectExpr("container_kind", "token_end - token_start AS n").groupBy("container_kind").sum("n").toDF("container_kind", "n").collect()}
    assert used == dict.fromkeys(kinds, 100)


def plain_packing(rows, capacity):
    """Windows of one shard by the rule itself, every choice among all items."""
    left = [(s or "", n, d) for d, s, n in rows if n]
    total = sum(n for _, n, _ in left)
    shares = {s: sum(n for t, n, _ in left if t == s) / total for s, _, _ in left}
    owed, windows = dict.fromkeys(shares, 0.0), []
    while left:
        for s in owed:
            owed[s] += shares[s] * capacity
        large = {s for s, n, _ in left if 2 * n > capacity}
        window, room = [], capacity
        while True:
            fits = [x for x in left if x[1] <= room]
            if not fits:
                break
            pool = {s for s, _, _ in fits} if window or not large else large
            s = max(pool, key=lambda s: (owed[s], s))
            item = max((x for x in fits if x[0] == s), key=lambda x: (x[1], x[2]))
            left.remove(item)
            window.append(item[2])
            room -= item[1]
            owed[s] -= item[1]
        windows.append(window)
    return sorted(map(tuple, windows))


def test_packing_as_by_trying_all_items(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["hot"] * 4 + ["a", "b", None]), rng.randrange(1, 100)) for i in range(300)]
    placed = K.pack(spark.createDataFrame(rows, ITEMS), 101).toPandas().sort_values("position")
    assert sorted(tuple(g["doc"]) for _, g in placed.groupby("container")) == plain_packing(rows, 101)


def test_sources_may_be_many(spark):
    df = spark.range(100_001).selectExpr("id AS doc", "concat('s', id) AS source", "1 + id % 7 AS n_tokens")
    placed = K.pack(df, 64, shard_tokens=20_000)
    assert placed.selectExpr("count(*)", "sum(token_end - token_start)").first() == (100_001, sum(1 + i % 7 for i in range(100_001)))


def test_running_sums(spark):
    rng = random.Random(6)
    rows = [(k, i, rng.randrange(9)) for k in "ab" for i in rng.sample(range(500), 300)]
    for keys in (["k"], []):
        mine = [r for r in rows if keys or r[0] == "a"]
        got = {(r["k"], r["i"]): r["s"] for r in sums_before(spark.createDataFrame(mine, "k string, i int, v int"), keys, "i", {"s": F.col("v")}, width=7).collect()}
        assert got == {(k, i): sum(w for q, j, w in mine if q == k and j < i) for k, i, _ in mine}


def test_packing_of_nothing(spark):
    assert K.pack(spark.createDataFrame([], ITEMS), 10).count() == 0 and K.pack(spark.createDataFrame([(1, "a", 0), (None, "a", 5), (2, "a", None)], ITEMS), 10).count() == 0
    with pytest.raises(ValueError):
        K.pack(spark.createDataFrame([], ITEMS), 0)


def test_permutations():
    for size in (1, 2, 3, 17, 256, 1000):
        for key in (0, 5):
            out = M.permute(np.arange(size), np.full(size, size), np.full(size, key))
            assert sorted(out.tolist()) == list(range(size))
    a, b = (M.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, k)) for k in (1, 2))
    assert (a == b).mean() < 0.05 and (np.diff(a) == 1).mean() < 0.05


def test_shares_within_caps():
    got = M.shares_within_caps({"a": 0.5, "b": 0.3, "c": 0.2, "none": 0.1}, {"a": 1000, "b": 10, "c": 1000, "none": 0}, 100)
    assert abs(sum(got.values()) - 1) < 1e-9 and abs(got["b"] - 0.1) < 1e-9 and got["none"] == 0 and abs(got["a"] / got["c"] - 2.5) < 1e-9
    got = M.shares_within_caps({"a": 0.5, "b": 0.5}, {"a": 90, "b": 90}, 100)
    assert got == {"a": 0.5, "b": 0.5}


TARGETS = "source string, target_share double, max_repeats long"


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 6 + ["mid"] * 3 + ["rare"]), rng.randrange(0, 300)) for i in range(3000)] + [(9000, "untargeted", 500), (9001, None, 500)]
    targets = [("hot", 0.3, 2), ("mid", 0.4, 2), ("rare", 0.3, 2), ("absent", 0.1, 5), (None, 0.2, 1), ("mid", 0.1, 1)]
    df, goal = spark.createDataFrame(rows, ITEMS), spark.createDataFrame(targets, TARGETS)
    drawn, report = M.mix(df, goal, M.Settings(block=64, shard_blocks=200))
    got, table = drawn.toPandas(), report.toPandas().set_index("source")
    held = {s: sum(r[2] for r in rows if r[1] == s) for s in ("hot", "mid", "rare")}
    assert set(got["source"]) == {"hot", "mid", "rare"} and table.loc["absent", "tokens"] == 0
    assert (table["repeats"] <= table["max_repeats"]).all() and (table.loc["rare", "repeats"] == 2)
    assert not got.duplicated(["shard", "slot", "doc", "token_start"]).any()
    got["n"] = got["token_end"] - got["token_start"]
    blocks = got.groupby(["shard", "slot"]).agg(n=("n", "sum"), block=("block", "first"), source=("source", "first"), turn=("repeat", "first"))
    assert (blocks["n"] <= 64).all() and (blocks["n"] == 64).mean() > 0.99 and not blocks.duplicated(["source", "block", "turn"]).any()
    free = table.loc[["hot", "mid"], "actual_share"]
    assert abs(free["hot"] / free["mid"] - 0.75) < 0.08 and abs(table["actual_share"].sum() - 1) < 1e-9
    assert abs(blocks["n"].sum() - sum(held.values())) < 0.02 * sum(held.values()) + 64
    assert drawn.exceptAll(M.mix(df.repartition(7), goal, M.Settings(block=64, shard_blocks=200))[0]).count() == 0


def test_blocks_lay_out_every_token_once(spark):
    rows = [(i, "s" if i % 3 else "t", (i * 37) % 50) for i in range(400)]
    pieces = M.block_pieces(M.laid_out(spark.createDataFrame(rows, ITEMS), bucket_items=50), 16).toPandas()
    pieces["n"] = pieces["token_end"] - pieces["token_start"]
    assert pieces["n"].sum() == sum(r[2] for r in rows) and (pieces["n"] > 0).all()
    by = pieces.groupby(["source", "block"])["n"].sum()
    for s in ("s", "t"):
        assert (by[s].iloc[:-1] == 16).all()
    assert pieces.groupby("doc")["n"].sum().to_dict() == {d: n for d, _, n in rows if n}


def test_mixing_of_nothing(spark):
    none, goal = spark.createDataFrame([], ITEMS), spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    drawn, report = M.mix(none, goal)
    assert drawn.count() == 0 and report.count() == 1
    drawn, report = M.mix(spark.createDataFrame([(1, "a", 5)], ITEMS), goal.limit(0))
    assert drawn.count() == 0 and report.count() == 0


def test_token_counts(spark):
    texts = ["hello world", "", None, "<|endoftext|>", "x" * 100_000]
    df = spark.createDataFrame([(t, "n") for t in texts], "text string, n_tokens string")
    got = with_token_counts(df, "text").toPandas()["n_tokens"].tolist()
    whole = counter(TOKENIZER.replace(".tiktoken", ".json"))  # another library over the same vocabulary
    assert got == [whole(t) if t else 0 for t in texts] and got[3] > 1
    assert isinstance(pd.Series(got).sum().item(), int)
