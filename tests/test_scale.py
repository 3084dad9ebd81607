"""Hot keys, large sheets and growing state: what the operators keep apart, and that results stay those of plain versions."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docledger.operators import grid as G
from docledger.operators import layout as L
from docledger.operators import publish as P
from docledger.shared import cut, new_path
from docledger.streaming import core as S
from docledger.streaming.state import ROCKS, STORE, BucketedTable, action_runs, observed_once, review_items


@pytest.fixture
def ranges(spark):
    """Small ranges, so that keys span several."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bucketed_table_rewrites_touched_buckets_only(spark):
    t = BucketedTable(spark, "t", "k bigint, v string", ["k"], 8)
    put = lambda old, new: old.join(new, "k", "left_anti").unionByName(new)
    t.merge(spark.createDataFrame([(k, "a") for k in range(100)], "k bigint, v string"), 0, put)
    first = t.manifest(1)
    assert len(first) == 8 and set(first.values()) == {1}
    hit = t.merge(spark.createDataFrame([(5, "b"), (1000, "c")], "k bigint, v string"), 1, put)
    second = t.manifest(2)
    assert {b for b, v in second.items() if v == 2} == hit and len(hit) <= 2
    files = lambda v: {f.split("/data/")[1] for f in t.at(v).inputFiles()}
    untouched = {f for f in files(2) if f.startswith("1/")}
    assert untouched and untouched <= files(1)
    assert {r["k"]: r["v"] for r in t.at(2).collect()} == {k: "a" for k in range(100)} | {5: "b", 1000: "c"}
    t.merge(spark.createDataFrame([(5, "b"), (1000, "c")], "k bigint, v string"), 1, put)  # the batch comes again
    assert t.at(2).count() == 101
    t.merge(spark.createDataFrame([(5, "d")], "k bigint, v string"), 2, put)
    assert {r["k"]: r["v"] for r in t.at(3).filter("k in (5, 1000)").collect()} == {5: "d", 1000: "c"}
    assert {r["k"] for r in t.near(spark.createDataFrame([(5,)], "k bigint")).collect()} < set(range(1001))
    t.merge(spark.createDataFrame([], "k bigint, v string"), 3, put)
    assert t.at(4).count() == 101
    t.merge(t.at(4).filter("k < 1000"), 4, lambda old, new: old.join(new, "k", "left_anti"))  # rows may go
    assert [r["k"] for r in t.at(5).collect()] == [1000]
    with pytest.raises(ValueError, match="keys"):
        t.merge(spark.createDataFrame([(1, "x")], "k bigint, v string"), 5, lambda old, new: new.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(50)).cast("array<bigint>"))))


def queue(actions):
    out = {}
    for key, ts, tie, action in sorted(actions, key=lambda a: (a[0], a[1], a[2])):
        now = out.get(key)
        if action == "add":
            now = now or ["OPEN", ts, ts, 0]
            now[2], now[3] = ts, now[3] + 1
            now[0] = "OPEN" if now[0] == "RESOLVED" else now[0]
            out[key] = now
        elif now and action == "resolve" and now[0] == "OPEN":
            now[0], now[2] = "RESOLVED", ts
        elif now and action == "ignore":
            now[0] = "IGNORED"
    return {k: tuple(v) for k, v in out.items()}


def test_review_items_compose(spark):
    """A user with a third of all actions, over three batches: the same as one action after the other."""
    rnd, start = random.Random(3), datetime(2026, 1, 1)
    rows = [(0 if rnd.random() < 0.34 else rnd.randint(1, 30), start + timedelta(minutes=rnd.randint(0, 20_000)), n, rnd.choices(["add", "resolve", "ignore"], [10, 8, 0.1])[0]) for n in range(1500)]
    path = new_path(spark, "steps")
    parts = [[r for r in rows if lo <= (r[1] - start).days < hi] for lo, hi in ((0, 5), (5, 9), (9, 99))]
    for k, part in enumerate(parts):
        runs = action_runs(spark.createDataFrame(part, "key bigint, ts timestamp, event_id bigint, action string").repartition(4), "key", "ts", "event_id", [3600, 86400])
        assert runs.count() == len({r[0] for r in part})
        runs.select("key", F.lit(k).alias("batch"), "step.*").write.parquet(f"{path}/{k}")
    spark.conf.set(STORE, ROCKS)
    try:
        steps = spark.readStream.schema(spark.read.parquet(f"{path}/*").schema).option("maxFilesPerTrigger", 1000).parquet(f"{path}/*")
        states = new_path(spark, "states")
        S.run(review_items(steps), lambda df, k: df.write.mode("overwrite").parquet(f"{states}/{k}"), "update", "items")
    finally:
        spark.conf.unset(STORE)
    assert {r["key"]: tuple(r)[1:] for r in spark.read.parquet(f"{states}/*").collect()} == queue(rows)


def test_no_task_holds_all_of_a_hot_users_actions(spark):
    start = datetime(2026, 1, 1)
    rows = [(1, start + timedelta(minutes=n), n, "add" if n % 2 else "resolve") for n in range(6000)]
    actions = spark.createDataFrame(rows, "key bigint, ts timestamp, event_id bigint, action string")
    per_hour = actions.groupBy("key", F.floor(F.unix_timestamp("ts") / 3600)).count()
    assert per_hour.agg(F.max("count")).first()[0] == 60  # what one list holds at most
    step = action_runs(actions, "key", "ts", "event_id", [3600, 86400]).first()["step"]
    assert (step["end_NONE"], step["n"], step["first"], step["last_NONE"]) == ("OPEN", 3000, rows[1][1], rows[-1][1])


def test_expired_observations_leave_the_state(spark):
    path, seen = new_path(spark, "observed"), []
    day = lambda n: datetime(2026, 1, 1) + timedelta(days=n)
    log = new_path(spark, "observed-log")
    for k, rows in enumerate([[(day(0), "a"), (day(0), "b")], [(day(1), "a"), (day(30), "c")], [(day(30), "b")], [(day(31), "d")]]):
        spark.createDataFrame(rows, "at timestamp, x string").write.parquet(f"{path}/{k}")
        stream = observed_once(spark.readStream.schema("at timestamp, x string").parquet(f"{path}/*"), "at", ["x"], "10 days")
        query = stream.writeStream.foreachBatch(lambda df, _: seen.extend(r["x"] for r in df.collect())).option("checkpointLocation", log).trigger(availableNow=True).start()
        query.awaitTermination()
        progress = query.lastProgress
    assert sorted(seen) == ["a", "b", "b", "c", "d"]  # b came again 30 days later
    assert progress["stateOperators"][0]["numRowsTotal"] <= 3  # a, and the first b, have left


def plain_carry(rows, own, back):
    out, by = {}, defaultdict(list)
    for key, at, value in rows:
        by[key].append((at, value))
    for key, held in by.items():
        last = None
        for at, value in sorted(held, reverse=back):
            if own and value is not None:
                last = value
            out[key, at] = last
            if value is not None:
                last = value
    return out


@pytest.mark.parametrize("hot", [True, False])
def test_carries_over_ranges(ranges, hot):
    rnd = random.Random(hot)
    rows = [(1 if hot else rnd.randint(0, 5), at, at if rnd.random() < 0.05 else None) for at in range(3000)] + [(None, -1, 7), (None, -2, None), (9, 1, None)]
    df = ranges.createDataFrame(rows, "key bigint, at bigint, anchor bigint").repartition(4)
    ranged = L.in_ranges(df, ["key"], ["at"])
    assert ranged.groupBy("__part").count().agg(F.max("count")).first()[0] < 2000  # the hot key's rows are spread
    for own, back in ((True, False), (False, False), (False, True), (True, True)):
        found = L.carried(ranged, ["key"], ["at"], F.col("anchor"), "x", own, back)
        assert {(r["key"], r["at"]): r["x"] for r in found.collect()} == plain_carry(rows, own, back)
    assert {(r["key"], r["at"]): r["x"] for r in L.asof_anchor(df, ["key"], ["at"], F.col("anchor"), "x").collect()} == plain_carry(rows, True, False)
    starts = df.filter("anchor IS NOT NULL")
    got = {(r["key"], r["at"]): r["block_end"] for r in L.blocks(starts, ["key"], "at", F.lit(9999)).collect()}
    want = plain_carry([(k, a, a) for k, a, v in rows if v is not None], False, True)
    assert got == {k: 9999 if v is None else v - 1 for k, v in want.items()}




def test_a_merge_heavy_sheet_has_few_candidates(spark):
    """A sheet of 200,000 cells and 10,000 merges: each cell meets the merges of its tile only."""
    at = spark.range(200_000)
    cells = at.select(F.lit("d").alias("document_id"), F.lit("s").alias("sheet"), (F.floor(F.col("id") / 100) + 1).cast("int").alias("row"), (F.col("id") % 100 + 1).cast("int").alias("column"))
    m = spark.range(10_000)
    top, left = (F.floor(F.col("id") / 10) * 2 + 1).cast("int"), (F.col("id") % 10 * 10 + 1).cast("int")
    merges = m.select(F.lit("d").alias("document_id"), F.lit("s").alias("sheet"), top.alias("top"), (top + 1).alias("bottom"), left.alias("left"), (left + 2).alias("right"), F.struct(top.alias("row"), left.alias("column")).alias("parent"))
    found = G.covered_by(cells, merges)
    assert found.filter("parent IS NOT NULL").count() == 10_000 * 6 and found.count() == 200_000
    inner = cells.withColumns({"r": F.floor(F.col("row") / 16), "c": F.floor(F.col("column") / 8)})
    tiles = merges.select(F.explode(F.sequence(F.floor(F.col("top") / 16), F.floor(F.col("bottom") / 16))).alias("r"), "left", "right").select("r", F.explode(F.sequence(F.floor(F.col("left") / 8), F.floor(F.col("right") / 8))).alias("c"))
    assert inner.join(tiles, ["r", "c"]).count() < 25 * 200_000


def test_range_join_on_a_hot_key(spark):
    rnd = random.Random(1)
    points = [(1 if rnd.random() < 0.8 else 2, rnd.randint(-500, 5000)) for _ in range(2000)] + [(None, 3), (3, 5), (1, None)]
    spans = [(rnd.choice([1, 2]), a, a + rnd.randint(-1, 90), n) for n, a in enumerate(rnd.randint(-500, 5000) for _ in range(300))]
    p, r = spark.createDataFrame(points, "k int, at int"), spark.createDataFrame(spans, "k int, low int, high int, n int")
    want = sorted((k, at, n) for k, at in points for j, low, high, n in spans if k == j and at is not None and low <= at <= high)
    assert sorted((x["k"], x["at"], x["n"]) for x in L.range_join(p, r, ["k"], "at", "low", "high").collect()) == want
    left = L.range_join(p, r, ["k"], "at", "low", "high", "left")
    assert left.filter("n IS NULL").count() == sum(not any(k == j and at is not None and low <= at <= high for j, low, high, _ in spans) for k, at in points)
    lone = spark.createDataFrame([(1, n, n + 3, n) for n in range(0, 100_000, 10)], "k int, low int, high int, n int")
    hot = spark.range(100_000).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("at"))
    joined = L.range_join(hot, lone, ["k"], "at", "low", "high")
    assert joined.count() == 40_000


def test_digest_tree_is_bounded_and_finds_differences(spark):
    rows = [("a", n, f"d{n}") for n in range(3000)] + [("b", 5, "x"), ("b", None, "y")]
    df = spark.createDataFrame(rows, "source string, id bigint, digest string").repartition(3)
    tree = P.digest_tree(df, ["source"], "id", "digest", 10)
    assert tree.agg(F.max("level")).first()[0] == 3
    per = tree.filter("level > 0").join(tree.select("source", (F.col("level") + 1).alias("level"), F.floor(F.col("node") / 10).alias("node")), ["source", "level", "node"]).groupBy("source", "level", "node").count()
    assert per.agg(F.max("count")).first()[0] <= 10
    assert {(r["source"], r["n"]) for r in tree.filter("level = 3").collect()} == {("a", 3000), ("b", 1)}
    other = df.filter("id IS NULL OR id NOT IN (17, 2000)").withColumn("digest", F.when(F.col("id") == 999, "new").otherwise(F.col("digest"))).unionByName(spark.createDataFrame([("c", 50_000, "z")], df.schema))
    tree2 = P.digest_tree(other, ["source"], "id", "digest", 10)
    found = P.tree_difference(tree, tree2, df, other, ["source"], "id", "digest", 10)
    assert {tuple(r) for r in found.collect()} == {("a", 17, "dropped"), ("a", 2000, "dropped"), ("a", 999, "changed"), ("c", 50_000, "added")}
    assert P.tree_difference(tree, tree, df, df, ["source"], "id", "digest", 10).count() == 0
    empty = df.limit(0)
    none = P.digest_tree(empty, ["source"], "id", "digest", 10)
    assert P.tree_difference(none, tree2, empty, other, ["source"], "id", "digest", 10).count() == 3000 - 2 + 2


def plain_merge(base, incoming):
    accepted = {d for d, *_ in incoming}
    while True:
        now = [r for r in base if r[0] not in accepted] + [r for r in incoming if r[0] in accepted]
        held = defaultdict(set)
        for d, s, c in now:
            held[s].add(c)
        bad = {d for d, s, _ in now if len(held[s]) > 1 and d in accepted}
        if not bad:
            return accepted
        accepted -= bad


@pytest.mark.parametrize("seed", range(4))
def test_semi_naive_merge_agrees_with_whole_rounds(spark, seed):
    rnd = random.Random(seed)
    base = [(d, rnd.randint(0, 60), rnd.choice("xy") if rnd.random() < 0.1 else "x") for d in range(40) for _ in range(2)]
    incoming = [(d, rnd.randint(0, 60), "y" if rnd.random() < 0.08 else "x") for d in rnd.sample(range(60), 35) for _ in range(2)]
    base = [(d, s, c if rnd.random() > 0.1 else "z") for d, s, c in base]
    schema = "doc bigint, slot bigint, item string"
    a, r = P.merge_to_fixpoint(spark.createDataFrame(base, schema), spark.createDataFrame(incoming, schema), ["slot"], ["item"], "doc", lambda df: cut(df, "t"), buckets=4)
    want = plain_merge(base, incoming)
    assert {x[0] for x in a.collect()} == want and {x[0] for x in r.collect()} == {d for d, *_ in incoming} - want


def test_a_chain_of_restorations_reads_few_buckets(spark, monkeypatch):
    """Document n's old version conflicts with document n + 1's new one: a round a document, each reading the buckets of one."""
    base = [(n, n + 1, "old") for n in range(12)] + [(100 + n, 500 + n, "x") for n in range(400)]
    incoming = [(n, n, "new") for n in range(12)] + [(50, 0, "other")] + [(100 + n, 500 + n, "y") for n in range(400)]
    read, near = [], BucketedTable.near
    monkeypatch.setattr(BucketedTable, "near", lambda self, keys, version=None: read.append(near(self, keys, version)) or read[-1])
    schema = "doc bigint, slot bigint, item string"
    a, r = P.merge_to_fixpoint(spark.createDataFrame(base, schema), spark.createDataFrame(incoming, schema), ["slot"], ["item"], "doc", lambda df: cut(df, "t"))
    assert {x[0] for x in r.collect()} == {*range(12), 50} and a.count() == 400
    assert len(read) >= 20 and max(x.count() for x in read[4:]) < 100  # of 412 restorable and as many challenged rows
