import duckdb
import pytest
from pyspark.sql import functions as F

from draftstats.llm import mixing, queries

SCHEMA = "doc_id long, text string, source string, size int, start string, target string"


def twin(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toArrow())
    return rows(con.execute(mixing.taken_sql()).fetchall())


def rows(found):
    return sorted(map(tuple, found), key=str)


def mixed(docs):
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return rows(mixing.taken(*mixing.mix(docs)).select(*columns).collect())


def brute_targets(sizes):
    """Share, limit, share the excess again, until no target is above twice its source."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, limited = dict.fromkeys(names, 0.0), set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(target[s] for s in limited)
        free = [s for s in names if s not in limited]
        for s in free:
            target[s] = left * weights[s] / sum(weights[x] for x in free)
        above = [s for s in free if target[s] > 2 * sizes[s]]
        if not above:
            return target
        for s in above:
            target[s] = 2.0 * sizes[s]
            limited.add(s)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, None: 500, "Z": 40, "é": 3}, {"a": 7}, {"a": 0, "b": 90}])
def test_targets(spark, sizes):
    found = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    assert {r.source: round(r.target, 6) for r in found} == {s: round(t, 6) for s, t in brute_targets(sizes).items()}


@pytest.mark.parametrize("n", [1, 2, 17, 1000, 300_000])
def test_permutations(spark, n):
    rows = spark.range(n).selectExpr("id % 2 AS source_no", "id DIV 2 AS index").unionByName(spark.sql("SELECT 9 AS source_no, 0 AS index"))
    found = mixing.permuted(rows, ["source_no"], "index", "place").toPandas()
    for source, some in found.groupby("source_no"):
        some = some.sort_values("index")
        assert sorted(some["place"]) == list(range(len(some)))
        if len(some) > 400:
            # As a random order: neighbours a third of all apart on average, and no trend.
            step = some["place"].diff().abs().mean() / len(some)
            assert abs(step - 1 / 3) < 0.05 and abs(some["place"].corr(some["index"])) < 0.1
    assert found.equals(mixing.permuted(rows, ["source_no"], "index", "place").toPandas()) or n > 1000


def test_permutations_differ_from_round_to_round(spark):
    rows = spark.range(2_000).selectExpr("id % 2 AS round", "id DIV 2 AS index")
    found = mixing.permuted(rows, ["round"], "index", "place").toPandas().sort_values("index")
    first, second = (found[found["round"] == r]["place"].to_numpy() for r in (0, 1))
    assert (first == second).mean() < 0.02


def test_shards_draw_sources_as_a_multinomial_does(spark):
    """Given the totals, a shard's counts of the sources vary as independent draws do: chi-square over all shards."""
    sizes = [("a", 640_000), ("b", 320_000), ("c", 256_000)]
    targets = spark.createDataFrame([(i, n, float(n)) for i, (_, n) in enumerate(sizes)], "source_no long, source_size long, target double")
    counts = mixing.slots(targets, 64, shard_slots=100).groupBy("shard", "source_no").count().toPandas()
    table = counts.pivot(index="shard", columns="source_no", values="count").fillna(0).to_numpy()
    assert table.sum() == sum(n for _, n in sizes) / 64 and (table.sum(axis=1) == 100).all()
    expected = 100 * table.sum(axis=0) / table.sum()
    chi = ((table - expected) ** 2 / expected).sum()
    degrees = (len(table) - 1) * 2
    assert abs(chi - degrees) < 4 * (2 * degrees) ** 0.5


def test_slots_are_made_by_many_tasks(spark):
    targets = spark.createDataFrame([(0, 64 * 200_000, 64.0 * 250_000)], "source_no long, source_size long, target double")
    found = mixing.slots(targets, 64)
    assert found.count() == 250_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "Python" not in plan


def test_against_sql_with_nulls_ties_repeats_and_clashing_columns(spark):
    texts = [None, "", " \n", "a b c", "word " * 9_000, "x"] + ["some words here " * 40] * 8
    data = [(i // 2 if i % 5 else None, t, (None, "s", "s", "t")[i % 4], 1, "a", "b") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data + data[-2:], SCHEMA)
    found = mixed(docs)
    assert found == twin(docs) == mixed(docs.repartition(3))
    assert all(r[4] <= 2 * r[1] for r in found)


def test_empty_table(spark):
    assert mixed(spark.createDataFrame([], SCHEMA)) == []
    assert {r[4] for r in mixed(spark.createDataFrame([(1, "", "s"), (2, None, None)], "doc_id long, text string, source string"))} == {0}


def test_slots_fill_shards_and_blocks_are_taken_evenly(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents, mixture = mixing.mix(docs, block=16, shard_slots=64)
    slots = mixture.select("shard", "slot").distinct()
    by_shard = {r.shard: r["count"] for r in slots.groupBy("shard").count().collect()}
    assert all(n == 64 for shard, n in by_shard.items() if shard < max(by_shard))
    assert len(by_shard) > 3
    counts = mixing.taken(documents, mixture).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"))
    assert all(abs(r.taken - r.target) <= 0.02 * r.target + 64 for r in counts.collect())


def test_query_is_native(spark, sf_dir):
    plan = queries.op6_source_mixing(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_mixed_documents_have_the_words_taken_whatever_their_columns_are_called(spark):
    texts = [None, "", "a b c", "word " * 900] + [f"some words of text {i} " * 40 for i in range(12)]
    names = "mixed_hash string, mixed_doc string, mixed_words string, mixed_round string, mark_no string"
    data = [(i // 2 if i % 5 else None, t, (None, "s", "t")[i % 3], 7, "a", "b", "c", "d", "e") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data + data[-3:], f"doc_id long, text string, source string, n_chars int, {names}")
    found = mixing.mixed_documents(docs)
    assert found.schema == docs.schema
    got, wanted = {}, {}
    for r in found.collect():
        assert (r.mixed_hash, r.mark_no, r.n_chars) == ("a", "e", len(r.text))
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + len(r.text.split())
    for r in mixing.taken(*mixing.mix(docs)).filter("taken > 0").collect():
        wanted[r.doc_id, r.source] = wanted.get((r.doc_id, r.source), 0) + r.taken
    assert got == wanted
