import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cratemark.llm import mixing


def words(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


def filled(sizes, weights, total, most=3):
    """Targets by resharing again and again."""
    target, open_ = {s: 0.0 for s in sizes}, {s for s in sizes if sizes[s]}
    rest = float(total)
    while rest > 1e-9 and open_:
        share = sum(weights[s] for s in open_)
        for s in list(open_):
            target[s] += rest * weights[s] / share
        rest = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


DOCS = [
    (i, words(3 + i * 7 % 40, f"d{i}_"), "big" if i % 3 else f"s{i % 7}", "x") for i in range(240)
] + [(500, "only two", "tiny", "x"), (501, None, None, "x"), (502, words(30, "n"), None, "x"), (503, "", "void", "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, source string, size string")


def test_targets_and_sample(spark, docs):
    plan = mixing.mixing_plan(docs.repartition(5)).collect()
    again = mixing.mixing_plan(docs.repartition(3)).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    assert len(plan) == len(DOCS)
    source = {i: s for i, _, s, _ in DOCS}
    sizes = defaultdict(int)
    for i, t, s, _ in DOCS:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: mixing.CYCLE[k % 3] for k, s in enumerate(order)}
    target = filled(sizes, weights, sum(sizes.values()))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in plan:
        s = source[r.doc_id]
        assert r["size"] == len((dict((i, t) for i, t, _, _ in DOCS)[r.doc_id] or "").split())
        assert r.source_size == sizes[s] and math.isclose(r.target, target[s], abs_tol=1e-6)
        assert 0 <= r.copies <= 3
        taken[s] += r.copies * r["size"]
        largest[s] = max(largest[s], r["size"])
    for s in sizes:
        assert taken[s] <= target[s] + 1e-6
        assert target[s] - taken[s] <= largest[s]
    assert target["tiny"] == 6 == taken["tiny"]


def test_mixture_repeats_whole_rows(docs):
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    plan = {r.doc_id: r.copies for r in mixing.mixing_plan(docs).collect() if r.copies}
    assert counts == plan


def test_unequal_probabilities(spark):
    rows = [(i, words(10, "w"), "a", 3.0 if i % 2 else 1.0) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double")
    plan = mixing.mixing_plan(docs, total=8000, doc_weight_col="quality").collect()
    odd = sum(r.copies for r in plan if r.doc_id % 2)
    even = sum(r.copies for r in plan if not r.doc_id % 2)
    # 800 documents, three quarters of them odd.
    assert odd + even == 800 and 560 <= odd <= 640


def test_named_weights_and_empty_table(spark, docs):
    sizes = spark.createDataFrame([("a", 100), ("b", 100), (None, 100)], "source string, source_size long")
    found = mixing.source_targets(sizes, {"a": 3, None: 2}, total=60).collect()
    assert {r.source: round(r.target, 6) for r in found} == {"a": 30, "b": 10, None: 20}
    assert mixing.mixing_plan(docs.limit(0)).collect() == []
    assert mixing.mixture(docs.limit(0)).collect() == []


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "a b c", "s"), (None, "a b c", "s"), (1, None, None), (1, "x y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mixing_plan(docs).collect()
    assert len(plan) == 4 and sorted(r["size"] for r in plan) == [0, 2, 3, 3]
    assert len({r.copies for r in plan if r["size"] == 3}) == 1


def test_pareto_order_of_equal_fractions_is_the_draw(docs):
    plan, _ = mixing.mix(docs)
    rows = plan.where((F.col("_source") == "big") & (F.col("_expected") > F.col("_whole"))).collect()
    by_rank = sorted(rows, key=lambda r: r["_rank"])
    assert [r["_draw"][:13] for r in by_rank] == sorted(r["_draw"][:13] for r in rows)


@pytest.mark.parametrize("rows, target", [(300, 2857), (100, 1071)])
def test_equal_rows_are_split(spark, rows, target, tmp_path):
    """A source of nothing but copies, and one of few words beside it."""
    beside = "x " * 60 if rows == 300 else "y " * 500
    text = words(10, "w")
    extra = [(2, beside, "b")] if rows == 300 else [(k, "y " * 50, "b") for k in range(10, 20)]
    frame = spark.createDataFrame([(1, text, "a")] * rows + extra, "doc_id long, text string, source string")
    frame.repartition(5).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    plan = mixing.mixing_plan(docs, split_equal=True).collect()
    own = [r for r in plan if r.doc_id == 1]
    goal = own[0].target
    taken = sum(r.copies * r["size"] for r in own)
    assert goal - 10 < taken <= goal + 1e-6
    assert max(r.copies for r in own) - min(r.copies for r in own) <= 1
    mixed = mixing.mixture(docs, split_equal=True).where("doc_id = 1").count()
    assert mixed * 10 == taken
    other = mixing.mixing_plan(docs.repartition(3), split_equal=True).collect()
    assert sum(r.copies for r in other if r.doc_id == 1) == sum(r.copies for r in own)


def test_equal_rows_against_sql(spark, tmp_path):
    import duckdb

    from cratemark.llm import queries as llm_queries

    rows = [(i % 7, words(3 + i % 7, "w"), "abc"[i % 3]) for i in range(400)]
    rows += [(None, "a b c", None)] * 90 + [(5, None, "c")] * 4 + [(9, "one two", "d")] * 50
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    found = llm_queries.op8_source_mix(spark, str(tmp_path))
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cursor = sql.execute(llm_queries.oracle_sql()["op8_source_mix"])
    columns = [d[0] for d in cursor.description]
    rows = [tuple(r) for r in found.select(*columns).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, cursor.fetchall()))
