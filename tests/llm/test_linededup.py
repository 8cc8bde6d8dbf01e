import random

import pytest

from cratemark.llm import linededup


def reference(texts, min_chars, min_lines):
    """Brute force, by the definition: texts in the order of their ids."""
    docs = [None if t is None else t.split("\n") for t in texts]
    places = [(d, i) for d, lines in enumerate(docs) if lines is not None for i in range(len(lines))]

    def block(place, h):
        d, i = place
        return tuple(docs[d][i : i + h]) if i + h <= len(docs[d]) else None

    gone = set()
    for n, place in enumerate(places):
        source, h = None, 1
        while block(place, h) is not None:
            first = next(q for q in places[: n + 1] if block(q, h) == block(place, h))
            if first == place:
                break
            source, h = first, 2 * h
        if source is None:
            continue
        length = h // 2
        while block(place, length + 1) is not None and block(place, length + 1) == block(source, length + 1):
            length += 1
        lines = block(place, length)
        if sum(map(len, lines)) >= min_chars and length >= min_lines:
            gone |= {(place[0], place[1] + k) for k in range(length)}
    return [
        None if lines is None else "\n".join(x for i, x in enumerate(lines) if (d, i) not in gone)
        for d, lines in enumerate(docs)
    ]


def deduped(spark, rows, schema="doc_id long, text string", **options):
    found = linededup.dedup_lines(spark.createDataFrame(rows, schema), **options)
    return {r.doc_id: r.text for r in found.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    alphabet = ["a", "bb", "ccc", "", "dddddddddddd", "e" * 30]
    texts = ["\n".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(25)]
    texts += [texts[3], texts[3] + "\nend", None, ""]
    options = {"min_chars": rng.choice([0, 5, 10]), "min_lines": rng.choice([1, 2])}
    expected = reference(texts, **options)
    found = deduped(spark, list(enumerate(texts)), **options)
    assert [found[i] for i in range(len(texts))] == expected


def test_later_copies_go_and_the_first_stays(spark):
    rows = [
        (2, "one line of text\nsecond line here\nown words of two"),
        (1, "one line of text\nsecond line here\nown words of one"),
        (3, "}\nown words of three\n}"),
        (4, "}\nown words of four"),
        (5, None),
    ]
    found = deduped(spark, rows)
    assert found[1] == rows[1][1]
    assert found[2] == "own words of two"
    assert found[3] == rows[2][1] and found[4] == rows[3][1]
    assert found[5] is None


def test_nulls_copies_and_clashing_columns(spark):
    text = "a line that is long enough\nanother line that is long enough"
    rows = [(None, text, 1, 2), (7, text, 3, 4), (7, text, 5, 6), (8, "", 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` int, `order` int")
    found = linededup.dedup_lines(docs, with_counts=True).collect()
    assert sorted((r["row"], r["order"]) for r in found) == [(1, 2), (3, 4), (5, 6), (7, 8)]
    assert sorted(r.text for r in found) == ["", "", "", text]
    assert sorted((r.n_lines, r.n_deleted) for r in found) == [(1, 0), (2, 0), (2, 2), (2, 2)]
    assert next(r.text for r in found if r.doc_id is None) == ""


def test_empty_table_and_long_text(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert linededup.dedup_lines(empty).collect() == []
    long_text = "\n".join(f"line number {i} of a long text" for i in range(3000))
    found = deduped(spark, [(1, long_text), (2, long_text + "\nits own last line")])
    assert found[1] == long_text and found[2] == "its own last line"


def test_no_table_of_lines_is_broadcast(spark, monkeypatch):
    """Whatever Spark takes the sizes of stored and exploded tables for, no join
    brings one into the driver."""
    plans = []
    kept = linededup.stored

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(linededup, "stored", lambda df, name: kept(planned(df), name))
    text = "\n".join(f"line number {i} of a text" for i in range(40))
    rows = [(1, text), (2, text), (3, "own line of three\n" + text + "\nand its end"), (4, None)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = {r.doc_id: r.text for r in planned(linededup.dedup_lines(docs)).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {1: text, 2: "", 3: "own line of three\nand its end", 4: None}
    assert any("SortMergeJoin" in plan for plan in plans)
    assert not any("Broadcast" in plan for plan in plans)
