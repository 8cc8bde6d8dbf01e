"""The pipeline on a small corpus, against what its stages are to do."""

import random

import pytest

import corpus_pipeline
from cratemark.llm.linededup import dedup_lines

SF_DIR = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near-duplicates", "decontamination", "mixing",
    ]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean documents, toxic ones, copies, near copies and leaked items."""
    path = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(4)
    talk = lambda n: " ".join("".join(rng.choice(["ta", "re", "in", "vel", "um", "os"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    line = lambda: talk(rng.randint(8, 14)).capitalize() + "."
    clean = {i: "\n".join(line() for _ in range(rng.randint(2, 6))) for i in range(400)}
    toxic = {1000 + i: "\n".join([line(), f"{talk(4)} {rng.choice(['idiot', 'moron'])} {talk(3)}.", line()]) for i in range(120)}
    item = talk(14)
    leaked = {2000 + i: f"{line()}\n{talk(3)} {item} {talk(3)}\n{line()}" for i in range(5)}
    copies = {3000 + i: clean[i] for i in range(20)}
    docs = [(i, t, "en", f"s{i % 4}", len(t)) for group in (clean, toxic, leaked, copies) for i, t in group.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in clean] + [(i, 0, 1) for i in toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, clean, toxic, leaked, copies


def test_each_stage(spark, folder):
    path, clean, toxic, leaked, copies = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, path)
        docs.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        assert docs.columns == columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name == "line dedup":
            own = {r.doc_id: r.text for r in dedup_lines(before).collect()}
            assert own == {i: r.text for i, r in kept[name].items()}
            assert all(r.n_chars == len(r.text) for r in kept[name].values())
    gone = set(clean) - set(kept["toxicity"])
    assert len(gone) <= 0.03 * len(clean)
    assert sum(i in kept["toxicity"] for i in toxic) <= 0.1 * len(toxic)
    here = [i for i in copies if i in kept["toxicity"] and i - 3000 in kept["toxicity"]]
    assert all(kept["line dedup"][i].text == "" for i in here)
    # Copies are empty by now, and one of the empty ones stays.
    near = kept["near-duplicates"]
    assert len([i for i in copies if i in near]) <= 1 + len(copies) - len(here)
    assert all(i in near for i in clean if i not in gone)
    assert not set(leaked) & set(kept["decontamination"])
    assert set(kept["decontamination"]) == set(near) - set(leaked)


def test_run(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert found.columns == docs.columns
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    rows = found.collect()
    assert rows and {r.doc_id for r in rows} <= ids


def test_empty_documents(spark, folder, tmp_path):
    path = folder[0]
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.collect() == []
