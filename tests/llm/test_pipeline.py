"""The pipeline, stage by stage, against plain versions."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import corpus_pipeline
from daymark.llm import toxicity
from daymark.session import shared_folder
from tests.llm.test_minhash import plain_components, plain_sets
from tests.llm.test_substrings import plain_removed

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {}
    frames = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = frames[name] = spark.read.parquet(path)
        rows[name] = docs.collect()
        if name != "packing":
            assert docs.schema.names == frames["input"].schema.names
    rows["input"] = frames["input"].collect()

    model = toxicity.fit(frames["input"], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    known = toxicity._known(model)
    clean = [r for r in rows["input"] if toxicity.severity(r["text"].encode(), model, known)[0] < 0.5]
    assert Counter(rows["toxicity"]) == Counter(clean) and len(clean) < len(rows["input"])

    sets = plain_sets([(r["doc_id"], r["text"]) for r in clean])
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    group = plain_components(pairs)
    firsts = [r for r in clean if group.get(r["doc_id"], r["doc_id"]) == r["doc_id"]]
    assert Counter(rows["near_copies"]) == Counter(firsts) and len(firsts) < len(clean)

    kept = plain_removed([(r["doc_id"], r["text"]) for r in firsts], 50)
    wanted = {r["doc_id"]: r["text"] if len(kept[r["doc_id"]]) == len(r["text"].split()) else " ".join(kept[r["doc_id"]]) for r in firsts}
    cut = {r["doc_id"]: r["text"] for r in rows["repeats"]}
    assert cut == wanted and cut != {r["doc_id"]: r["text"] for r in firsts}

    mixed = Counter(r["doc_id"] for r in rows["mixing"])
    assert set(mixed) <= set(cut) and set(mixed.values()) <= {1, 2}
    assert {(r["doc_id"], r["text"]) for r in rows["mixing"]} <= set(cut.items())

    packed = Counter(r["doc_id"] for r in rows["packing"] if r["start"] == 0)
    assert packed == mixed
    ends = max((r["sequence_id"], r["offset"] + r["length"]) for r in rows["packing"])
    assert sum(r["length"] for r in rows["packing"]) == ends[0] * 4096 + ends[1]


def test_run_is_its_stages(spark):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = {path.name for path in folder.iterdir()}
    assert corpus_pipeline.run(spark, FOLDER).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    ]
    left = {path.name for path in folder.iterdir()} - before
    assert [name.rsplit("-", 1)[0] for name in left if not name.startswith("rdd-")] == ["pipeline-packing"]
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
