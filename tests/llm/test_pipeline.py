"""The pipeline's stages: what each takes away, and that clean documents come through."""

import re
import zlib

import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F
from test_minhash import plain_classes
from test_suffixes import plain
from tokenizers import Tokenizer

import corpus_pipeline
from barorail.llm import compression, queries
from barorail.llm.common import saved
from barorail.llm.packing import pack_documents, sequences
from barorail.llm.secrets import base_spans

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(saved(stage(spark, kept[-1], SF), name.replace(" ", "-")))
    for df in kept[1:-1]:
        assert df.columns == columns
    texts = [{r["doc_id"]: r["text"] for r in df.collect()} for df in kept[:-1]]
    assert all((df.where("n_chars <> length(text)").count() == 0) for df in kept[3:-1])

    quality = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id")["quality"]
    stayed = quality.index.isin(list(texts[1]))
    assert stayed[quality == 1].mean() > 0.97 and stayed[quality == 0].mean() < 0.4

    classes = plain_classes(texts[1])
    assert set(texts[2]) == {i for i, c in classes.items() if i == c}

    assert set(texts[3]) == set(texts[2])
    copies = [(i, a, b) for i, a, b, copy in plain(texts[2], 50) if copy]
    assert {i for i in texts[2] if texts[2][i] != texts[3][i]} == {i for i, _, _ in copies}
    for i in texts[2]:
        words = texts[2][i].split()
        gone = {w for j, a, b in copies if j == i for w in range(a, b)}
        assert texts[3][i].split() == [w for at, w in enumerate(words) if at not in gone]

    assert set(texts[4]) == set(texts[3])
    assert any(base_spans(t) for t in texts[3].values())
    for i, t in texts[4].items():
        assert not [s for s in base_spans(t) if s[2] != 0]
        assert re.sub("<secret>", "", t) == t.replace("<secret>", "")
        if not base_spans(texts[3][i]) and "<secret>" not in t:
            assert t == texts[3][i]
    packed = kept[-1].toPandas()
    assert set(packed.doc_id) == set(texts[4])
    assert packed.groupby("sequence_id").length.sum().max() <= 4096


def test_run_and_empty_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        df.limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert corpus_pipeline.ORACLE_SQL is None


def test_last_stage_gives_the_ids(spark):
    texts = {1: "The train  leaves at noon.", 2: None, 3: "delay " * 5000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    packed = corpus_pipeline.packed(spark, docs, SF)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted(packed.collect(), key=lambda r: (r["doc_id"], r["piece"]))
    for i, text in texts.items():
        own = [r for r in rows if r["doc_id"] == i]
        assert sum((r["ids"] for r in own), []) == [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert all(r["length"] == len(r["ids"]) for r in own)
    assert sum(len(r["ids"]) for r in sequences(packed).collect()) == sum(r["length"] for r in rows)


def test_query_takes_checksums_from_the_ids_of_the_pieces(spark, monkeypatch):
    def other_ids(*args, **options):
        assert options["keep_ids"]
        return pack_documents(*args, **options).withColumn("ids", F.expr("array(7, 8)"))

    monkeypatch.setattr(queries, "pack_documents", other_ids)
    found = queries.op6_best_fit_packing(spark, "/root/testdata/sf0.001").select("ids_crc32").distinct().collect()
    assert [r[0] for r in found] == [zlib.crc32(bytes([7, 0, 0, 0, 8, 0, 0, 0]))]


LONG = " ".join(f"w{i}" for i in range(80))
OTHER = " ".join(f"v{i}" for i in range(80))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars long")


def test_stages_on_a_table_loaded_twice(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    once = corpus_pipeline.one_of_each_group(spark, docs, SF)
    twice = corpus_pipeline.one_of_each_group(spark, docs.union(docs), SF)
    worded = "trim(text) <> ''"
    texts = sorted(map(tuple, once.where(worded).select("doc_id", "text").collect()))
    assert sorted(map(tuple, twice.where(worded).select("doc_id", "text").collect())) == texts
    cut = corpus_pipeline.without_repeats(spark, frame(spark, [(4, LONG, 1), (4, LONG, 1), (3, LONG + " x", 1)]), SF)
    assert sorted(r["text"] for r in cut.collect()) == ["", "", LONG + " x"]


def test_stages_on_missing_and_shared_ids(spark):
    rows = [(None, LONG, 1), (None, LONG, 1), (7, OTHER, 1), (7, LONG, 1), (None, OTHER, 1), (None, None, None)]
    left = corpus_pipeline.one_of_each_group(spark, frame(spark, rows), SF).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in left) == [("7", OTHER), ("7", LONG), ("None", "None")]
    cut = corpus_pipeline.without_repeats(spark, frame(spark, rows), SF).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in cut if r["text"]) == [("7", OTHER), ("7", LONG)]


def test_each_row_has_its_own_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdicts = compression.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = verdicts.where("predicted = 1").count()
    shared = corpus_pipeline.good_documents(spark, docs.union(docs.withColumn("doc_id", F.lit(None).cast("long"))), SF)
    assert shared.where("doc_id IS NULL").count() == shared.where("doc_id IS NOT NULL").count() == good


def test_columns_with_names_of_helpers(spark):
    """A table's own columns come through as they are, whatever they are called."""
    names = ["_row", "_cuts", "_score", "__row", "class_row", "missing", "hash", "copy", "score"]
    rows = [(1, LONG, 1, *(f"{n}1" for n in names)), (2, LONG, 1, *(f"{n}2" for n in names)), (3, OTHER, 1, *[None] * len(names))]
    schema = "doc_id long, text string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    found = corpus_pipeline.one_of_each_group(spark, docs, SF)
    assert found.schema == docs.schema
    assert sorted(map(tuple, found.collect())) == [rows[0], rows[2]]
    found = corpus_pipeline.without_repeats(spark, docs, SF)
    assert found.columns == docs.columns
    assert sorted(r[3:] for r in found.collect() if r[0] < 3) == [r[3:] for r in rows[:2]]
    assert sorted((r.doc_id, r.text) for r in found.collect()) == [(1, LONG), (2, ""), (3, OTHER)]
    assert corpus_pipeline.good_documents(spark, docs, SF).schema == docs.schema
    assert corpus_pipeline.without_secrets(spark, docs, SF).columns == docs.columns


def test_texts_are_merged_with_what_is_found_in_them_at_any_size(spark):
    """So a small table shuffles its share of the texts, and tells what a large one will."""
    rows = frame(spark, [(4, LONG, 1), (5, LONG, 1), (3, OTHER, 1)])
    for stage, kind in ((corpus_pipeline.one_of_each_group, "LeftAnti"), (corpus_pipeline.without_repeats, "LeftOuter")):
        plan = stage(spark, rows, SF)._jdf.queryExecution().executedPlan().toString()
        assert any("SortMergeJoin" in line and kind in line for line in plan.splitlines())
