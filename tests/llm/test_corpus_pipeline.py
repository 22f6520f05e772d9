"""The corpus pipeline: stage by stage against plain readings of each rule."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_decontam import brute
from test_probminhash import brute_groups
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tillroll.llm import langmix, toxicity

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns

    models = langmix.train(docs, ~langmix.held_out(F.col("doc_id"), 4, 2))
    rows = docs.collect()
    kept = [r for r in rows if (m := models.mixture(r["text"]))[0] != "und" and m[1] >= 0.5]
    one = cp.language(spark, docs, SF)
    assert one.columns == columns and ids(one) == sorted(r["doc_id"] for r in kept)

    model = toxicity.train(one, labels, ~langmix.held_out(F.col("doc_id"), 5, 0))
    kept = [r for r in kept if model.score(r["text"].encode()) < 0.5]
    two = cp.not_toxic(spark, one, SF)
    assert two.columns == columns and ids(two) == sorted(r["doc_id"] for r in kept)

    two = spark.createDataFrame(kept, docs.schema).coalesce(1)
    groups = brute_groups([(r["doc_id"], r["text"]) for r in kept])
    first = {}
    for r, g in zip(kept, groups):
        first[g] = min(first.get(g, r["doc_id"]), r["doc_id"])
    kept = [r for r in kept if r["doc_id"] in first.values()]
    three = cp.deduplicated(spark, two, SF)
    assert three.columns == columns and ids(three) == sorted(r["doc_id"] for r in kept)

    kept = [r for r in kept if not brute(r["text"], items)[3]]
    four = cp.decontaminated(spark, three, SF)
    assert four.columns == columns and ids(four) == sorted(r["doc_id"] for r in kept)

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = {}
    for r in cp.packed(spark, four, SF).orderBy("doc_id", "start").collect():
        packed.setdefault(r["doc_id"], []).append(np.frombuffer(r["ids"], "<u4"))
    assert {d: np.concatenate(p).tolist() for d, p in packed.items()} == {
        r["doc_id"]: tok.encode(r["text"], add_special_tokens=False).ids + [1] for r in kept
    }


def test_run_works_on_all_rows(spark):
    got = cp.run(spark, SF)
    assert got.select("doc_id").distinct().count() > 150 and got.filter("length <= 0").count() == 0
    assert [name for name, _ in cp.STAGES] == ["language", "toxicity", "near_dedup", "decontamination", "packing"]


def test_odd_rows_go_through_every_stage(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (None, "some words of a text", None, None, None), (2, "", "en", "s", 0), (2, "12 !!", "en", "s", 5)], schema
    )
    extra = odd.withColumn("uid", F.lit("clash")).withColumn("score", F.lit(1)).withColumn("class_id", F.lit("x"))
    for df in (odd, extra, odd.filter("false")):
        for _, stage in cp.STAGES:
            stage(spark, df, SF).collect()


def test_rows_keep_their_key_when_a_later_scan_is_cut_otherwise(spark, tmp_path, monkeypatch):
    spark.read.parquet(f"{SF}/documents.parquet").repartition(4, "doc_id").write.parquet(str(tmp_path / "docs"))
    size = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(size)

    def recut(f):
        def run(*args, **more):
            got = f(*args, **more)
            spark.conf.set(size, str(1 << 40))  # from here on a file each, as when the number of cores has changed
            return got

        return run

    monkeypatch.setattr(cp.probminhash, "near_duplicates", recut(cp.probminhash.near_duplicates))
    monkeypatch.setattr(cp.decontam, "contamination", recut(cp.decontam.contamination))
    for stage in (cp.deduplicated, cp.decontaminated):
        kept = []
        for change in (False, True):
            spark.conf.set(size, "0")
            spark.conf.set("spark.sql.files.minPartitionNum", "1")
            got = stage(spark, docs := spark.read.parquet(str(tmp_path / "docs")), SF)
            if not change:
                spark.conf.set(size, "0")
            kept.append(ids(got))
        spark.conf.set(size, before)
        spark.conf.unset("spark.sql.files.minPartitionNum")
        assert kept[0] == kept[1] and 0 < len(kept[0]) < docs.count()
