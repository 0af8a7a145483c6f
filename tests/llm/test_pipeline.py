import importlib.util
import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tilth.llm.common import table, written
from tilth.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents and what each stage makes of them, written and read again."""
    found = [table(spark, SF, "documents")]
    for name, stage in pipeline.STAGES:
        found.append(written(stage(spark, found[-1], SF), name))
    return found


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "near_dedup", "repeat_removal", "source_mix", "sequences"]
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_language_stage_keeps_texts_with_letters(stages):
    texts = stages[0].toPandas()
    kept = set(stages[1].toPandas()["doc_id"])
    assert {d for d, t in zip(texts["doc_id"], texts["text"]) if any(c.isalpha() for c in t)} == kept


def test_near_copies_leave_their_first(stages):
    before = stages[1].toPandas().sort_values("doc_id")
    classes = plain_components(before["doc_id"].tolist(), [plain_fingerprint(t) for t in before["text"]])
    assert set(classes) == set(stages[2].toPandas()["doc_id"])


def test_repeats_go_once(stages):
    before = stages[2].toPandas().sort_values("doc_id")
    after = stages[3].toPandas().set_index("doc_id")
    seen = set()
    for d, t in zip(before["doc_id"], before["text"]):
        raw = t.encode()
        strings = {raw[i : i + 50] for i in range(len(raw) - 49)}
        if strings & seen:
            assert after.loc[d, "text"] != t and after.loc[d, "n_chars"] == len(after.loc[d, "text"])
        else:
            assert after.loc[d, "text"] == t
        seen |= strings


def test_mix_and_sequences(stages):
    mixed = stages[4].toPandas()
    size = stages[3].toPandas().set_index("doc_id")["text"].str.split().str.len()
    taken = mixed["text"].str.split().str.len().groupby(mixed["doc_id"]).sum()
    assert (taken <= 3 * size[taken.index]).all() and abs(taken.sum() - size.sum()) < 50
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(e.ids) + 1 for e in tokenizer.encode_batch(mixed["text"].tolist(), add_special_tokens=False))
    windows = stages[5].groupBy("sequence_id").agg(F.sum("length").alias("n")).toPandas().sort_values("sequence_id")
    assert windows["n"].sum() == tokens and (windows["n"].iloc[:-1] == 1024).all() and windows["n"].max() <= 1024


def test_run_gives_the_last_stage(spark, stages):
    got = pipeline.run(spark, SF)
    assert got.columns == stages[5].columns and got.count() == stages[5].count()


def test_odd_documents_pass_all_stages(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "x", "en", "s", 1), (1, None, None, None, None), (2, "", "en", None, 0), (3, "word " * 30, None, None, None), (4, "word " * 30000, "en", "s", 5)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in pipeline.STAGES:
            docs = written(stage(spark, docs, SF), name)
            docs.count()


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    spec = importlib.util.spec_from_file_location("entry", os.path.join(os.path.dirname(pipeline.__file__), "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
