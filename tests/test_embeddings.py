"""Batch embedding, credentials and the backfill policy."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.functions.embedding import embed, hashing_embedder, imported_model, referred_model
from folioflow.operators import embeddings as E


def test_long_texts_are_cut_and_failures_stay_local(spark):
    def fussy(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("model failure")
        return np.array([[len(t), 1.0] for t in texts])

    texts = ["x" * 9000, "bad", None, "abc", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    rows = df.select("i", embed(F.col("t"), fussy).alias("v")).orderBy("i").collect()
    assert [r.v for r in rows] == [[8192.0, 1.0], None, None, [3.0, 1.0], [0.0, 1.0]]
    assert df.select(embed(F.col("t"), None).alias("v")).where("v IS NOT NULL").count() == 0


def test_hashing_is_normalised_and_repeatable():
    one, two, empty = hashing_embedder(64)(["a b b", "b a b", " \n"])
    assert np.allclose(one, two) and np.isclose(np.linalg.norm(one), 1) and not empty.any()


@pytest.fixture
def settings(spark):
    configurations = spark.createDataFrame(
        [(1, "u1", "openai"), (2, "u2", "OpenAI"), (3, "u3", "openai"), (4, "u4", "vendor_b"),
         (5, "u5", "openai"), (6, "u5", "openai"), (7, None, "openai")],
        "id long, user_id string, default_provider string")
    providers = spark.createDataFrame(
        [(10, 1, "openai", True), (20, 2, "openai", True), (21, 2, "OpenAI", True),
         (30, 3, "openai", False), (40, 4, "vendor_b", True), (61, 6, "openai", True),
         (51, 5, "openai", True), (50, 5, "OpenAI", True)],
        "id long, a_i_configuration_id long, provider string, is_enabled boolean")
    return configurations, providers


def test_provider_must_match_exactly_and_be_enabled(settings):
    got = {r.user_id: r.provider_config_id for r in E.resolve_providers(*settings).collect()}
    assert got == {"u1": 10, "u2": 21, "u5": 51}


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("parity", [True, False])
def test_backfill_policy(spark, settings, fallback, parity):
    backlog = spark.createDataFrame(
        [(1, 0, "some words", "u1"), (1, 1, "　 ", "u1"), (2, 0, "other words", "u9"),
         (3, 0, "fail", "u1"), (4, 0, "nobody", None), (4, 1, None, "u1")],
        "document_id long, chunk_index int, content string, uploaded_by_user_id string")

    def model(texts):
        if "fail" in texts:
            raise RuntimeError
        return np.ones((len(texts), 4))

    plan = E.plan_backfill(backlog, E.resolve_providers(*settings), fallback)
    assert not any("key" in c for c in plan.columns)
    rows = E.run_backfill(plan, model, parity, dim=6).collect()
    got = {(r.document_id, r.chunk_index): (r.embed_status, r.credential_source, r.dim) for r in rows}
    other = ("embedded", "fallback") if fallback else ("no_credential", "none")
    lost = 6 if parity else None
    assert got == {
        (1, 0): ("embedded", "user", 4),
        (1, 1): ("blank", "user", lost),
        (2, 0): (*other, 4 if fallback else lost),
        (3, 0): ("error", "user", lost),
        (4, 0): (*other, 4 if fallback else lost),
        (4, 1): ("blank", "user", lost),
    }
    for r in rows:
        assert (r.embedding is None) == (r.dim is None)
        if r.embed_status != "embedded" and parity:
            assert r.embedding == [0.0] * 6


def test_backlog_joins_owners_and_drops_orphans(spark):
    chunks = spark.createDataFrame(
        [(1, 0, "a", None), (1, 1, "b", [1.0]), (5, 0, "c", None)],
        "document_id long, chunk_index int, content string, embedding array<float>")
    docs = spark.createDataFrame([(1, "u1"), (2, "u2")], "id long, uploaded_by_user_id string")
    assert [tuple(r) for r in E.embedding_backlog(chunks, docs).collect()] == [(1, 0, "a", "u1")]


def test_dimensions(spark):
    df = spark.createDataFrame([([1.0] * 768,), ([1.0] * 1536,), ([1.0] * 1536,), (None,)], "embedding array<float>")
    rows = {r.dim: (r.n, r.unexpected) for r in E.dimension_audit(df).collect()}
    assert rows == {768: (1, False), 1536: (2, True), None: (1, False)}


def test_model_is_loaded_once_a_worker_and_never_travels(spark, tmp_path):
    log = str(tmp_path)

    def load(reference):
        with open(f"{log}/{os.getpid()}", "a") as out:
            out.write(reference + "\n")
        return lambda texts: np.array([[len(text), len(reference)] for text in texts])

    model = referred_model(load, "models/one")
    rows = spark.range(4000).repartition(24).select("id", F.col("id").cast("string").alias("text"))
    for _ in range(2):
        got = rows.select("id", embed(F.col("text"), model).alias("v")).collect()
        assert len(got) == 4000 and all(list(r.v) == [len(str(r.id)), 10] for r in got)
    loads = [path.read_text().splitlines() for path in tmp_path.iterdir()]
    assert loads and all(lines == ["models/one"] for lines in loads)


def test_model_that_cannot_be_loaded_fails_the_task(spark):
    def load(reference):
        raise OSError(f"no {reference}")

    rows = spark.createDataFrame([("a",)], "text string").select(embed(F.col("text"), referred_model(load, "gone")))
    with pytest.raises(Exception, match="no gone"):
        rows.collect()
    nothing = spark.createDataFrame([(None,)], "text string")
    assert nothing.select(embed(F.col("text"), referred_model(load, "gone")).alias("v")).first().v is None


def test_two_references_are_two_models(spark):
    def load(reference):
        return lambda texts: np.array([[len(reference)] for _ in texts])

    rows = spark.createDataFrame([("x",)], "text string").coalesce(1)
    for reference in ("a", "bbb", "a"):
        assert rows.select(embed(F.col("text"), referred_model(load, reference)).alias("v")).first().v == [len(reference)]


def test_model_by_name(spark, tmp_path):
    (tmp_path / "named_model.py").write_text(
        "import numpy as np\n\n\ndef load(reference):\n"
        "    return lambda texts: np.array([[len(text), len(reference)] for text in texts])\n")
    spark.sparkContext.addPyFile(str(tmp_path / "named_model.py"))
    rows = spark.createDataFrame([("word",)], "text string")
    model = imported_model("named_model:load", "store@v2")
    assert rows.select(embed(F.col("text"), model).alias("v")).first().v == [4.0, 8.0]
    with pytest.raises(Exception, match="no_such_module"):
        rows.select(embed(F.col("text"), imported_model("no_such_module:f", "x"))).collect()
