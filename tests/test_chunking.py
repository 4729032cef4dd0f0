import random
import subprocess
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from folioflow.functions.chunking import split_text
from folioflow.functions.text import WHITESPACE
from folioflow.operators import chunks as C
from tests.splitter_spec import check_split

GOLDENS = [
    ("", []),
    ("   ", []),
    ("　\x1c", []),
    ("short", []),
    ("exactly11ch", [11]),
    ("\n\n" + "a" * 1200, [1000, 401]),
    ("a" * 2500, [1000, 1201, 701]),
    (("x" * 990 + ". ") * 3, [990, 1191, 1192]),
    (" " + "é " * 700, [999, 599]),
    (("w" * 150 + "\n\n") * 12, [910, 1111]),
    ("tiny\n\n" + "b" * 1000, [1005]),
    ("🙂" * 1500, [1000, 701]),
]


@pytest.mark.parametrize("text,lengths", GOLDENS)
def test_goldens(text, lengths):
    assert [len(c) for c in split_text(text)] == lengths


ATOMS = ["\n", "\n\n", "\n\n\n", ". ", "! ", "? ", "; ", ", ", " ", "  ", "a", "é", "🙂", "word",
         ".", "\x1c", "　", "\t", "longerword" * 3]


@settings(max_examples=600, deadline=None)
@given(
    st.lists(st.sampled_from(ATOMS), max_size=120).map("".join),
    st.integers(1, 40),
    st.integers(0, 15),
)
def test_keeps_the_rules(text, size, overlap):
    check_split(text, split_text(text, size, overlap), size, overlap)


def test_keeps_the_rules_on_long_texts():
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choices(ATOMS, k=4000))
        check_split(text, split_text(text))
        check_split(text, split_text(text, 300, 0), 300, 0)


def test_whitespace_is_what_strip_removes():
    assert len(WHITESPACE) == 29
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_chunk_rows_equal_the_splitter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {}
    for r in C.chunk_documents(docs).orderBy("document_id", "chunk_index").collect():
        got.setdefault(r.document_id, []).append((r.chunk_index, r.content))
    want = {
        r.doc_id: list(enumerate(split_text(r.text))) for r in docs.collect()
        if split_text(r.text)
    }
    assert got == want


def test_splitter_runs_once_per_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = C.chunk_documents(docs, keep=["lang"])
    for some in (rows, rows.where("lang = 'en' AND document_id = 5")):
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
        assert "Exchange" not in plan
    assert "EqualTo(doc_id,5)" in plan and "EqualTo(lang,en)" in plan


def test_sweep_equals_single_settings(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sweep = C.chunk_sweep(docs)
    for size, overlap, name in C.SWEEP:
        one = C.chunk_documents(docs, size=size, overlap=overlap)
        many = sweep.where(sweep.setting == name).drop("setting")
        assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    plan = sweep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_replacing_chunks_twice_changes_nothing(spark):
    old = spark.createDataFrame(
        [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "document_id long, chunk_index int, content string"
    )
    new = spark.createDataFrame([(1, 0, "z")], old.schema)
    once = C.replace_chunks(old, new)
    assert sorted(map(tuple, once.collect())) == [(1, 0, "z"), (2, 0, "c")]
    assert sorted(C.replace_chunks(once, new).collect()) == sorted(once.collect())


def test_executors_need_no_copy_of_the_package():
    code = "import pickle, sys; print(len(pickle.load(sys.stdin.buffer)('a' * 2500)))"
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(split_text),
                          capture_output=True, cwd="/", check=True)
    assert done.stdout.strip() == b"3"


INDENTED = "".join(
    f"\n    Paragraph {i} speaks of many things: ships, shoes; wax.\n    \n    - item {i}\n"
    for i in range(60)
)


def test_indented_text_without_paragraph_breaks():
    for size, overlap, _ in C.SWEEP:
        check_split(INDENTED, split_text(INDENTED, size, overlap), size, overlap)
