"""Assembled pages against plain Python, a hot document included."""

import random

import pytest

from folioflow.functions.text import TRUNCATION_MARKER
from folioflow.operators.pages import assemble_pages


def python_text(pages, limit):
    text = ""
    for page, direct, ocr in sorted(pages):
        if direct is not None and len(direct.strip()) >= 50:
            text += f"\n--- Página {page} ---\n{direct}\n"
        else:
            text += f"\n--- Página {page} (OCR) ---\n{ocr or ''}\n"
    text = text.strip()
    return text if len(text) <= limit else text[:limit] + TRUNCATION_MARKER


def make(seed):
    rng = random.Random(seed)
    docs = {}
    for doc in range(30):
        n = 400 if doc == 0 else rng.randint(1, 12)  # one document holds most of the pages
        docs[doc] = [
            (
                page + 1,
                rng.choice([None, "", "short", "   " * 40, "t" * 50 + " \n" * rng.randint(0, 30),
                            "word " * rng.randint(9, 60)]),
                rng.choice([None, "", "  \n \n", "scan 🙂 " * rng.randint(1, 20)]),
            )
            for page in range(n)
        ]
    return docs


@pytest.mark.parametrize("limit,block", [(10 ** 7, 64), (400, 3), (90, 1), (1000, 2)])
def test_equals_plain_assembly(spark, limit, block):
    docs = make(limit)
    rows = [(d, *p) for d, pages in docs.items() for p in pages]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(
        rows, "document_id long, page int, page_text string, ocr_text string").repartition(5)
    got = {r.document_id: (r.text, r.n_pages) for r in assemble_pages(df, limit, block).collect()}
    assert got == {d: (python_text(p, limit), len(p)) for d, p in docs.items()}


def test_exact_limits(spark):
    """Texts ending right at, one below and one above the limit."""
    pages = [(1, "p" * 60 + "  \n ", ""), (2, "q" * 70 + "\n\n", "")]
    whole = len(python_text(pages, 10 ** 6))
    df = spark.createDataFrame(
        [(1, *p) for p in pages], "document_id long, page int, page_text string, ocr_text string")
    for limit in [whole - 90, whole - 80, whole - 75, whole - 1, whole, whole + 1]:
        for block in (1, 2, 64):
            assert assemble_pages(df, limit, block).first().text == python_text(pages, limit)


def test_far_pages_are_not_collected(spark):
    """Only the blocks within the limit reach the group of a hot document."""
    df = spark.range(5000).selectExpr(
        "1L AS document_id", "CAST(id + 1 AS INT) AS page", "repeat('z', 60) AS page_text",
        "'' AS ocr_text")
    out = assemble_pages(df, 1000, 10)
    assert out.first().n_pages == 5000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "<= 1001)" in plan


def test_only_wanted_documents(spark):
    docs = make(8)
    rows = [(d, *p) for d, pages in docs.items() for p in pages]
    df = spark.createDataFrame(rows, "document_id long, page int, page_text string, ocr_text string")
    wanted = spark.createDataFrame([(0,), (3,), (99,)], "document_id long")
    got = {r.document_id: r.text for r in assemble_pages(df, 500, 4, wanted).collect()}
    assert got == {d: python_text(docs[d], 500) for d in (0, 3)}
