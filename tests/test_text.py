"""Native text expressions against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as X

ATOMS = ["\n", "\r\n", "\r", " ", "　", "\x1c", "\t", "a", "é", "🙂", "Word", ". ", "​"]


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(5)
    return ["", " ", "　\x1c"] + ["".join(rng.choices(ATOMS, k=rng.randint(0, 40)))
                                      for _ in range(200)]


def evaluate(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_strip_and_blank(spark, samples):
    assert evaluate(spark, samples, X.strip) == [s.strip() for s in samples]
    assert evaluate(spark, samples, X.is_blank) == [not s.strip() for s in samples]


def test_truncation_counts_characters(spark, samples):
    want = [s if len(s) <= 7 else s[:7] + X.TRUNCATION_MARKER for s in samples]
    assert evaluate(spark, samples, lambda c: X.truncate(c, 7)) == want


def test_summary_and_preview(spark):
    texts = ["🙂" * 1000, "🙂" * 1001, "a" * 100, "a" * 101]
    assert evaluate(spark, texts, X.summarize) == [
        "🙂" * 1000, "🙂" * 1000 + "...", "a" * 100, "a" * 101]
    assert evaluate(spark, texts[2:], X.preview) == ["a" * 100, "a" * 100 + "..."]


def test_fallback_applies_only_after_a_refused_write(spark):
    long = "x" * 20
    assert evaluate(spark, [long], lambda c: X.fallback_truncate(c, F.lit(False), 5)) == [long]
    assert evaluate(spark, [long], lambda c: X.fallback_truncate(c, F.lit(True), 5)) == [
        "xxxxx" + X.TRUNCATION_MARKER]


def python_decode(content):
    try:
        text, name = content.decode("utf-8"), "utf-8"
    except UnicodeDecodeError:
        text, name = content.decode("latin-1"), "latin-1"
    return text.replace("\r\n", "\n").replace("\r", "\n"), name


def test_decoding_any_bytes(spark):
    rng = random.Random(1)
    blobs = [b"", "café\r\nx\ry".encode(), "café".encode("latin-1"), b"\xef\xbb\xbfbom",
             b"\xed\xa0\x80", b"\xc0\xaf", "🙂".encode(), b"\xf4\x90\x80\x80"]
    blobs += [bytes(rng.choices(range(256), k=rng.randint(1, 12))) for _ in range(300)]
    values = [bytearray(b) for b in blobs]
    want = [python_decode(b) for b in blobs]
    assert evaluate(spark, values, X.decode_text, "binary") == [w[0] for w in want]
    assert evaluate(spark, values, X.decoded_as, "binary") == [w[1] for w in want]


def test_extensions_and_routes(spark):
    kinds = ["pdf", "Docx", "CSV", "png", "7", None, "ODT", "nonsense"]
    assert evaluate(spark, kinds, X.file_extension) == [
        "pdf", "docx", "pdf", "pdf", "pdf", "pdf", "odt", "pdf"]
    whole = evaluate(spark, kinds, lambda c: X.extractor(X.file_extension(c, complete=True)))
    assert whole == ["pages", "text", "text", "image", "pages", "pages", "text", "pages"]


def test_error_text(spark):
    texts = [X.ERROR_MARKER + ": x", " " + X.ERROR_MARKER, None]
    assert evaluate(spark, texts, X.is_error_text) == [True, False, False]
