"""Periodic runs against plain comparison of every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm import queries, runs


def plain_runs(words, least=24, periods=3):
    """Every maximal stretch of every period, with its smallest period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= 2 * q:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, periods * q))


def kept_words(words, found):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]


def got_runs(words, least=24, periods=3):
    symbols = np.array([hash(w) % 1000003 for w in words], np.int64)
    start, end, period = runs.periodic_runs(symbols, least, periods)
    return [(int(s), int(e - s), int(q)) for s, e, q in zip(start, end, period)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60), st.sampled_from([(2, 2), (4, 2), (5, 3)]))
def test_any_words_equal_plain_comparison(words, limits):
    assert got_runs(words, *limits) == plain_runs(words, *limits)


def loops(pick, longest):
    words = []
    while len(words) < longest:
        part = [pick.choice("abcde") for _ in range(pick.randrange(1, 40))]
        words += (part * pick.randrange(1, 9))[:pick.randrange(1, 200)]
    return words


def test_loops_of_all_lengths_equal_plain_comparison():
    pick = random.Random(3)
    for _ in range(30):
        words = loops(pick, 400)
        assert got_runs(words) == plain_runs(words)
    assert got_runs(["a"] * 5000) == [(0, 5000, 1)]
    assert got_runs((["a"] * 40 + ["b"]) * 30) == plain_runs((["a"] * 40 + ["b"]) * 30)


def test_texts_never_share_and_awkward_rows(spark):
    pick = random.Random(4)
    texts = [None, "", " \n\t", "one", "x " * 30, "x " * 30, "  é\x0bé " * 40, *[" ".join(loops(pick, n)) for n in (10, 100, 900)]]
    frame = spark.createDataFrame([(i, t, "r", 2.0) for i, t in enumerate(texts)], "doc_id int, text string, runs string, n double")
    got = runs.find_runs(frame.repartition(1), "text").collect()
    assert set(got[0].asDict()) == {"doc_id", "n", "runs", "strongest", "collapsed"} and len(got) == len(texts)
    for row in got:
        words = (texts[row.doc_id] or "").split()
        want = plain_runs(words)
        assert [tuple(r) for r in row.runs] == want
        assert row.collapsed == " ".join(kept_words(words, want))
        best = max(want, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        assert (tuple(row.strongest) if row.strongest else None) == best
    assert runs.find_runs(frame.limit(0), "text").count() == 0


def test_an_odd_byte_string_stays_text():
    [found, _, collapsed] = runs.marked(pa.array(["ã\x85 b\xa0c"]))
    assert found.to_pylist() == [[]] and collapsed.to_pylist() == ["ã\x85 b\xa0c"]


def test_query_equals_plain_comparison(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op13_runs(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    hits = 0
    for row in got:
        words = [w for w in (docs[row.doc_id] or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
        if len(words) > 3000:
            continue  # plain comparison takes the square of the words
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        want = plain_runs(words)
        hits += bool(want)
        best = max(want, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(want), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(kept_words(words, want)).encode()).hexdigest()
    assert hits > 5
