"""Benchmark decontamination: a BM25 inverted index of test items, queried by every passage.

Training texts are cut into overlapping windows so long that any item lies whole in one.
A window's query is its set of words; an item's score is BM25 divided by the score of the
item against itself, so 1 means that every word of the item is there. All items of at
least ``threshold`` are retrieved, and a hit counts when enough of the item's question and
of its answer stands in the window.

Retrieval follows block-max WAND in bulk, over all windows of a batch at once. Words are
ordered by the largest weight they have in any item; those that together can't reach
the part ``SLACK`` of the threshold in any item are set aside, which is the pivot rule. The
others' postings are blocks of items with the largest weight per block; their sums bound a
block's best score, and only blocks whose bound reaches the threshold are scored in full.
No item above the threshold is lost.

The index is cut into slices of bounded size, each built by one task and written to the shared
folder; the texts are passed once, and a task holds one slice at a time. Word counts, lengths
and windows are those of all items, so slices never change a result.
An item's answer is its last sentence, or the last half of its words if it has only one.
Items and texts without words, NULLs included, match nothing. An item with a NULL id is found
like any other. Repeated ids are rows of their own: equal hits are reported once.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from folioflow.llm.store import extended, lean, materialise, open_store, write_file
from folioflow.llm.words import WordHasher, slices
from folioflow.session import workspace

K1, B = 1.2, 0.75
THRESHOLD, SLACK = 0.6, 0.5
OVERLAP, GRAM = 0.5, 3
ITEMS_PER_BLOCK = 8
SLICE_ITEMS, SLICE_CHARS = 20_000, 16 << 20
U64 = np.uint64


def hasher() -> WordHasher:
    """Words of letters and digits in lower case (ASCII), so that punctuation never hides a copy."""
    return WordHasher(fold_case=True, letters_only=True)


def words_of(text: str, tool: WordHasher) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    begin, end, _ = tool.spans(data, np.array([0, len(data)]))
    return tool.hashes(data, begin, end)


def question_and_answer(text: str) -> tuple[str, str]:
    sentences = [m.end() for m in re.finditer(r"[.!?]+\s+(?=\S)", text)]
    if sentences:
        return text[:sentences[-1]], text[sentences[-1]:]
    words = [m.start() for m in re.finditer(r"\S+", text)]
    cut = words[len(words) // 2] if len(words) > 1 else 0
    return text[:cut], text[cut:]


class Totals(NamedTuple):
    """What scores and windows take from all items: their number, mean and largest number of words."""

    items: int
    mean: float
    span: int


class Index:
    """Block-max postings of a slice's items: (item_id, text) pairs, texts with words only.

    ``holders`` maps the slice's words, sorted, to the number of all items that hold them.
    An index is stored and loaded as a dict of arrays and lists.
    """

    def __init__(self, state: dict) -> None:
        self.__dict__.update(state)

    @classmethod
    def build(cls, items: list[tuple], totals: Totals, holders: tuple[np.ndarray, np.ndarray]) -> dict:
        self = cls({})
        tool = hasher()
        found = [(key, text, words_of(text, tool)) for key, text in items]
        self.ids = [key for key, _, _ in found]
        parts = [words_of(part, tool) for _, text, _ in found for part in question_and_answer(text)]
        self.part_words = np.concatenate([np.zeros(0, U64), *parts])
        self.part_bounds = np.concatenate([[0], np.cumsum([len(part) for part in parts], dtype=np.int64)])
        lengths = np.array([len(w) for _, _, w in found], float)
        self.span = totals.span
        owner = np.repeat(np.arange(len(found)), lengths.astype(int))
        self.terms, term = np.unique(np.concatenate([np.zeros(0, U64), *[w for _, _, w in found]]), return_inverse=True)
        key, times = np.unique(term * max(1, len(found)) + owner, return_counts=True)
        term, item = key // max(1, len(found)), key % max(1, len(found))
        df = holders[1][np.searchsorted(holders[0], self.terms)]
        idf = np.log1p((totals.items - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / totals.mean)
        weight = idf[term] * times * (K1 + 1) / (times + norm[item])
        weight /= np.bincount(item, weight, len(found))[item]
        # postings by term; a block's postings by (term, block)
        self.item, self.weight = item, weight
        self.begin = np.searchsorted(term, np.arange(len(self.terms) + 1))
        # words set aside: common first, as long as no item has more than SLACK of the threshold in them
        largest = np.zeros(len(self.terms))
        np.maximum.at(largest, term, weight)
        aside, spent = np.zeros(len(self.terms), bool), np.zeros(len(found))
        for t in np.argsort(-df, kind="stable"):
            part = slice(self.begin[t], self.begin[t + 1])
            if df[t] < 2 or (spent[item[part]] + weight[part] > SLACK * THRESHOLD).any():
                continue
            spent[item[part]] += weight[part]
            aside[t] = True
        self.block_of = item // ITEMS_PER_BLOCK
        self.blocks = -(-len(found) // ITEMS_PER_BLOCK)
        slack = np.zeros(max(1, self.blocks))
        np.maximum.at(slack, np.arange(len(found)) // ITEMS_PER_BLOCK, spent)
        self.need = THRESHOLD - slack - 1e-9
        key = term * max(1, self.blocks) + self.block_of
        block_key, back = np.unique(key, return_inverse=True)
        self.block_max = np.zeros(len(block_key))
        np.maximum.at(self.block_max, back, weight)
        self.block_id = block_key % max(1, self.blocks)
        self.block_begin = np.searchsorted(block_key // max(1, self.blocks), np.arange(len(self.terms) + 1))
        self.essential = ~aside
        return vars(self)

    def parts(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of an item's question and answer."""
        a, b, c = self.part_bounds[2 * item:2 * item + 3]
        return self.part_words[a:b], self.part_words[b:c]

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Term numbers of words, -1 where no item has the word."""
        if not len(self.terms):
            return np.full(len(words), -1)
        if not hasattr(self, "_bucket"):  # a hash table of the top 16 bits in front of the sorted terms
            self._bucket = np.zeros(1 << 16, bool)
            self._bucket[(self.terms >> U64(48)).astype(np.int64)] = True
        out = np.full(len(words), -1)
        maybe = np.flatnonzero(self._bucket[(words >> U64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, words[maybe]), len(self.terms) - 1)
        out[maybe] = np.where(self.terms[at] == words[maybe], at, -1)
        return out

    def search(self, words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, float, float, float]]:
        """(text, item, score, question, answer) of every verified hit of a batch of texts."""
        terms = self.lookup(words)
        known = np.flatnonzero((terms >= 0))
        known = known[self.essential[terms[known]]]
        if not len(known):
            return []
        # windows of 2 span words every span words, numbered over all texts
        text = np.searchsorted(bounds, known, "right") - 1
        count = np.maximum(1, -(-np.diff(bounds) // self.span))
        first = np.concatenate([[0], np.cumsum(count)])
        half = first[text] + (known - bounds[text]) // self.span
        window = np.concatenate([half, np.maximum(half - 1, first[text])])
        key = np.unique(window * len(self.terms) + np.concatenate([terms[known]] * 2))
        window, term = key // len(self.terms), key % len(self.terms)
        # bounds of the blocks
        size = self.block_begin[term + 1] - self.block_begin[term]
        post = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.block_begin[term], size)
        pair = np.repeat(window, size) * self.blocks + self.block_id[post]
        pairs, back = np.unique(pair, return_inverse=True)
        best = np.bincount(back, self.block_max[post])
        chosen = pairs[best >= self.need[pairs % self.blocks]]
        hits = []
        owner = np.searchsorted(first, chosen // self.blocks, "right") - 1
        for one, t in zip(chosen, owner, strict=True):
            w, block = divmod(int(one), self.blocks)
            begin = bounds[t] + (w - first[t]) * self.span
            passage = words[begin:min(begin + 2 * self.span, bounds[t + 1])]
            hits += [(int(t), *hit) for hit in self.score(passage, np.unique(terms[begin:begin + len(passage)]), block)]
        return hits

    def score(self, passage: np.ndarray, terms: np.ndarray, block: int) -> list[tuple[int, float, float, float]]:
        """Full scores of a block's items, and the shares of question and answer found."""
        terms = terms[terms >= 0]
        size = self.begin[terms + 1] - self.begin[terms]
        post = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.begin[terms], size)
        post = post[self.block_of[post] == block]
        total = np.bincount(self.item[post] - block * ITEMS_PER_BLOCK, self.weight[post], ITEMS_PER_BLOCK)
        out = []
        for k in np.flatnonzero(total >= THRESHOLD):
            item = block * ITEMS_PER_BLOCK + int(k)
            question, answer = (overlap(part, passage) for part in self.parts(item))
            if question >= OVERLAP and answer >= OVERLAP:
                out.append((item, float(total[k]), question, answer))
        return out


def grams(words: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(0, len(words) - size + 1), U64)
    for k in range(size):
        out = out * U64(0x9E3779B97F4A7C15) + words[k:len(words) - size + 1 + k]
    return out


def overlap(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of a part's word triples (shorter parts: of its words in a row) in the passage; 1 for no words."""
    size = min(GRAM, len(part))
    if not size:
        return 1.0
    return float(np.isin(grams(part, size), grams(passage, size)).mean())


def build_index(items: DataFrame, key: str, text: str) -> tuple[str, int]:
    """Folder and number of the index's slices, of about SLICE_ITEMS items and SLICE_CHARS characters at most."""
    spark = items.sparkSession
    rows = items.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t IS NOT NULL").distinct()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = hasher()
        for batch in batches:
            size = [np.diff(tool.spans(data, bounds)[2]) for _, _, data, bounds in slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0, np.int64), *size]))], names=["k", "t", "n"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = hasher()
        for batch in batches:
            for start, stop, data, bounds in slices(batch.column(1)):
                begin, end, at = tool.spans(data, bounds)
                words = tool.hashes(data, begin, end)
                for k in range(stop - start):
                    own = np.unique(words[at[k]:at[k + 1]]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), batch.column(0)[start + k].as_py())), pa.array(own)], names=["slice", "term"])

    folder = workspace(spark, "item-slices")
    store, path = open_store(folder)
    store.create_dir(path)
    counted = materialise(rows.mapInArrow(measure, extended(rows.schema, "n long")).where("n > 0"), "items")
    total = counted.agg(F.count("*").alias("items"), F.avg("n").alias("mean"), F.max("n").alias("span"), F.sum(F.length("t")).alias("chars")).first()
    if not total["items"]:
        return folder, 0
    totals = total["items"], total["mean"], total["span"]
    count = max(math.ceil(total["items"] / SLICE_ITEMS), math.ceil(total["chars"] / SLICE_CHARS))
    sliced = counted.withColumn("slice", F.pmod(F.xxhash64("k", "t"), F.lit(count)))
    pairs = sliced.select("slice", "t").mapInArrow(spread, "slice long, term long").groupBy("slice", "term").agg(F.count("*").alias("own"))
    holders = pairs.join(pairs.groupBy("term").agg(F.sum("own").alias("df")), "term").select("slice", "term", "df")

    def write(number: tuple, part: pa.Table, words: pa.Table) -> pa.Table:
        slice_ = number[0].as_py()
        term, df = words["term"].to_numpy().view(U64), words["df"].to_numpy()
        order = np.argsort(term)
        part = part.sort_by([("k", "ascending"), ("t", "ascending")])
        state = Index.build(list(zip(part["k"].to_pylist(), part["t"].to_pylist(), strict=True)), Totals(*totals), (term[order], df[order]))
        store, path = open_store(folder)
        write_file(store, f"{path}/{slice_}", pickle.dumps(state, protocol=5))
        return pa.table({"slice": pa.array([slice_], pa.int64())})

    written = sliced.select("slice", "k", "t").groupBy("slice").cogroup(holders.groupBy("slice")).applyInArrow(write, "slice long")
    written.agg(F.count("*")).collect()
    return folder, count


def searches(folder: str, count: int) -> Callable[[pa.Array], Iterator[tuple]]:
    """A function from a column of texts to (row, index, item, score, question, answer) of all hits.

    One slice is loaded at a time, for all texts at hand; a single one stays loaded.
    """
    tool, store, path = hasher(), *open_store(folder)
    kept: list[Index] = []

    def load(number: int) -> Index | None:
        if kept:
            return kept[0]
        info = store.get_file_info(f"{path}/{number}")
        if not info.is_file:  # no item fell into it
            return None
        with store.open_input_stream(info.path) as file:
            index = Index(pickle.loads(file.read()))
        if count == 1:
            kept.append(index)
        return index

    def search(texts: pa.Array) -> Iterator[tuple]:
        for number in range(count):
            index = load(number)
            for start, _, data, bounds in slices(texts) if index else ():
                begin, end, at = tool.spans(data, bounds)
                for t, *hit in index.search(tool.hashes(data, begin, end), at):
                    yield start + t, index, *hit

    return search


def clean(docs: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no item is found."""
    at_text = docs.columns.index(text)
    folder, count = build_index(items, item_key, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = searches(folder, count)
        for batch in batches:
            free = np.ones(batch.num_rows, bool)
            for row, *_ in search(batch.column(at_text)):
                free[row] = False
            yield batch.filter(pa.array(free))

    return docs.mapInArrow(lean(run), docs.schema)


def hits(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): one row per text and item found in it."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    kinds = source.schema["doc_id"].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, question_overlap double, answer_overlap double"
    kind = to_arrow_type(items.schema[item_key].dataType)
    folder, count = build_index(items, item_key, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = searches(folder, count)
        for batch in batches:
            found = [(row, index.ids[item], *scores) for row, index, item, *scores in search(batch.column(1))]
            rows, ids, *scores = zip(*found, strict=True) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(ids, kind), *[pa.array(c, pa.float64()) for c in scores]],
                names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
            )

    found = source.mapInArrow(lean(run), schema)
    return found.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")])
