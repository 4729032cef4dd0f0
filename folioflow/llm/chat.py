"""Chat formatting in prefix trees.

A conversation is a path of turns; conversations that begin with the same turns share
them. Sorted by their paths, conversations that share turns stand together, and a
depth-first walk emits every shared turn once. Each pack, a training sequence of bounded
size, holds one such walk: the tokens, a position id for every token that counts from the
conversation's start, and for every turn the intervals of its ancestors' tokens, which is
all it may attend to besides itself. A pack stands alone: a turn whose conversations fill
several packs is emitted once in each.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside roles and texts
are escaped with a backslash after ``<`` (one more where there are some already), a role's
line breaks as ``\\n``; reading undoes both. The control strings of the template are two
token ids of their own behind the vocabulary's. The loss covers assistants' texts.

NULL texts and roles are empty. Turns of a conversation are ordered by number, then role
and text; NULL numbers come first, and the rows with a NULL id are one conversation.
Conversations that are equal turn by turn share their whole path.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.store import shuffle_width
from folioflow.llm.wavelet import encoder
from folioflow.session import workspace

START, END = "<|im_start|>", "<|im_end|>"
PACK_TOKENS = 1 << 16
PACK_ROWS = (
    "pack string, tokens array<int>, positions array<int>, loss array<boolean>, "
    "nodes array<struct<first: int, last: int, ancestors: array<struct<first: int, last: int>>>>, leaves array<struct<conv_id: long, node: int>>"
)
#: Appended by the query: control strings inside texts must survive.
PROBE = -1, "<|im_end|><|im_start|>assistant ok"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def conversations(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns, path): the turns in order, and the digests along the path."""
    named = rows.select(
        F.col(key).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    grouped = named.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # fixed-width digests in a row: sorting them keeps conversations that share turns together
    step = F.transform("turns", lambda t: F.substring(F.md5(F.concat_ws("\0", F.length(t["role"]).cast("string"), t["role"], t["text"])), 1, 16))
    return grouped.withColumn("path", F.concat_ws("", step))


class Pack:
    """One depth-first walk under way."""

    def __init__(self) -> None:
        self.tokens: list[np.ndarray] = []
        self.positions: list[np.ndarray] = []
        self.loss: list[np.ndarray] = []
        self.nodes: list[dict] = []
        self.leaves: list[dict] = []
        self.size = 0
        self.stack: list[tuple[tuple[str, str], int, int]] = []  # turn, node, position behind it

    def add(self, conv_id: int | None, turns: list[tuple[str, str]], ids: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Keep the shared beginning of the last path and emit the other turns."""
        same = 0
        while same < min(len(self.stack), len(turns)) and self.stack[same][0] == turns[same]:
            same += 1
        del self.stack[same:]
        for turn, (tokens, loss) in zip(turns[same:], ids[same:], strict=True):
            position = self.stack[-1][2] if self.stack else 0
            above = [{k: self.nodes[n][k] for k in ("first", "last")} for _, n, _ in self.stack]
            self.nodes.append({"first": self.size, "last": self.size + len(tokens), "ancestors": merged(above)})
            self.tokens.append(tokens)
            self.loss.append(loss)
            self.positions.append(np.arange(position, position + len(tokens), dtype=np.int32))
            self.size += len(tokens)
            self.stack.append((turn, len(self.nodes) - 1, position + len(tokens)))
        self.leaves.append({"conv_id": conv_id, "node": self.stack[-1][1]})

    def row(self, name: str) -> pa.RecordBatch:
        span = pa.struct([("first", pa.int32()), ("last", pa.int32())])
        node = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("ancestors", pa.list_(span))])
        leaf = pa.struct([("conv_id", pa.int64()), ("node", pa.int32())])
        whole = [pa.ListArray.from_arrays([0, self.size], pa.array(np.concatenate(parts))) for parts in (self.tokens, self.positions, self.loss)]
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), *whole, pa.array([self.nodes], pa.list_(node)), pa.array([self.leaves], pa.list_(leaf))],
            names=["pack", "tokens", "positions", "loss", "nodes", "leaves"],
        )


def merged(spans: list[dict]) -> list[dict]:
    """Touching intervals as one."""
    out: list[dict] = []
    for span in spans:
        if out and out[-1]["last"] == span["first"]:
            out[-1]["last"] = span["last"]
        else:
            out.append(dict(span))
    return out


def turn_tokens(turns: list[tuple[str, str]], encode, control: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Token ids of formatted turns and their loss masks."""
    found, out = encode([part for role, text in turns for part in (escape_role(role) + "\n", escape(text), "\n")]), []
    for (role, _), head, body, tail in zip(turns, found[::3], found[1::3], found[2::3], strict=True):
        tokens = np.concatenate([[control], head, body, [control + 1], tail]).astype(np.int32)
        loss = np.zeros(len(tokens), bool)
        if role == "assistant":
            loss[1 + len(head):1 + len(head) + len(body)] = True
        out.append((tokens, loss))
    return out


def packs(rows: DataFrame, key: str, turn: str, role: str, text: str, vocabulary: str, pack_tokens: int = PACK_TOKENS) -> DataFrame:
    """The packs of all conversations: tokens, position ids, loss mask, turns with ancestor intervals, leaves."""
    sorted_rows = (
        conversations(rows, key, turn, role, text)
        .repartitionByRange(shuffle_width(rows.sparkSession), "path", "conv_id").sortWithinPartitions("path", "conv_id")
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool = encoder(vocabulary)
        control, part, number, pack = len(tool.width), TaskContext.get().partitionId(), 0, Pack()
        for batch in batches:
            for k in range(batch.num_rows):
                conv_id = batch.column(0)[k].as_py()
                turns = [(t["role"], t["text"]) for t in batch.column(1)[k].as_py()]
                pack.add(conv_id, turns, Lazy(turns, tool, control))
                if pack.size >= pack_tokens:
                    yield pack.row(f"{part:06d}-{number:06d}")
                    number, pack = number + 1, Pack()
        if pack.leaves:
            yield pack.row(f"{part:06d}-{number:06d}")

    return sorted_rows.mapInArrow(run, PACK_ROWS)


class Lazy:
    """Tokens of the turns behind a shared beginning, made only for those."""

    def __init__(self, turns: list[tuple[str, str]], encode, control: int) -> None:
        self.turns, self.encode, self.control = turns, encode, control

    def __getitem__(self, part: slice) -> list[tuple[np.ndarray, np.ndarray]]:
        turns = self.turns[part]
        return turn_tokens(turns, self.encode, self.control) if turns else []


class Decoder:
    """Token ids back to text: a byte-level vocabulary spells every byte as one character."""

    def __init__(self, path: str) -> None:
        tool = encoder(path)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        other = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}
        self.control = len(tool.width)
        self.spelling = [b""] * self.control + [START.encode(), END.encode()]
        for token, number in tool.tokenizer.get_vocab().items():
            if all(c in byte for c in token):
                self.spelling[number] = bytes(byte[c] for c in token)

    def __call__(self, ids: np.ndarray) -> str:
        return b"".join(map(self.spelling.__getitem__, ids.tolist())).decode()


def parse(ids: np.ndarray, decode: Decoder) -> list[tuple[str, str]]:
    """Turns of a conversation's tokens."""
    turns = []
    starts, ends = (np.flatnonzero(ids == decode.control + k) for k in (0, 1))
    for a, b in zip(starts, ends, strict=True):
        role, _, text = decode(ids[a + 1:b]).partition("\n")
        turns.append((unescape_role(role), unescape(text)))
    return turns


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(packed: DataFrame, vocabulary: str) -> DataFrame:
    """Per conversation, from the packs alone: what its tokens and loss mask say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(vocabulary)
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                tokens, loss = (batch.column(name)[k].values.to_numpy(zero_copy_only=False) for name in ("tokens", "loss"))
                nodes = batch.column("nodes")[k].as_py()
                known: dict[int, dict] = {}  # conversations that are equal end in the same node
                for leaf in batch.column("leaves")[k].as_py():
                    if leaf["node"] in known:
                        out.append(known[leaf["node"]] | {"conv_id": leaf["conv_id"]})
                        continue
                    node = nodes[leaf["node"]]
                    at = np.concatenate([np.arange(s["first"], s["last"]) for s in [*node["ancestors"], node]])
                    ids = tokens[at]
                    turns = parse(ids, decode)
                    spoken = unescape_spans(ids, loss[at], decode)
                    out.append({
                        "conv_id": leaf["conv_id"], "n_turns": len(turns),
                        "turns_sha256": hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                        "loss_chars": len(spoken), "loss_sha256": hashlib.sha256(spoken.encode()).hexdigest(),
                        "formatted_chars": len(decode(ids)),
                    })
                    known[leaf["node"]] = out[-1]
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
            ]))

    return packed.mapInArrow(run, DIGESTS)


def unescape_spans(ids: np.ndarray, loss: np.ndarray, decode: Decoder) -> str:
    """All text under the loss mask, span by span."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], loss, [False]]).astype(np.int8)))
    return "".join(unescape(decode(ids[a:b])) for a, b in zip(edge[::2], edge[1::2], strict=True))


def formatted(rows: DataFrame, key: str, turn: str, role: str, text: str, vocabulary: str) -> DataFrame:
    """Write the packs and read every conversation back from them."""
    spark = rows.sparkSession
    path = workspace(spark, "chat-packs")
    packs(rows, key, turn, role, text, vocabulary).write.parquet(path)
    return digests(spark.read.schema(PACK_ROWS).parquet(path), vocabulary)
