"""Chat formatting by token-level assembly.

Role and text of a turn are encoded apart and reserved ids are spliced between
them, so no text can ever produce a control token. Control strings inside a text
are also escaped, which makes the formatted *string* unambiguous and reversible.
The loss mask is the prefix sum of +1 where an assistant text begins and -1
where it ends.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BINARY, LONG, STRING, arrow_batch
from .tokens import encoder, vocabulary

START, END = "<|im_start|>", "<|im_end|>"
START_ID, END_ID = 50257, 50258  # free ids above the vocabulary
TRAINED_ROLE = "assistant"
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")

FORMATTED = ("conv_id long, turn long, position long, token_start long, ids binary, loss_mask binary, "
             "text_chars long")


def escape(text: str) -> str:
    """Put one backslash more between ``<`` and ``|``; no control string remains."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def assemble(roles: list[str], texts: list[str], coder, trained: str = TRAINED_ROLE) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, mask) of each turn: start, role, line feed, text, end, line feed."""
    line = coder.ids("\n")
    heads = coder.batch([escape_role(r) for r in roles])
    bodies = coder.batch([escape(t) for t in texts])
    out = []
    for role, head, body in zip(roles, heads, bodies):
        ids = np.concatenate([[START_ID], head, line, body, [END_ID], line]).astype("<u4")
        delta = np.zeros(len(ids) + 1, dtype=np.int8)
        if role == trained:
            at = 1 + len(head) + len(line)
            delta[at] += 1
            delta[at + len(body)] -= 1
        out.append((ids, np.cumsum(delta[:-1], dtype=np.int8)))
    return out


def read_turn(ids: np.ndarray, mask: np.ndarray, coder) -> tuple[str, str, str, int]:
    """(role, text, text under the mask, formatted characters) of one assembled turn."""
    at = np.flatnonzero(ids == END_ID)
    if len(ids) < 3 or ids[0] != START_ID or len(at) != 1:
        raise ValueError("not an assembled turn")
    inner = coder.text(ids[1:at[0]])
    tail = coder.text(ids[at[0] + 1:])
    role, _, body = inner.partition("\n")
    under = unescape(coder.text(ids[mask == 1])) if mask.any() else ""
    return unescape_role(role), unescape(body), under, len(START) + len(inner) + len(END) + len(tail)


def format_chat(conversations: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """Every turn assembled (see ``FORMATTED``), in order within its conversation.

    ``position`` counts turns from 0, ``token_start`` the conversation's tokens
    before the turn. Turns are ordered by turn, then role and text (repeated
    turns stay). Null role or text: empty. A null conversation id is a
    conversation of its own. Turns are encoded where they lie and only then
    brought to their conversation, which is streamed row by row: memory does
    not grow with a conversation's length. Other columns are ignored.
    """
    path = ranks_path or vocabulary()
    narrow = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                  F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                  F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for f in batches:
            texts = f["text"].to_pylist()
            made = assemble(f["role"].to_pylist(), texts, coder)
            yield arrow_batch({"conv_id": f["conv_id"], "turn": f["turn"], "role": f["role"],
                               "text_hash": [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in texts],
                               "ids": [i.tobytes() for i, _ in made], "loss_mask": [m.tobytes() for _, m in made],
                               "text_chars": [len(t) for t in texts]},
                              {"text_hash": BINARY, "ids": BINARY, "loss_mask": BINARY, "text_chars": LONG})

    coded = narrow.mapInArrow(encode, "conv_id long, turn long, role string, text_hash binary, ids binary, "
                                       "loss_mask binary, text_chars long")
    ordered = coded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text_hash")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, position, tokens = object(), 0, 0
        for f in batches:
            positions, starts = [], []
            for conv, ids in zip(f["conv_id"].to_pylist(), f["ids"].to_pylist()):
                if conv != at:
                    at, position, tokens = conv, 0, 0
                positions.append(position)
                starts.append(tokens)
                position += 1
                tokens += len(ids) // 4
            yield arrow_batch({"conv_id": f["conv_id"], "turn": f["turn"], "position": positions, "token_start": starts,
                               "ids": f["ids"], "loss_mask": f["loss_mask"], "text_chars": f["text_chars"]},
                              {"position": LONG, "token_start": LONG})

    return ordered.mapInArrow(place, FORMATTED)


def read_back(formatted: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """Digests of each conversation, read from its assembled ids and masks alone.

    Expects the row order of :func:`format_chat`. One running hash per
    conversation; nothing of it is held in memory.
    """
    path = ranks_path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        held = None

        def close() -> tuple:
            conv, turns, digest, loss, loss_digest, chars = held
            return conv, turns, digest.hexdigest(), loss, loss_digest.hexdigest(), chars

        for f in batches:
            done = []
            for conv, ids, mask in zip(*(f[c].to_pylist() for c in ("conv_id", "ids", "loss_mask"))):
                if held is None or held[0] != conv:
                    if held is not None:
                        done.append(close())
                    held = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, under, chars = read_turn(np.frombuffer(ids, dtype="<u4"), np.frombuffer(mask, dtype=np.int8), coder)
                held[1] += 1
                held[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                held[3] += len(under)
                held[4].update(under.encode("utf-8", "surrogatepass"))
                held[5] += chars
            yield _digests(done)
        if held is not None:
            yield _digests([close()])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    types = {"conv_id": LONG, "n_turns": LONG, "turns_sha256": STRING, "loss_chars": LONG, "loss_sha256": STRING,
             "formatted_chars": LONG}
    return arrow_batch({n: [r[k] for r in rows] for k, n in enumerate(types)}, types)
