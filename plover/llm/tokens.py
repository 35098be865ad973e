"""Token ids of public byte-level BPE vocabularies inside tasks.

Pre-tokenisation never joins the end of one word with the space or line feed
before the next, so a batch of texts is cut into words, each distinct word is
encoded once, and the ids are gathered back in text order. Words are told apart
by a 64-bit hash within a batch of a few megabytes. Texts where such a cut would
not be safe (runs of white space, other white space, a blank end) are encoded
whole by the vocabulary's own coder; the ids are the same either way.
"""
from __future__ import annotations

import base64
import os
import re

import numpy as np

from .common import release_memory, word_hashes

DEFAULT_VOCAB = "byte_bpe_50k"
_BATCH = 8 << 20
_MEMORY = 1_500_000  # distinct words remembered by a worker, about 70 MB
_OTHER_SPACE = re.compile(r"[^\S \n]")
_RUN = re.compile(r"\s\s")
_KIND = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)  # start, space, line feed
#: Strings that the vocabulary's JSON form (plain call of the tokenizer library) reads as one reserved id.
RESERVED = (("<|endoftext|>", 50256),)
_LOADED: dict[tuple, "Encoder"] = {}


def vocabulary(name: str = DEFAULT_VOCAB, suffix: str = "tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(f"{name}.{suffix}")


class Encoder:
    """Ids of ordinary text; strings of ``reserved`` become their id, without it they are text like any other."""

    def __init__(self, ranks_path: str, reserved: tuple[tuple[str, int], ...] = ()):
        import public_tokenizers
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._feed = ranks[b"\n"]
        self._coder = tiktoken.Encoding(os.path.basename(ranks_path), pat_str=public_tokenizers.PATTERN,
                                        mergeable_ranks=ranks, special_tokens=dict(reserved))
        self._reserved = [text for text, _ in reserved]
        self._forget()

    def _forget(self) -> None:
        self._known, self._new = _Words(), _Words()
        self._pool, self._filled = np.empty(1 << 16, dtype=np.uint32), 0

    def release(self) -> None:
        """Forget the words of a task; the vocabulary stays."""
        self._forget()
        release_memory()

    def ids(self, text: str) -> np.ndarray:
        if any(r in text for r in self._reserved):
            return np.array(self._coder.encode(text, allowed_special="all"), dtype=np.uint32)
        return np.array(self._coder.encode_ordinary(text), dtype=np.uint32)

    def text(self, ids) -> str:
        return self._coder.decode_bytes([int(i) for i in ids]).decode("utf-8", "replace")

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text (null: empty), as unsigned 32-bit arrays."""
        out: list = [None] * len(texts)
        group: list[int] = []
        held = 0
        for i, t in enumerate(texts):
            if not t:
                out[i] = np.empty(0, dtype=np.uint32)
            elif t[-1].isspace() or _RUN.search(t) or _OTHER_SPACE.search(t) or any(r in t for r in self._reserved):
                out[i] = self.ids(t)
            else:
                group.append(i)
                held += len(t)
                if held >= _BATCH:
                    self._group(texts, group, out)
                    group, held = [], 0
        if group:
            self._group(texts, group, out)
        return out

    def _group(self, texts: list, group: list[int], out: list) -> None:
        parts = [texts[i].encode("utf-8", "surrogatepass") for i in group]
        data = b"\t".join(parts)  # no text of a group holds a tab
        ends = np.cumsum([len(p) + 1 for p in parts])
        first, after, word = word_hashes(data)
        raw = np.frombuffer(data, dtype=np.uint8)
        before = raw[np.maximum(first - 1, 0)]
        kind = np.where(before == 32, 1, np.where(before == 10, 2, 0))
        kind[0] = kind[0] if first[0] else 0
        keys, at, back = np.unique(word ^ _KIND[kind], return_index=True, return_inverse=True)
        start, length = self._learn(data, keys, first[at] - (kind[at] == 1), after[at], kind[at] == 2)
        count = length[back]
        upto = np.cumsum(count)
        pick = np.repeat(start[back] - (upto - count), count) + np.arange(upto[-1])
        all_ids = self._pool[pick]
        cuts = np.append(0, upto)[np.searchsorted(first, ends)]
        lo = 0
        for i, hi in zip(group, cuts.tolist()):
            out[i] = all_ids[lo:hi]
            lo = hi

    def _learn(self, data: bytes, keys, head, after, fed) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each distinct word lie in the pool, encoding those not yet known."""
        if len(self._known.keys) + len(self._new.keys) > _MEMORY:
            self._forget()
        start, length, known = self._known.find(keys)
        late = ~known
        start[late], length[late], known[late] = self._new.find(keys[late])
        new = np.flatnonzero(~known)
        if len(new):
            joined = b"\n" + b"\n".join([data[a:b] for a, b in zip(head[new].tolist(), after[new].tolist())])
            ids = np.array(self._coder.encode_ordinary(joined.decode("utf-8", "surrogatepass")), dtype=np.uint32)
            mark = np.flatnonzero(ids == self._feed)  # one before each word
            own = mark + 1 - fed[new]
            start[new], length[new] = own + self._filled, np.append(mark[1:], len(ids)) - own
            self._store(ids)
            self._new.add(keys[new], start[new], length[new])
            if len(self._new.keys) > max(1 << 14, len(self._known.keys) // 4):
                self._known.add(self._new.keys, self._new.start, self._new.length)
                self._new = _Words()
        return start, length

    def _store(self, ids: np.ndarray) -> None:
        need = self._filled + len(ids)
        if need > len(self._pool):
            room = np.empty(max(need, 2 * len(self._pool)), dtype=np.uint32)
            room[:self._filled] = self._pool[:self._filled]
            self._pool = room
        self._pool[self._filled:need] = ids
        self._filled = need


class _Words:
    """Sorted word hashes with the place and number of their ids in the pool."""

    def __init__(self):
        self.keys = np.empty(0, dtype=np.uint64)
        self.start = np.empty(0, dtype=np.int64)
        self.length = np.empty(0, dtype=np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        start, length = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        start[known], length[known] = self.start[at[known]], self.length[at[known]]
        return start, length, known

    def add(self, keys: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        """Merge sorted new words in; the caller gathers them first, so the large arrays are copied seldom."""
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.start = np.insert(self.start, at, start)
        self.length = np.insert(self.length, at, length.astype(np.int32))


def encoder(ranks_path: str, reserved: tuple[tuple[str, int], ...] = ()) -> Encoder:
    """One encoder per worker process, vocabulary file and set of reserved strings."""
    if (ranks_path, reserved) not in _LOADED:
        _LOADED[ranks_path, reserved] = Encoder(ranks_path, reserved)
    return _LOADED[ranks_path, reserved]
