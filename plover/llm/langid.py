"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton holds every substring of a sample of its
labelled text. A text is cut greedily into the longest phrases the automaton
knows; the fewer phrases, each charged the bits that point into the sample, the
closer the language. Texts are parsed in lanes of a fixed number of bytes, all
lanes of a batch and all languages in step.
"""
from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import DOUBLE, STRING, arrow_batch, release_memory, texts_of

#: Bounds of the labelled sample: documents per language, characters of each from one place.
PER_LANGUAGE, PASSAGE = 128, 480
LANE = 256
_BATCH = 4 << 20


@dataclass(frozen=True)
class LanguageModel:
    samples: tuple[tuple[str, tuple[str, ...]], ...]  # language, passages; sorted by language


def has_letter(text: str) -> bool:
    """Whether a character of category L (a letter; digits and numbers of any kind are none) occurs."""
    return any(unicodedata.category(c)[0] == "L" for c in text)


def _folded(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def suffix_automaton(parts: list[bytes]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of ``parts`` (state 0: the empty string)."""
    step: list[dict[int, int]] = [{}]
    link, depth = [-1], [0]
    for part in parts:
        last = 0
        for c in part:
            q = step[last].get(c)
            if q is not None and depth[q] == depth[last] + 1:
                last = q
                continue
            at, new = last, -1
            if q is None:
                new = len(step)
                step.append({})
                link.append(0)
                depth.append(depth[last] + 1)
                while at >= 0 and c not in step[at]:
                    step[at][c] = new
                    at = link[at]
                q = step[at][c] if at >= 0 else None
            if q is None:
                last = new
                continue
            if depth[q] != depth[at] + 1:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                depth.append(depth[at] + 1)
                link[q] = copy
                while at >= 0 and step[at].get(c) == q:
                    step[at][c] = copy
                    at = link[at]
                q = copy
            if new >= 0:
                link[new] = q
                last = new
            else:
                last = q
    return step


@dataclass(frozen=True)
class Automaton:
    """Transitions of one language's automaton, three numbers each: state, byte, next state."""

    lang: str
    states: int
    edges: np.ndarray
    bits: float  # what a pointer into the sample costs


def automata(model: LanguageModel) -> tuple[Automaton, ...]:
    """The automata of a model, built once on the driver from its bounded sample."""
    out = []
    for lang, passages in model.samples:
        parts = [_folded(p) for p in passages]
        step = suffix_automaton(parts)
        edges = np.array([(q, c, to) for q, s in enumerate(step) for c, to in s.items()], dtype=np.int32).reshape(-1, 3)
        out.append(Automaton(lang, len(step), edges, math.log2(2 + sum(map(len, parts)))))
    return tuple(out)


class Parser:
    """Dense parse tables: next state, with the top bit where a phrase ends.

    Tables take about 20 MB a language. A task makes its own from the few
    transitions that it is sent and drops them with its last batch, so a reused
    Python worker keeps nothing for the stages that follow.
    """

    END = np.uint32(1 << 31)

    def __init__(self, languages: tuple[Automaton, ...]):
        self.langs = [a.lang for a in languages]
        seen = sorted({int(c) for a in languages for c in np.unique(a.edges[:, 1])})
        self.width = len(seen) + 2  # bytes met in training, any other byte, padding
        self.pad = self.width - 1
        self.classes = np.full(256, self.width - 2, dtype=np.uint8 if self.width < 256 else np.uint16)
        self.classes[seen] = np.arange(len(seen))
        self.tables, self.bits = [], [a.bits for a in languages]
        for a in languages:
            state, column, to = a.edges[:, 0], self.classes[a.edges[:, 1]], a.edges[:, 2].astype(np.uint32)
            alone = a.states  # the state after a byte that this language never showed: a phrase by itself
            begin = np.full(self.width, alone, dtype=np.uint32)
            begin[column[state == 0]] = to[state == 0]
            table = np.repeat((begin | self.END)[None, :], a.states + 1, axis=0)
            table[0] = begin  # no phrase comes before the first
            table[state, column] = to
            table[:, self.pad] = np.arange(a.states + 1)
            self.tables.append(table.ravel())

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """[language, text] number of phrases, summed over the lanes of a text."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        lanes = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(texts)), lanes)
        data = self.classes[np.frombuffer(b"".join(texts), dtype=np.uint8)]
        begin = np.repeat(np.cumsum(sizes) - sizes, lanes) + LANE * (np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        end = np.repeat(np.cumsum(sizes), lanes)
        board = np.full((LANE, len(owner)), self.pad, dtype=data.dtype)
        for k in range(LANE):
            inside = begin + k < end
            board[k, inside] = data[begin[inside] + k]
        out = np.zeros((len(self.langs), len(texts)), dtype=np.int64)
        for which, table in enumerate(self.tables):
            state = np.zeros(len(owner), dtype=np.uint32)
            ended = np.ones(len(owner), dtype=np.uint32)  # the last phrase of a lane
            for k in range(LANE):
                step = table[state * np.uint32(self.width) + board[k]]
                ended += step >> np.uint32(31)
                state = step & np.uint32((1 << 31) - 1)
            out[which] = np.bincount(owner, weights=ended, minlength=len(texts)).astype(np.int64)
        return out


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  seed: int = 3) -> LanguageModel:
    """Automaton samples from labelled rows (the caller leaves out held-out rows).

    Per language the PER_LANGUAGE documents with the smallest seeded hash of
    their id give one passage each. Rows with null language, id or text, or
    text without a letter, are not sampled. No labelled row: an empty model.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(lang_col).cast("string").alias("l"),
                       F.col(text_col).cast("string").alias("t"))
    rows = rows.filter("i is not null and l is not null and t is not null").filter(F.col("t").rlike("\\p{L}"))
    room = F.greatest(F.length("t") - PASSAGE, F.lit(0))
    at = (F.pmod(F.xxhash64(F.lit(seed), "i"), room + 1) + 1).cast("int")
    near = rows.select("l", "i", F.xxhash64(F.lit(seed + 1), "i").alias("h"), F.substring(F.col("t"), at, F.lit(PASSAGE)).alias("p"))
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h", "i", "p"))  # limited before the shuffle
    got = near.withColumn("r", rank).filter(F.col("r") <= PER_LANGUAGE).orderBy("l", "r").collect()
    by: dict[str, list[str]] = {}
    for r in got:
        by.setdefault(r["l"], []).append(r["p"])
    return LanguageModel(tuple(sorted((k, tuple(v)) for k, v in by.items())))


def predict(texts: list[str | None], parser: Parser | None) -> tuple[list[str], list[float]]:
    """Language and score per text; 'und' and 0.0 for null texts, texts without a letter, or no parser."""
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    if parser is None:
        return langs, scores
    group: list[int] = []
    held = 0

    def flush() -> None:
        if not group:
            return
        cost = parser.phrases([_folded(texts[i]) for i in group]) * np.array(parser.bits)[:, None]
        order = np.argsort(cost, axis=0, kind="stable")  # ties: the first language by name
        for k, i in enumerate(group):
            best = cost[order[0, k], k]
            langs[i] = parser.langs[order[0, k]]
            scores[i] = float(1 - best / cost[order[1, k], k]) if len(parser.langs) > 1 else 1.0
        group.clear()

    for i, t in enumerate(texts):
        if t is None or not has_letter(t):
            continue
        group.append(i)
        held += len(t)
        if held >= _BATCH:
            flush()
            held = 0
    flush()
    return langs, scores


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``, from the whole text.

    ``score`` is the relative lead over the second language (0 to 1). Null and
    repeated ids pass through; other columns are ignored; empty table: empty.
    """
    languages = automata(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(languages) if languages else None
        for f in batches:
            langs, scores = predict(f["t"].to_pylist(), parser)
            yield arrow_batch({"doc_id": f["doc_id"], "lang_pred": langs, "score": scores},
                              {"lang_pred": STRING, "score": DOUBLE})
        del parser
        release_memory()

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with an identified language, all columns unchanged.

    Null texts, empty texts and texts without a letter go. Without any labelled
    row there is nothing to tell languages by, and every row with a letter stays.
    """
    languages = automata(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(languages) if languages else None
        for f in batches:
            texts = [None if x is None else str(x) for x in f.column(at).to_pylist()]
            keep = ([x != "und" for x in predict(texts, parser)[0]] if parser else [t is not None and has_letter(t) for t in texts])
            yield f.filter(pa.array(keep, type=pa.bool_()))
        del parser
        release_memory()

    return docs.mapInArrow(run, docs.schema)
