"""Phrase mining against plain counting."""
import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from plover.llm import collocations as C

DOCS = "doc_id long, text string, lang string"


def plain_pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in (re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0A-\x0D]", low)) if w]


def plain(rows, longest, least, percent, top):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        for w in plain_pieces(text):
            n[lang or "und" if lang is None else lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[("und" if lang is None else lang, tuple(w[i:i + size]))] += 1
    wanted = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    covered = set()
    for (lang, long), a in wanted.items():
        for size in range(2, len(long)):
            for i in range(len(long) - size + 1):
                if 100 * a >= percent * f[lang, long[i:i + size]]:
                    covered.add((lang, long[i:i + size]))
    out = collections.defaultdict(list)
    for (lang, p), a in wanted.items():
        if (lang, p) not in covered:
            score, k = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank + 1, p.decode(), -a, l, r, n[lang], -s) for lang, items in out.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(items)[:top]))


def fixture():
    rng = random.Random(11)
    words = ["The", "of", "élan", "ÉLAN", "x-1", "new", "york", "city", "a\xa0b", "_"]
    rows = []
    for i in range(120):
        parts = [rng.choice(words) if rng.random() < 0.7 else rng.choice(["new york city", "The of", "of\t the"]) for _ in range(rng.randrange(0, 60))]
        seps = [rng.choice([" ", " ", " ", "\t", ". ", "\n", ",", "  "]) for _ in parts]
        rows.append((i % 50, "".join(a + b for a, b in zip(parts, seps)), rng.choice(["en", "de", None, ""])))
    rows += [(1, None, "en"), (None, "", None), (2, ".,;", "xx"), (3, "one two", "yy"), (4, "la " * 5000, "en"), (4, "la " * 5000, "en"), (5, "a.a.a.a " * 30, "de"),
             (6, "b" * 50000, "de")]
    return rows


@pytest.mark.parametrize("longest,least,percent,top,parts", [(3, 10, 50, 2000, 1), (3, 2, 50, 7, 6), (5, 3, 80, 2000, 3), (2, 10, 50, 2000, 2), (3, 10**6, 50, 10, 1)])
def test_collocations_against_plain_counting(spark, longest, least, percent, top, parts):
    docs = spark.createDataFrame(fixture(), DOCS).withColumn("block", F.lit("clash")).withColumn("f", F.lit(1)).repartition(parts)
    got = C.collocations(docs, longest=longest, least=least, covered_percent=percent, top=top).collect()
    assert sorted(map(tuple, got)) == plain(fixture(), longest, least, percent, top)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert C.collocations(spark.createDataFrame([(1, None, None), (2, " . ", "en")], DOCS)).count() == 0


def test_scores_pass_64_bits(spark):
    a, l, r = 7 * 10**12, 9 * 10**12 + 1, 8 * 10**12 + 3
    got = spark.range(1).select(C._score(F.lit(a), F.lit(l), F.lit(r)).alias("s")).first().s
    assert got == 10**6 * a * a // (l * r)


def test_pieces_and_packed_columns():
    coded, lengths = C.cut_pieces(["A b. c", "", "d\te,,f\x0bG"])
    assert [w.decode() for w in coded.dictionary_decode().to_pylist()] == ["a", "b", "c", "d", "e", "f", "g"] and lengths.tolist() == [2, 1, 2, 1, 1]
    numbers = np.array([0, 1, 255, 256, 2**32 - 1], dtype=np.uint32)
    assert C._unpack(C._pack(numbers)).tolist() == numbers.tolist() and len(C._unpack(C._pack(numbers[:0]))) == 0
    at, left, right, number = C._joined(np.array([3, 4, -1, 3, 4, 3]), np.array([2, 4]))
    assert at.tolist() == [0, 3, 4] and left.tolist() == [3, 4] and right.tolist() == [4, 3] and number.tolist() == [0, 0, 1]
