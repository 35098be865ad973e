"""Order MinHash against a plain version, and what the fingerprint is sensitive to."""
import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from plover.llm import order_minhash as O

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t", "a", "A b", "x " * 3000, "é ü\x0bß", "same text here now", "same  text here\tnow", "\x00 ~", "a" * 70000]


def plain(text, k=O.K, least=O.TUPLE):
    w = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in re.findall("[^\x20\x09-\x0D]+", text or "")]
    seen, ranks = collections.Counter(), []
    for i in range(max(len(w) - k, 0) + 1 if w else 0):
        mer = sum(x * f for x, f in zip(w[i:i + k], O._WORD)) % O.PRIME
        ranks.append(((mer * O._RANK + seen[mer] * O._NTH) % O.PRIME, i))
        seen[mer] += 1
    sections = collections.defaultdict(list)
    for r in sorted(ranks):
        sections[r[0] >> 25].append(r)
    out = []
    for s, items in sorted(sections.items()):
        chosen = sorted(items[:least], key=lambda r: r[1])
        out.append("%02X%08X" % (s, sum(r * f % O.PRIME for (r, _), f in zip(chosen, O._ORDER)) % O.PRIME))
    return ",".join(out)


def alike(x, y):
    a, b = (set(filter(None, f.split(","))) for f in (x, y))
    either = {e[:2] for e in a | b}
    return len(a & b) / len(either) if either else 1.0


def rows_of(spark, pairs):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], DOCS)


@pytest.mark.parametrize("k,least", [(3, 2), (1, 1), (2, 4)])
def test_fingerprint_equals_plain_version(spark, k, least):
    rng = random.Random(k)
    texts = [t or "" for t in ODD] + [" ".join(rng.choices("ab cd ef the of in".split(), k=rng.randrange(1, 400))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.fp for r in O.with_fingerprint(df, "t", "fp", k, least).collect()}
    assert got == {i: plain(t, k, least) for i, t in enumerate(texts)}


def test_query_columns_against_plain_version(spark):
    rng = random.Random(4)
    texts = ODD + [" ".join(rng.choices("ab cd ef the of in".split(), k=rng.randrange(1, 90))) for _ in range(30)] + ["same text here now"]
    pairs = [(None if i == 3 else 7 * i % 97, t) for i, t in enumerate(texts)] + [(0, None)]  # one row stands twice
    order = sorted({(i, t or "") for i, t in pairs}, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    want = {}
    for at, (i, t) in enumerate(order):
        after = order[(at + 1) % len(order)][1]
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        fp, other = plain(t), plain(edited)
        want[i, t] = (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fp, other, alike(fp, other), alike(fp, plain(after)))
    docs = rows_of(spark, pairs).withColumn("hash", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("fingerprint_a", F.lit(2))
    got = [tuple(r) for r in O.fingerprints(docs).collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted([want[i, t or ""] for i, t in pairs], key=key)


def test_lone_document_and_empty_table(spark):
    got = O.fingerprints(rows_of(spark, [(5, "a b c d")])).collect()
    assert len(got) == 1 and got[0].near_next == 1.0
    assert O.fingerprints(rows_of(spark, [])).count() == 0


def test_order_counts_beside_content(spark):
    rng = random.Random(2)
    w = [f"w{i}" for i in range(2000)]
    some = list(w)
    for _ in range(40):
        some[rng.randrange(2000)] = "new"
    shuffled = [w[i:i + 4] for i in range(0, 2000, 4)]
    rng.shuffle(shuffled)
    variants = [w, some, w[1000:] + w[:1000], sum(shuffled, []), [f"v{i}" for i in range(2000)], w[::-1]]
    df = spark.createDataFrame([(i, " ".join(v)) for i, v in enumerate(variants)], "i int, t string")
    fp = {r.i: r.fp for r in O.with_fingerprint(df, "t", "fp", k=1).collect()}
    like = [alike(fp[0], fp[i]) for i in range(6)]
    assert like[0] == 1.0 and like[1] > 0.85 and like[4] == 0.0
    # The same words in another order: every selected pair whose order changed is lost.
    assert 0.3 < like[2] < 0.75 and 0.3 < like[3] < 0.75 and like[5] < 0.1
