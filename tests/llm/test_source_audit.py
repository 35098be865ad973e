"""Source divergence audit against plain counting."""
import collections
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plover.llm import source_audit as S

DOCS = "doc_id long, text string, lang string, source string"


def plain_terms(text):
    return re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, least, top):
    rows = [(l or "", s or "", plain_terms(t)) for _, t, l, s in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        df = collections.Counter(t for _, _, terms in mine for t in set(terms))
        kept = [t for t in df if df[t] >= least]
        counts = {s: collections.Counter(t for _, x, terms in mine if x == s for t in terms if df[t] >= least) for _, s, _ in mine}
        whole = sum(counts.values(), collections.Counter())
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        q, ps = p(whole), {s: p(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(o, sum(abs(ps[s][t] - ps[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, ps[s][t] - q[t]) for t in kept if counts[s][t] and ps[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def fixture():
    rng = random.Random(6)
    words = ["The", "of", "élan", "ÉLAN", "x1y", "don't", "日本", "zZ", "[a]", "_b", "\x7fc"] + [f"w{chr(97 + i)}" for i in range(12)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s10", None, "é"])) for i in range(300)]
    rows += [(1, None, None, None), (1, "", "xx", "only"), (None, "the the", "en", "s1"), (7, "of " * 4000, "en", "s2"), (7, "of " * 4000, "en", "s2"),
             (8, "123 !", "yy", "a"), (9, "b", "yy", "b")]
    return rows


@pytest.mark.parametrize("least,top", [(30, 50), (1, 3), (2000, 5)])
def test_audit_against_plain_counting(spark, least, top):
    docs = spark.createDataFrame(fixture(), DOCS).withColumn("term", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("base", F.lit(1))
    got = S.audit(docs, least_docs=least, top=top).collect()
    assert sorted(map(tuple, got)) == plain(fixture(), least, top)
    assert S.audit(docs.limit(0)).count() == 0


def test_many_small_blocks_and_batches_give_the_same(spark, monkeypatch):
    """Blocks of a few words each, postings of a term spread over many of them and over small Arrow batches."""
    docs = spark.createDataFrame(fixture(), DOCS).select("lang", "source", "text").fillna("")
    rows = [tuple(r) for r in docs.collect()]
    monkeypatch.setattr(S, "BLOCK_BYTES", 50)
    blocks = [S._block([l], [s], [t]) for l, s, t in rows if plain_terms(t)]
    merged = collections.Counter()
    for b in blocks:
        for r in b.to_pylist():
            merged[r["lang"], r["term"], r["source"]] += r["n"]
    want = collections.Counter((l, t, s) for l, s, text in rows for t in plain_terms(text))
    assert merged == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = S.frequencies(S.block_runs(docs.repartition(3)), 1).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.lang, r.term, r.source): r.n for r in got} == dict(want)
    whole = collections.Counter()
    for (l, t, _), n in want.items():
        whole[l, t] += n
    assert all(r.whole == whole[r.lang, r.term] for r in got)


def test_shares_pass_64_bits(spark):
    big = 10**14
    df = spark.range(1).select(S.share(F.lit(big), F.lit(3 * big), F.lit(7)).alias("p"))
    assert df.first().p == 1 + 10**9 * (big + 5) // (3 * big + 35)


def test_block_is_sorted():
    b = S._block(["b", "a", "a"], ["s", "t", "s"], ["z y z", "y", "y é"])
    assert b.to_pylist() == [dict(lang="a", term="y", source="s", n=1, d=1), dict(lang="a", term="y", source="t", n=1, d=1),
                             dict(lang="a", term="é", source="s", n=1, d=1), dict(lang="b", term="y", source="s", n=1, d=1),
                             dict(lang="b", term="z", source="s", n=2, d=1)]
    assert S._block(["a"], ["s"], ["12 !"]) is None and isinstance(S.terms_of(["", "a"])[0], pa.DictionaryArray)
