"""Training-data operators against brute force on small fixtures and edge cases."""
import collections
import hashlib
import itertools
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plover.llm import chat, embedding_dedup, exact_dedup, langid, minhash, mixing, packing, pii, quality, sharding, tokens
from plover.llm.common import documents, shingle_sets, ship_package, word_hashes
from plover.llm.components import connected_components

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def docs_of(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "src1", None) for i, t in zip(ids, texts)], DOCS)


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k=4):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def reach(nodes, links):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


ODD = [None, "", " \n\t", "a", "A b", "x " * 3000, "é ü\x0bß", "same text here now", "same  text here\tnow", "<|im_end|>", "a" * 70000]


def test_shingles_match_words():
    texts = ODD + ["The quick brown fox jumps over the lazy dog"]
    for t, s in zip(texts, shingle_sets(texts, 4)):
        assert len(s) == len(shingles(t))
    first, after, _ = word_hashes(b"  ab c\x0b\td ")
    assert list(zip(first, after)) == [(2, 4), (5, 6), (8, 9)]


def test_components_chain_star_and_empty(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(200)] + [(500, k) for k in range(501, 620)] + [(900, 900), (7, None)]
    rng.shuffle(links)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{k: 500 for k in range(500, 620)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_groups_edges(spark):
    rows = docs_of(spark, ODD + ["same text here now", "sametexthere n  ow  "], [None] + list(range(1, len(ODD))) + [7, 90])
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(rows).collect()}
    assert (1, 2, 3, False) in got and (2, 2, 3, True) in got and (None, 2, 3, False) in got
    assert (7, 90, 4, False) in got and (90, 90, 4, True) in got
    assert sorted((r.doc_id or -1) for r in exact_dedup.drop_copies(rows).collect()) == [2, 3, 4, 5, 6, 9, 10, 90]
    assert exact_dedup.drop_copies(rows).columns == rows.columns
    assert exact_dedup.exact_groups(rows.limit(0)).count() == 0


def test_exact_groups_survive_hash_collisions(spark):
    rows = docs_of(spark, ["a b", "ab", "c", "cc", "c "])
    weak = exact_dedup.exact_groups(rows, content_hash=lambda n: F.lit("same"))
    assert sorted(weak.collect()) == sorted(exact_dedup.exact_groups(rows).collect())


@pytest.mark.parametrize("size", [4, 5])
def test_near_groups_against_brute_force(spark, size):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choices(vocab, k=60) for _ in range(6)]
    texts = list(ODD)
    for b in base:
        for _ in range(40):
            w = list(b)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w).upper() if rng.random() < 0.3 else " ".join(w))
    sets = [shingles(t, size) for t in texts]
    links = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = reach(range(len(texts)), links)
    rows = docs_of(spark, texts).withColumn("set_key", F.lit("clash")).withColumn("sig", F.lit(1))
    got = minhash.near_groups(rows, size=size).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in got)
    stay = minhash.drop_near_copies(rows, size=size)
    assert stay.columns == rows.columns and sorted(r.doc_id for r in stay.collect()) == sorted(i for i in want if want[i] == i)


def test_near_groups_empty_and_null_ids(spark):
    assert minhash.near_groups(docs_of(spark, [])).count() == 0
    got = minhash.near_groups(docs_of(spark, ["a b c d e", "a b c d e", None], [None, 4, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (-1, 4, False), (4, 4, True)]


def test_circulant_signature_estimates_jaccard():
    a, b = shingle_sets([" ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(100, 500))], 4)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    est = (minhash.signature(a, 1024) == minhash.signature(b, 1024)).mean()
    assert abs(est - true) < 0.06


@pytest.fixture(scope="module")
def vocabulary_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_batch_encoder_equals_tokenizer(spark, vocabulary_tokenizer):
    texts = [r.text for r in documents(spark, SF_SMALL).select("text").collect()]
    texts += ["", " a", "a ", "\n a", "a\n b", "a  b", "\xa0 x", "don't 'll\n's", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "日本 語\t1", "\x1c a", "x\ny z"]
    coder = tokens.Encoder(tokens.vocabulary(), tokens.RESERVED)
    assert [i.tolist() for i in coder.batch(texts)] == [vocabulary_tokenizer(t or "") for t in texts]
    plain = tokens.Encoder(tokens.vocabulary())
    assert plain.text(plain.ids("<|endoftext|>")) == "<|endoftext|>" and 50256 not in plain.ids("<|endoftext|>")


def test_encoder_knows_words_of_many_batches(vocabulary_tokenizer):
    rng = random.Random(8)
    coder = tokens.Encoder(tokens.vocabulary())
    for _ in range(12):
        texts = [" ".join("".join(rng.choices("abcdéz", k=rng.randrange(1, 9))) for _ in range(3000)) for _ in range(4)]
        assert [i.tolist() for i in coder.batch(texts)] == [vocabulary_tokenizer(t) for t in texts]
    assert len(coder._known.keys) and len(np.unique(coder._known.keys)) == len(coder._known.keys)
    coder.release()
    assert not len(coder._known.keys)


def test_packing_round_trip(spark, vocabulary_tokenizer):
    texts = [t for t in ODD if t is None or len(t) < 10000] + [r.text for r in documents(spark, SF_SMALL).limit(60).collect()]
    rows = docs_of(spark, texts, [None] + list(range(1, len(texts))))
    packed = packing.pack_pieces(packing.tokenize_pieces(rows), 2).collect()
    ids = collections.defaultdict(list)
    for r in sorted(packed, key=lambda r: (r.doc_id or 0, r.piece)):
        assert r.start == len(ids[r.doc_id]) and r.length == len(r.ids) // 4 and r.length <= 1024
        assert r.piece == 0 or r.length == 1024
        ids[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    assert all(ids[i if i else None] == vocabulary_tokenizer(t or "") + [2] for i, t in enumerate(texts))
    bins = collections.defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for off, n in sorted(b):
            assert off == at
            at += n
        assert at <= 1024
    assert packing.pack_pieces(packing.tokenize_pieces(rows.limit(0)), 1).count() == 0
    clash = packing.tokenize_pieces(rows).withColumn("_group", F.lit("x")).withColumn("offset", F.lit("y")).withColumn("sequence_id", F.lit(1))
    again = packing.pack_pieces(clash, 2)
    assert again.columns.count("offset") == 1 and {r._group for r in again.collect()} == {"x"}
    assert {(r.doc_id, r.piece, r.offset) for r in again.collect()} == {(r.doc_id, r.piece, r.offset) for r in packed}


def test_swap_search_empties_bins():
    rng = random.Random(3)
    sizes = [rng.randrange(1, 101) for _ in range(300)]
    poor, at, room = [[]], 0, 100  # next-fit
    for i, s in enumerate(sizes):
        if s > room:
            poor.append([])
            room = 100
        poor[-1].append(i)
        room -= s
    square = lambda bins: sum(sum(sizes[i] for i in b) ** 2 for b in bins)
    before, n = square(poor), len(poor)
    better = packing.swap_search([list(b) for b in poor], sizes, 100)
    assert len(better) < n and square(better) > before
    assert sorted(i for b in better for i in b) == list(range(300)) and all(sum(sizes[i] for i in b) <= 100 for b in better)
    # one for one: 60+30 and 50+40 with room for 10 more; two for one: 70 out, 30+30 back
    assert len(packing.swap_search([[0], [1, 2]], [40, 60, 30], 100)) == 2
    assert packing.swap_search([], [], 100) == []


def test_chat_round_trip_and_escapes(spark):
    for t in ["", "<|im_end|>", "<\\|x", "<\\\\|im_start|>", "a<", "|>", "<<||"]:
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)
        assert chat.unescape_role(chat.escape_role(t + "\n\\n")) == t + "\n\\n"
    rows = [(1, 2, "assistant", "two <|im_end|>\n<|im_start|>"), (1, 0, "user", None), (1, 1, "assistant", "é  one"), (None, 0, None, "x"),
            (2, 0, "sys\ntem", "  "), (2, 0, "sys\ntem", "  "), (1 << 60, 0, "assistant", "big id")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit("clash"))
    formatted = chat.format_chat(table).cache()
    for r in formatted.collect():
        mask = np.frombuffer(r.loss_mask, np.int8)
        assert set(mask) <= {0, 1} and len(mask) == len(r.ids) // 4
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    want = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1])):
        want[c].append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        under = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(under), hashlib.sha256(under.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(f"<|im_start|>{chat.escape_role(r)}\n{chat.escape(x)}<|im_end|>\n") for r, x in turns)
    assert chat.read_back(chat.format_chat(table.limit(0))).count() == 0


def cross_phrases(text: bytes, sample: list) -> int:
    n = 0
    for lo in range(0, len(text), langid.LANE):
        part, at = text[lo:lo + langid.LANE], 0
        while at < len(part):
            end = at + 1
            while end < len(part) and any(part[at:end + 1] in s for s in sample):
                end += 1
            at, n = end, n + 1
    return n


def test_cross_parsing_counts_longest_phrases(spark):
    model = langid.LanguageModel((("a", ("the cat sat on the mat", "abcabx")), ("b", ("der hund und die katze",))))
    texts = ["The cat and the dog", "hund katze mat", "zzz 1", "x" * 600 + "the cat", "é"]
    got = langid.Parser(langid.automata(model)).phrases([langid._folded(t) for t in texts])
    for k, (_, passages) in enumerate(model.samples):
        assert got[k].tolist() == [cross_phrases(langid._folded(t), [p.encode() for p in passages]) for t in texts]
    rows = docs_of(spark, [None, "", "123 !", "the cat sat", "der hund", "² ½ Ⅷ ٣", "_"], [None, 1, 2, 3, 4, 5, 6]).withColumn("score", F.lit("clash"))
    out = {r.doc_id: (r.lang_pred, 0 <= r.score <= 1) for r in langid.identify(rows, model).collect()}
    assert out == {None: ("und", True), 1: ("und", True), 2: ("und", True), 3: ("a", True), 4: ("b", True), 5: ("und", True), 6: ("und", True)}
    assert sorted(r.doc_id for r in langid.keep_identified(rows, model).collect()) == [3, 4]
    empty = langid.fit_languages(rows.limit(0))
    assert empty.samples == () and langid.identify(rows, empty).filter("lang_pred <> 'und'").count() == 0
    # Nothing to tell languages by: whatever has a letter stays.
    assert sorted(r.doc_id for r in langid.keep_identified(rows, empty).collect()) == [3, 4]


def test_language_and_quality_held_out(spark):
    from plover.llm.queries import QUERIES
    truth = {r.doc_id: r.lang for r in documents(spark, SF_MID).select("doc_id", "lang").collect()}
    got = [r for r in QUERIES["op7_langid_cross_parsing"](spark, SF_MID).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert sum(held) / len(held) > 0.95
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    scored = QUERIES["op1_quality_compression"](spark, SF_MID).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in scored)
    held = [(r.score, marks[r.doc_id]) for r in scored if r.held_out and r.doc_id in marks]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.9


def test_quality_edges(spark):
    rows = docs_of(spark, ODD, [None] + list(range(1, len(ODD))))
    none = quality.fit_quality(rows, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r.score for r in quality.score_quality(rows, none).collect()] == [0.5] * len(ODD)
    one = quality.fit_quality(rows, spark.createDataFrame([(1, 1), (2, 1), (3, None)], "doc_id long, quality int"))
    assert all(r.score > 0.5 for r in quality.score_quality(rows, one).collect())
    assert quality.score_quality(rows.limit(0), one).count() == 0


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    rows = []
    for i in range(300):
        v = base[i % 30] + rng.standard_normal(16) * rng.choice([0.05, 0.2, 0.3])
        rows.append((i, v.tolist(), int(i % 2) if i % 11 else None))
    rows += [(300, rows[1][1], 1), (301, [0.0] * 16, 1), (302, None, 1), (303, [float("nan")] * 16, 1), (304, [None] * 16, 1),
             (305, [1.0], 1), (306, [2.0], 1), (307, [], 0), (308, [x * 1e200 for x in rows[1][1]], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit("clash"))
    unit = {}
    for i, v, lab in rows:
        if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v) / np.abs(v).max()
            unit[i] = (lab, a / np.linalg.norm(a))
    links = [(a, b) for a, b in itertools.combinations(unit, 2)
             if unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.93]
    want = reach([r[0] for r in rows], links)
    n = collections.Counter(x for pair in links for x in pair)
    got = embedding_dedup.near_vectors(table).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (n[i], want[i], want[i] == i) for i in want}
    assert embedding_dedup.near_vectors(table.limit(0)).count() == 0


def test_binary_code_estimate_is_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((400, 64))
    b = a + rng.standard_normal((400, 64)) * 0.4
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    codes, factor, _ = embedding_dedup.encode(b)
    est, width = embedding_dedup.estimate(a @ embedding_dedup.rotations(64, 768)[:, :64], codes, factor)
    true = a @ b.T
    assert abs((est - true).mean()) < 0.005 and (np.abs(est - true) <= width).mean() > 0.998


def test_hilbert_curve_and_shards(spark):
    pts = sorted(itertools.product(range(8), repeat=3), key=lambda p: sharding.hilbert_index(list(p), 3))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(pts, pts[1:]))
    cells = spark.createDataFrame(pts, "x int, y int, z int")
    got = cells.select("x", "y", "z", sharding.hilbert_column([F.col("x"), F.col("y"), F.col("z")], 3).alias("h")).collect()
    assert all(r.h == sharding.hilbert_index([r.x, r.y, r.z], 3) for r in got)
    rows = documents(spark, SF_SMALL).select("doc_id", "text", "lang", "source").union(
        spark.createDataFrame([(None, None, None, None), (5, "", "en", None), (5, "", "en", None)], "doc_id long, text string, lang string, source string"))
    out = sharding.hilbert_shards(rows.withColumn("n", F.lit("clash")).withColumn("salt", F.lit(0))).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    sizes = [len(by[s]) for s in range(16)]
    assert sum(sizes) == rows.count() and max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in b) == list(range(len(b))) for b in by.values())
    assert all(max(r.curve for r in by[s]) <= min(r.curve for r in by[s + 1]) for s in range(15))
    texts = {r.doc_id: r.text or "" for r in rows.collect() if r.doc_id != 5}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in out if r.doc_id != 5)
    assert sharding.hilbert_shards(rows.limit(0)).count() == 0
    assert sorted((r.shard, r.slot) for r in sharding.hilbert_shards(rows.limit(3)).collect()) == [(5, 0), (10, 0), (15, 0)]


def test_mix_redistributes_among_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 50), ("b", "x", "s4", 30)],
                                   "domain string, lang string, source string, supply long")
    plan = lambda total, **k: {r.source: r.budget for r in mixing.budgets(leaves, F.lit(total), weights={}, **{"max_epochs": 1, **k}).collect()}
    assert plan(40) == {"s1": 5, "s2": 5, "s3": 10, "s4": 20}
    assert plan(60) == {"s1": 8, "s2": 7, "s3": 15, "s4": 30} or sum(plan(60).values()) == 60
    assert plan(200) == {"s1": 10, "s2": 110, "s3": 50, "s4": 30}  # s1's and y's shortage stays in a; b is used up
    assert plan(5000) == {"s1": 10, "s2": 1000, "s3": 50, "s4": 30}
    assert plan(400, max_epochs=4)["s4"] == 120


def test_mix_edges(spark):
    rows = docs_of(spark, ODD, [None] + list(range(1, len(ODD)))).withColumn("tokens", F.lit("clash"))
    got = mixing.mix(rows, share_percent=100).collect()
    assert len(got) == len(ODD) and all(r.copies == 1 for r in got)
    assert all(r.copies in (2, 3) for r in mixing.mix(rows, share_percent=250, max_epochs=3).collect() if r.tokens)
    assert mixing.mix(rows.limit(0)).count() == 0
    assert mixing.take_mix(rows).columns == rows.columns
    assert mixing.take_mix(rows.limit(0)).count() == 0


def test_mix_repeats_what_is_short_of_its_weight(spark):
    # d0 (weight 3) holds a tenth of the words: it is repeated, and the rest of its share goes to the others.
    rows = [(i, "a b c d", "en", "src4" if i < 10 else "src3", None) for i in range(100)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs).collect()
    assert sum(r.tokens * r.copies for r in got) == 400
    assert {r.copies for r in got if r.source == "src4"} == {4} and sum(r.copies for r in got if r.source == "src3") == 60
    out = mixing.take_mix(docs.withColumn("_keep", F.lit(1)).withColumn("_times", F.lit(2)))
    assert out.count() == 100 and {r["count"] for r in out.filter("source = 'src4'").groupBy("doc_id").count().collect()} == {4}
    assert {r.domain: round(r.share, 2) for r in mixing.shares(mixing.mix(docs)).collect()} == {"d0": 0.4, "d3": 0.6}


def test_dropping_operators_take_any_column_names(spark):
    names = ("_keep", "_digest", "_digest_own", "_group", "t", "rep", "node", "component", "KEEP")
    rows = docs_of(spark, ["a b c d e f", "a b c d e f", "a b  c d e f", None, ""])
    for k, name in enumerate(names):
        rows = rows.withColumn(name, F.lit(f"own{k}"))
    for drop, want in ((exact_dedup.drop_copies, [2, 3]), (minhash.drop_near_copies, [0, 3, 4]), (mixing.take_mix, [0, 1, 2, 3, 4])):
        out = drop(rows)
        assert out.columns == rows.columns, drop
        got = out.collect()
        assert sorted({r.doc_id for r in got}) == want, drop
        assert all([r[n] for n in names] == [f"own{k}" for k in range(len(names))] for r in got), drop


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def brute_spans(t):
    pats = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for k, (kind, p) in enumerate(pats.items()):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_pattern_spans_equal_plain_patterns():
    rng = random.Random(9)
    alphabet = ["a", "b", "@", ".", "-", "1", "2", "4", "0", " ", "+", "(", ")", "%", "é", "12", "255", "x@y.z", "4434884578412152", "+1 (366) 555-9807"]
    for _ in range(4000):
        t = "".join(rng.choices(alphabet, k=rng.randrange(0, 30)))
        assert pii.base_spans(t) == brute_spans(t), t
    assert pii.base_spans("a" * 200_000 + "1" * 2000) == [] and pii.base_spans("") == []


def test_disclosing_words(spark):
    said = [f"note{i} from kestrel{i} the zanzibar desk mail jo@ex.com about the zanzibar plan {i}" for i in range(5)]
    plain = [f"the plan number {i} about a desk and mail from note" for i in range(200)]
    rows = docs_of(spark, said + plain + [None, ""]).withColumn("spans", F.lit("clash"))
    got = {r.doc_id: r for r in pii.find_personal(rows).collect()}
    assert len(got) == 207 and all(not got[i].term_spans for i in range(5, 207))
    for i, t in enumerate(said):
        found = {t[s["start"]:s["end"]] for s in got[i].term_spans}
        assert found == {"kestrel", "zanzibar"} and [s["kind"] for s in got[i].spans] == ["email"]
        spans = [(s["kind"], s["start"], s["end"]) for s in got[i].spans + got[i].term_spans]
        assert "jo@ex.com" not in pii.sanitise(t, spans) and "zanzibar" not in pii.sanitise(t, spans)
    assert pii.find_personal(rows.limit(0)).count() == 0


def test_one_text_discloses_its_entity(spark):
    plain = [f"the plan number {i} about a desk and mail" for i in range(200)]
    rows = docs_of(spark, ["the plan of quetzal mail jo@ex.com about a desk"] + plain)
    got = {r.doc_id: r for r in pii.find_personal(rows).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[0].term_spans][-1] == ("removed", 12, 19)
    shares = [pii._lower_rate(F.lit(float(k)), F.lit(float(n))) for k, n in ((1, 1), (3, 3), (1, 10), (300, 300))]
    low = spark.range(1).select(*shares).first()
    assert low[0] == pytest.approx(1 / 2) and low[1] == pytest.approx(3 / 4) and low[2] < 0.05 and low[3] > 0.99


def test_copies_of_disclosing_texts_change_nothing(spark):
    said = [f"desk {i} zanzibar mail jo@ex.com about the plan" for i in range(3)]
    plain = [f"the plan number {i} about a desk and mail" for i in range(200)]
    terms = lambda texts: {t: {(s["kind"], s["start"]) for s in r.term_spans} for t, r in
                           zip(texts, sorted(pii.find_personal(docs_of(spark, texts)).collect(), key=lambda r: r.doc_id))}
    once, often = terms(said + plain), terms(said * 100 + plain + plain[:7] * 5)
    assert once == often and all(("removed", 7) in once[t] for t in said)
    got = {r.word: r.n_word for r in pii.texts_with(docs_of(spark, said * 100 + plain + [None, ""])).collect()}
    assert got["zanzibar"] == 3 and got["number"] == 200 and got["desk"] == 203


def test_terms_are_marked_wherever_they_stand(spark):
    far = "the plan about a desk and mail " * 60
    said = [f"zanzibar {i} {far} jo@ex.com {far} {'q' * 500}" for i in range(20)]
    plain = [f"the plan number {i} about a desk and mail" for i in range(300)]
    alone = "the plan of zanzibar about a desk"
    got = {r.doc_id: r for r in pii.find_personal(docs_of(spark, said + [alone] + plain)).collect()}
    for i, t in enumerate(said + [alone]):
        found = {t[s["start"]:s["end"]] for s in got[i].term_spans}
        assert found == ({"zanzibar", "q" * 500} if i < 20 else {"zanzibar"})
    assert all(not got[i].term_spans for i in range(21, 321))
    assert list(pii.words_outside("ab jo@ex.com+cd ef", [("email", 3, 12), ("ip", 10, 15)])) == [("ab", 0, 2), ("ef", 16, 18)]


def test_pipeline_against_plain_python(spark):
    import corpus_pipeline
    docs = documents(spark, SF_SMALL)
    text = {r.doc_id: r.text for r in docs.collect()}
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        frame = stage(spark, frame, SF_SMALL)
        assert frame.columns == docs.columns
    ids = sorted(i for i, t in text.items() if t and any(unicodedata.category(c).startswith("L") for c in t))
    best = {}
    for i in ids:
        key = re.sub("[\x20\x09-\x0D]+", "", text[i])
        if key not in best or len(text[i]) > len(text[best[key]]):
            best[key] = i
    ids = sorted(best.values())
    sets = {i: shingles(text[i], 5) for i in ids}
    links = [(a, b) for a, b in itertools.combinations(ids, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = reach(ids, links)
    assert sorted(r.doc_id for r in frame.collect()) == [i for i in ids if low[i] == i]
    mixed = corpus_pipeline.mix_sources(spark, frame, SF_SMALL)
    kept = {r.doc_id for r in mixed.collect()}
    taken = {r.doc_id for r in mixing.mix(frame).collect() if r.copies}
    assert mixed.count() == sum(r.copies for r in mixing.mix(frame).collect())
    assert kept == taken and {r.doc_id for r in corpus_pipeline.run(spark, SF_SMALL).collect()} == kept


def test_registered_sql(spark):
    import duckdb
    from plover.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, SF_SMALL).toPandas()
        want = con.execute(sql).fetch_df()[list(got.columns)]
        rows = lambda f: sorted(map(tuple, f.astype(str).values.tolist()))
        assert rows(got) == rows(want), name
