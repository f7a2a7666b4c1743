"""The operators for training data against brute force, and on rows that are null, empty, long, tied or repeated."""

from __future__ import annotations

import cProfile
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from statledger.llm import (
    decontaminate,
    katz,
    language_id,
    licenses,
    near_duplicates,
    packing,
    quality_rules,
    range_coder,
    secret_scan,
    token_files,
    url_filter,
)
from statledger.llm.cluster import ship
from statledger.llm.vocabularies import public_path, vocabulary

IDS = public_path("word_bpe_49k.json")
PIECES = public_path("piece_bpe_32k.model")
WORDS = {
    "en": "the of and to in that with house river stone morning every light between".split(),
    "de": "der die und zu mit dass haus fluss stein morgen jeder licht zwischen über".split(),
    "fr": "le la et de avec que maison rivière pierre matin chaque lumière entre été".split(),
}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, ids string, kept string, start int"


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + str(rng.randint(0, 99)) * (rng.random() < 0.4) for _ in range(n)).capitalize() + "."


def documents():
    """Prose in three languages, copies and near copies, and the rows that break things."""
    rng = random.Random(1)
    out = [(i, prose(rng, lang, rng.randint(20, 120)), lang, f"s{i % 3}") for i, lang in enumerate(["en", "de", "fr"] * 12)]
    text = prose(rng, "en", 150)
    for i in range(12):  # a chain of edits and copies of the first
        changed = text.split()
        for _ in range(i // 2):
            changed[rng.randrange(len(changed))] = "edited"
        out.append((100 + i, " ".join(changed), "en", "s0"))
        out.append((200 + i, text, "en", "s1"))
    out += [
        (300, None, None, None), (301, "", "en", "s0"), (302, " \n\t ", "en", "s0"), (303, "12 34", None, "s0"), (304, "One", "en", None),
        (305, "One", "en", "s2"), (306, "a b c d e f g h i j k l", "en", "s0"), (None, "no id at all", "en", "s0"), (None, None, None, None),
        (307, prose(rng, "de", 30_000), "de", "s1"), (308, "Ünï \U0001d4d0 \u4e2d\u6587 ﬁ # $ | same\nsame line\nsame line\n\nsame line", "fr", "s1"),
    ]
    out += [out[0], out[0], (1, out[1][1], "xx", "s9")]  # repeated rows
    return out


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(*d, len(d[1] or ""), 0.5, 7, "x", "y", 1) for d in documents()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return ship(spark).createDataFrame([], SCHEMA)


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(pattern, lowered)


def held(doc_id, divisor):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor


# --- 1: language-model scoring


def brute_katz(rows, held_out):
    tokens = [words(r.text) + [None] for r in rows]
    train = [t for r, t in zip(rows, tokens) if not held_out(r)]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip([0, *t[:-1]], t))
    n, v = sum(one.values()), len(one)
    d1, d2 = (katz.good_turing(dict(Counter(c.values()))) for c in (one, two))
    kept = {w: float(d1(np.array([c]))[0]) for w, c in one.items()}
    unknown = 1 - sum(kept.values()) / n
    low = lambda w: kept[w] / n if w in kept else unknown
    after = Counter()
    for (u, _), c in two.items():
        after[u] += c
    share = {(u, w): float(d2(np.array([c]))[0]) / after[u] for (u, w), c in two.items()}
    mass, lower = Counter(), Counter()
    for (u, w), p in share.items():
        mass[u] += p
        lower[u] += low(w)
    weight = {u: (1 - mass[u]) / (1 - lower[u]) for u in after}
    chance = lambda u, w: share.get((u, w)) or weight.get(u, 1.0) * low(w)
    return tokens, one, n, v, chance


@pytest.mark.parametrize("block_rows,buckets", [(8192, 4), (5, 1), (16, 32)])
def test_katz_against_brute_force(docs, block_rows, buckets):
    test = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    rows = docs.select("doc_id", "text").collect()
    tokens, one, n, v, chance = brute_katz(rows, lambda r: held(r.doc_id, 5) == 1)
    want = Counter()
    for r, t in zip(rows, tokens, strict=True):
        score = sum(math.log10(chance(u, w)) for u, w in zip([0, *t[:-1]], t))
        base = sum(math.log10((one[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        want[(r.doc_id, held(r.doc_id, 5) == 1, len(t), sum(one[w] > 0 for w in t), n, round(base, 5), round(score, 5))] += 1
    got = Counter((*r[:5], round(r[5], 5), round(r[6], 5)) for r in katz.score(docs, test, block_rows, buckets).collect())
    assert got == want


def test_katz_is_normalised(docs):
    rows = docs.select("doc_id", "text").collect()
    _, one, _, _, chance = brute_katz(rows, lambda r: False)
    for context in ["the", "der", "one", 0, "never seen"]:
        assert sum(chance(context, w) for w in one) + chance(context, "unknown") == pytest.approx(1)


def test_katz_over_many_partitions_and_long_texts(spark, docs):
    rows = [(i, f"one two three {i % 7}", i % 5 == 1) for i in range(290)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    want, got = ({r.doc_id: round(r.score, 6) for r in katz.score(d, F.col("held")).collect()} for d in (df.coalesce(1), df.repartition(140)))
    assert got == want and len(want) == 290
    blocks = katz.with_blocks(katz.numbered(df.coalesce(1), F.col("held")), 100, 150).groupBy("block").agg(F.sum(F.length("text")).alias("size")).collect()
    assert len(blocks) == 29 and max(r["size"] for r in blocks) <= 165


def test_katz_without_training(docs, nothing):
    assert katz.score(nothing, F.lit(False)).count() == 0
    got = katz.score(docs, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.score) for r in got} == {(0, 0, 0.0)} and len(got) == docs.count()


# --- 2: near duplicates


def brute_components(rows, size, percent=80):
    sets = {}
    for r in rows:
        w = words(r.text)
        if w and r.doc_id is not None:
            sets[r.doc_id] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("rule", [near_duplicates.Join(), near_duplicates.Join(shingle=4), near_duplicates.Join(shingle=4, exhaustive=0, pivots=1, depth=3)])
def test_near_duplicates_against_brute_force(docs, rule):
    rows = docs.select("doc_id", "text").collect()
    component, size = brute_components(rows, rule.shingle)
    got = near_duplicates.near_duplicates(docs, rule).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (size.get(r.doc_id, 0), component.get(r.doc_id, r.doc_id))
            assert r.kept == (r.component_id == r.doc_id)


def test_large_groups_of_near_copies_are_one_component(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(80)]
    rows = []
    for i in range(150):
        text = list(base)
        text[rng.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(text) + " " + " ".join(f"t{i % 2}") * (i % 3)))
    rows += [(1000 + i, "shared passage of some ten words that many texts all have " * 2 + " ".join(f"y{rng.randrange(9999)}" for _ in range(30))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute_components(df.collect(), 5)
    got = near_duplicates.near_duplicates(df, near_duplicates.Join(exhaustive=1))
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_texts_that_met_no_other_are_not_shuffled(spark, monkeypatch):
    rows = [(i, f"w{i // 40} " + " ".join(f"t{i}-{k}" for k in range(9))) for i in range(4000)] + [(None, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = df.filter("doc_id % 50 = 0").select("doc_id")
    near = near_duplicates._may_be_in(df, wanted, "doc_id").select("doc_id").collect()
    assert {r.doc_id for r in near} >= {*range(0, 4000, 50)} and len(near) < 90
    # Fewer bits than values: others pass too, and none is lost.
    with monkeypatch.context() as m:
        m.setattr(near_duplicates, "FILTER_BITS", 64)
        near = near_duplicates._may_be_in(df, wanted, "doc_id").select("doc_id").collect()
        assert {r.doc_id for r in near} >= {*range(0, 4000, 50)}
    moved, full_sets = [], near_duplicates.full_sets

    def watched(texts, rule):
        moved.append(texts._jdf.queryExecution().optimizedPlan().toString())
        return full_sets(texts, rule)

    monkeypatch.setattr(near_duplicates, "full_sets", watched)
    text = " ".join(f"c{k}" for k in range(60))
    copies = spark.createDataFrame([*rows, (5000, text), (5001, text + " more")], df.schema)
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(copies).collect()}
    assert got[5001] == 5000 and got[0] == 0
    semi, bits = moved[0].index("LeftSemi"), moved[0].index("bitmap_construct_agg")
    assert semi < bits, "all texts are shuffled to be joined"


@pytest.mark.parametrize("rule", [near_duplicates.Join(), near_duplicates.Join(block=300)])
def test_variants_are_linked_by_their_original_only(spark, rule):
    """3,000 variants, each about 0.85 like the original and 0.72 like each other: recall of the links by brute force."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(base))]
    for i in range(1, 3001):
        text = list(base)
        for k in range(6):  # five shingles each
            text[rng.randrange(66 * k, 66 * k + 60)] = f"x{i}-{k}"
        rows.append((i, " ".join(text)))
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert all(like(0, i) >= 0.8 for i in range(1, 3001)) and sum(like(i, i + 1) < 0.8 for i in range(1, 3000)) > 2900
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), rule)
    assert {r.component_id for r in got.select("component_id").distinct().collect()} == {0}


def test_keep_one(docs, nothing):
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 100 in ids and not {200, 201, 305} & set(ids) and ids.count(0) == 1 and {300, 301, 302, None} <= set(ids)
    assert near_duplicates.keep_one(nothing).count() == 0


# --- 3: language


def test_language_of_held_out_documents(docs, nothing):
    model = language_id.train(docs.filter(F.col("lang").isin(*WORDS)))
    rng = random.Random(77)
    fresh = docs.sparkSession.createDataFrame([(i, prose(rng, lang, 12), lang) for i, lang in enumerate([*WORDS] * 20)], "doc_id long, text string, lang string")
    got = language_id.identify(fresh, model).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 58 and all(0 < r.score <= 1 for r in got)
    judged = language_id.identify(docs, model)
    assert set(judged.columns) == {*docs.columns, "lang_pred"}
    by_text = {r.text: (r.lang_pred, r.score) for r in judged.collect()}
    assert [by_text[t] for t in (None, "", " \n\t ", "12 34")] == [("und", 0.0)] * 4
    empty = language_id.train(nothing)
    assert {(r.lang_pred, r.score) for r in language_id.identify(docs, empty, keep=["doc_id"]).collect()} == {("und", 0.0)}
    assert language_id.identify(nothing, model).count() == 0


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(4000, 3))
    truth = np.array([rng.choice(3, p=p) for p in language_id.softmax(scores)])
    assert language_id.best_temperature(scores * 5, truth) == pytest.approx(5, rel=0.15)


# --- 4: secrets


def test_spans_and_ownership(spark):
    key, hexa, jwt = "AKIA" + "B" * 16, "0123456789abcdef" * 2, "eyJ" + "a" * 9 + "." + "b" * 9 + "." + "c" * 9
    rows = [
        (1, f"Ünï \U0001d4d0 Password: 'abc' token={hexa} {key} {jwt}", "a", 5),
        (2, f"x secret=token: abcdefgh API-key={key} apikey = Zz1234", "b", 5),
        (3, f"{key} {jwt} gh{'p'}_{'q' * 36}", "a", 5),
        (4, None, None, None), (5, "", "a", 0), (None, f"{hexa}", None, 1), (3, f"{key} {jwt} gh{'p'}_{'q' * 36}", "a", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    spans = secret_scan.scan(docs, max_owners=1, max_repositories=0)
    got = {r.doc_id: r for r in secret_scan.report(docs, spans).collect()}
    patterns = {k.name: (re.compile(k.pattern, re.A), k.value, k.least) for k in secret_scan.KINDS}
    shared = {key, hexa}  # of two owners
    for doc_id, text, *_ in rows:
        found = [
            (m.start(), list(patterns).index(k), f"{k}:{m.start()}:{m.end()}", m[value])
            for k, (pattern, value, least) in patterns.items() for m in pattern.finditer(text or "") if len(m[value]) >= least
        ]
        base = [s for s in sorted(found) if s[1] < 3]
        assert got[doc_id].base_spans == ",".join(s[2] for s in base)
        assert got[doc_id].spans == ",".join(s[2] for s in sorted(found) if s[1] < 3 or s[3] not in shared)
        assert (got[doc_id].n_assign, got[doc_id].n_access, got[doc_id].n_hex) == tuple(sum(s[1] == i for s in base) for i in range(3))
    clean = {r.doc_id: r for r in secret_scan.redact(docs, spans).collect()}
    assert clean[2].text == f"x secret=token: abcdefgh API-key={key} apikey = [SECRET]" and clean[2].n_chars == len(clean[2].text)
    assert clean[3].text == f"{key} [SECRET] [SECRET]" and clean[1].text.startswith(f"Ünï \U0001d4d0 Password: 'abc' token={hexa}")
    assert (clean[4].text, clean[5].text, clean[5].n_chars) == (None, "", 0)


def test_pipeline_keeps_only_widely_published_values(spark):
    keys = {c: "AKIA" + c * 16 for c in "ABCD"}
    copies = {"A": (2, 2), "B": (30, 3), "C": (6, 6), "D": (30, 6)}  # documents and sources
    rows = [(100 * n + i, f"x {keys[c]} y", f"s{i % s}") for n, (c, (d, s)) in enumerate(copies.items()) for i in range(d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    stage = dict(corpus_pipeline.STAGES)["secrets"]
    assert {r.text for r in stage(spark, docs, "").collect()} == {"x [SECRET] y", f"x {keys['D']} y"}
    # The operator's own rule is the same, on both sides of each count.
    assert (corpus_pipeline.MAX_OWNERS, corpus_pipeline.MAX_REPOSITORIES) == (secret_scan.MAX_OWNERS, secret_scan.MAX_REPOSITORIES)
    found = secret_scan.report(docs, secret_scan.scan(docs))
    assert {r.doc_id // 100: r["max(n_live)"] for r in found.groupBy("doc_id").max("n_live").collect()} == {0: 1, 1: 1, 2: 1, 3: 0}


def test_added_spans_are_listed_unless_widely_published(spark):
    tokens = {c: "ghp_" + c * 36 for c in "ABC"}
    copies = {"A": (21, 6), "B": (20, 6), "C": (21, 5)}  # documents and sources: only the first has more of both
    rows = [(100 * n + i, tokens[c], f"s{i % s}") for n, (c, (d, s)) in enumerate(copies.items()) for i in range(d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id // 100: r.spans for r in secret_scan.report(docs, secret_scan.scan(docs)).collect()}
    assert got == {0: "", 1: "github:0:40", 2: "github:0:40"}


def test_secrets_of_odd_tables(docs, nothing):
    assert secret_scan.redact(docs, secret_scan.scan(docs)).exceptAll(docs).count() == 0
    assert secret_scan.report(nothing, secret_scan.scan(nothing)).count() == 0


# --- 5: decontamination


def brute_matches(text, items, window):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w, hit, names = words(text, pattern), set(), set()
    for name, item in items:
        own = words(item, pattern)
        size = min(len(own), window)
        tests = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(w) - size + 1):
            if size and tuple(w[i : i + size]) in tests:
                hit |= {*range(i, i + size)}
                names |= {name}
    return len(w), len(hit), sorted(n for n in names if n is not None)


def test_contamination_against_brute_force(docs, spark):
    texts = [r.text for r in docs.collect() if r.text]
    items = [(i, " ".join(t.split()[5 : 5 + i])) for i, t in enumerate(texts[:30])] + [(None, texts[3]), (90, None), (91, ""), (92, "ONE"), (93, "!"), (5, texts[9])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for window, block in ((10, 1 << 20), (4, 300)):
        got = decontaminate.contamination(docs, bench, window, block).collect()
        assert len(got) == docs.select("doc_id").distinct().count()
        by_id = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
        for r in got:
            if r.doc_id is not None:
                assert (r.n_words, r.n_hit, list(r.item_ids)) == brute_matches(by_id[r.doc_id], items, window), r.doc_id
    left = decontaminate.remove_contaminated(docs, bench)
    assert left.columns == docs.columns and all(brute_matches(r.text, items, 10)[1] == 0 for r in left.collect())


def test_longest_match_and_empty_benchmark(spark, docs, nothing):
    bench = spark.createDataFrame([(1, " ".join(f"q{i}" for i in range(40)))], "item_id long, text string")
    text = "before " + " ".join(f"Q{i}," for i in range(3, 30)) + " after"
    one = spark.createDataFrame([(7, text)], "doc_id long, text string")
    found = decontaminate.matches(one, bench).first()
    assert [tuple(m) for m in found.matches] == [(1, 27, 1)]
    assert decontaminate.contamination(one, bench).first().longest_match == 27
    assert decontaminate.contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.contamination(nothing, bench).count() == 0


# --- 6: token files


def whole_ids(text):
    return vocabulary(IDS).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_range_coder_round_trips():
    rng = np.random.default_rng(5)
    cases = [[], [0], [1], [2**32 - 1], [7] * 5000, [*range(4096)], [0, 1, 2, 2**31, 65_535, 65_536] * 9]
    cases += [rng.integers(0, 2**32, n) for n in (1, 2047, 2048, 2049)] + [rng.zipf(1.2, 6000).clip(0, 49_000)]
    for case in cases:
        ids = np.array(case, dtype=np.uint32)
        coded = range_coder.encode(ids)
        assert (range_coder.decode(coded) == ids).all()
        assert (range_coder.decode(coded + range_coder.encode(ids[::-1])) == np.concatenate([ids, ids[::-1]])).all()
    assert len(range_coder.encode(np.full(2048, 9, np.uint32))) < 200
    for at in (0, 20, len(coded) // 2):
        broken = bytearray(coded)
        broken[at] ^= 255
        with pytest.raises(range_coder.CorruptBlock):
            range_coder.decode(bytes(broken))
    with pytest.raises(range_coder.CorruptBlock):
        range_coder.decode(coded[:-1])


def test_the_range_coder_works_on_many_blocks_in_one_call():
    """What Python calls doesn't grow with the ids of a frame; before, 2,048 steps took a call for each 4 ids."""
    ids = np.random.default_rng(3).zipf(1.3, 300_000).clip(0, 49_000).astype(np.uint32)
    coded = range_coder.encode(ids)
    for work in (lambda: range_coder.encode(ids), lambda: range_coder.decode(coded)):
        profile = cProfile.Profile()
        profile.runcall(work)
        assert sum(entry.callcount for entry in profile.getstats()) < len(ids) / 6


@pytest.mark.parametrize("blocks", [1, 3])
def test_ids_of_several_frames_are_read_back(monkeypatch, blocks):
    monkeypatch.setattr(range_coder, "FRAME_BLOCKS", blocks, raising=False)
    rng = np.random.default_rng(8)
    for ids in (rng.zipf(1.3, 700).clip(0, 49_000), rng.integers(0, 2**32, 700), rng.integers(0, 70_000, 700) ** 2 % 2**20):
        ids = ids.astype(np.uint32)
        coded = range_coder.encode(ids, 64)
        assert (range_coder.decode(coded) == ids).all()
        for at in range(0, len(coded), 97):
            broken = bytearray(coded)
            broken[at] ^= 64
            try:  # the last bits of a block may not matter
                assert (range_coder.decode(bytes(broken)) == ids).all()
            except range_coder.CorruptBlock:
                pass


def test_ids_read_back_are_not_shuffled(docs, workdir):
    token_files.write_token_files(docs, f"{workdir}/plain", IDS, 1)
    spark = docs.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = token_files.read_token_files(spark, f"{workdir}/plain")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert re.search(r"\w+Join", plan).group() == "BroadcastHashJoin"


@pytest.mark.parametrize("segment", [2_000_000, 300])
def test_token_files_round_trip(docs, nothing, workdir, segment):
    token_files.write_token_files(docs, f"{workdir}/files", IDS, 1, segment)
    got = token_files.read_token_files(docs.sparkSession, f"{workdir}/files").collect()
    place, want = 0, []
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")):
        ids = [*whole_ids(r.text), 1]
        want.append((r.doc_id, place, len(ids), np.array(ids, "<u4").tobytes()))
        place += len(ids)
    assert sorted((r.start, r.doc_id or -1, r.n_tokens, bytes(r.ids)) for r in got) == sorted((w[1], w[0] or -1, w[2], w[3]) for w in want)
    token_files.write_token_files(nothing, f"{workdir}/none", IDS, 1)
    assert token_files.read_token_files(docs.sparkSession, f"{workdir}/none").count() == 0


def test_a_word_is_looked_up_without_a_table_of_all_words_held(monkeypatch):
    from statledger.llm import vocabularies

    def nothing(*args, **kwargs):
        raise AssertionError("all words held were gone through")

    texts = pa.array(["house house12, été! Σίσυφος", None, "", "house 12.. river", "x\u200by été", " "])
    plain = [x for s in texts.to_pylist() for x in whole_ids(s)]
    encoder = vocabularies.Vocabulary(IDS)
    with monkeypatch.context() as m:
        m.setattr(vocabularies.pc, "index_in", nothing)
        for _ in range(2):
            assert encoder.encode(texts)[0].tolist() == plain
    # Different words of one hash keep their own ids.
    encoder = vocabularies.Vocabulary(IDS)
    monkeypatch.setattr(vocabularies, "_hashes", lambda strings: np.full(len(strings), 7, np.uint64))
    for _ in range(2):
        assert encoder.encode(texts)[0].tolist() == plain


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_vocabulary_gives_the_tokenizers_ids(name):
    encoder = vocabulary(public_path(name))
    texts = [None, "", " \t", "Don't <|endoftext|>x <|ENDOFTEXT|> it's Áb é x  9'8's Ab's, 'll", "ΑΣ. 日本語 abc123, \u0338x", "İstanbul Ǆ ﬁne, é. KK\x85y\u00a0z"]
    texts += [d[1] for d in documents()]
    for part in (texts, texts[2:5], texts[:1], texts[::-1]):
        ids, ends = encoder.encode(pa.array(part, pa.string()))
        want = encoder.tokenizer.encode_batch([t or "" for t in part], add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [w.ids for w in want]


# --- 7: licences


def test_licences_by_dice(docs, nothing, spark):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 500)
    rows = [
        (1, "Some text.\nReleased under the MIT License.\nMore."),
        (2, mit), (3, mit.replace("Software", "Program", 1)), (4, mit[: len(mit) // 2]), (5, "Intro.\n\n" + mit.replace(". ", ".\n") + "\n\nOutro."),
        (6, "all RIGHTS reserved"), (7, "all rights"), (8, None), (9, ""), (10, "LICENSED under CC-BY-NC 4.0! " * 2),
    ]
    got = {r.doc_id: {x["license"]: x.dice for x in r.licenses} for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == {"MIT": 1.0} and got[2] == {"MIT": 1.0} and got[6] == {"proprietary": 1.0} and got[5] == {"MIT": 1.0}
    assert 0.9 < got[3]["MIT"] < 1 and all(got[i] == {} for i in (4, 7, 8, 9))
    assert got[10] == {"CC-BY-NC-4.0": 1.0}
    assert licenses.scan(docs).filter("size(licenses) > 0").count() == 0 and licenses.scan(docs).count() == docs.count()
    assert licenses.scan(nothing).count() == 0


def test_licences_wherever_they_stand(spark):
    text = {n: t for n, t in licenses.TEMPLATES if len(t) > 200}
    mit = text["MIT"]
    cut = [mit.index("The above"), mit.index("THE SOFTWARE IS")]
    paragraphs = ["Copyright (c) 2020 Some One", mit[: cut[0]], mit[cut[0] : cut[1]], mit[cut[1] :]]
    code = "\n".join(f"def step_{i}(value):\n    return value * {i}" for i in range(60))
    lines = lambda t: [" ".join(t.split()[i : i + 9]) for i in range(0, len(t.split()), 9)]
    rows = [
        "\n\n".join([*paragraphs, code]),
        "\n".join(["# " + x for x in lines(mit)] + [code]),
        "/*\n" + "\n".join([" * " + x for x in lines(text["BSD-3-Clause"])]) + "\n */\n" + code,
        code + "\nThis project is licensed under the MIT License.",
        "// SPDX-License-Identifier: Apache-2.0\n" + code,
        code + "\n\n" + text["ISC"].replace("THE AUTHOR ", "SOME ONE ") + "\n\n" + code,
        "END OF TERMS\n" + text["GPL-2.0"] + "\n" + code,
        code,
    ]
    found = licenses.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    got = {r.doc_id: {x["license"]: x.dice for x in r.licenses} for r in found}
    assert [max(got[i], key=got[i].get) for i in range(7)] == ["MIT", "MIT", "BSD-3-Clause", "MIT", "Apache-2.0", "ISC", "GPL-2.0"]
    assert [got[i][n] for i, n in ((0, "MIT"), (1, "MIT"), (2, "BSD-3-Clause"), (3, "MIT"), (4, "Apache-2.0"), (6, "GPL-2.0"))] == [1.0] * 6
    assert 0.9 < got[5]["ISC"] < 1 and got[7] == {} and got[0] == {"MIT": 1.0}


def test_licence_windows_against_brute_force():
    rng = random.Random(7)
    some = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    templates = [(f"L{i}", some(n)) for i, n in enumerate((2, 3, 5, 8, 13, 30))]
    texts = [some(n) for n in (1, 2, 3, 7, 12, 40, 90)] + [some(20) + " " + t + " x " + some(15) for _, t in templates]
    pairs = lambda t: list(zip(t.split(), t.split()[1:], strict=False))
    want = {}
    for i, text in enumerate(texts):
        for name, template in templates:
            a, b = pairs(text), pairs(template)
            size = min(len(a), len(b))
            for start in range(len(a) - size + 1 if a else 0):
                common = sum((Counter(a[start : start + size]) & Counter(b)).values())
                dice = 2 * common / (size + len(b))
                if dice >= 0.6:
                    want[i, name] = max(dice, want.get((i, name), 0))
    known = licenses.bigrams(templates)
    own = licenses.words(pa.array(texts), licenses.LETTER_OR_DIGIT)
    at, value = own.windows(2)
    near = np.flatnonzero(np.isin(value, known.known))
    found = licenses.windows(own.text[at], near, np.searchsorted(known.known, value[near]), known, 0.6)
    assert {(int(t), known.names[k]): d for t, k, d in zip(*found, strict=True)} == pytest.approx(want) and len(want) > 20


# --- 8: URLs


RULES = [url_filter.Rule("org", "/", "allow"), url_filter.Rule("bad.org", "/x/", "block"), url_filter.Rule("net", "/", "block")]


def test_url_rules_and_model(spark):
    rng = random.Random(3)
    name = lambda letters: "".join(rng.choice(letters) for _ in range(12))
    urls = [f"https://{name('abcde')}.org/{name('abcde')}" for _ in range(60)] + [f"http://{name('wxyz')}.net/{name('wxyz')}" for _ in range(60)]
    urls += ["http://BAD.org/x/1", "http://sub.bad.org/X/1", "http://notbad.org/x/", "http://bad.org?x", "no scheme", "", None, "a://org/ü?q://net/", urls[0], urls[0]]
    urls += [f"http://{name('abcde')}.com/{name('abcde')}" for _ in range(30)] + [f"http://{name('wxyz')}.com/{name('wxyz')}" for _ in range(30)]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = [tuple(r) for r in url_filter.judge(pages, RULES).orderBy("page_id").select("host", "path", "rule", "verdict").collect()]
    assert got[120:128] == [
        ("bad.org", "/x/1", "bad.org/x/", "block"), ("sub.bad.org", "/X/1", "org/", "allow"), ("notbad.org", "/x/", "org/", "allow"),
        ("bad.org", "", None, got[123][3]), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("org", "/ü", "org/", "allow"),
    ]
    assert [g[3] for g in got[130:]] == ["allow"] * 30 + ["block"] * 30
    assert url_filter.judge(pages.limit(0), RULES).count() == 0
    # Held URLs teach nothing: what only they have says nothing either way.
    held = [u for u in urls if u and hashlib.md5(u.encode()).hexdigest()[0] in url_filter.HELD_OUT]
    judged = pages.filter(F.col("url").isin(held)).select("url", F.lit("qq").alias("host"), F.lit("").alias("path"), F.lit("allow").alias("action"))
    scores = url_filter.score_urls(judged, url_filter.HELD_OUT).collect()
    assert len(scores) == len(set(held)) > 20 and all(r.held and r.score == 0 for r in scores)
    long = spark.createDataFrame([(1, "http://x.org/" + "a" * 8_000, "h"), (2, "http://y.com/" + "b" * 8_000, "h")], pages.schema)
    assert [r.rule for r in url_filter.judge(long, RULES).orderBy("page_id").collect()] == ["org/", None]
    assert {r.verdict for r in url_filter.judge(pages, RULES[:1]).collect()} == {"allow"}


def test_url_chances_against_brute_force(spark):
    urls = [("aab", "allow"), ("abb", "allow"), ("bca", "block"), ("aab", "block"), ("ccc", None)]
    df = spark.createDataFrame([(f"u{i}", s, a) for i, (s, a) in enumerate(urls)], "url string, host string, action string").withColumn("path", F.lit(""))
    counts = {}
    for s, action in urls:
        padded = url_filter.START * 3 + s
        for i in range(len(s)):
            for k in range(4):
                counts[(action, padded[i + 3 - k : i + 3], padded[i + 3])] = counts.get((action, padded[i + 3 - k : i + 3], padded[i + 3]), 0) + 1

    def chance(action, context, c):
        lower = chance(action, context[1:], c) if context else 1 / url_filter.ALPHABET
        own = [n for (a, x, _), n in counts.items() if a == action and x == context]
        return (counts.get((action, context, c), 0) + len(own) * lower) / (sum(own) + len(own)) if own else lower

    for i, (s, _) in enumerate(urls):
        padded = url_filter.START * 3 + s
        want = np.mean([math.log(chance("allow", padded[j : j + 3], padded[j + 3])) - math.log(chance("block", padded[j : j + 3], padded[j + 3])) for j in range(len(s))])
        assert url_filter.score_urls(df).filter(F.col("url") == f"u{i}").first().score == pytest.approx(want)


# --- 9: packing


def check_packed(pieces, rows, end_id):
    want = Counter((r.doc_id, np.array([*whole_ids(r.text), end_id], "<u4").tobytes()) for r in rows)
    sequences, parts = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
        assert len(p.ids) == 4 * p.length > 0
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        total = sum(p.length for p in own)
        assert [p.offset for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        assert {p.sequence_tokens for p in own} == {total} and total <= 4096 and total & (total - 1) == 0
    for p in pieces:
        parts.setdefault(p.doc_id, []).append(p)
    for doc_id, own in parts.items():
        whole = [ids for (d, ids), n in want.items() for _ in range(n) if d == doc_id]
        assert sum(p.length for p in own) == sum(len(w) // 4 for w in whole)
        if len(whole) == 1:
            own.sort(key=lambda p: p.start)
            assert b"".join(bytes(p.ids) for p in own) == whole[0] and own[0].doc_tokens == len(whole[0]) // 4
    assert set(parts) == {d for d, _ in want}
    return sequences


def test_packing_keeps_every_token(docs, nothing):
    sequences = check_packed(packing.pack_documents(docs, IDS, 2).collect(), docs.collect(), 2)
    assert len([s for s in sequences.values() if s[0].sequence_tokens == 4096]) > 10
    assert packing.pack_documents(nothing, IDS, 2).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs, IDS, 2, tiers=(100,))


def test_packing_holds_slices_of_text_and_of_pieces(monkeypatch):
    """Texts are tokenised and pieces given out a slice at a time, and packed as they were in one slice."""
    encoder, seen = vocabulary(IDS), []

    class Watched:
        def encode(self, texts):
            seen.append(sum(len((t or "").encode()) for t in texts.to_pylist()))
            return encoder.encode(texts)

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 3)

    rng = random.Random(4)
    texts = [None, "", *(prose(rng, "en", rng.randint(1, 900)) for _ in range(300))]
    rows = pa.RecordBatch.from_pydict({"doc_id": [*range(len(texts))], "text": texts})
    long = pa.int64()
    schema = pa.schema([("doc_id", long), ("start", long), ("length", long), ("ids", pa.binary()), ("doc_tokens", long)])
    for name in ("sequence_id", "offset", "sequence_tokens", "step_group"):
        schema = schema.append(pa.field(name, long))
    monkeypatch.setattr(packing, "TaskContext", Task)
    monkeypatch.setattr(packing, "vocabulary", lambda path: Watched())
    monkeypatch.setattr(packing, "BATCH_BYTES", 1 << 19)
    found = {}
    for size in (1 << 30, 1 << 15):
        monkeypatch.setattr(packing, "SLICE_BYTES", size)
        seen.clear()
        given = [*packing._packed(iter([rows]), IDS, 2, packing.TIERS, 65_536, schema)]
        found[size] = pa.Table.from_batches(given).to_pylist()
    assert max(seen) <= 1 << 15 and len(seen) > 20
    assert max(sum(map(len, g.column("ids").to_pylist())) for g in given) < (1 << 15) + 4 * 4096
    assert found[1 << 30] == found[1 << 15]
    check_packed([type("Piece", (), r) for r in found[1 << 15]], [type("Row", (), r) for r in rows.to_pylist()], 2)


def test_step_groups_are_balanced():
    rng = random.Random(2)
    lengths = [rng.choice([4096, 2048, 1024, 512]) for _ in range(400)]
    groups = packing.step_groups(lengths, 65_536)
    work = Counter()
    for length, group in zip(lengths, groups, strict=True):
        work[group] += length
    assert max(work.values()) - min(work.values()) <= 4096 and len(work) == -(-sum(lengths) // 65_536)


# --- 10: quality


def brute_quality(text):
    w = words(text) and re.findall(r"[^\x20\x09-\x0D]+", text or "")
    places, seen, dup = {}, set(), 0
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i : i + 5]), []).append(i)
    repeated = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    ids = [i for x in w for i in vocabulary(PIECES).model.encode(x)]
    shares = [c / len(ids) for c in Counter(ids).values()]
    entropy = -sum(p * math.log2(p) for p in shares) / math.log2(max(2, len(ids)))
    byte = sum(vocabulary(PIECES).model.is_byte(i) for i in ids)
    chars = sum(map(len, w))
    rest = (chars / max(1, len(ids)), byte / max(1, len(ids)), entropy)
    return (len(w), chars, len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated), len(ids), byte, *(round(x, 9) for x in rest))


def test_quality_against_brute_force(docs, nothing):
    judged = quality_rules.judge(docs, PIECES).collect()
    want = Counter((r.doc_id, r.lang, *brute_quality(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.lang, *r[2:9], *(round(x, 9) for x in r[9:12])) for r in judged) == want
    for r in judged:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (r.in_bands and not r.base_failed)
    assert quality_rules.judge(nothing, PIECES).count() == 0


def test_fertility_bands_reject_what_does_not_fit(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, "en", 100), "en") for i in range(80)]
    rows += [(900, " ".join("".join(chr(rng.randrange(0x12000, 0x12300)) for _ in range(5)) for _ in range(30)), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    bands = quality_rules.Bands(prior=0, quartiles=3)
    got = {r.doc_id: r for r in quality_rules.judge(docs, PIECES, bands).collect()}
    assert all(got[i].kept for i in range(80)) and got[900].byte_share > 0.5
    same = quality_rules.judge(docs.withColumn("lang", F.lit(None).cast("string")), PIECES, bands)
    assert same.filter("kept").count() == sum(r.kept for r in got.values())


def test_small_classes_meet_wider_bands(spark):
    rng = random.Random(4)
    junk = lambda n: " ".join("".join(chr(rng.randrange(0x12000, 0x12300)) for _ in range(5)) for _ in range(n))
    rows = [(i, prose(rng, "en", 100), "en") for i in range(80)]
    rows += [(900, junk(30), "xx"), (901, junk(30), None), (902, junk(3000), "en"), (903, prose(rng, "en", 100), "yy")]
    judged = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES)
    assert {r.doc_id for r in judged.filter("in_bands").collect()} == {*range(80), 903}


def test_shipped_bands_reject_each_kind_of_misfit(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, "en", 100 + i), "en") for i in range(160)] + [(200 + i, prose(rng, "de", 100 + i), "de") for i in range(160)]
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    misfits = [
        (900, " ".join(some("áéíóúñçãõàèù", 6) for _ in range(120)), "en"),  # few characters a token
        (901, " ".join(some("qxzjkvw", 8) for _ in range(120)), "de"),
        (902, " ".join(["stone"] * 150), "en"),  # no entropy
        (903, " ".join(some([chr(c) for c in range(0x12000, 0x12300)], 5) for _ in range(60)), "de"),  # bytes
    ]
    docs = spark.createDataFrame(rows + misfits, "doc_id long, text string, lang string")
    judged = quality_rules.judge(docs, [PIECES, IDS])
    assert {r.doc_id for r in judged.filter("not in_bands").collect()} == {900, 901, 902, 903}
    for name in quality_rules.fertility(2):
        assert judged.filter(f"{name} is null").count() == 0


# --- the pipeline


def test_pipeline_against_brute_force(spark, docs, workdir):
    """Each stage's decision on its own input, in order."""
    folder = f"{workdir}/tables"
    docs.write.parquet(f"{folder}/documents.parquet")
    secret = "password = Xy12345678"
    texts = {r.doc_id: r.text for r in docs.collect()}
    extra = [(800, prose(random.Random(5), "en", 80) + " " + secret, "en", "s5"), (801, prose(random.Random(6), "en", 60), "en", "s5")]
    docs.sparkSession.createDataFrame([(*e, len(e[1]), 0.1, 1, "x", "y", 2) for e in extra], SCHEMA).write.mode("append").parquet(f"{folder}/documents.parquet")
    items = [(1, " ".join(extra[1][1].split()[10:40])), (2, texts[5])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    stages = [spark.read.parquet(f"{folder}/documents.parquet")]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, stages[-1], folder).write.parquet(f"{folder}/stage{number}")
        stages.append(spark.read.parquet(f"{folder}/stage{number}"))
    assert all(s.columns == docs.columns for s in stages[:-1])
    identified = Counter(r.doc_id for r in stages[1].collect())
    assert not {300, 301, 302, 303} & set(identified) and {0, 1, 2, 100, 307, 800, 801} <= set(identified)
    rows = stages[1].collect()
    component, _ = brute_components(rows, 5)
    deduplicated = stages[2].collect()
    assert {r.doc_id for r in deduplicated} - {None} == {i for i, c in component.items() if i == c}
    left = {r.doc_id: r.text for r in stages[3].collect()}
    assert set(left) == {r.doc_id for r in deduplicated if not brute_matches(r.text, items, 10)[1]} and not {801, 5} & set(left)
    clean = {r.doc_id: r.text for r in stages[4].collect()}
    assert {k: v for k, v in clean.items() if k != 800} == {k: v for k, v in left.items() if k != 800}
    assert clean[800] == left[800].replace("Xy12345678", "[SECRET]")
    check_packed(stages[5].collect(), stages[4].collect(), corpus_pipeline.END_ID)
    assert corpus_pipeline.run(spark, folder).count() == stages[5].count()
