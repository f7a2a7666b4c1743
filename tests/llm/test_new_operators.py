"""Periodic runs, conversation repair and WARC chunks against brute force, and on rows that break things."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import random
import re
from functools import cache

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statledger.llm import conversations, runs, textarrays, warc
from statledger.llm.cluster import ship

# --- 11: periodic runs


def brute_runs(w, least=6, repeats=4):
    found = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, repeats * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_words(rng):
    n, kinds = rng.choice([0, 1, 5, 7, 20, 60, 200, 700]), rng.choice([1, 2, 3, 50])
    w = [f"w{rng.randint(0, kinds)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a = rng.randrange(n)
        p, e = 1 + (n - a) // rng.randint(3, 10), rng.randint(a, n)
        w = [w[a + (i - a) % p] if a <= i < e else w[i] for i in range(n)]
    return w


@pytest.mark.parametrize("seed,least,repeats", [(1, 6, 4), (2, 6, 4), (3, 2, 4), (4, 12, 5)])
def test_runs_of_many_texts_against_brute_force(seed, least, repeats):
    rng = random.Random(seed)
    for _ in range(60):
        texts = [periodic_words(rng) for _ in range(rng.randint(0, 12))]
        parts = textarrays.words(pa.array([" \n".join(w) for w in texts], pa.string()), textarrays.NOT_WHITE, lower=False)
        owner, found = runs.find_runs(parts.hashes, parts.first, least, repeats)
        assert [[tuple(x) for x in found[owner == d].tolist()] for d in range(len(texts))] == [brute_runs(w, least, repeats) for w in texts]


def test_runs_of_long_periods_and_of_one_word():
    rng = random.Random(9)
    unit = [f"u{rng.randint(0, 400)}" for _ in range(3001)]
    texts = [["noise"] + unit * 4 + unit[:17] + ["end"], ["same"] * 50_000, (["a"] * 9 + ["b"]) * 300]
    parts = textarrays.words(pa.array([" ".join(w) for w in texts], pa.string()), textarrays.NOT_WHITE, lower=False)
    owner, found = runs.find_runs(parts.hashes, parts.first)
    by = [[tuple(x) for x in found[owner == d].tolist()] for d in range(3)]
    assert by[0] == [(1, 4 * 3001 + 17, 3001)] and by[1] == [(0, 50_000, 1)]
    assert (0, 3000, 10) in by[2] and len(by[2]) == 301  # and each stretch of nine
    with pytest.raises(ValueError):
        runs.find_runs(parts.hashes, parts.first, least_repeats=3)


def test_runs_of_a_table_with_odd_rows(spark):
    rng = random.Random(5)
    texts = [" ".join(periodic_words(rng)) for _ in range(40)]
    texts += [None, "", " \n\t", "x " * 40, "Ä Ä " * 30 + "ende", texts[3], texts[3]]
    rows = [(k if k % 7 else None, t, "clash", 1) for k, t in enumerate(texts)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, runs string, n_words int").repartition(3)
    got = runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        want = brute_runs(w)
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(w), want)
        assert r.collapsed == " ".join(x for i, x in enumerate(w) if i not in gone)
    assert runs.periodic_runs(docs.limit(0)).collect() == []


# --- 12: conversation repair


def brute_repair(rows):
    """(cost, audit, repaired turns): the least of all edits, tried one after another."""
    seen, turns = set(), []
    for role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        gone = not shown or (role, text) in seen
        seen.add((role, text))
        turns.append((role, text, gone, not gone and shown[-1] not in ".!?"))

    def begins(initials):  # can it be continued to (s?(ua)+)?
        return re.fullmatch("s?(ua)*u?", initials)

    @cache
    def best(i, initials, inserted):
        found = [(0, "", ())] if i == len(turns) and re.fullmatch("(s?(ua)+)?", initials) else []
        ways = [(5, "I", r, "") for r in ("user", "assistant")] if inserted < 2 else []
        if i < len(turns):
            role, text, gone, cut = turns[i]
            ways.append((2, "D", None, None))
            if not gone:
                ways += [(5 * cut, "K", role, text)] + [(5 * cut + 1, "R", r, text) for r in ("user", "assistant")]
        for price, letter, role, text in ways:
            then = initials + ("" if role is None else role[:1] or "?")
            if begins(then):
                then = then if len(then) < 3 else then[len(then) - 2 :].replace("au", "u")
                rest = best(i + (letter != "I"), then, inserted + 1 if letter == "I" else 0)
                if rest:
                    found.append((price + rest[0], letter + rest[1], ((role, text), *rest[2]) if role is not None else rest[2]))
        return min(found, default=None)

    return best(0, "", 0)


def brute_report(rows):
    """Of one conversation's rows (turn, role, text, copies), in order."""
    flat = [(t, r, x) for t, r, x, n in rows for _ in range(n)]
    known = [t for t, _, _ in flat if t is not None]
    seen, counts = set(), [0, 0, 0]
    for _, role, text in flat:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        fault = 0 if not shown else 1 if (role, text) in seen else 2 if shown[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
    illegal = sum((a[1][:1] or "?") + (b[1][:1] or "?") not in ("su", "ua", "au") for a, b in zip(flat, flat[1:]))
    cost, audit, turns = brute_repair([(r, x) for _, r, x in flat])
    sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in turns).encode()).hexdigest()
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, *counts, illegal, cost, audit, sha)


def some_conversations(rng):
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Ünï. \t", "a.\nb", "end.\x0c", "\x85", "x" * 50 + "."]
    out = []
    for conv in [None, *range(60)]:
        for turn in range(rng.choice([1, 2, 3, 5, 8, 12])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "User", "", "tool", None])
            shown = rng.choice([None, *texts, f"own {turn}.", f"own {conv} {turn}", f"more {rng.random()}!"])
            out.append((conv, rng.choice([None, turn, turn, turn, turn + 3, turn // 2]), role, shown, rng.choice([0, 1, 1, 1, 1, 2, 3])))
    return out


@pytest.mark.parametrize("block_turns,partitions", [(8192, 2), (1, 5), (3, 7)])
def test_conversations_against_brute_force(spark, block_turns, partitions):
    rows = some_conversations(random.Random(block_turns))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = ship(spark).createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, copies long, audit string")
        got = {r.conv_id: tuple(r)[1:] for r in conversations.repair(turns, block_turns).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for conv in {r[0] for r in rows}:
        folded = {}
        for _, turn, role, text, n in (r for r in rows if r[0] == conv and r[4]):
            key = (turn, " " if role is None else role, " " if text is None else text)
            folded[key] = folded.get(key, 0) + n
        order = sorted(folded, key=lambda k: (k[0] is not None, k[0] or 0, k[1].encode(), hashlib.md5(k[2].encode()).hexdigest()))
        want[conv] = brute_report([(*k, folded[k]) for k in order])
    assert got == want


def test_edits_of_all_short_conversations():
    """Every sequence of up to four turns, by halving and by search."""
    import itertools

    texts = {conversations.FINE: "ok %d.", conversations.CUT_OFF: "cut %d", conversations.DELETED: ""}
    roles = ["system", "user", "assistant", "tool"]
    for n in range(4):
        for codes in itertools.product(range(12), repeat=n):
            rows = [(roles[c // 3], texts[c % 3] % k if c % 3 != conversations.DELETED else "") for k, c in enumerate(codes)]
            cost, audit, _ = brute_repair(rows)
            assert (conversations.edits(bytes(codes)), conversations.cost_of(audit, bytes(codes))) == (audit, cost)


def test_a_long_conversation_is_the_same_in_blocks(spark):
    rng = random.Random(2)
    rows = [(7, k, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes %d.", "cut %d", "", "Same."]).replace("%d", str(k)), 1) for k in range(2500)]
    turns = ship(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string, copies long").repartition(4)
    one, many = (conversations.repair(turns, n).collect() for n in (8192, 100))
    assert len(one) == 1 and one == many
    codes = bytes(
        3 * ["system", "user", "assistant"].index(r) + (2 if not x or x == "Same." and (r, x) in {(b, c) for _, _, b, c, _ in rows[:k]} else 1 if "cut" in x else 0)
        for k, (_, _, r, x, _) in enumerate(rows)
    )
    assert one[0].audit == conversations.edits(codes) and one[0].cost == conversations.cost_of(one[0].audit, codes)
    blocks = conversations.repair_blocks(turns, 100).orderBy("part", "block").collect()
    assert len(blocks) >= 25 and "".join(b.audit for b in blocks) == one[0].audit
    kept = [t for b in blocks for t in b.repaired]
    assert re.fullmatch("(s?(ua)+)?", "".join(t.role[0] for t in kept))
    assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in kept).encode()).hexdigest() == one[0].repaired_sha256


def test_repeats_of_one_turn_and_an_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string, copies long"
    turns = ship(spark).createDataFrame([(1, 0, "user", "Hi.", 9000), (1, 1, "assistant", "Yes.", 1), (2, 5, "user", "x", 0)], schema)
    got = {r.conv_id: r for r in conversations.repair(turns, 1000).collect()}
    assert (got[1].duplicate, got[1].illegal, got[1].cost, got[1].audit) == (8999, 8999, 2 * 8999, "K" + "D" * 8999 + "K")
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversations.repair(turns.limit(0)).collect() == []


# --- the pipeline on odd tables


def test_pipeline_stages_on_an_empty_table_and_without_languages(spark, workdir):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    ship(spark).createDataFrame([("i1", "some words of a benchmark item that nobody else has")], "item_id string, text string").write.parquet(f"{workdir}/benchmark.parquet")
    none = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, workdir)
        assert none.collect() == []
    rows = [(k, f"words of document number {k} " * 5 if k else None, None, "s", 10) for k in range(6)]
    kept = dict(corpus_pipeline.STAGES)["language ID"](spark, spark.createDataFrame(rows, schema), workdir)
    assert sorted(map(tuple, kept.collect())) == rows


# --- 13: WARC


PAGES = [
    (1, "http://a/", "é" * 50_000), (2, "v", "é" * 50_000), (3, "x\r\ny", "a\r\n\r\nWARC/1.1\r\nb"), (4, None, None), (5, "", ""),
    (None, "q", "é\U0001d4d0z" * 3000), (7, "z", "\r\n\r\n"), (5, "", ""), (0, "late", "a\r\n\r\nWARC/1.1\r\nb"), (9, "n", "x\n"),
    (None, "n", "x\n"), (None, "only null", "twice"), (None, "only null", "twice"),
]


def want_records(rows, least):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        own = first.get(html or "")
        again = len(data) >= least and own is not None and own != page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", own if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_bytes,least", [(1 << 15, 0), (4, 3), (7, 0), (1000, 10**9)])
def test_pages_come_back_from_the_archives(spark, workdir, chunk_bytes, least):
    pages = ship(spark).createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    rows = [p for p in PAGES if chunk_bytes >= 7 or len(p[2] or "") < 20_000]
    pages = pages.filter(F.coalesce(F.length("html"), F.lit(0)) < 20_000) if chunk_bytes < 7 else pages
    warc.write_archives(pages, f"{workdir}/w", chunk_bytes, least)
    got = warc.read_records(spark, f"{workdir}/w").select(F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long"))
    assert sorted(map(tuple, got.collect()), key=repr) == want_records(rows, least)
    chunks = warc.read_chunks(spark, f"{workdir}/w").distinct().collect()  # rows of one id and payload are one record
    whole = {}
    for c in sorted(chunks, key=lambda c: (c.record_id, c.chunk)):
        data = whole.setdefault(c.record_id, b"") if c.chunk else b""
        assert c.offset == len(data) and c.bytes == len(c.data) <= max(chunk_bytes + 3, 1 << 22)
        whole[c.record_id] = data + c.data
        assert base64.b32encode(hashlib.sha1(whole[c.record_id]).digest()).decode() == c.digest_so_far
    assert {b.decode() for b in whole.values()} >= {p[2] or "" for p in rows if p[0] is not None}


def test_empty_pages_and_archives_from_elsewhere(spark, workdir):
    none = ship(spark).createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(none, f"{workdir}/none")
    assert warc.read_records(spark, f"{workdir}/none").collect() == []
    body = b"HTTP/1.1 200 OK\r\n\r\n\xff\xfe binary \n" * 300_000  # one long record, a gzip member each
    heads = [b"warcinfo", b"response"]
    os.makedirs(f"{workdir}/far")
    with open(f"{workdir}/far/a.warc.gz", "wb") as out:
        for n, (kind, data) in enumerate(zip(heads, [b"software: x\r\n", body])):
            out.write(gzip.compress(b"WARC/1.0\r\nwarc-type:%s\r\nWARC-Record-ID: <urn:x:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind, n, len(data), data)))
    chunks = warc.read_chunks(spark, f"{workdir}/far").orderBy("record_id", "chunk").collect()
    assert len(chunks) > 2 and b"".join(c.data for c in chunks if c.type == "response") == body
    last = [c for c in chunks if c.last]
    assert [c.digest_so_far for c in last] == [base64.b32encode(hashlib.sha1(x).digest()).decode() for x in (b"software: x\r\n", body)]


@pytest.mark.parametrize("damage", ["cut", "length", "segment"])
def test_damaged_archives_are_errors(spark, workdir, damage):
    pages = ship(spark).createDataFrame([(1, "u", "abc" * 100)], "page_id long, url string, html string")
    warc.write_archives(pages, f"{workdir}/w", chunk_bytes=100)
    data = b"".join(gzip.open(f"{workdir}/w/{n}").read() for n in sorted(os.listdir(f"{workdir}/w")) if n.endswith(".gz"))
    if damage == "cut":
        data = data[:-60]
    elif damage == "length":
        data = data.replace(b"Content-Length: 100", b"Content-Length: 99")
    else:
        data = data.replace(b"WARC-Segment-Number: 2", b"WARC-Segment-Number: 3")
    os.makedirs(f"{workdir}/bad")
    with gzip.open(f"{workdir}/bad/a.warc.gz", "wb") as out:
        out.write(data)
    with pytest.raises(Exception, match="BadArchive"):
        warc.read_records(spark, f"{workdir}/bad").collect()
