"""Conversation repair, spelling variants and BPE against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tabflow.llm import bpe, conversations as cv, variants
from tabflow.llm.queries import QUERIES

# --- op11 -------------------------------------------------------------------


def accepts(initials):
    return re.fullmatch(r"(s?(ua)+)?", initials) is not None


def every_audit(rows):
    """(cost, audit) of every edit sequence with at most two inserts in a row that gives a legal conversation."""

    def place(state, letter, initial):
        role = initial if letter == "K" else "a" if state == "u" else "u"
        ok = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        return role if role and role in ok else None

    out = []

    def go(i, state, cost, audit, inserted):
        if i == len(rows) and state in ("", "a"):
            out.append((cost, audit))
        if inserted < 2:
            role = place(state, "I", "")
            go(i, role, cost + 5, audit + "I", inserted + 1)
        if i < len(rows):
            initial, truncated, forced = rows[i]
            if forced:
                go(i + 1, state, cost + 2 * forced, audit + "D" * forced, 0)
                return
            go(i + 1, state, cost + 2, audit + "D", 0)
            for letter, price in (("K", 0), ("R", 1)):
                role = place(state, letter, initial)
                if role:
                    go(i + 1, role, cost + price + 5 * truncated, audit + letter, 0)

    go(0, "", 0, "", 0)
    return min(out)


def plain_audit(rows):
    """Cheapest (cost, audit) with whole strings for every state."""
    heads = {"": (0, "")}

    def relax():
        for to, sources in (("u", ("", "s", "a")), ("a", ("u",))):
            options = [(heads[s][0] + 5, heads[s][1] + "I") for s in sources if s in heads] + ([heads[to]] if to in heads else [])
            if options:
                heads[to] = min(options)

    relax()
    for initial, truncated, forced in rows:
        for _ in range(max(forced, 1)):
            new = {}

            def put(state, cost, audit):
                new[state] = min(new.get(state, (10**9, "")), (cost, audit))

            for state, (cost, audit) in heads.items():
                put(state, cost + 2, audit + "D")
                if not forced:
                    if initial in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and initial:
                        put(initial, cost + 5 * truncated, audit + "K")
                    put("a" if state == "u" else "u", cost + 1 + 5 * truncated, audit + "R")
            heads.clear()
            heads.update(new)
            relax()
    return min(heads[s] for s in ("", "a") if s in heads)


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 3])  # 3: nearly all hashes collide
def test_audit_is_cheapest_and_least(modulus):
    r = random.Random(4)

    def best(rows):
        tree, heads = cv.audit(rows, cv.EMPTY, cv.Audits(modulus))
        return min((c, tree.text(n)) for s, (c, n) in heads.items() if s in (cv.EMPTY, cv.ASSISTANT))

    some = [("s", False, 0), ("u", False, 0), ("a", False, 0), ("u", True, 0), ("a", True, 0), ("x", False, 0), ("", False, 1), ("", False, 3), ("", False, 0)]
    for n in range(4):
        for rows in itertools.product(some[:7], repeat=n):
            assert best(list(rows)) == every_audit(list(rows)) == plain_audit(list(rows))
    for _ in range(200):
        rows = [r.choice(some) for _ in range(r.randint(4, 60))]
        assert best(rows) == plain_audit(rows)


def test_audits_compare_by_common_prefix():
    for modulus in ((1 << 61) - 1, 2):
        r = random.Random(9)
        tree, texts = cv.Audits(modulus), {0: ""}
        for _ in range(300):
            p, letter = r.choice(list(texts)), r.choice("DIKR")
            texts[tree.add(p, letter)] = texts[p] + letter
        for _ in range(3000):
            a, b = r.choice(list(texts)), r.choice(list(texts))
            assert tree.less(a, b) == (texts[a] < texts[b])
            d = min(len(texts[a]), len(texts[b]))
            assert texts[tree.ancestor(a, d)] == texts[a][:d]


def plain_repair(rows):
    """{conv_id: the columns of ``repair``} and {conv_id: repaired turns} of (conv_id, turn, role, text) rows."""
    out, turns = {}, {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if ro is None else ro, " " if x is None else x) for c, t, ro, x in rows if c == conv]
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, edits = set(), []
        count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            edits.append((role[:1], fault == "truncated", int(fault in ("blank", "duplicate"))))
        cost, audit = plain_audit(edits)
        some = [t for t, _, _ in own if t is not None]
        gaps = max(some) - min(some) + 1 - len(set(some)) if some else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        left, told = iter(own), []
        for letter in audit:
            _, role, text = next(left) if letter != "I" else (None, "", "")
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if told and told[-1][0][0] == "u" else "user"
            told.append((role, text))
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in told).encode()).hexdigest()
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)
        turns[conv] = told
    return out, turns


@pytest.fixture(scope="module")
def talks():
    """Conversations with every fault; one holds a third of all rows; nulls; no two different rows of one turn."""
    r = random.Random(12)
    texts = ["Yes.", "No!", "Why?", "cut off", "  ", "", None, "Yes.", "Ünder ", "End.\n ", "a. b"]
    rows = []
    for conv in [*range(60), None]:
        for turn in sorted(r.sample(range(-3, 12), r.randint(1, 9))):
            rows += [(conv, turn, r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), r.choice(texts) if r.random() < 0.6 else f"text {r.random()}.")] * r.choice([1, 1, 1, 2])
        if r.random() < 0.2:
            rows += [(conv, None, "user", "no turn.")] * 2
    rows += [(100, i, r.choice(["user", "assistant"]), f"turn {i}" + "." * (i % 5 > 0)) for i in range(600)]
    rows += [(101, None, None, None), (102, 5, "assistant", "x" * 300_000)]
    rows += [(103, 1, "user", "the same row.")] * 500
    return rows


@pytest.fixture(scope="module")
def cut_ranges(spark):
    """Ranges stay small, so that long conversations are cut by their borders."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


SCHEMA = "conv_id long, turn long, role string, text string"
CLASH = ["part", "kind", "blank", "copies_", "h1", "h2", "audit", "cost", "digest", "seq", "slice", "state", "first_initial"]


def test_repair(spark, talks, cut_ranges):
    expected, told = plain_repair(talks)
    frame = spark.createDataFrame(talks, SCHEMA).withColumns({c: F.lit("z") for c in CLASH})
    frame = frame.union(frame.limit(0)).repartition(5)
    extra = spark.createDataFrame([(100, "x"), (777, "y"), (None, "z")], "conv_id long, audit string")
    got = cv.repair(frame, frame.select("conv_id", "audit").union(extra))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest"]
    got = got.collect()
    assert len(got) == len(expected) + 1
    rows = {g.conv_id: tuple(g)[1:] for g in got}
    assert rows.pop(777) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert rows == expected
    turns = {}
    for t in cv.repaired_turns(frame).orderBy("conv_id", "part", "place").collect():
        turns.setdefault(t.conv_id, []).append((t.role, t.text))
    assert turns == {c: t for c, t in told.items() if t}


def test_hot_conversation_lies_in_several_ranges(spark, talks, cut_ranges):
    parts = cv._segments(cv._prepared(cv.damaged(spark.createDataFrame(talks, SCHEMA))), False).where("kind = 0 and conv_id = 100")
    rows = parts.collect()
    assert len(rows) > 1 and sum(r.paths is not None for r in rows) == len(rows)


def test_repair_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cv.repair(cv.damaged(none), none).count() == 0
    assert cv.repaired_turns(none).count() == 0


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def test_op11_query(spark, talks, tmp_path):
    rows = [(c, t, ro, x) for c, t, ro, x in dict.fromkeys(talks)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    expected, _ = plain_repair(plain_damage(rows))
    for conv in {r[0] for r in rows} - expected.keys():
        expected[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    assert {g.conv_id: tuple(g)[1:] for g in got} == expected and len(got) == len(expected)


# --- op12 -------------------------------------------------------------------


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v)) if near else None
        form = best if near and counts[best] >= 2 * n else None
        out[w] = [n, len(near), form, counts[form] if form else None]
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def test_variants(spark):
    r = random.Random(2)
    counts = {"".join(r.choice("abé") for _ in range(r.randint(5, 8))): r.choice([3, 3, 4, 6, 9, 20, 50, 200]) for _ in range(500)}
    counts |= {"ending" + "tion" * k: 3 * k for k in range(1, 5)} | {"aaaaa": 7, "aaaaaa": 14, "aaaaaaa": 28, "x" * 70_000: 3, "x" * 70_001: 6, "ünder": 3, "under": 9}
    frame = spark.createDataFrame([(w, n, 1, 2, 3) for w, n in counts.items()], "word string, n long, key int, quarter int, size int")
    got = {o.word: (o.n, o.n_near, o.form, o.form_n, o.root) for o in variants.group_variants(frame).collect()}
    long = {w for w in counts if len(w) > 1000}
    assert {w: got[w] for w in long} == {"x" * 70_000: (3, 1, "x" * 70_001, 6, "x" * 70_001), "x" * 70_001: (6, 1, None, None, "x" * 70_001)}
    assert {w: g for w, g in got.items() if w not in long} == plain_variants({w: n for w, n in counts.items() if w not in long})
    assert variants.group_variants(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        variants.group_variants(frame, ratio=1)


def test_op12_query(spark, corpus, tmp_path):
    r = random.Random(8)
    stems = ["Ümlaut", "Éternel", "wordle", "Worlds", "wOrld", "stream", "streams", "steam"]
    rows = [(i, t) for i, t, _ in corpus] + [(1000 + i, " ".join(r.choice(stems) + "-" * (r.random() < 0.3) for _ in range(200))) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = {}
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    got = {o.word: (o.n, o.n_near, o.form, o.form_n, o.root) for o in QUERIES["op12_spelling_variants"](spark, str(tmp_path)).collect()}
    assert got == plain_variants(counts) and any(v[2] for v in got.values())


# --- op13 -------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_bpe_equals_library(library):
    r = random.Random(3)
    some = ["a", "b", "aa", " ", "  ", "\n", "'s", "'ll", "<|endoftext|>", "é", "日本", "😀", "1", "12", ".", "!!", "\t", " ", "\x1c", "the", "THE", "<|", "ing", " ", "é"]
    texts = ["".join(r.choice(some) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += [f"a {chr(c)}{chr(c)} b{chr(c)}1" for c in range(1, 0x3000)] + ["a" * 100_000, "ab" * 50_000, "=-" * 30_000, " " * 50_000, "", None]
    own = bpe.Bpe(bpe.load(public_tokenizers.path("byte_bpe_50k.json")))
    got = own.encode(texts[:2000]) + own.encode(texts[2000:])  # the second call knows pieces of the first
    assert got == [packed(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert [own.decode(g) for g in got] == [t or "" for t in texts]
    for _ in range(500):  # ids that are no whole characters
        ids = [r.randrange(50257) for _ in range(r.randint(0, 12))]
        assert own.decode(packed(ids)) == library.decode(ids, skip_special_tokens=False)
    assert own.decode(packed([50_257, 4_000_000_000])) == "" and own.decode(None) == ""


def test_pieces_forgotten_and_laid_out_in_parts(library, monkeypatch):
    own = bpe.Bpe(bpe.load(public_tokenizers.path("byte_bpe_50k.json")))
    r = random.Random(6)
    texts = [" ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 9))) for _ in range(50)) for _ in range(60)]
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    monkeypatch.setattr(bpe, "TOGETHER", 30)
    got = [x for k in range(0, 60, 10) for x in own.encode(texts[k:k + 10])]
    assert got == [packed(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_op13_query(spark, corpus, library, tmp_path):
    rows = [(i, t) for i, t, _ in corpus] + [(500, "ends <|endoftext|> here"), (501, "日" * 9000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for i, t in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(e), hashlib.sha256(packed(e)).hexdigest(), hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()))
    got = QUERIES["op13_bpe"](spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    ids = spark.createDataFrame(rows, "doc_id long, text string").select("text", bpe.encode(F.col("text"), vocabulary).alias("ids"))
    assert ids.where(F.coalesce("text", F.lit("")) != bpe.decode(F.col("ids"), vocabulary)).count() == 0


def test_bpe_refuses_other_vocabularies():
    with pytest.raises(ValueError):
        bpe.load(public_tokenizers.path("word_bpe_49k.json"))
