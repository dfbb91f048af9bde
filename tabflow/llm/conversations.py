"""Conversation structure repair: the cheapest edits that make turns alternate.

A repaired conversation has no turn, or an optional system turn and then user
and assistant in turn, ending with the assistant.  Edits, one for each row in
order: Keep (0; 5 if the text is truncated), Rerole to user or assistant (1;
6), Delete (2; the only edit of blank and duplicate rows), and Insert of an
empty user or assistant turn anywhere (5).  Among the cheapest audits (the
edits' initials) the least in ASCII order is taken.

The dynamic programme keeps one audit for each of four states (nothing yet,
after system, user, assistant).  Audits are persistent: a node links to its
prefix, which many share, and holds binary-lifting ancestors and a rolling
hash of its path.  Equally cheap audits are compared by searching their
longest common prefix over those ancestors by hash; equal hashes are verified
letter by letter once (back to a shared or already verified node), so a
collision cannot decide.  Audits that tie end in the same state after the
same rows, and then none is a prefix of the other, so the best prefixes give
the best audit.

Rows are spread by ranges of (conversation, turn, role, text hash), so a hot
conversation lies in as many tasks as its rows need; repeated rows are
counted before the shuffle.  A conversation inside one range is finished in
its task.  One that is cut by range borders (two a range at most) becomes
segments with the cheapest audit from each state to each other, which are
then chained.  Only the digest of a cut conversation's text has to be read in
order by one task (SHA-256 is sequential); that pass streams.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.llm.scratch import Scratch

BLANKS = " \t\n\x0b\f\r"
#: States: nothing yet, after system, after user, after assistant; where a turn of a role initial leads.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = ("su", "ua", "au")
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5


def damaged(convs: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of the rows that a crc32 of
    ``conv_id:turn`` modulo 20 leaves: 0 drops a row, 1 empties its text, 2
    removes its ``.!?``, 3 repeats it, 4 sets its role to user.  A null role,
    text or part of the key is one blank."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = convs.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


class Audits:
    """Edit sequences as nodes that share their prefixes; node 0 is the empty one.

    A step is a letter with a count: the repeated deletes of equal rows are one
    step.  ``modulus`` of the rolling hash is a parameter for tests.
    """

    def __init__(self, modulus: int = (1 << 61) - 1):
        self.modulus = modulus
        self.step: list[tuple[str, int]] = [("", 0)]
        self.up: list[tuple[int, ...]] = [()]
        self.depth, self.hash = [0], [0]
        self.same: set[tuple[int, int]] = set()

    def add(self, node: int, letter: str, count: int = 1) -> int:
        up = [node]
        while len(up) <= len(self.up[up[-1]]):  # the 2^k-th ancestor, for every k
            up.append(self.up[up[-1]][len(up) - 1])
        self.step.append((letter, count))
        self.up.append(tuple(up))
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * 1_000_003 + ord(letter) * 31 + count) % self.modulus)
        return len(self.step) - 1

    def ancestor(self, node: int, depth: int) -> int:
        k = self.depth[node] - depth
        while k:
            low = (k & -k).bit_length() - 1
            node = self.up[node][low]
            k &= k - 1
        return node

    def equal(self, x: int, y: int) -> bool:
        """Of two nodes of one depth: equal hashes are verified, each pair once."""
        if x == y:
            return True
        if self.hash[x] != self.hash[y]:
            return False
        way = []
        while x != y and (x, y) not in self.same:
            if self.step[x] != self.step[y]:
                return False
            way.append((x, y))
            x, y = self.up[x][0], self.up[y][0]
        self.same.update(way)
        return True

    def less(self, a: int, b: int) -> bool:
        """Audit a before audit b in ASCII order, by their longest common prefix."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.equal(x, y):
            return self.depth[a] < self.depth[b]
        k = len(self.up[x])
        while k:
            k -= 1
            if k < len(self.up[x]) and not self.equal(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return self.step[x] < self.step[y]

    def text(self, node: int) -> str:
        parts = []
        while node:
            letter, count = self.step[node]
            parts.append(letter * count)
            node = self.up[node][0]
        return "".join(reversed(parts))


Heads = dict[int, tuple[int, int]]


def _best(tree: Audits, options: list[tuple[int, int, str, int]], own: tuple[int, int] | None = None) -> tuple[int, int] | None:
    """Cheapest of (cost, prefix, letter, count) and of ``own`` (cost, node); ties by audit."""
    costs = [o[0] for o in options] + ([own[0]] if own else [])
    if not costs:
        return None
    least = min(costs)
    nodes = [own[1]] if own and own[0] == least else []
    nodes += [tree.add(p, letter, count) for c, p, letter, count in options if c == least]
    best = nodes[0]
    for n in nodes[1:]:
        if tree.less(n, best):
            best = n
    return least, best


def _inserts(tree: Audits, heads: Heads) -> None:
    """Empty turns that may follow: user from any other state, then assistant."""
    for to, sources in ((USER, (EMPTY, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
        options = [(heads[s][0] + INSERT, heads[s][1], "I", 1) for s in sources if s in heads]
        if (best := _best(tree, options, heads.get(to))) is not None:
            heads[to] = best


def audit(rows: list[tuple[str, bool, int]], start: int = EMPTY, tree: Audits | None = None) -> tuple[Audits, Heads]:
    """Cheapest audits of ``rows`` from state ``start`` to each state.

    A row is (role initial, truncated, 0) or, for deletes that have no choice,
    ("", False, how many).
    """
    tree = tree or Audits()
    heads: Heads = {start: (0, 0)}
    _inserts(tree, heads)
    for initial, truncated, forced in rows:
        if forced:  # a run of deletes: an insert within would come later in ASCII order behind it
            heads = {s: (c + DELETE * forced, tree.add(n, "D", forced)) for s, (c, n) in heads.items()}
        else:
            extra = TRUNCATED if truncated else 0
            options: dict[int, list] = {}
            for s, (c, n) in heads.items():
                options.setdefault(s, []).append((c + DELETE, n, "D", 1))
                to = NEXT.get(initial, {}).get(s)
                if to is not None:
                    options.setdefault(to, []).append((c + extra, n, "K", 1))
                to = ASSISTANT if s == USER else USER
                options.setdefault(to, []).append((c + extra + REROLE, n, "R", 1))
            heads = {s: _best(tree, o) for s, o in options.items()}
        _inserts(tree, heads)
    return tree, heads


def replay(letters: Iterator[str], rows: Iterator[tuple[str, str]], state: int = EMPTY) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns that an audit gives; ``rows`` are (role, text), one for each edit but Insert."""
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == USER else "user"
        state = NEXT[role[:1]][state]
        yield role, text


def _prepared(rows: DataFrame) -> DataFrame:
    """The rows in two kinds, repeats counted: kind 0 is the first row of a
    role and text in its conversation, with the text; kind 1 says how many
    rows have a conversation, turn, role and text (and whether it is blank)."""
    bare = F.btrim("text", F.lit(BLANKS))
    own = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "copies",
                      F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), (bare == "").alias("blank"),
                      (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"))
    first = F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn"))["turn"]
    texts = (own.where("not blank").groupBy("conv_id", "role", "h1", "h2", "truncated")
                .agg(first.alias("turn"), F.first("text").alias("text")))
    counts = own.groupBy("conv_id", "turn", "role", "h1", "h2", "blank").agg(F.sum("copies").cast("long").alias("copies"))
    cols = ["conv_id", "turn", "role", "h1", "h2"]
    return (texts.select(*cols, F.lit(0).alias("kind"), F.lit(False).alias("blank"), "truncated", F.lit(0).cast("long").alias("copies"), "text")
                 .union(counts.select(*cols, F.lit(1), "blank", F.lit(False), "copies", F.lit(None).cast("string"))))


class _Segment:
    """The rows of one conversation in one range, and their statistics."""

    def __init__(self, conv):
        self.conv = conv
        self.rows: list[tuple[str, str, bool, int]] = []  # role, text, truncated, forced deletes
        self.blank = self.duplicate = self.truncated = self.illegal = self.n_turns = 0
        self.first_initial = self.last_initial = self.turn_lo = self.turn_hi = None
        self.open = False  # the last row is the first of its text, its copies are still to come

    def add(self, turn, role, kind, blank, truncated, copies, text):
        initial = role[:1]
        if kind == 0:
            self.rows.append((role, text, truncated, 0))
            self.truncated += truncated
            self.open = True
            return
        deletes = copies - self.open
        self.open = False
        if blank:
            self.blank += deletes
        else:
            self.duplicate += deletes
        if deletes:
            self.rows.append(("", "", False, deletes))
        self.illegal += copies - 1 + (self.last_initial is not None and self.last_initial + initial not in LEGAL)
        if self.first_initial is None:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None:
            self.n_turns += self.turn_hi is None or turn != self.turn_hi
            self.turn_lo = turn if self.turn_lo is None else self.turn_lo
            self.turn_hi = turn

    def edits(self):
        return [(role[:1], truncated, forced) for role, _, truncated, forced in self.rows]

    def originals(self) -> Iterator[tuple[str, str]]:
        for role, text, _, forced in self.rows:
            for _ in range(forced or 1):
                yield role, text


def line_of(role: str, text: str) -> str:
    return f"{role}:{text}"


def _digest(turns: Iterator[tuple[str, str]]) -> str:
    h = hashlib.sha256()
    for k, (role, text) in enumerate(turns):
        h.update((("\n" if k else "") + line_of(role, text)).encode())
    return h.hexdigest()


_STATS = ["blank", "duplicate", "truncated", "illegal", "n_turns", "turn_lo", "turn_hi"]
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_PATHS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _segments(prepared: DataFrame, turns: bool) -> DataFrame:
    """Kind 0: a row for each conversation and range (finished if it cannot be
    cut, else with paths); kind 1: the rows of conversations that may be cut."""
    conv_type = prepared.schema["conv_id"].dataType
    fields = [T.StructField("conv_id", conv_type), T.StructField("part", T.IntegerType()), T.StructField("kind", T.IntegerType())]
    fields += [T.StructField(s, T.LongType()) for s in _STATS]
    fields += [T.StructField(s, T.StringType()) for s in ("first_initial", "last_initial")]
    fields += [T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("digest", T.StringType()),
               T.StructField("turns", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))),
               T.StructField("paths", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()),
                                                                T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))),
               T.StructField("seq", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("deletes", T.LongType())]
    names = [f.name for f in fields]

    def finished(s: _Segment) -> dict:
        tree, heads = audit(s.edits())
        ends = [heads[x] for x in (EMPTY, ASSISTANT) if x in heads]
        best = min(c for c, _ in ends)
        nodes = [n for c, n in ends if c == best]
        node = nodes[0] if len(nodes) == 1 or tree.less(nodes[0], nodes[1]) else nodes[1]
        text = tree.text(node)
        out = list(replay(iter(text), s.originals()))
        return {"cost": best, "audit": text, "digest": _digest(iter(out)), "turns": [{"role": r, "text": t} for r, t in out] if turns else None}

    def paths(s: _Segment) -> list[dict]:
        out = []
        for start in range(4):
            tree, heads = audit(s.edits(), start)
            out += [{"start": start, "stop": stop, "cost": c, "audit": tree.text(n)} for stop, (c, n) in sorted(heads.items())]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        held = size = 0
        first, own, part, kind_of = True, None, None, None

        def flush() -> pa.RecordBatch:
            arrays = []
            for f in fields:
                t = kind_of if f.name == "conv_id" else _TURNS if f.name == "turns" else _PATHS if f.name == "paths" else (
                    pa.int32() if f.dataType == T.IntegerType() else pa.int64() if f.dataType == T.LongType() else pa.string())
                arrays.append(pa.array([r.get(f.name) for r in out], t))
            return pa.RecordBatch.from_arrays(arrays, names)

        def close(s: _Segment, cut: bool) -> int:
            row = {"conv_id": s.conv, "part": part, "kind": 0, "first_initial": s.first_initial, "last_initial": s.last_initial}
            row |= {k: getattr(s, k) for k in _STATS}
            out.append(row | ({"paths": paths(s)} if cut else finished(s)))
            if cut:
                for seq, (role, text, _, forced) in enumerate(s.rows):
                    out.append({"conv_id": s.conv, "part": part, "kind": 1, "seq": seq, "role": role, "text": text, "deletes": forced})
            return sum(len(t) for _, t, _, _ in s.rows) if cut or turns else 0

        for batch in batches:
            kind_of = batch.schema.field("conv_id").type
            cols = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "kind", "blank", "truncated", "copies", "text", "part")]
            for conv, turn, role, kind, blank, truncated, copies, text, p in zip(*cols):
                if own is None or conv != own.conv:
                    if own is not None:
                        size += close(own, first)
                        first = False
                        if len(out) > 5000 or size > 1 << 23:
                            yield flush()
                            out, size = [], 0
                    own, part = _Segment(conv), p
                own.add(turn, role, kind, blank, truncated, copies, text)
        if own is not None:
            close(own, True)
            yield flush()

    keys = ["conv_id", "turn", "role", "h1", "h2"]
    ordered = prepared.repartitionByRange(*keys).sortWithinPartitions(*keys, "kind").withColumn("part", F.spark_partition_id())
    return ordered.select("conv_id", "turn", "role", "kind", "blank", "truncated", "copies", "text", "part").mapInArrow(run, T.StructType(fields))


def _chain(cut: DataFrame) -> DataFrame:
    """Cheapest audits of cut conversations from their segments: ``conv_id,
    part, slice, state`` for each segment (the audit's part and the state
    before it), with the statistics and the cost at a conversation's first."""
    conv_type = cut.schema["conv_id"].dataType
    names = ["conv_id", "part", "slice", "state", "cost", *_STATS]
    schema = T.StructType([T.StructField("conv_id", conv_type), T.StructField("part", T.IntegerType()), T.StructField("slice", T.StringType()),
                           T.StructField("state", T.IntegerType()), T.StructField("cost", T.LongType()), *[T.StructField(s, T.LongType()) for s in _STATS]])

    def before(a, b) -> bool:
        """Chains (earlier, segment, path): ASCII order of their audits, from where they part."""
        x, y = [], []
        while a is not b:
            x.append(a[2]["audit"])
            y.append(b[2]["audit"])
            a, b = a[0], b[0]
        return "".join(reversed(x)) < "".join(reversed(y))

    def solved(conv, segments: list[dict]) -> list[dict]:
        heads: dict[int, tuple[int, tuple | None]] = {EMPTY: (0, None)}
        for s in segments:
            new: dict[int, tuple[int, tuple]] = {}
            for p in s["paths"]:
                if p["start"] in heads:
                    c, chain = heads[p["start"]]
                    option = (c + p["cost"], (chain, s, p))
                    old = new.get(p["stop"])
                    if old is None or option[0] < old[0] or option[0] == old[0] and before(option[1], old[1]):
                        new[p["stop"]] = option
            heads = new
        ends = [heads[x] for x in (EMPTY, ASSISTANT) if x in heads]
        best = ends[0]
        if len(ends) > 1 and (ends[1][0] < best[0] or ends[1][0] == best[0] and before(ends[1][1], best[1])):
            best = ends[1]
        total = {k: sum(s[k] for s in segments) for k in ("blank", "duplicate", "truncated", "illegal", "n_turns")}
        total["illegal"] += sum(s["last_initial"] + t["first_initial"] not in LEGAL for s, t in zip(segments, segments[1:]))
        last = None  # a turn on both sides of a border counts once
        for s in segments:
            if s["turn_lo"] is not None:
                total["n_turns"] -= s["turn_lo"] == last
                last = s["turn_hi"]
        lows = [s["turn_lo"] for s in segments if s["turn_lo"] is not None]
        total |= {"turn_lo": lows[0] if lows else None, "turn_hi": last, "cost": best[0]}
        out, chain = [], best[1]
        while chain is not None:
            chain, s, p = chain
            out.append({"conv_id": conv, "part": s["part"], "slice": p["audit"], "state": p["start"]})
        out[-1] |= total
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        kind = None

        def done() -> pa.RecordBatch:
            rows = solved(held[0]["conv_id"], held)
            types = [kind, pa.int32(), pa.string(), pa.int32(), *[pa.int64()] * (1 + len(_STATS))]
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], names)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    yield done()
                    held = []
                held.append(row)
        if held:
            yield done()

    own = cut.select("conv_id", "part", *_STATS, "first_initial", "last_initial", "paths")
    return own.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, schema)


def _replayed(slices: DataFrame, rows: DataFrame, digest: bool) -> DataFrame:
    """Of cut conversations, read in order: ``conv_id, digest``, or (``digest``
    false) ``conv_id, part, place, role, text`` of each segment's turns."""
    conv_type = slices.schema["conv_id"].dataType
    both = (slices.select("conv_id", "part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("seq"), F.col("slice").alias("role"),
                          F.lit(None).cast("string").alias("text"), F.col("state").cast("long").alias("deletes"))
                  .union(rows.select("conv_id", "part", "kind", "seq", "role", "text", "deletes")))
    tail = [("digest", T.StringType(), pa.string())] if digest else [
        ("part", T.IntegerType(), pa.int32()), ("place", T.LongType(), pa.int64()), ("role", T.StringType(), pa.string()), ("text", T.StringType(), pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out, waiting = None, [], 0

        def flat():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield from batch.to_pylist()

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out))
            arrays = [pa.array(cols[0], kind)] + [pa.array(c, t[2]) for c, t in zip(cols[1:], tail)]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", *[t[0] for t in tail]])

        source = flat()
        head = next(source, None)
        conv, h, n = head["conv_id"] if head else None, hashlib.sha256(), 0
        while head is not None:  # a segment: its slice, then its rows
            if head["conv_id"] != conv:
                if digest:
                    out.append((conv, h.hexdigest()))
                conv, h, n = head["conv_id"], hashlib.sha256(), 0
            following = [None]

            def originals():
                for r in source:
                    if r["kind"] == 0:
                        following[0] = r
                        return
                    for _ in range(r["deletes"] or 1):
                        yield r["role"], r["text"]

            rest = originals()
            for place, (role, text) in enumerate(replay(iter(head["role"]), rest, head["deletes"])):
                if digest:
                    h.update((("\n" if n else "") + line_of(role, text)).encode())
                    n += 1
                else:
                    out.append((conv, head["part"], place, role, text))
                    waiting += len(text)
                    if waiting > 1 << 22 or len(out) > 50_000:
                        yield flush()
                        out, waiting = [], 0
            for _ in rest:  # the next slice stands behind the last row
                pass
            head = following[0]
        if digest and kind is not None:
            out.append((conv, h.hexdigest()))
        if out:
            yield flush()

    keys = ["conv_id"] if digest else ["conv_id", "part"]
    schema = T.StructType([T.StructField("conv_id", conv_type), *[T.StructField(n, t) for n, t, _ in tail]])
    return both.repartition(*keys).sortWithinPartitions("conv_id", "part", "kind", "seq").mapInArrow(run, schema)


def _solve(rows: DataFrame, turns: bool) -> tuple[Scratch, DataFrame, DataFrame, DataFrame]:
    """Scratch, finished conversations, slices and rows of cut ones."""
    tmp = Scratch(rows.sparkSession, "conversations")
    if "copies" not in rows.columns:
        rows = rows.withColumn("copies", F.lit(1))
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    own = rows.select("conv_id", "turn", part("role"), part("text"), "copies")
    parts = tmp.save(_segments(_prepared(own), turns), "segments")
    slices = tmp.save(_chain(parts.where("kind = 0 and paths is not null")), "slices")
    return tmp, parts.where("kind = 0 and paths is null"), slices, parts.where("kind = 1")


def repair(rows: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, digest``.

    ``rows`` has ``conv_id, turn, role, text`` and may have ``copies`` (a row
    stands for so many equal ones); other columns are ignored, a null role or
    text is one blank, a null ``conv_id`` is a conversation of its own.  Rows
    are taken by turn, nulls first; rows of one turn by role, then by a hash
    of the text.  A row's first fault counts: blank (nothing but white space),
    duplicate (role and text seen earlier), truncated (its last character that
    is no white space is none of ``.!?``).  ``gaps`` are the turn numbers
    missing between least and largest, ``illegal`` the neighbours that are not
    system-user, user-assistant or assistant-user by their initials, both
    before repair.  ``digest`` is the SHA-256 of the repaired ``role:text``
    lines.  Conversations of ``conv_ids`` without rows have zeros, an empty
    audit and the empty digest.  An empty table gives no rows.
    """
    _, done, slices, cut = _solve(rows, False)
    gaps = F.coalesce(F.col("turn_hi") - F.col("turn_lo") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps")
    cols = ["blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest"]
    # a cut conversation's audit is one value of the result: its slices in order
    whole = (slices.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "slice"))), lambda x: x["slice"]), "").alias("audit"),
        *[F.max(c).alias(c) for c in [*_STATS, "cost"]]))
    digests = _replayed(slices, cut, True).withColumnRenamed("conv_id", "_c")
    whole = whole.join(digests, F.col("conv_id").eqNullSafe(F.col("_c"))).select("conv_id", gaps, *cols)
    out = done.select("conv_id", gaps, *cols).union(whole)
    if conv_ids is None:
        return out
    every = conv_ids.select(F.col("conv_id").alias("_c")).distinct()
    zero = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    zero |= {"audit": F.lit(""), "digest": F.lit(hashlib.sha256().hexdigest())}
    return (every.join(out, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
                 .select(F.col("_c").alias("conv_id"), *[F.coalesce(c, z).alias(c) for c, z in zero.items()]))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, part, place, role, text``: the repaired conversations, in the
    order of (part, place) within each; see ``repair`` for ``rows``."""
    _, done, slices, cut = _solve(rows, True)
    own = done.select("conv_id", "part", F.posexplode("turns").alias("place", "t")).select("conv_id", "part", F.col("place").cast("long").alias("place"), "t.role", "t.text")
    return own.union(_replayed(slices, cut, False))


def n_edits(audit_text: Column) -> Column:
    """Edits of an audit other than Keep."""
    return F.char_length(F.translate(audit_text, "K", ""))
