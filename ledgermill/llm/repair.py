"""Repair of conversation structure by dynamic programming over grammar-compressed symbol sequences.

A row's symbol is the initial of its role and its fault.  Of the sequences of many conversations
Re-Pair makes one grammar: the most frequent pair of neighbours becomes a rule, over and over.  Each
symbol has a transfer matrix of cheapest costs between the four states of the role grammar
`(s?(ua)+)?`, with the inserts before its row; a rule's matrix is the min-plus product of its two
parts, made once, bottom-up, and used wherever the rule occurs.  An entry's audit is a rope, a pair of
the ropes below it.

Ties take the least audit without comparing ropes.  Two cheapest audits of the same rows from one
state differ in some place where both go on: one that continued the other could only add inserts,
and they cost.  So an entry needs only its rank among the entries of its row, and the ranks of a
product follow from those of its parts.

Conversations are cut by range of (conversation, turn) into partitions and into chunks of at most
CHUNK rows and one more, so that a very long conversation is worked on by many tasks.  Chunks hold
no text.  Their matrices and audits then meet the texts in one task for each conversation, which
streams: SHA-256 has to read a conversation's rows one after the other.  It holds the matrices, one
chunk's audits and the audit that it returns.

Defined results: null roles and texts count as one blank; rows of a null id are one conversation; rows
of the same turn follow each other by a hash of role and text, so equal ones are neighbours; a
conversation without rows has zeros, an empty audit and the hash of the empty string; an empty table
gives an empty table.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import SPACES, settle

#: Symbols of a chunk; pairs that make a rule; sequences that a worker remembers.
CHUNK, PAIRS, MEMO = 1 << 16, 4, 1 << 15
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, behind system, behind user, behind assistant.
_USER, _ASSISTANT = {0: 2, 1: 2, 3: 2}, {2: 3}
_KEEP = {"s": {0: 1}, "u": _USER, "a": _ASSISTANT, "x": {}}
#: Numbers of the roles' initials, and of a symbol: initial, plus 4 if truncated; 8 must go.
INITIALS, GONE = "suax", 8


def _closed(state: int) -> list[tuple[int, int]]:
    """(state, inserts) that inserts lead to, fewest first."""
    out = [(state, 0)]
    for n in (1, 2):
        last = out[-1][0]
        out.append((_ASSISTANT[2] if last == 2 else _USER[last], n))
    return out


def _terminal(symbol: int) -> list[list[tuple]]:
    """For each state the entries (state behind it, cost, rank, audit) of one row and the inserts before it."""
    out = []
    for p in range(4):
        best = {}
        for q, n in _closed(p):
            ways = [(q, DELETE, b"D")]
            if symbol != GONE:
                more = TRUNCATED if symbol >= 4 else 0
                ways += [(t, more, b"K") for s, t in _KEEP[INITIALS[symbol % 4]].items() if s == q]
                ways += [(t, more + REROLE, b"R") for s, t in (*_USER.items(), *_ASSISTANT.items()) if s == q]
            for r, cost, letter in ways:
                best[r] = min(best.get(r, (1 << 60, b"")), (cost + n * INSERT, b"I" * n + letter))
        order = sorted(best, key=lambda r: best[r][1])
        out.append([(r, best[r][0], k, best[r][1]) for k, r in enumerate(order)])
    return out


TERMINALS = [_terminal(s) for s in range(GONE + 1)]


def product(left: list[list[tuple]], right: list[list[tuple]]) -> list[list[tuple]]:
    """The min-plus product of two matrices, least audits first among equal costs."""
    out = []
    for row in left:
        best = {}
        for q, c1, k1, a in row:
            for r, c2, k2, b in right[q]:
                old = best.get(r)
                if old is None or (c1 + c2, k1) < old[:2]:
                    best[r] = (c1 + c2, k1, k2, (a, b))
        order = sorted(best, key=lambda r: best[r][1:3])
        out.append([(r, best[r][0], k, best[r][3]) for k, r in enumerate(order)])
    return out


def flat(rope) -> bytes:
    """The string of a rope."""
    out, todo = [], [rope]
    while todo:
        part = todo.pop()
        if isinstance(part, bytes):
            out.append(part)
        else:
            todo += (part[1], part[0])
    return b"".join(out)


def repair_pairs(sequences: list[np.ndarray], symbols: int = GONE + 1) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """(rules, sequences with the rules put in): Re-Pair down to pairs that occur PAIRS times."""
    if not sequences:
        return [], []
    text = np.concatenate([np.append(s.astype(np.int64), -1) for s in sequences])
    rules, banned = [], np.zeros(0, np.int64)
    while True:
        size = symbols + len(rules) + 1
        codes = text[:-1] * size + text[1:]
        found, n = np.unique(codes[(text[:-1] >= 0) & (text[1:] >= 0)], return_counts=True)
        n[np.isin(found, [a * size + b for a, b in banned])] = 0
        if not len(n) or n.max() < PAIRS:
            break
        pair = found[n.argmax()]
        a, b = divmod(int(pair), size)
        at = np.flatnonzero(codes == pair)
        if a == b:  # in a run every second one
            first = np.append(True, np.diff(at) > 1)
            start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
            if len(at) < PAIRS:
                banned = np.append(banned.reshape(-1, 2), [[a, b]], 0)
                continue
        text[at] = size - 1
        text = np.delete(text, at + 1)
        rules.append((a, b))
    ends = np.flatnonzero(text < 0)
    return rules, [text[a:b] for a, b in zip(np.append(0, ends[:-1] + 1), ends)]


def matrices(sequences: list[np.ndarray]) -> list[list[list[tuple]]]:
    """The transfer matrix of each sequence, over one grammar of all."""
    rules, rest = repair_pairs(sequences)
    made = list(TERMINALS)
    for a, b in rules:
        made.append(product(made[a], made[b]))
    out = []
    for seq in rest:
        parts = [made[s] for s in seq]
        while len(parts) > 1:  # neighbours in turn, so that a long rest is no deep rope
            parts = [product(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        out.append(parts[0])
    return out


def best_end(row: list[tuple]) -> tuple[int, object, int]:
    """(cost, rope, inserts behind the last row) of the cheapest way from the first state to an end."""
    need = {0: 0, 1: 2, 2: 1, 3: 0}
    cost, _, rope, n = min((c + need[q] * INSERT, k, a, need[q]) for q, c, k, a in row)
    return cost, rope, n


# Rows


def damaged(rows: DataFrame) -> DataFrame:
    """Damage by checksum of id and turn: dropped, emptied, cut off, repeated, or given to the user."""
    said = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text = F.coalesce("text", F.lit(" "))
    hit = rows.withColumn("x13_hit", F.crc32(said.cast("binary")) % 20).where("x13_hit <> 0")
    return hit.select(
        "conv_id", "turn",
        F.when(F.col("x13_hit") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("x13_hit") == 1, "").when(F.col("x13_hit") == 2, F.translate(text, ".!?", ""))
        .otherwise(text).alias("text"),
        F.explode(F.when(F.col("x13_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("copy")).drop("copy")


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with the hashes that order rows of a turn and tell equal ones."""
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.xxhash64("role", "text").alias("h1"),
                       F.xxhash64("text", F.lit(1), "role").alias("h2"), "role", "text")


def symbols(rows: DataFrame) -> DataFrame:
    """One narrow row for each different (conversation, turn, role, text), with their number `n`.

    `initial` is its role's, `fault` 0 none, 1 blank, 2 truncated, and `new` whether the role and text
    are new to the conversation.  More than CHUNK equal rows are dealt to several `part`s.
    """
    end = F.rtrim("text", F.lit(SPACES))
    fault = F.when(end == "", 1).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), 2).otherwise(0)
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = settle(rows.select("conv_id", "turn", "h1", "h2", number.alias("initial"), fault.alias("fault"))
                    .groupBy("conv_id", "turn", "h1", "h2", "initial", "fault").agg(F.count("*").alias("n")),
                    "repair-rows")
    turn = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    again = (narrow.groupBy("conv_id", "h1", "h2").agg(F.min(turn).alias("first"), F.count("*").alias("m"))
             .where("m > 1").select(F.col("conv_id").alias("c"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    marked = narrow.join(again, same, "left").withColumn("new", F.col("first").isNull() | (F.col("first") == turn))
    part = F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {CHUNK}")))
    return (marked.withColumn("part", part)
            .select("conv_id", "turn", "h1", "h2", "part", "initial", "fault",
                    (F.col("new") & (F.col("part") == 0)).alias("new"),
                    F.least(F.lit(CHUNK), F.col("n") - F.col("part") * CHUNK).cast("int").alias("n")))


def _chunk(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, list[int | None]]:
    """(symbols, figures) of neighbouring narrow rows of one conversation.

    The figures are blank, duplicate, truncated and illegal, different turns, first and last initial,
    and the least turn.
    """
    n, new, fault = rows["n"], rows["new"], rows["fault"]
    first = np.where((fault == 1) | ~new, GONE, rows["initial"] + 4 * (fault == 2))
    seq = np.full(n.sum(), GONE, np.uint8)
    seq[np.cumsum(n) - n] = first
    initial = np.repeat(rows["initial"], n)
    pair = initial[:-1] * 4 + initial[1:]
    legal = (pair == 1) | (pair == 6) | (pair == 9)  # su, ua, au
    some = rows["some"]
    turns = np.flatnonzero(some)
    different = int(len(turns) > 0) + int((np.diff(rows["turn"][turns]) != 0).sum())
    other = fault != 1
    return seq, [int(n[~other].sum()), int((n - new)[other].sum()), int(((fault == 2) & new).sum()),
                 int((~legal).sum()), different, int(initial[0]), int(initial[-1]),
                 int(rows["turn"][turns[0]]) if len(turns) else None]


def chunks(narrow: DataFrame) -> DataFrame:
    """One row for each chunk: its first key, figures, and the entries of its matrix with their audits."""
    kind = narrow.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "h1", "h2", "part"]
    names = ("conv_id", "turn", "h1", "h2", "part", "last_turn", "figures", "entries", "audits")

    def run(batches):
        memo: dict[bytes, list] = {}

        def made(todo):
            keys = [seq.tobytes() for _, seq, _ in todo]
            fresh = list(dict.fromkeys(k for k in keys if k not in memo))
            if len(memo) + len(fresh) > MEMO:
                memo.clear()
                fresh = list(dict.fromkeys(keys))
            memo.update(zip(fresh, matrices([np.frombuffer(k, np.uint8) for k in fresh])))
            out = [[] for _ in names]
            for (key, _, figures), k in zip(todo, keys):
                cells = [(p, q, c, r, a) for p, row in enumerate(memo[k]) for q, c, r, a in row]
                for column, value in zip(out, (*key, figures, [x for c in cells for x in c[:4]],
                                               [flat(c[4]).decode() for c in cells])):
                    column.append(value)
            kinds = (conv_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                     pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], names)

        def cut(table, whole):
            """Split off the complete chunks of the table; returns (them, the rows that are left)."""
            conv = table.column("conv_id").combine_chunks()
            ids = conv.dictionary_encode(null_encoding="encode").indices.to_numpy()
            turn = table.column("turn")
            rows = {"turn": turn.fill_null(0).to_numpy(), "some": ~turn.is_null().to_numpy(),
                    **{c: table.column(c).to_numpy() for c in ("initial", "fault", "n")},
                    "new": table.column("new").to_numpy()}
            todo, start, size, total = [], 0, 0, len(ids)
            for i, (mine, n) in enumerate(zip(ids.tolist(), rows["n"].tolist())):
                size += n
                last = i + 1 == total
                if (last and whole) or (not last and ids[i + 1] != mine) or size >= CHUNK:
                    seq, figures = _chunk({k: v[start:i + 1] for k, v in rows.items()})
                    key = [conv[start].as_py(), turn[start].as_py(), *(table.column(c)[start].as_py() for c in order[2:]),
                           turn[i].as_py()]
                    todo.append((key, seq, figures))
                    start, size = i + 1, 0
            return todo, table.slice(start)

        rest, conv_type = None, None
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            todo, rest = cut(table.combine_chunks(), False)
            if todo:
                yield made(todo)
        if rest is not None and len(rest):
            yield made(cut(rest.combine_chunks(), True)[0])

    sorted_ = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_.mapInArrow(run, f"conv_id {kind}, turn long, h1 long, h2 long, part long, last_turn long, "
                                   "figures array<long>, entries array<long>, audits array<string>")


# Conversations


class Conversation:
    """One conversation as its rows arrive: the chunks' matrices, then audits and texts in order."""

    def __init__(self, conv_id):
        self.id, self.row, self.figures = conv_id, [(0, 0, 0, b"")], [0] * 4
        self.turns = self.chunks = 0
        self.least = self.most = self.last = None
        self.ways = None
        self.audit, self.letters, self.state = [], deque(), 0
        self.digest, self.started = hashlib.sha256(), False

    def matrix(self, turn, last_turn, figures, entries) -> None:
        self.figures = [a + b for a, b in zip(self.figures, figures)]
        first, last, least = figures[5:]
        if self.chunks and (self.last_initial, first) not in ((0, 1), (1, 2), (2, 1)):
            self.figures[3] += 1
        self.turns += figures[4] - int(self.chunks > 0 and turn is not None and turn == self.last)
        self.chunks, self.last_initial, self.last = self.chunks + 1, last, last_turn
        self.least = least if self.least is None else self.least
        self.most = self.most if last_turn is None else last_turn
        table = [[] for _ in range(4)]
        for p, q, cost, rank in zip(*(entries[i::4] for i in range(4))):
            table[p].append((q, cost, rank, b"%d%d" % (p, q)))
        self.row = product([self.row], table)[0]

    def _choose(self) -> None:
        self.cost, rope, self.inserts = best_end(self.row)
        ways = flat(rope)
        self.ways = deque((ways[i] - 48, ways[i + 1] - 48) for i in range(0, len(ways), 2))

    def audits(self, entries, audits) -> None:
        if self.ways is None:
            self._choose()
        way = self.ways.popleft()
        found = next(a for a, p, q in zip(audits, entries[0::4], entries[1::4]) if (p, q) == way)
        self.audit.append(found)
        self.letters.append(iter(found))

    def _letter(self) -> str:
        while True:
            letter = next(self.letters[0], None)
            if letter is not None:
                return letter
            self.letters.popleft()

    def _say(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.started else ''}{role}:{text}".encode())
        self.started = True

    def _next(self) -> str:
        self.state = 3 if self.state == 2 else 2
        return "assistant" if self.state == 3 else "user"

    def text(self, role: str, text: str) -> None:
        while True:
            letter = self._letter()
            if letter == "I":
                self._say(self._next(), "")
                continue
            if letter == "R":
                self._say(self._next(), text)
            elif letter == "K":
                self.state = 1 if role[:1] == "s" else 2 if role[:1] == "u" else 3
                self._say(role, text)
            return

    def result(self) -> tuple:
        if self.ways is None:
            self._choose()
        for _ in range(self.inserts):
            self._say(self._next(), "")
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return (self.id, gaps, *self.figures[:4], self.cost, "".join(self.audit) + "I" * self.inserts,
                self.digest.hexdigest())


def repaired(rows: DataFrame, every: DataFrame) -> DataFrame:
    """One row for each conversation of `every`: figures, cost, audit and digest of the repaired rows."""
    spark, kind = rows.sparkSession, rows.schema["conv_id"].dataType.simpleString()
    rows = keyed(rows)
    made = settle(chunks(symbols(rows)), "repair-chunks")
    key = ["turn", "h1", "h2"]

    def shaped(df, phase, sub, **given):
        columns = {"conv_id": kind, "turn": "long", "h1": "long", "h2": "long", "part": "long", "last_turn": "long",
                   "figures": "array<long>", "entries": "array<long>", "audits": "array<string>",
                   "role": "string", "text": "string"}
        return df.select(*[(F.col(c) if given.get(c, c in df.columns) else F.lit(None).cast(t)).alias(c)
                           for c, t in columns.items()], F.lit(phase).alias("phase"), F.lit(sub).alias("sub"))

    # phase 0: that the conversation exists; 1: its matrices; 2: audits, each before its first text
    all_rows = (shaped(every.select("conv_id").distinct(), 0, 0).unionByName(shaped(made, 1, 0, audits=False))
                .unionByName(shaped(made, 2, 0, figures=False)).unionByName(shaped(rows, 2, 1)))
    ordered = all_rows.repartition("conv_id").sortWithinPartitions("conv_id", "phase", *key, "sub", "part")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches):
        now = None

        def table(done, conv_type):
            kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done), kinds)], names)

        conv_type = None
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            done = []
            wanted = ("conv_id", "phase", "sub", "turn", "last_turn", "figures", "entries", "audits", "role", "text")
            for conv, phase, sub, turn, last, figures, entries, audits, role, text in zip(
                    *(batch.column(c).to_pylist() for c in wanted)):
                if phase == 0:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(conv)
                elif phase == 1:
                    now.matrix(turn, last, figures, entries)
                elif sub == 0:
                    now.audits(entries, audits)
                else:
                    now.text(role, text)
            if done:
                yield table(done, conv_type)
        if now is not None:
            yield table([now.result()], conv_type)

    return ordered.mapInArrow(run, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, "
                                   "illegal long, cost long, audit string, repaired_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    """op13: repairs of all conversations after damage."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repaired(damaged(rows), rows)
