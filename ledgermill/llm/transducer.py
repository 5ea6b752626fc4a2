"""Token counts by a deterministic transducer compiled from a byte-level BPE with word ends.

Compilation.  The encoding of a prefix ends in one token t, and what stands before t is the
encoding of the shorter prefix; t fits behind that encoding's last token a if and only if the
string a + t encodes to exactly [a, t].  So a position only needs, for each earlier position from
which some token of the vocabulary can still reach over it, the place in the trie of tokens, the
last token there and the count relative to here.  That tuple is a state; there are finitely many
whatever the text.  A transition on a byte (or on a word's last byte) is annotated with the change
of the count.  States and transitions are determinised as they are first met and kept in dense
tables; beyond STATES states the tables start anew, which changes no result.

Running.  A batch's words become one string of symbols, cut into chunks behind word ends where one
is near, else within a word.  All chunks step together through the tables, from the start state at
first.  A chunk that begins inside a word gets a map instead of one run: from every state that the
batch has been in behind the same WINDOW symbols, its possible entries, to the exit it leads to.  The
maps of a long word compose by a parallel prefix scan: maps over one chunk give those over two, four,
eight, and with each doubling twice as many chunks know their entry from the word's beginning.  They
run once more from these entries.  Should an entry have been none of the possible ones, what its
predecessor leaves is checked and the chunk run again until all agree.

Defined results: a null or empty text has no tokens; special strings inside a text count one each,
as in the library; any length of text or word is counted whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.common import slices

#: States kept by a worker; at 128 different symbols their tables take 80 MB.
STATES = 120_000
#: Largest number of tokens below a trie node for which those that fit are listed in the state.
LISTED = 48
#: Symbols that are run at once (a longer word is run whole), so that tables can start anew in between.
SEGMENT = 1 << 19
#: Symbols of a chunk, and those before it that tell its possible entries (a power of two).
CHUNK, WINDOW = 256, 32
LAST = 256  # added to a byte that ends a word
SPACE, LETTER, NUMBER, OTHER = range(4)
#: Fixed code points with the property White_Space.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
          0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Space, letter, number or other, by code point."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)],
                   np.uint8)
    out[_WHITE] = SPACE
    return out


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        letter = byte_letters()
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]))
        added = {t["content"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if t not in added}
        self.symbols: dict[int, tuple] = {}
        for token, i in vocab.items():
            last = token.endswith(end)
            body = [letter[c] for c in (token[:-len(end)] if last else token)]
            if last and body:
                body[-1] += LAST
            self.symbols[i] = tuple(body)
        self.single = {s[0]: i for i, s in self.symbols.items() if len(s) == 1}
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b])
                       for rank, (a, b) in enumerate(map(tuple, model["merges"]))}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for (a, b), (rank, whole) in self.merges.items():
            if whole in self.parts:
                rank, a, b = self._last_merge(whole)
            self.parts[whole] = (rank, a, b)
        self.child: dict[tuple[int, int], int] = {}
        self.token_at, self.inner = [-1], [True]
        for i, body in self.symbols.items():
            node = 0
            for s in body:
                self.inner[node] = True
                nxt = self.child.get((node, s))
                if nxt is None:
                    nxt = self.child[(node, s)] = len(self.token_at)
                    self.token_at.append(-1), self.inner.append(False)
                node = nxt
            if body:
                self.token_at[node] = i
        self.below: list[tuple | None] = [()] * len(self.token_at)
        parent = {c: n for (n, _), c in self.child.items()}
        for node in range(len(self.token_at) - 1, -1, -1):  # children come after their parent
            own, up = self.below[node], parent.get(node)
            if self.token_at[node] >= 0 and own is not None:
                whole = (*own, self.token_at[node])
            else:
                whole = own
            if up is not None:
                sofar = self.below[up]
                joint = None if sofar is None or whole is None else (*sofar, *whole)
                self.below[up] = joint if joint is None or len(joint) <= LISTED else None
        self.fit: dict[tuple, bool] = {}
        self.forget()

    def forget(self):
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.column = np.zeros(2 * LAST, np.int32)  # 0: a symbol not met so far
        self.columns = 1
        self.next = np.full((1024, 32), -1, np.int32)
        self.emit = np.zeros((1024, 32), np.int8)
        self._state(((0, -1, 0),))

    # Compilation

    def plain(self, symbols, once: list[int] | None = None) -> list[int]:
        """Merge by rank, leftmost first; for single tokens, so short.  One merge of `once` only."""
        ids = list(once) if once else [self.single[s] for s in symbols]
        while len(ids) > 1:
            found = [(self.merges[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
            if not found:
                break
            (_, merged), i = min(found, key=lambda x: (x[0][0], x[1]))
            ids[i:i + 2] = [merged]
            if once:
                break
        return ids

    def _last_merge(self, token: int) -> tuple[int, int, int]:
        """The merge that completes a token which several merges could."""
        ids = [self.single[s] for s in self.symbols[token]]
        while len(ids) > 2:
            shorter = self.plain(self.symbols[token], once=ids)
            if len(shorter) == len(ids):
                break
            ids = shorter
        return (self.merges[tuple(ids)][0], *ids) if len(ids) == 2 else (-1, token, token)

    def fits(self, before: int, token: int) -> bool:
        """Whether `token` can follow `before`: no merge over the border comes first.

        Time is the rank of merges.  Going back in time, both sides fall apart merge by merge; a
        pair that meets at the border would merge if its rank is below that of the merge that takes
        up its left part, and not above that of the one that takes up its right part.
        """
        key = (before, token)
        known = self.fit.get(key)
        if known is not None:
            return known
        if len(self.fit) > 1_000_000:
            self.fit.clear()
        if before < 0:
            answer = self.plain(self.symbols[token]) == [token]
        else:
            a, b, end_a, end_b, answer = before, token, 1 << 40, 1 << 40, None
            while answer is None:
                rank = self.merges.get((a, b), (1 << 41,))[0]
                if rank < end_a and rank <= end_b:
                    answer = False
                    break
                rank_a, _, right = self.parts.get(a, (-1, 0, 0))
                rank_b, left, _ = self.parts.get(b, (-1, 0, 0))
                if rank_a < 0 and rank_b < 0:
                    answer = True
                elif rank_a > rank_b:
                    end_a, a = rank_a, right
                else:
                    end_b, b = rank_b, left
        self.fit[key] = answer
        return answer

    def _state(self, key: tuple) -> int:
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.states)
            self.states.append(key)
            if n == len(self.next):
                self._grow(n // 2, 0)
        return n

    def _grow(self, rows: int, columns: int):
        self.next = np.pad(self.next, ((0, rows), (0, columns)), constant_values=-1)
        self.emit = np.pad(self.emit, ((0, rows), (0, columns)))

    def _columns(self, symbols: np.ndarray) -> np.ndarray:
        new = np.flatnonzero((np.bincount(symbols, minlength=2 * LAST) > 0) & (self.column == 0))
        self.column[new] = self.columns + np.arange(len(new))
        self.columns += len(new)
        if self.columns > self.next.shape[1]:
            self._grow(0, self.columns + 15 - self.next.shape[1])
        return self.column[symbols]

    def _entry(self, node: int, before, rel: int):
        """What a place in the trie needs for the future; None if no token below it can follow.

        Before few tokens only which of them fit counts, so last tokens that agree on these share
        a state.
        """
        below = self.below[node]
        if below is not None:
            before = tuple(t for t in below if (
                t in before if isinstance(before, tuple) else self.fits(before, t)))
            if not before:
                return None
        return node, before, rel

    def compile(self, state: int, symbol: int):
        """Add the transition of `state` on `symbol`."""
        won, reach = None, []
        for node, before, rel in self.states[state]:
            node = self.child.get((node, symbol))
            if node is None:
                continue
            token = self.token_at[node]
            if won is None and token >= 0 and (
                    token in before if isinstance(before, tuple) else self.fits(before, token)):
                won = (token, rel + 1)
            if self.inner[node] and symbol < LAST:
                reach.append(self._entry(node, before, rel))
        token, change = won
        key = ((0, -1, 0),) if symbol >= LAST else (
            *((e[0], e[1], e[2] - change) for e in reach if e), (0, token, 0))
        target, column = self._state(key), self.column[symbol]
        self.next[state, column], self.emit[state, column] = target, change

    # Running

    def steps(self, symbols: np.ndarray, columns: np.ndarray, start: np.ndarray, size: np.ndarray,
              entry: np.ndarray, out: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
        """Run chunks from their entry states; returns exit states.

        Emissions go to `out` by place, and the states behind the symbols to `seen`.
        """
        self.rounds += 1
        order = np.argsort(-size, kind="stable")
        start, size, state = start[order], size[order], entry[order]
        live = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        for k, n in enumerate(live):
            at = start[:n] + k
            s, col = state[:n], columns[at]
            to = self.next[s, col]
            if to.min() < 0:
                miss = to < 0
                for pair in np.unique(s[miss] * np.int64(2 * LAST) + symbols[at[miss]]).tolist():
                    self.compile(*divmod(pair, 2 * LAST))
                to = self.next[s, col]
            out[at] = self.emit[s, col]
            if seen is not None:
                seen[at] = to
            state[:n] = to
        exits = np.empty_like(state)
        exits[order] = state
        return exits

    def scanned(self, symbols, columns, start, size, inner, seen) -> np.ndarray:
        """Entry states of all chunks by maps over possible entries and a prefix scan; 0 where one is unknown."""
        entry = np.zeros(len(start), np.int32)
        within = inner | np.append(inner[1:], False)  # chunks of words that were cut
        place = np.arange(size[within].sum()) + np.repeat(
            start[within] - np.cumsum(size[within]) + size[within], size[within])
        code = symbols.astype(np.uint64) + np.uint64(1)
        width = 1
        while width < WINDOW:  # of the last `width` symbols, then of twice as many
            code[width:] = code[width:] * np.uint64(0x9E3779B97F4A7C15) ^ (code[:-width] * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(7))
            width *= 2
        # the pairs (code, state) that occur, and for each chunk inside a word those of the code before it
        order = np.lexsort((seen[place], code[place]))
        codes, states = code[place][order], seen[place][order]
        new = np.append(True, (codes[1:] != codes[:-1]) | (states[1:] != states[:-1]))
        codes, states = codes[new], states[new]
        chunk = np.flatnonzero(within)
        before = code[np.maximum(start[chunk] - 1, 0)]
        low, high = np.searchsorted(codes, before, "left"), np.searchsorted(codes, before, "right")
        head = ~inner[chunk]
        n = np.where(head, 1, high - low)
        first = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(chunk)), n)
        pick = np.arange(n.sum()) - first[owner]
        come = np.where(head[owner], 0, states[np.minimum(low[owner] + pick, len(states) - 1)]).astype(np.int32)
        leave = self.steps(symbols, columns, start[chunk][owner], size[chunk][owner], come, np.zeros(len(symbols), np.int8))
        # a pair leads to the pair of the next chunk whose entry it leaves; -1 if there is none
        key = owner.astype(np.int64) << 32 | come
        goal = (owner.astype(np.int64) + 1) << 32 | leave
        at = np.minimum(np.searchsorted(key, goal), len(key) - 1)
        jump = np.where(key[at] == goal, at, -1)
        step = np.arange(len(chunk)) - np.maximum.accumulate(np.where(head, np.arange(len(chunk)), 0))
        found = np.where(head, first, -1)
        width = 1
        while width <= step.max(initial=0):
            reach = np.flatnonzero((step >= width) & (step < 2 * width))
            back = found[reach - width]
            found[reach] = np.where(back >= 0, jump[back], -1)
            jump = np.where(jump >= 0, jump[jump], -1)
            width *= 2
        known = found >= 0
        entry[chunk[known]] = come[found[known]]
        return entry

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        """Change of the count at each symbol, by segments that end with a word."""
        ends = np.flatnonzero(symbols >= LAST) + 1
        at = np.searchsorted(ends, np.arange(SEGMENT, len(symbols), SEGMENT))
        cuts = np.unique(np.concatenate([[0], ends[at[at < len(ends)]], [len(symbols)]]))
        parts = [self._segment(symbols[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        return np.concatenate(parts) if parts else np.zeros(0, np.int8)

    def _segment(self, symbols: np.ndarray) -> np.ndarray:
        n = len(symbols)
        out = np.zeros(n, np.int8)
        if not n:
            return out
        if len(self.states) > STATES:
            self.forget()
        columns = self._columns(symbols)
        ends = np.flatnonzero(symbols >= LAST) + 1
        marks = np.arange(CHUNK, n, CHUNK)
        near = np.append(ends, n + CHUNK)[np.searchsorted(ends, marks)]
        cuts = np.unique(np.concatenate([[0], np.where(near < marks + CHUNK, near, marks), [n]]))
        start, size = cuts[:-1], np.diff(cuts)
        entry = np.zeros(len(start), np.int32)
        inner = np.append(False, symbols[start[1:] - 1] < LAST)
        seen = np.zeros(n, np.int32) if inner.any() else None
        self.rounds = 0
        exits = self.steps(symbols, columns, start, size, entry, out, seen)
        if seen is not None:
            entry = self.scanned(symbols, columns, start, size, inner, seen)
            redo = np.flatnonzero(entry)
            exits[redo] = self.steps(symbols, columns, start[redo], size[redo], entry[redo], out)
        while True:
            come = np.concatenate([[0], exits[:-1]]).astype(np.int32)
            redo = np.flatnonzero(come != entry)
            if not len(redo):
                return out
            entry[redo] = come[redo]
            exits[redo] = self.steps(symbols, columns, start[redo], size[redo], entry[redo], out)

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text."""
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if not text:
                continue
            pieces = self.special.split(text) if "<|" in text else [text]
            extra[i] = len(pieces) - 1
            for piece in pieces:
                if not piece.isascii():
                    piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
                parts.append(piece.lower())
                owner.append(i)
        if not parts:
            return extra
        symbols, ends = words(parts)
        total = np.concatenate([[0], np.cumsum(self.emissions(symbols), dtype=np.int64)])[ends]
        np.add.at(extra, np.array(owner), np.diff(total, prepend=0))
        return extra


def words(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words of lower-cased texts, and how many of them each text's end has before it.

    Words are contractions, runs of letters, single numbers and runs of the rest.
    """
    text = " ".join(parts) + " "
    point = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = classes()[point]
    final = np.append(kind[1:] != kind[:-1], True) | (kind == NUMBER)
    quote = np.flatnonzero(point[:-1] == 39)
    quote = quote[(quote == 0) | (kind[np.maximum(quote, 1) - 1] != OTHER)]
    one, two = point[quote + 1], point[np.minimum(quote + 2, len(point) - 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    for at, n in ((quote[short], 1), (quote[long & ~short], 2)):
        final[at] = False
        final[at + n] = True
    width = 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)
    keep = kind != SPACE
    symbols = np.frombuffer(text.encode(), np.uint8).astype(np.int16)
    symbols[np.cumsum(width)[final & keep] - 1] += LAST
    symbols = symbols[np.repeat(keep, width)]
    before = np.concatenate([[0], np.cumsum(width * keep)])
    ends = np.cumsum([len(p) + 1 for p in parts])
    return symbols, before[ends]


@lru_cache(maxsize=1)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens",
                 keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) and `out`, the number of tokens of the whole text."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != out]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(out, T.LongType())])

    def run(batches):
        machine = transducer(path)
        for batch in batches:
            column, rest = batch.column("x8_text"), batch.select(kept)
            for a, b in slices(pc.fill_null(pc.utf8_length(column), 0).to_numpy()):
                counts = pa.array(machine.count(column.slice(a, b - a).to_pylist()))
                yield pa.RecordBatch.from_arrays([*rest.slice(a, b - a).columns, counts], [*kept, out])

    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("x8_text"))
    return source.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: bytes and tokens of every document."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "text",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    counted = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"),
                           keep=["doc_id", "n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)
