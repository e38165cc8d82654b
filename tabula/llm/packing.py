"""Sequence packing by minimum bin slack.

Documents are tokenised once; token ids and, per task, running counts are
written to a table.  Whole windows of a long document are sequences of their
own.  The remaining lengths (1 to capacity - 1) are counted: this histogram,
at most capacity - 1 numbers whatever the corpus, is all the driver sees.

Plan, on the histogram: each bin takes the largest remaining length, then a
subset-sum over bitsets (one integer, bit s set if a sum s can be reached) of
the remaining multiset finds the filling closest to capacity; backtracking
through the bitsets gives how often each length is used.  Slack that is left is
closed by cutting a piece off another document; its rest is a new length.  The
pattern is applied as often as the counts last, so there are few patterns even
for very many bins, and only the last bin of all can have slack.

Placement is arithmetic: a remainder's rank among those of equal length (rank
in its task plus the counts of earlier tasks) says which use of which pattern
it fills.

Ids are those of the ``tokenizers`` file; its rank file gives the same ids and
is what tasks load.  As by that file, the name of one of its added tokens in a text is that token.

Defined results: a null text is empty and has the end id only; repeated rows
are packed each; a null doc_id passes through; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tabula.llm.common import maybe_broadcast, written

CAPACITY = 2048
END_ID = 1
#: Whitespace other than single blanks and line ends between words.
_ODD = re.compile(r"[^\S \n]|[ \n][ \n]")
_FULL_SHIFT = 33
KEPT = 32                        # characters of the pieces that are remembered


class PieceCache(dict):
    """Blank-separated piece -> its ids as bytes; every piece is cut off where the
    tokenizer's own pattern also cuts, so its ids don't depend on its neighbours.  Long pieces are not kept."""

    def __init__(self, encode, prefix: str, most: int = 400_000):
        super().__init__()
        self.encode, self.prefix, self.most = encode, prefix, most

    def __missing__(self, piece: str) -> bytes:
        value = np.array(self.encode(self.prefix + piece), np.uint16).tobytes()
        if len(piece) <= KEPT:
            if len(self) >= self.most:
                self.clear()
            self[piece] = value
        return value


@lru_cache(maxsize=2)
def encoding(ranks_path: str, pattern: str):
    """A process's one tiktoken encoding of a rank file (they take tens of MB)."""
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if max(ranks.values()) >= 1 << 16:
        raise ValueError("ids of more than 16 bits")
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Text -> token ids as little-endian 16-bit integers."""

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int] | None = None):
        """``added``: tokens that are cut out of a text before it is tokenised."""
        if max(added.values() if added else [0]) >= 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.added = {name: np.array([i], np.uint16).tobytes() for name, i in (added or {}).items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.encode = encoding(ranks_path, pattern).encode_ordinary
        self.first, self.inner = PieceCache(self.encode, ""), PieceCache(self.encode, " ")
        self.line_end = np.array(self.encode("\n"), np.uint16).tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if self.cut and self.cut.search(text):
            return b"".join(self.added[part] if i % 2 else self.plain(part) for i, part in enumerate(self.cut.split(text)))
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        if _ODD.search(text):
            return np.array(self.encode(text), np.uint16).tobytes()
        first, inner, lines = self.first.__getitem__, self.inner.__getitem__, []
        for line in text.split("\n"):
            pieces = line.split(" ")
            head = pieces[0]
            lines.append((first(head) if head else b"") + b"".join(map(inner, pieces[1:])))
        return self.line_end.join(lines)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(ranks_path: str, added: dict[str, int] | None = None) -> Encoder:
    key = ranks_path, tuple(sorted((added or {}).items()))
    if key not in _ENCODERS:
        import public_tokenizers
        _ENCODERS[key] = Encoder(ranks_path, public_tokenizers.PATTERN, added)
    return _ENCODERS[key]


def added_tokens(json_path: str) -> dict[str, int]:
    """Added tokens of a ``tokenizers`` file and their ids."""
    with open(json_path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """A multiset of the available lengths whose sum is as near to ``room`` as can be, not above."""
    reach, mask, goal = 1, (1 << (room + 1)) - 1, 1 << room
    steps: list[tuple[int, int, int]] = []                  # reach before, length, copies
    for length in sorted((x for x, n in counts.items() if n > 0 and x <= room), reverse=True):
        left, lot = min(counts[length], room // length), 1
        while left and not reach & goal:
            lot = min(lot, left)
            steps.append((reach, length, lot))
            reach |= (reach << (length * lot)) & mask
            left -= lot
            lot *= 2
        if reach & goal:
            break
    total, used = reach.bit_length() - 1, defaultdict(int)
    for before, length, lot in reversed(steps):
        if not before >> total & 1:                         # this lot was needed to get here
            used[length] += lot
            total -= length * lot
    return dict(used)


@dataclass
class Plan:
    """Uses of length classes: ranks start to end of a class fill ``uses`` places a bin from
    ``bin`` on, at ``offset``; ``then`` is the class of what a cut leaves (-1: nothing)."""

    bins: int = 0
    cls: list[int] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    uses: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    length: list[int] = field(default_factory=list)
    then: list[int] = field(default_factory=list)

    def add(self, **use: int) -> None:
        for name, value in use.items():
            getattr(self, name).append(value)

    def table(self) -> np.ndarray:
        """Rows sorted by (class, start)."""
        t = np.array([self.cls, self.start, self.uses, self.bin, self.offset, self.length, self.then], np.int64).T.reshape(-1, 7)
        return t[np.lexsort((t[:, 1], t[:, 0]))]


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Patterns for all remainders; class ids below ``capacity`` are the lengths themselves."""
    plan = Plan()
    left = {length: n for length, n in histogram.items() if n > 0}          # class -> not yet placed
    length_of = {c: c for c in left}
    used_up = defaultdict(int)                                              # class -> ranks already placed
    of_length: dict[int, set[int]] = defaultdict(set)
    for c in left:
        of_length[c].add(c)
    total = {length: n for length, n in left.items()}
    next_class = capacity
    while total:
        counts = dict(total)
        seed = max(counts)
        counts[seed] -= 1
        wanted = fill(counts, capacity - seed)
        wanted[seed] = wanted.get(seed, 0) + 1
        slack = capacity - sum(x * n for x, n in wanted.items())
        donor = max((x for x, n in total.items() if x > slack and n > wanted.get(x, 0)), default=0) if slack else 0
        # which classes stand for these lengths
        uses: dict[int, int] = {}
        for length, n in wanted.items():
            for c in sorted(of_length[length], key=lambda c: (-left[c], c)):
                take = min(n, left[c])
                uses[c] = uses.get(c, 0) + take
                n -= take
                if not n:
                    break
        cut = None
        if donor:
            cut = max((c for c in of_length[donor] if left[c] > uses.get(c, 0)), key=lambda c: (left[c] - uses.get(c, 0), -c))
        times = min(left[c] // (n + (c == cut)) for c, n in uses.items())
        if cut is not None:
            times = min(times, left[cut] // (uses.get(cut, 0) + 1))
        offset = 0
        for c, n in sorted(uses.items(), key=lambda x: (-length_of[x[0]], x[0])):
            plan.add(cls=c, start=used_up[c], uses=n, bin=plan.bins, offset=offset, length=length_of[c], then=-1)
            offset += n * length_of[c]
            used_up[c] += n * times
            left[c] -= n * times
        if cut is not None:
            plan.add(cls=cut, start=used_up[cut], uses=1, bin=plan.bins, offset=offset, length=slack, then=next_class)
            used_up[cut] += times
            left[cut] -= times
            rest = length_of[cut] - slack
            length_of[next_class], left[next_class] = rest, times
            of_length[rest].add(next_class)
            total[rest] = total.get(rest, 0) + times
            uses[cut] = uses.get(cut, 0)
            total[length_of[cut]] -= times
            next_class += 1
        for c, n in uses.items():
            total[length_of[c]] -= n * times
            if not left[c]:
                of_length[length_of[c]].discard(c)
        total = {x: n for x, n in total.items() if n}
        plan.bins += times
    return plan


def place(table: np.ndarray, keys: np.ndarray, cls: np.ndarray, rank: np.ndarray):
    """Follow every remainder through the plan: yields (rows, bin, offset, length) until none is left.
    ``keys``: class and start of the table's rows in one integer."""
    rows = np.arange(cls.size)
    while rows.size:
        use = table[np.searchsorted(keys, (cls << 40) + rank, side="right") - 1]
        i = rank - use[:, 1]
        yield rows, use[:, 3] + i // use[:, 2], use[:, 4] + (i % use[:, 2]) * use[:, 5], use[:, 5]
        on = use[:, 6] >= 0
        rows, cls, rank = rows[on], use[on, 6], i[on]


def _tokenise(ranks_path: str, capacity: int, added: dict[str, int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(ranks_path, added), np.array([END_ID], np.uint16).tobytes()
        part, seen, full = TaskContext.get().partitionId(), np.zeros(capacity, np.int64), 0
        for batch in batches:
            ids, tokens, rank, full_at = [], [], [], []
            for text in batch.column(1).to_pylist():
                got = encode(text or "") + end
                n = len(got) // 2
                ids.append(got)
                tokens.append(n)
                rank.append(int(seen[n % capacity]))
                full_at.append(full)
                seen[n % capacity] += 1
                full += n // capacity
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(ids), pa.int64()), pa.array(ids, pa.binary()), pa.array(tokens, pa.int64()),
                 pa.array([n % capacity for n in tokens], pa.int64()), pa.array(rank, pa.int64()), pa.array(full_at, pa.int64())],
                names=["doc_id", "part", "ids", "doc_tokens", "rest", "rank", "full_at"])
    return run


def _cut(table: np.ndarray, bins: int, capacity: int):
    keys = (table[:, 0] << 40) + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield cut(batch.slice(at, 1000))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        part, tokens, rest, rank, full_at = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                                             for c in ("part", "doc_tokens", "rest", "rank", "full_at"))
        whole = tokens // capacity
        row = [np.repeat(np.arange(batch.num_rows), whole)]
        nth = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
        start, length = [nth * capacity], [np.full(nth.size, capacity)]
        seq = [bins + (part[row[0]] << _FULL_SHIFT) + full_at[row[0]] + nth]
        offset = [np.zeros(nth.size, np.int64)]
        some = np.flatnonzero(rest > 0)
        done = (whole * capacity)[some]
        for rows, b, o, n in place(table, keys, rest[some], rank[some]):
            row.append(some[rows])
            start.append(done[rows].copy())
            length.append(n)
            seq.append(b)
            offset.append(o)
            done[rows] += n
        row, start, length, seq, offset = map(np.concatenate, (row, start, length, seq, offset))
        order = np.lexsort((start, row))
        row, start, length, seq, offset = (x[order] for x in (row, start, length, seq, offset))
        ids, last, wide = batch.column(batch.schema.get_field_index("ids")), -1, b""
        pieces = []
        for r, s, n in zip(row.tolist(), start.tolist(), length.tolist()):
            if r != last:
                last, wide = r, np.frombuffer(ids[r].as_py(), "<u2").astype("<u4").tobytes()
            pieces.append(wide[4 * s:4 * (s + n)])
        return pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(row)), pa.array(start), pa.array(length),
             pa.array(pieces, pa.binary()), pa.array(tokens[row]), pa.array(seq), pa.array(offset)],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, added: dict[str, int] | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian unsigned 32-bit, binary),
    doc_tokens, sequence_id, offset."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    tokens = docs.select("doc_id", "text").mapInArrow(
        _tokenise(ranks_path, capacity, added),
        f"doc_id {kind}, part long, ids binary, doc_tokens long, rest long, rank long, full_at long")
    tokens = written(tokens, "tokens", "zstd")
    # ranks go on from task to task
    per_task = tokens.filter("rest > 0").groupBy("rest", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    per_task = written(per_task.select("rest", "part", "n", F.coalesce(before, F.lit(0)).alias("before")), "ranks")
    histogram = {r["rest"]: r["n"] for r in per_task.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    plan = make_plan(histogram, capacity)
    base = maybe_broadcast(per_task.select(F.col("rest").alias("rest_"), F.col("part").alias("part_"), "before"), per_task.count(), 80)
    on = (F.col("rest") == F.col("rest_")) & (F.col("part") == F.col("part_"))
    ranked = tokens.join(base, on, "left").withColumn("rank", F.col("rank") + F.coalesce("before", F.lit(0)))
    return ranked.select("doc_id", "part", "ids", "doc_tokens", "rest", "rank", "full_at").mapInArrow(
        _cut(plan.table(), plan.bins, capacity),
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def pack_files(docs: DataFrame) -> DataFrame:
    """``pack`` with the ids of byte_bpe_50k.json, and their checksum ``ids_crc32``."""
    import public_tokenizers
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), added=added_tokens(public_tokenizers.path("byte_bpe_50k.json")))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


def op8(docs: DataFrame) -> DataFrame:
    return pack_files(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
