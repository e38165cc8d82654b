"""Alignment of two tokenizers' tokens: a byte-level BPE (A) and a piece BPE with byte fallback (B).

Both see a blank and the text.  Spans give the coarse cuts: character offsets of ``tokenizers``
for A, the spans of sentencepiece's proto result for B (its immutable proto; since it was renamed,
return type ``proto``, with byte spans).  A token that ends inside a character, and every byte-fallback
token, is cut by its decoded bytes instead.  Where tokens of A and B both end, a group ends; A and
B tokens whose byte ranges overlap are linked.

Neither tokenizer has a token that reaches over a single blank between two other characters (A's
pattern starts a token there, no piece of B has a blank after another character), so a text
is aligned part by part between such blanks, and parts seen before come from a bounded cache.

The corpus-wide counts of linked id pairs are a Spark aggregation over each document's distinct pairs;
they come back to the documents by a join in which frequent pairs, as many as fit a bound, are broadcast and
the others shuffled.

Defined results: a null or empty text, or one that the tokens' bytes don't give back (it holds U+2581), has no
tokens, zeros and an empty digest.  Special tokens' strings are plain text.  Texts of any length are taken whole (parts beyond
``CACHED`` characters are not kept).  Repeated rows are documents each; null ids pass through; ties of the highest
count are all best; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator
from itertools import chain, pairwise
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabula.llm.common import BROADCAST_BYTES, written

#: A piece's id and the end of its span, read together.
_ID_END = attrgetter("id", "end")
#: Blanks at which both tokenizers cut.
_CUT = re.compile(r" (?<=\S )(?=\S)")       # the blank first: it is searched for as a literal
BLANK = "▁"
CACHED = 48
CACHE_PARTS = 300_000            # in each of two generations
CHUNK = 16_000                   # characters that are tokenised at once
PAIR_BYTES = 48                  # of a pair in a broadcast table
SHIFT = 32                       # a pair of ids in one long: A's id above, B's below


def byte_alphabet() -> dict[str, int]:
    """Byte-level BPE's characters: printable Latin-1 bytes stand for themselves, the others follow from 256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Parts of a text -> their tokens, cuts, links."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_byte = np.array([bool(re.fullmatch("<0x[0-9A-F]{2}>", p)) for p in pieces])
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace(BLANK, " ").encode() for p, byte in zip(pieces, self.b_byte)]
        self.a_len, self.b_len = (np.array([len(x) for x in table]) for table in (self.a_bytes, self.b_bytes))
        # an id as text with what may follow it
        self.marked = [np.array([f"{i}{mark}" for i in range(len(table)) for mark in ",|;"], object) for table in (self.a_bytes, self.b_bytes)]
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def a_tokens(self, text: str, whole: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """A's ids and their byte ends in ``whole``, a blank and the text; None if the tokens give other bytes."""
        got = self.a.encode(" " + text, add_special_tokens=False)
        ids = got.ids
        if b"".join(map(self.a_bytes.__getitem__, ids)) != whole:
            return None
        ids, spans = np.array(ids), np.fromiter(chain.from_iterable(got.offsets), np.int64, 2 * len(ids))
        start, ends = spans[::2], spans[1::2]
        if len(whole) > len(text) + 1:                                   # characters -> bytes
            heads = np.flatnonzero((np.frombuffer(whole, np.uint8) & 0xC0) != 0x80)
            inside = np.append(start[1:] < ends[:-1], False)             # the next token shares this one's last character
            ends = refine(np.append(heads, len(whole))[ends], inside, self.a_len[ids])
        return ids, ends

    def b_tokens(self, text: str, whole: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """The same of B, which puts the blank before the text itself; its spans are bytes of the text."""
        pieces = self.b.encode(text, return_type="proto").pieces
        found = np.fromiter(chain.from_iterable(map(_ID_END, pieces)), np.int64, 2 * len(pieces))
        ids, ends = found[::2], found[1::2] + 1
        if b"".join(map(self.b_bytes.__getitem__, ids.tolist())) != whole:
            return None
        fallback = self.b_byte[ids]
        return ids, refine(ends, fallback, self.b_len[ids]) if fallback.any() else ends

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and byte ends of A and of B for a blank and the text."""
        whole = (" " + text).encode()
        a, b = self.a_tokens(text, whole), self.b_tokens(text, whole)
        return None if a is None or b is None else (*a, *b)

    def align(self, parts: list[str]) -> list[tuple | None]:
        """For each part: number of A tokens, of B tokens, of groups, its links as 64-bit integers, its groups as text
        (each followed by a semicolon); None if the tokens don't give its bytes."""
        out: list[tuple | None] = [None] * len(parts)
        joined = [i for i, p in enumerate(parts) if p and not p[0].isspace() and not p[-1].isspace()]
        chunk, size = [], 0
        for i in joined:
            chunk.append(i)
            size += len(parts[i])
            if size > CHUNK:
                self._align(parts, chunk, out)
                chunk, size = [], 0
        self._align(parts, chunk, out)
        # blanks at a part's edge would not be cut, and one part with other bytes spoils its chunk
        for i, p in enumerate(parts):
            if out[i] is None:
                self._align(parts, [i], out)
        return out

    def _align(self, parts: list[str], chunk: list[int], out: list) -> None:
        got = self.tokens(" ".join(parts[i] for i in chunk)) if chunk else None
        if got is None:
            return
        a_ids, a_ends, b_ids, b_ends = got
        cuts = np.union1d(a_ends, b_ends)
        both = np.intersect1d(a_ends, b_ends, assume_unique=True)
        links = (a_ids[np.searchsorted(a_ends, cuts)] << SHIFT | b_ids[np.searchsorted(b_ends, cuts)]).tobytes()
        # tokens by group, A's before B's, each with the mark that follows it
        group = [np.searchsorted(both, ends) for ends in (a_ends, b_ends)]
        last = [np.append(g[1:] != g[:-1], True) for g in group]
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        shown = np.concatenate([self.marked[0][3 * a_ids + last[0]], self.marked[1][3 * b_ids + 2 * last[1]]])[order].tolist()
        ends = np.cumsum([len(parts[i].encode()) + 1 for i in chunk])
        at = [np.concatenate([[0], np.searchsorted(x, ends, side="right")]).tolist() for x in (a_ends, b_ends, both, cuts)]
        for k, i in enumerate(chunk):
            (a, a_), (b, b_), (g, g_), (n, n_) = ((x[k], x[k + 1]) for x in at)
            out[i] = a_ - a, b_ - b, g_ - g, links[8 * n:8 * n_], "".join(shown[a + b:a_ + b_])

    def look_up(self, texts: list[list[str]]) -> dict[str, tuple | None]:
        """Alignments of all parts of some texts, from the cache (what was used lately stays) or anew."""
        young, old, known, fresh = self.young, self.old, {}, []
        for p in set().union(*texts):
            if p in young:
                known[p] = young[p]
            elif p in old:
                known[p] = young[p] = old[p]
            else:
                fresh.append(p)
        for p, x in zip(fresh, self.align(fresh)):
            known[p] = x
            if len(p) <= CACHED:
                young[p] = x
        if len(young) > CACHE_PARTS:
            self.young, self.old = {}, young
        return known


def refine(ends: np.ndarray, inside: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Byte ends of tokens; where ``inside``, the span doesn't tell, and the token's decoded bytes are counted from
    the last end that does."""
    total = np.cumsum(length)
    sure = np.where(inside, -1, np.arange(ends.size))
    base = np.maximum.accumulate(sure)
    known = base >= 0
    return np.where(known, ends[base] + total - total[base], total)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def parts_of(text: str | None) -> list[str]:
    """Parts between the blanks where both tokenizers cut; none for texts without tokens."""
    return _CUT.split(text) if text and BLANK not in text else []


def _chunks(texts: list[str | None], most: int = 1 << 20) -> Iterator[list[list[str]]]:
    """Parts of the texts, in runs of about ``most`` characters."""
    run, size = [], 0
    for text in texts:
        run.append(parts_of(text))
        size += len(text or "")
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def _documents(a_path: str, b_path: str):
    schema = pa.schema([("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                        ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    def one(known, parts: list[str]) -> tuple:
        got = list(map(known.__getitem__, parts))
        if not got or None in got:
            return 0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)
        n_a, n_b, n_groups, links, groups = zip(*got)
        links = np.frombuffer(b"".join(links), np.int64)
        return (sum(n_a), sum(n_b), sum(n_groups), links.size, hashlib.sha256("".join(groups)[:-1].encode()).hexdigest(),
                *np.unique(links, return_counts=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a_path, b_path)
        for batch in batches:
            at = 0
            for run_ in _chunks(batch.column(1).to_pylist()):
                # a run makes many small tuples and no cycles: collections wait until it is done
                gc.disable()
                try:
                    known = align.look_up(run_)
                    rows = list(zip(*(one(known, parts) for parts in run_)))
                finally:
                    gc.enable()
                ends = np.concatenate([[0], np.cumsum([p.size for p in rows[5]])]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x).astype(t)))
                         for x, t in ((rows[5], np.int64), (rows[6], np.int32))]
                cols = [pa.array(c, f.type) for c, f in zip(rows[:5], schema)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(run_)), *cols, *lists], names=["doc_id", *schema.names])
                at += len(run_)
    return run


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Written table, one row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, its
    distinct linked pairs of ids (A's id in the upper 32 bits) with how often each occurs, and a row number."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(
        _documents(a_path, b_path),
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")
    return written(out.withColumn("nr", F.monotonically_increasing_id()), "aligned", "zstd")


def pair_counts(rows: DataFrame) -> DataFrame:
    """Written table of linked id pairs: pair, n (links that hold it), best (no pair of its B id has more)."""
    links = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    pairs = written(links.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    most = pairs.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return written(pairs.join(most, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best")), "counts")


def frequent(pairs: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` pairs have this count or more."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = dict(map(tuple, pairs.groupBy(level.alias("level")).agg(F.count(F.lit(1))).collect()))
    total, cut = 0, 1 << (max(sizes, default=0) + 1)
    for level in sorted(sizes, reverse=True):
        total += sizes[level]
        if total > most:
            break
        cut = 1 << level
    return cut


def scored(rows: DataFrame, most: int = BROADCAST_BYTES // PAIR_BYTES) -> DataFrame:
    """``rows`` of ``aligned`` with n_best and count_sum: at most ``most`` frequent pairs are broadcast."""
    pairs = pair_counts(rows)
    cut = frequent(pairs, most)
    links = rows.select("nr", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("nr", F.col("x.pairs").alias("pair"), "x.times")

    def sums(df: DataFrame) -> DataFrame:
        return df.groupBy("nr").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    hot, rest = F.broadcast(pairs.filter(F.col("n") >= cut)), pairs.filter(F.col("n") < cut)
    got = sums(links.join(hot, "pair"))
    if not rest.isEmpty():
        # no pair left has more than cut occurrences: none is a hot key
        got = got.unionByName(sums(links.join(hot, "pair", "left_anti").join(rest, "pair")))
    got = written(got.groupBy("nr").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "sums")
    out = rows.drop("pairs", "times").join(got, "nr", "left").drop("nr")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per group: doc_id, start and end (bytes of the blank and the text), a_ids, b_ids."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a_path, b_path)
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1).to_pylist()):
                rows, at = [], 0
                cuts = [align.tokens(p) for p in parts_of(text)]
                for a_ids, a_ends, b_ids, b_ends in [] if any(c is None for c in cuts) else cuts:
                    a_at, b_at = ({end: i + 1 for i, end in enumerate(ends.tolist())} for ends in (a_ends, b_ends))
                    shared = [0, *sorted(a_at.keys() & b_at.keys())]
                    for x, y in pairwise(shared):
                        rows.append((at + x, at + y, a_ids[a_at.get(x, 0):a_at[y]].tolist(), b_ids[b_at.get(x, 0):b_at[y]].tolist()))
                    at += shared[-1]
                for i in range(0, len(rows), 10_000):
                    some = rows[i:i + 10_000]
                    start, end, a, b = zip(*some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc.as_py()] * len(some), batch.schema.field(0).type), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                         pa.array(a, pa.list_(pa.int32())), pa.array(b, pa.list_(pa.int32()))], names=["doc_id", "start", "end", "a_ids", "b_ids"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, end long, a_ids array<int>, b_ids array<int>")


def op13(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    rows = aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return scored(rows).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
