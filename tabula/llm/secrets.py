"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

A subword vocabulary spends few tokens on words and many on random characters.
Candidates are runs of 16 or more base64 or URL-safe characters with a letter.  One with
few characters per token is a span of kind ``opaque``: at most ``ratio`` (1.9), less by
``SHORT`` below 20 characters, and less by ``PLAIN`` for letters of one case (a capital in front aside), which
long words look like.  Left out are known forms of digest (hexadecimal of a
digest's length, a digest with its algorithm's name in front) and identifiers
(UUID, number, path or name made of several words).

Spans are (kind, start, end) in code points.  Fixed patterns are matched
leftmost, without overlap, kind by kind; the method's spans are added where
they overlap none of these.

Defined results: null is an empty text and has no spans; repeated rows give
equal rows; empty tables give empty results; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabula.llm.common import free_name, outside, replace_spans

#: The patterns of the kinds, in their order.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}+")
KINDS = ("assign", "access", "hex", "opaque")
RATIO, SHORT, PLAIN = 1.9, 0.2, 0.2
LONG = 20

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
NAMED_DIGEST = re.compile(r"(?:md5|sha1|sha224|sha256|sha384|sha512)[-=_/].+", re.I)
#: Names and paths: words (with a short number behind at most) joined by - _ /.
NAME = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[-_/=+]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))+[-_/=+]*")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return spans + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def excluded(s: str) -> bool:
    """Known digests and identifiers, and what has no letter."""
    return (not re.search("[A-Za-z]", s) or bool(UUID.fullmatch(s))
            or (len(s) in DIGEST_LENGTHS and bool(DIGEST.fullmatch(s))) or bool(NAMED_DIGEST.fullmatch(s)) or bool(NAME.fullmatch(s)))


def most_characters(s: str, ratio: float = RATIO) -> float:
    """Characters per token up to which a run counts as random."""
    return ratio - SHORT * (len(s) < LONG) - PLAIN * bool(WORD.fullmatch(s))


def opaque_spans(text: str, count_tokens, ratio: float = RATIO) -> list[Span]:
    return [("opaque", m.start(), m.end()) for m in CANDIDATE.finditer(text)
            if not excluded(m[0]) and len(m[0]) <= most_characters(m[0], ratio) * count_tokens(m[0])]


def find(text: str | None, count_tokens, ratio: float = RATIO) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, each by start and kind."""
    if not text:
        return [], []
    order = {k: i for i, k in enumerate(KINDS)}
    base = sorted(base_spans(text), key=lambda s: (s[1], order[s[0]]))
    more = outside(opaque_spans(text, count_tokens, ratio), base)
    return base, sorted(base + more, key=lambda s: (s[1], order[s[0]]))


def token_counter(ranks_path: str):
    from tabula.llm.packing import encoder
    encode = encoder(ranks_path).encode
    return lambda s: len(encode(s))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, ranks_path: str, ratio: float = RATIO) -> DataFrame:
    """doc_id, counts of the fixed kinds and of ``opaque``, base and all spans as strings."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(ranks_path)
        for batch in batches:
            found = [find(t, count, ratio) for t in batch.column(1).to_pylist()]
            n = [pa.array([sum(s[0] == k for s in every) for _, every in found], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *n, pa.array([joined(b) for b, _ in found], pa.string()), pa.array([joined(e) for _, e in found], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, spans string")


def redact(docs: DataFrame, ranks_path: str, mark: str = "[SECRET]", ratio: float = RATIO) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; n_chars, if there, follows a changed text."""
    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        count = token_counter(ranks_path)
        return pa.array([replace_spans(t, find(t, count, ratio)[1], mark) for t in texts.to_pylist()], pa.string())

    new = free_name(docs.columns, "cleaned")
    out = docs.withColumn(new, cleaned(F.col("text")))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(new) != F.col("text"), F.length(new)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out.withColumn("text", F.col(new)).select(*docs.columns)


def op10(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    out = scan(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_opaque")
