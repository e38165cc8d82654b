"""Language identification with bit-sliced Bloom filters over character trigrams.

Training counts trigrams (letters lower-cased, everything else one space) by
language over all training rows.  A trigram belongs to the language that uses it most, by its share of
the language's trigrams, and to every other whose share is at least ``ratio`` of that.  So every trigram enters a filter,
and the rule behaves alike at every size, while a word quoted in another language does not make its
trigrams that language's.
One Bloom filter per language is stored bit-sliced: each cell is a bitmask with
one bit a language, so the AND of a trigram's cells gives at once all languages
containing it.  A text's popcounts per language are corrected for the false
positives that each language's fill predicts; the largest decides.

Defined results: null texts and texts without a letter are ``und`` with score
0; letters but no known trigram give the language with most training text,
score 0; ties go to the first language in string order; without training rows
everything is ``und``.  A null doc_id is neither learned from nor held out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabula.llm.common import written

#: A trigram belongs to the languages where its share is at least this part of its highest share.
RATIO = 0.2
#: Slots of 8 bytes (for each 64 languages) that the filters may take; with fewer slots than the trigrams ask for
#: the rate of false positives grows, and the correction with it.
MOST_SLOTS = 1 << 23
HASHES = 4
BITS_PER_ITEM = 16
#: Characters handled at once inside a task.
CHUNK = 2_000_000


def _letter_table() -> np.ndarray:
    table = np.zeros(0x110000, np.bool_)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


_LETTERS: list[np.ndarray] = []


def trigrams(text: str) -> np.ndarray:
    """Trigrams as integers, 21 bits a character; empty if the text has no letter."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    # a lone surrogate is no letter
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
    letter = _LETTERS[0][codes]
    if not letter.any():
        return np.zeros(0, np.uint64)
    keep = letter | np.concatenate([[True], letter[:-1]])       # runs of others become one space
    c = np.where(letter, codes, 32)[keep].astype(np.uint64)
    return (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts a language, of at most about ``CHUNK`` trigrams at a time; they add up later."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    held: dict[str, list[np.ndarray]] = defaultdict(list)
    size = 0

    def settle() -> Iterator[pa.RecordBatch]:
        for lang in list(held):
            grams, counts = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            if grams.size:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * grams.size, pa.string()), pa.array(grams.astype(np.int64)),
                                                  pa.array(counts.astype(np.int64))], schema=schema)

    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = trigrams(text) if text else np.zeros(0, np.uint64)
            held[lang].append(found)
            size += found.size
            if size >= CHUNK:
                yield from settle()
                size = 0
    yield from settle()


@dataclass
class LanguageFilters:
    """Bit-sliced filters: ``cells[w]`` holds the bits of languages 64*w to 64*w+63."""

    languages: list[str]
    default: int
    cells: np.ndarray
    false_positive: np.ndarray

    @staticmethod
    def slots(grams: np.ndarray, m: int) -> list[np.ndarray]:
        a = grams * np.uint64(0x9E3779B97F4A7C15)
        a ^= a >> np.uint64(31)
        b = (a * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
        b ^= (b >> np.uint64(27)) << np.uint64(1)
        mask = np.uint64(m - 1)
        return [((a + np.uint64(i) * b) & mask).astype(np.int64) for i in range(HASHES)]

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], weights: dict[str, int]) -> LanguageFilters:
        languages = sorted(grams)
        most = max((len(g) for g in grams.values()), default=0)
        m = cls.width(most)
        cells = np.zeros((max(1, -(-len(languages) // 64)), m), np.uint64)
        for i, lang in enumerate(languages):
            for slot in cls.slots(grams[lang].astype(np.uint64), m):
                cells[i // 64][slot] |= np.uint64(1 << (i % 64))
        return cls.of(languages, cells, weights)

    @staticmethod
    def width(most: int) -> int:
        """Slots for filters of up to ``most`` trigrams."""
        return 1 << max(10, (BITS_PER_ITEM * most - 1).bit_length())

    @classmethod
    def of(cls, languages: list[str], cells: np.ndarray, weights: dict[str, int]) -> LanguageFilters:
        fill = np.array([((cells[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
        default = max(range(len(languages)), key=lambda i: (weights[languages[i]], -i), default=0)
        return cls(languages, default, cells, fill ** HASHES)

    def popcounts(self, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each run of ``grams`` from ``starts``: how many each language contains."""
        slots = self.slots(grams, self.cells.shape[1])
        out = np.zeros((starts.size, len(self.languages)))
        for w, row in enumerate(self.cells):
            mask = row[slots[0]]
            for slot in slots[1:]:
                mask &= row[slot]
            for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                out[:, i] = np.add.reduceat(((mask >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int32), starts)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return langs, scores
        group: list[tuple[int, np.ndarray]] = []
        held = 0

        def decide() -> None:
            if not group:
                return
            sizes = np.array([g.size for _, g in group])
            n = sizes.astype(float)[:, None]
            raw = self.popcounts(np.concatenate([g for _, g in group]), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            fp = np.minimum(self.false_positive, 0.999)
            true = np.clip((raw - n * fp) / (1 - fp), 0, n)
            for (i, _), row in zip(group, true):
                best, whole = int(row.argmax()), row.sum()
                langs[i] = self.languages[best if whole > 0 else self.default]
                scores[i] = float(row[best] / whole) if whole > 0 else 0.0
            group.clear()

        for i, text in enumerate(texts):
            found = trigrams(text) if text else np.zeros(0, np.uint64)
            if found.size:
                group.append((i, found))
                held += found.size
                if held >= CHUNK:
                    decide()
                    held = 0
        decide()
        return langs, scores


def _cells(m: int):
    """Rows (gram, languages) -> the cells they set: word of 64 languages, slot, bits."""
    schema = pa.schema([("word", pa.int32()), ("slot", pa.int64()), ("bits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            langs = lists.flatten().to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            for slot in LanguageFilters.slots(batch.column(0).to_numpy().astype(np.uint64), m):
                yield pa.RecordBatch.from_arrays([pa.array(langs // 64, pa.int32()), pa.array(np.repeat(slot, sizes)),
                                                  pa.array((np.uint64(1) << (langs % 64).astype(np.uint64)).view(np.int64))], schema=schema)
    return run


def fit(train: DataFrame, ratio: float = RATIO, most_slots: int = MOST_SLOTS) -> LanguageFilters:
    """Filters learned from (text, lang) rows; counts cover all of them.

    The cells are aggregated by Spark; the driver gets one total a language and at most ``most_slots`` cells.
    """
    counted = train.filter(F.col("lang").isNotNull()).select(F.col("text").alias("text"), F.col("lang").alias("lang"))
    counts = written(counted.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    total = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not total:
        return LanguageFilters.build({}, {})
    languages = sorted(total)
    sizes = counts.sparkSession.createDataFrame([(x, i, total[x]) for i, x in enumerate(languages)], "lang string, nr long, whole long")
    shares = counts.join(F.broadcast(sizes), "lang").select("gram", "nr", (F.col("n") / F.col("whole")).alias("share"))
    # as many entries a trigram as there are languages
    grams = shares.groupBy("gram").agg(F.max("share").alias("top"), F.collect_list(F.struct("nr", "share")).alias("held"))
    grams = written(grams.select("gram", F.transform(F.filter("held", lambda x: x["share"] >= ratio * F.col("top")), lambda x: x["nr"]).alias("nrs")), "members")
    most = grams.select(F.explode("nrs").alias("nr")).groupBy("nr").count().agg(F.max("count")).collect()[0][0]
    m = min(LanguageFilters.width(most), most_slots)
    found = grams.mapInArrow(_cells(m), "word int, slot long, bits long").groupBy("word", "slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    cells = np.zeros((-(-len(languages) // 64), m), np.uint64)
    cells[found["word"].to_numpy(), found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return LanguageFilters.of(languages, cells, total)


def identify(docs: DataFrame, model: LanguageFilters) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = model.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
    held = F.coalesce(remainder() == 1, F.lit(False)).alias("held_out")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held, "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def remainder():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3


def op4(docs: DataFrame) -> DataFrame:
    return identify(docs, fit(docs.filter(remainder() != 1)))
