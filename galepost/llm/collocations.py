"""Phrases whose words occur together far more often than apart, by language.

Words, pairs, and runs of three and four words are counted in passes of a trie in every task
(``phrase_trie``), whose subtrees leave as sorted runs and are merged by prefix partition. A
phrase can be frequent only if all its words and pairs are, so each pass leaves out what the
ones before have shown to be rare.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galepost.session import stage

from .common import map_batches
from .phrase_trie import CODE_BITS, PhraseTrie, Vocabulary, sequences

LEAST = 30
LONGEST = 4
TOP = 2000
# A phrase goes if a longer one makes up this share of it, in hundredths.
COVERED = 80
NO_LANGUAGE = "und"


@dataclass(frozen=True)
class Limits:
    """Of a task: words read before they are counted, entries of its tries, words it knows.
    They bound memory; results are the same for all."""

    read: int = 1 << 20
    entries: int = 600_000
    words: int = 600_000


LIMITS = Limits()
# Rows of a sorted run, about.
RUN_ROWS = 1 << 16

# Bits of a bitmap of frequent phrases: 8 MB, whatever their number. A bitmap too full to
# tell phrases apart lets all pass, so results never depend on it.
BITS = 1 << 26
_BITS_ROW = 1 << 15

_LOWER = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + b".,;:!?\n\x0b\x0c\r",
    b"abcdefghijklmnopqrstuvwxyz " + b"\xff" * 10,
)

RUN = pa.schema(
    [("lang", pa.string()), ("part", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())]
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words; a lone byte 255, which no text holds, stands between pieces."""
    return text.translate(_LOWER).replace(b"\xff", b" \xff ").split()


def _hash(word: bytes) -> int:
    """As Spark's ``xxhash64``, unsigned."""
    return xxhash.xxh64_intdigest(word, seed=42)


def _turned(value: np.ndarray) -> np.ndarray:
    """64-bit values rotated by 21 bits."""
    return (value << np.uint64(21)) | (value >> np.uint64(43))


def _turned_column(value: F.Column) -> F.Column:
    return F.shiftleft(value, 21).bitwiseOR(F.shiftrightunsigned(value, 43))


def frequent_bitmap(phrases: DataFrame, size: int = BITS) -> np.ndarray:
    """A bitmap of (lang, first word, second word or null); ``size`` is a power of two."""
    second = F.when(F.col("second").isNull(), F.lit(0)).otherwise(
        _turned_column(F.xxhash64("second"))
    )
    mixed = F.xxhash64("first").bitwiseXOR(second)
    place = mixed.bitwiseXOR(_turned_column(F.xxhash64("lang"))).bitwiseAND(F.lit(size - 1))
    rows = (
        phrases.select(
            F.shiftright(place, 15).alias("row"), place.bitwiseAND(F.lit(_BITS_ROW - 1)).alias("bit")
        )
        .groupBy("row")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    out = np.zeros((size // _BITS_ROW, _BITS_ROW // 8), dtype=np.uint8)
    for row, bits in rows:
        out[row] = np.frombuffer(bits, dtype=np.uint8)
    return out.ravel()


class _Counter:
    """Counts in one task: the phrases of one language, of the given sizes."""

    def __init__(self, lang: str, sizes: tuple[int, ...], words, pairs):
        self.lang, self.sizes, self.known_words, self.known_pairs = lang, sizes, words, pairs
        self.salt = int(_turned(np.array([_hash(lang.encode())], dtype=np.uint64))[0])
        self.read: list[np.ndarray] = []
        self.total = 0
        self.renew()

    def renew(self) -> None:
        self.words = Vocabulary(None if self.known_words is None else self._frequent_word)
        self.trie = PhraseTrie(max(self.sizes))

    def _frequent_word(self, digest: int) -> bool:
        place = (digest ^ self.salt) & (8 * len(self.known_words) - 1)
        return bool(self.known_words[place >> 3] >> (place & 7) & 1)

    def _frequent_pairs(self, hashes: np.ndarray) -> np.ndarray:
        """For each two neighbours, whether the pair may be frequent."""
        if self.known_pairs is None:
            return np.ones(max(len(hashes) - 1, 0), dtype=bool)
        place = hashes[:-1] ^ _turned(hashes[1:]) ^ np.uint64(self.salt)
        place &= np.uint64(8 * len(self.known_pairs) - 1)
        bits = self.known_pairs[(place >> np.uint64(3)).astype(np.int64)]
        return (bits >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def take(self, text: bytes) -> int:
        tokens = words_of(text)
        if tokens:
            found = np.fromiter(map(self.words.__getitem__, tokens), np.int64, len(tokens))
            self.total += len(tokens) - tokens.count(b"\xff")
            self.read += [found, np.zeros(1, np.int64)]
        return len(tokens)

    def count(self) -> None:
        """Move what was read into the trie."""
        if self.read:
            codes, hashes = self.words.codes(np.concatenate(self.read))
            joined = self._frequent_pairs(hashes)
            self.trie.add(*sequences(codes, joined, self.sizes))
            self.read = []

    def runs(self, most: int) -> Iterator[pa.RecordBatch]:
        """Subtrees as sorted runs, until the trie holds ``most`` entries."""
        words = pa.array(self.words.words, pa.binary())
        hashes = np.array(self.words.hashes, dtype=np.uint64)
        waiting: list[tuple] = []
        for entries in self.trie.spill(most):
            waiting.append(entries)
            if sum(len(e[0]) for e in waiting) >= RUN_ROWS:
                yield from self._sorted_run(waiting, words, hashes)
                waiting = []
        if waiting:
            yield from self._sorted_run(waiting, words, hashes)

    def _sorted_run(self, entries: list[tuple], words, hashes) -> Iterator[pa.RecordBatch]:
        low, high, counts = (np.concatenate(column) for column in zip(*entries, strict=True))
        numbers = [
            ((half >> np.uint64(shift)) & np.uint64(0xFFFFFFFF)).astype(np.int64) >> 8
            for half in (low, high)
            for shift in (0, CODE_BITS)
        ]
        for size in self.sizes:
            mine = numbers[size - 1] > 0
            if size < len(numbers):
                mine &= numbers[size] == 0
            if not mine.any():
                continue
            own = [number[mine] for number in numbers[:size]]
            # Phrases that begin alike but end in different words may go to different parts,
            # so a very common first word is not one task.
            part = (hashes[own[0]] & np.uint64(255)) << np.uint64(8)
            part |= (hashes[own[-1]] >> np.uint64(8)) & np.uint64(255)
            mixed = np.zeros(len(part), dtype=np.uint64)
            for number in own:
                mixed = _turned(mixed) ^ hashes[number]
            order = np.lexsort((mixed, part))
            phrase = [words.take(pa.array(number[order])) for number in own]
            if size > 1:
                phrase = [pc.binary_join_element_wise(*phrase, b" ")]
            yield _run(self.lang, part[order].astype(np.int32), phrase[0], counts[mine][order])


def _run(lang: str, part, phrase, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(part), pa.string()),
            pa.array(part, pa.int32()),
            pa.array(phrase, pa.binary()).cast(pa.string()),
            pa.array(n, pa.int64()),
        ],
        schema=RUN,
    )


def count_runs(
    batches: Iterator[pa.RecordBatch], sizes: tuple[int, ...], limits=LIMITS, words=None, pairs=None
) -> Iterator[pa.RecordBatch]:
    """Sorted runs of the phrases of a task's texts; with words also, under the empty phrase,
    the number of all words. Memory is bounded, a text apart: what is over leaves early."""
    counters: dict[str, _Counter] = {}
    waiting = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
            if lang not in counters:
                counters[lang] = _Counter(lang, sizes, words, pairs)
            waiting += counters[lang].take(text)
            if waiting < limits.read:
                continue
            waiting = 0
            for counter in counters.values():
                counter.count()
            crowded = sum(len(c.words) for c in counters.values()) > limits.words
            over = sum(len(c.trie) for c in counters.values()) > limits.entries
            for counter in counters.values() if crowded or over else ():
                yield from counter.runs(0 if crowded else len(counter.trie) // 2)
                if crowded:
                    counter.renew()
    for lang, counter in counters.items():
        counter.count()
        yield from counter.runs(0)
        if 1 in sizes:
            yield _run(lang, [0], [b""], [counter.total])


def frequent_phrases(
    texts: DataFrame, sizes: tuple[int, ...], least: int, limits: Limits = LIMITS, **known
) -> DataFrame:
    """``(lang, phrase, n)`` of the phrases counted ``least`` times or more."""
    context = texts.sparkSession.sparkContext
    sent = {name: context.broadcast(bitmap) for name, bitmap in known.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return count_runs(batches, sizes, limits, **{name: b.value for name, b in sent.items()})

    runs = map_batches(texts, run, "lang string, part int, phrase string, n long")
    merged = (
        runs.repartition("lang", "part")
        .groupBy("lang", "part", "phrase")
        .agg(F.sum("n").alias("n"))
    )
    return stage(
        merged.where((F.col("n") >= least) | (F.col("phrase") == "")).drop("part"),
        f"phrases-{sizes[-1]}",
    )


def _words(phrase: str = "phrase") -> F.Column:
    return F.split(phrase, " ")


def _slice(words: F.Column, start, length) -> F.Column:
    return F.array_join(F.slice(words, start, length), " ")


def score_phrases(counted: DataFrame, covered: int = COVERED) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of the phrases that no longer one covers.

    ``counted`` holds every frequent word and phrase; a part of a phrase is at least as
    frequent, so all parts are there.
    """
    phrases = counted.select(
        "lang", "phrase", F.col("n").alias("a"), _words().alias("words")
    ).where(F.size("words") > 1)
    cuts = phrases.select(
        "lang",
        "phrase",
        "a",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - 1),
                lambda k: F.struct(
                    k.alias("k"),
                    _slice(F.col("words"), F.lit(1), k).alias("first"),
                    _slice(F.col("words"), k + 1, F.size("words") - k).alias("rest"),
                ),
            )
        ).alias("cut"),
    ).select("lang", "phrase", "a", "cut.*")
    for part, name in (("first", "l"), ("rest", "r")):
        found = counted.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
        cuts = cuts.join(found, ["lang", part])
    # Products may pass 64 bits.
    score = F.expr(
        "cast((cast(a as decimal(28,0)) * 2000000BD)"
        " div (cast(l as decimal(28,0)) + cast(r as decimal(28,0))) as bigint)"
    )
    lowest = (
        cuts.groupBy("lang", "phrase")
        .agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inner = F.filter(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.size("words") - 1),
                lambda size: F.transform(
                    F.sequence(F.lit(1), F.size("words") - size + 1),
                    lambda start: _slice(F.col("words"), start, size),
                ),
            )
        ),
        lambda phrase: phrase != "",
    )
    longest = (
        phrases.where(F.size("words") > 2)
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    share = F.expr(
        f"100BD * cast(longer as decimal(28,0)) >= {covered}BD * cast(a as decimal(28,0))"
    )
    return (
        lowest.join(longest, ["lang", "phrase"], "left")
        .where(~F.coalesce(share, F.lit(False)))
        .drop("longer")
    )


def top_phrases(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language, with ``rank`` from 1.

    Parts of a language are cut to their own first ones before they meet.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(32)))
    for keys in (["lang", "part"], ["lang"]):
        window = Window.partitionBy(*keys).orderBy(*order)
        parts = parts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top)
    return parts.withColumn("rank", F.col("rank").cast("long")).drop("part")


def mine_phrases(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    covered: int = COVERED,
    limits: Limits = LIMITS,
    bits: int = BITS,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first phrases.

    Only ``text`` and ``lang`` are read. A null text has no words, a null language is
    ``und``. Repeated rows count as often as they are there. A language without a frequent
    phrase, and an empty table, give no rows. Of phrases with equal scores the more frequent
    comes first, then the first in byte order, so ranks are unique.
    """
    texts = docs.select(
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    words = frequent_phrases(texts, (1,), least, limits)
    totals = words.where("phrase = ''").select("lang", F.col("n").alias("all_words"))
    words = words.where("phrase <> ''")
    no_word = F.lit(None).cast("string")
    known = {
        "words": frequent_bitmap(
            words.select("lang", F.col("phrase").alias("first"), no_word.alias("second")), bits
        )
    }
    pairs = frequent_phrases(texts, (2,), least, limits, **known)
    first, second = (_words().getItem(i) for i in (0, 1))
    known["pairs"] = frequent_bitmap(
        pairs.select("lang", first.alias("first"), second.alias("second")), bits
    )
    longer = frequent_phrases(texts, tuple(range(3, LONGEST + 1)), least, limits, **known)
    counted = words.unionByName(pairs).unionByName(longer)
    # A row for each language.
    return (
        top_phrases(score_phrases(counted, covered), top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score")
    )
