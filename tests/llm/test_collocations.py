import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as registry
from galepost.llm import collocations as co
from galepost.llm.phrase_trie import PhraseTrie, Vocabulary, sequences

from .conftest import prose


def counts_of(texts):
    """Counts of all phrases, and of all words, by language."""
    out, totals = {}, Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3, 4):
                for i in range(len(words) - size + 1):
                    seen = out.setdefault(lang, Counter())
                    seen[tuple(words[i : i + size])] += 1
    return out, totals


def expected(texts, least=30, top=2000):
    found, totals = counts_of(texts)
    rows = []
    for lang, f in found.items():
        kept = []
        often = {p: n for p, n in f.items() if n >= least and len(p) > 1}
        for p, a in often.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            longer = (
                n
                for q, n in often.items()
                if len(q) > len(p)
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            )
            if not any(100 * n >= 80 * a for n in longer):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows)


SCHEMA = "doc_id long, text string, lang string, phrase string, n string, part int, a int"


def table(spark, texts, parts=4):
    rows = [(i, t, lang, "x", "y", 1, 2) for i, (lang, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def mixed(seed, docs=60):
    rng = random.Random(seed)
    words = "the of And to aéß \U0001f600 New york city x\x00y IN   a".split(" ")
    out = []
    for _ in range(docs):
        text = "".join(
            rng.choice(words) + rng.choice([" "] * 12 + ["\t", ". ", "\n", ",", " ; ", "\r\n"])
            for _ in range(rng.randint(0, 80))
        )
        out.append((rng.choice(["en", "de", None, "und"]), text))
    return out


# The second has tries that spill and vocabularies that are renewed all the time, and a bitmap
# of the least size.
@pytest.mark.parametrize("limits, bits", [(co.LIMITS, co.BITS), (co.Limits(50, 40, 8), 1 << 15)])
def test_equals_brute_force(spark, limits, bits):
    texts = mixed(1) + [("en", prose(3, 900)), ("fr", "so it is so it is " * 40)]
    for least, top in ((3, 2000), (6, 11)):
        rows = co.mine_phrases(table(spark, texts), least, top, 80, limits, bits).collect()
        assert sorted(map(tuple, rows)) == expected(texts, least, top)


def test_edge_tables(spark, edge_texts):
    texts = [("en", t) for t in edge_texts * 8] + [(None, None)]
    rows = co.mine_phrases(table(spark, texts)).collect()
    assert sorted(map(tuple, rows)) == expected(texts)
    assert co.mine_phrases(table(spark, texts).limit(0)).count() == 0
    assert co.mine_phrases(table(spark, [(None, None), ("en", "a b")])).count() == 0


def test_bitmap_holds_words_and_pairs(spark):
    small = co.frequent_bitmap(spark.sql("select 'en' lang, 'a' first, 'b' second"), 1 << 15)
    assert small.nbytes == 4096 and sum(map(int.bit_count, small.tolist())) == 1
    words = spark.sql("select 'en' lang, 'café' first, cast(null as string) second")
    counter = co._Counter("en", (1,), co.frequent_bitmap(words), None)
    assert counter._frequent_word(co._hash("café".encode()))
    assert not counter._frequent_word(co._hash(b"cafe"))
    pairs = spark.sql("select 'en' lang, 'new' first, 'york' second")
    counter = co._Counter("en", (2,), None, co.frequent_bitmap(pairs))
    hashes = np.array([co._hash(w) for w in (b"new", b"york", b"new")], np.uint64)
    assert counter._frequent_pairs(hashes).tolist() == [True, False]


@pytest.mark.parametrize("longest", [2, 4])
def test_trie_bursts_and_spills(longest):
    rng = random.Random(4)
    trie, want = PhraseTrie(longest, burst=16), Counter()
    for _ in range(30):
        keys = [
            rng.randrange(1, 5000) << rng.choice([0, 0, 32, 32 * (longest - 1)]) | rng.randrange(1, 4000)
            for _ in range(200)
        ]
        counts = [rng.randint(1, 5) for _ in keys]
        trie.add(keys, counts)
        for key, n in zip(keys, counts, strict=True):
            want[key] += n
    assert any(type(node) is list for node in trie.root) and len(trie) == len(want)
    got, size = Counter(), len(trie)
    for most in (size // 2, 0):
        for low, high, counts in trie.spill(most):
            assert len(set((low & np.uint64(255)).tolist())) == 1
            for a, b, n in zip(low.tolist(), high.tolist(), counts.tolist(), strict=True):
                got[a | b << 64] += n
        assert len(trie) <= most
    assert got == want


def test_sequences():
    words = Vocabulary()
    tokens = co.words_of(b"a b a b. c a b a c")
    codes, _ = words.codes(np.array([words[t] for t in tokens]))
    joined = np.ones(len(codes) - 1, bool)
    joined[0] = False

    def named(*sizes):
        out = {}
        for key, n in zip(*sequences(codes, joined, sizes), strict=True):
            shifts = [s for s in (0, 32, 64, 96) if key >> s]
            phrase = b" ".join(words.words[(key >> s & 0xFFFFFFFF) >> 8] for s in shifts)
            assert phrase not in out
            out[phrase] = n
        return out

    assert named(1) == {b"a": 4, b"b": 3, b"c": 2}
    assert named(2) == {b"a b": 2, b"b a": 2, b"c a": 1, b"a c": 1}
    assert named(3, 4) == {
        b"b a b": 1, b"c a b": 1, b"a b a": 1, b"b a c": 1, b"c a b a": 1, b"a b a c": 1,
    }
    assert sequences(codes[:1], joined[:0], (2,)) == ([], [])


def test_query(spark):
    docs = spark.read.parquet(f"{registry.SMOKE_DIR}/documents.parquet").collect()
    rows = registry.queries()["op13_phrase_collocations"](spark, registry.SMOKE_DIR)
    assert sorted(map(tuple, rows.collect())) == expected([(d.lang, d.text) for d in docs])
