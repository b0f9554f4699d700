import random

import __spark_entry__ as registry
from galepost.llm import decontaminate as dc

from .conftest import prose


def fewest_edits(pattern, text):
    above = [0] * (len(text) + 1)
    for i, char in enumerate(pattern, 1):
        row = [i]
        for j, other in enumerate(text, 1):
            row.append(min(above[j - 1] + (char != other), above[j] + 1, row[-1] + 1))
        above = row
    return min(above)


def plain(text):
    return "".join(map(chr, dc.fold(text)[0]))


def noisy(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.random()
        if kind < 0.4:
            chars[at] = rng.choice("xyz")
        elif kind < 0.7:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyz"))
    return "".join(chars)


def test_against_full_alignment():
    rng = random.Random(5)
    for _ in range(60):
        item = prose(rng.random(), rng.randint(5, 40))
        patterns = dc.patterns_of([(1, item)])
        text = f"{prose(rng.random(), 5)} {noisy(rng, item, rng.randint(0, 9))} {prose(rng.random(), 5)}"
        edits = [fewest_edits(plain_codes(c), plain(text)) for c in patterns.codes]
        allowed = [e for e, k in zip(edits, patterns.edits, strict=True) if e <= k]
        found = dc.find_in_texts(patterns, ["other words", text, None, ""])
        assert bool(found) == bool(allowed)
        if found:
            assert found[0][0] == 1 and found[0][3] == min(allowed)


def plain_codes(codes):
    return "".join(map(chr, codes))


def test_excerpts_are_found_at_every_offset():
    rng = random.Random(11)
    item = plain(prose(77, 80))
    assert len(item) > 350
    patterns = dc.patterns_of([(1, item)])
    for size in (120, 140, 170):
        excerpts = [item[at : at + size] for at in range(len(item) - size + 1)]
        found = dc.find_in_texts(patterns, [f"{prose(78, 6)} {x} {prose(79, 6)}" for x in excerpts])
        assert sorted((f[0], f[2], f[3]) for f in found) == [(n, 1, 0) for n in range(len(excerpts))]
    for at in range(0, len(item) - dc.PASSAGE + 1, 7):
        changed = noisy(rng, item[at : at + dc.PASSAGE], 4)
        assert dc.find_in_texts(patterns, [f"{prose(78, 6)} {changed} {prose(79, 6)}"])
    assert not dc.find_in_texts(patterns, [f"{prose(78, 6)} {item[40:40 + 110]} {prose(79, 6)}"])


def test_an_edit_in_the_middle_of_a_small_item():
    for size in range(25, 51):
        item = plain(prose(size, 20))[:size].strip()
        text = f"== {item[: len(item) // 2]}#{item[len(item) // 2 + 1 :]} =="
        assert [f[3] for f in dc.find_in_texts(dc.patterns_of([(1, item)]), [text])] == (
            [1] if len(item) >= 25 else []
        )


def test_place_is_that_of_the_original_text():
    item = prose(9, 30)
    text = "Intro  text\n\n" + item.upper().replace(" ", "   ") + " end"
    (found,) = dc.find_in_texts(dc.patterns_of([(4, item)]), [text])
    assert plain(text[found[4] : found[5]]) == plain(item)


def test_short_items_need_whole_words():
    patterns = dc.patterns_of([(1, "Forty two"), (2, ""), (3, None)])
    found = dc.find_in_texts(patterns, ["so forty  two!", "forty twos", None])
    assert [(f[0], f[1]) for f in found] == [(0, 1)]


def test_tables(spark, documents, edge_texts):
    item = prose(50, 40)
    texts = [*edge_texts, f"{prose(51, 30)}\n{item}", item[:150], item]
    docs = documents(texts, [*range(len(texts) - 1), None])
    bench = spark.createDataFrame(
        [(1, item), (2, item), (None, None), (3, "")], "item_id long, text string"
    )
    rows = dc.find_contamination(docs, bench).collect()
    hit = {len(edge_texts), None}
    if len(item[:150]) >= dc.PASSAGE:
        hit.add(len(edge_texts) + 1)
    assert {(r.doc_id, r.item_id) for r in rows} == {(d, i) for d in hit for i in (1, 2)}
    clean = dc.drop_contaminated(docs, bench)
    assert clean.schema == docs.schema
    assert {r.doc_id for r in clean.collect()} == set(range(len(edge_texts)))
    assert dc.find_contamination(docs, bench.limit(0)).count() == 0
    assert dc.find_contamination(docs.limit(0), bench).count() == 0
    assert dc.drop_contaminated(docs, bench.limit(0)).count() == len(texts)


def test_blocks_find_the_same(spark, documents, monkeypatch):
    items = [prose(i, 40) for i in range(6)]
    docs = documents([f"{prose(90, 10)} {x}" for x in items])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = {tuple(r) for r in dc.find_contamination(docs, bench).collect()}
    monkeypatch.setattr(dc, "BLOCK_CHARS", 300)
    assert {tuple(r) for r in dc.find_contamination(docs, bench).collect()} == whole
    assert len(whole) == 6


def test_query_finds_every_whole_item(spark):
    sf = registry.SMOKE_DIR
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    want = {
        (d.doc_id, i.item_id) for d in docs for i in items if d.text and i.text and i.text in d.text
    }
    rows = registry.queries()["op2_decontamination"](spark, sf).collect()
    assert want <= {(r.doc_id, r.item_id) for r in rows}
    texts = {d.doc_id: d.text for d in docs}
    patterns = {i.item_id: dc.patterns_of([(i.item_id, i.text)]) for i in items}
    for row in rows:
        part = plain(texts[row.doc_id][row.match_start : row.match_end])
        mine = patterns[row.item_id]
        assert row.n_edits == min(fewest_edits(plain_codes(c), part) for c in mine.codes)
