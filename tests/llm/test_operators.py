"""Corpus operators against brute force, and their behaviour on odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakebook.llm import packing, substrings
from lakebook.llm.chat import Template, prefix_target_examples, read_back
from lakebook.llm.common import read
from lakebook.llm.decontaminate import canonical, find_leaks
from lakebook.llm.licenses import TEMPLATES, build_index, scan_licenses, scan_text
from lakebook.llm.quality import quality_verdict
from lakebook.llm.queries import LLM_CHECKS, tokenizer_path
from lakebook.llm.sharding import shard_by_bytes
from lakebook.llm.simhash import BKTree, simhash_components, spanning_links
from lakebook.llm.substrings import dedup_substrings
from lakebook.llm.tokens import byte_bpe
from lakebook.llm.toxicity import score_toxicity
from lakebook.llm.urls import build_index as url_index
from lakebook.llm.urls import filter_urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i}" for i in range(40_000))
# Null and empty texts, a null id, repeated rows, ties, a very long text; extra columns
# that clash with names used inside or differ in case alone.
ODD = "doc_id long, text string, TEXT string, bits long, shard int, size string, doc string"
ODD_ROWS = [
    (1, None, "x", 1, 1, "a", "d"),
    (2, "", "x", 1, 1, "a", "d"),
    (3, "one two three four five six seven eight nine ten eleven twelve thirteen end", "x", 1, 1, "a", "d"),
    (4, "one two three four five six seven eight nine ten eleven twelve thirteen END", "x", 1, 1, "a", "d"),
    (5, "same text", "x", 1, 1, "a", "d"),
    (5, "same text", "x", 1, 1, "a", "d"),
    (None, "same text", "x", 1, 1, "a", "d"),
    (6, LONG, "x", 1, 1, "a", "d"),
    (7, " \n\t ", "x", 1, 1, "a", "d"),
]


@pytest.fixture(scope="module")
def odd(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    df = spark.createDataFrame(ODD_ROWS, ODD)
    yield df
    spark.conf.set("spark.sql.caseSensitive", "false")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r[0]: r[1] for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()}


def labels_of(spark):
    return spark.createDataFrame([(3, 0), (4, None), (None, 1)], "doc_id long, toxic int")


def items_of(spark):
    return spark.createDataFrame([(1, None), (2, "too short"), (None, "x")], "item_id long, text string")


OPERATORS = {
    "leaks": lambda s, d: find_leaks(d, items_of(s)),
    "pack": lambda s, d: packing.pack(d, tokenizer_path()),
    "quality": lambda s, d: quality_verdict(d),
    "substrings": lambda s, d: dedup_substrings(d),
    "licenses": lambda s, d: scan_licenses(d),
    "toxicity": lambda s, d: score_toxicity(d, labels_of(s)),
    "simhash": lambda s, d: simhash_components(d),
    "shards": lambda s, d: shard_by_bytes(d),
}
# Rows that the odd table gives; packing cuts the long text.
ODD_COUNTS = {"leaks": 0, "licenses": 0, "pack": None}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_rows(spark, odd, name):
    rows = OPERATORS[name](spark, odd).collect()
    wanted = ODD_COUNTS.get(name, len(ODD_ROWS))
    if wanted is not None:
        assert len(rows) == wanted
    if name == "pack":
        pieces = Counter(r.doc_id for r in rows)
        assert pieces[5] == 2 and pieces[1] == pieces[2] == 1 and pieces[6] > 10
        assert {r.length for r in rows if r.doc_id in (1, 2)} == {1}
    if name == "quality":
        assert {r.kept for r in rows if r.doc_id in (1, 2, 5, 7)} == {False}
    if name == "substrings":
        gone = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in rows}
        assert gone[3][1] == 0 and gone[4] == (14, 13, " END")
        assert gone[1] == gone[2] == (0, 0, "") and gone[5][1] == 0 and gone[6][:2] == (40_000, 0)
    if name == "toxicity":
        assert all(0 <= r.score <= 1 for r in rows)
    if name == "simhash":
        of = {(r.doc_id, r.fingerprint): r.component_id for r in rows}
        zero = "0" * 16
        assert of[1, zero] == of[2, zero] == of[7, zero] == 1
        assert [r.component_id for r in rows if r.doc_id is None] == [5]
    if name == "shards":
        assert {r.size for r in rows if r.doc_id in (1, 2)} == {8}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(spark, odd, name):
    assert OPERATORS[name](spark, odd.limit(0)).collect() == []


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    rng = random.Random(3)
    parts = ["a", "b ", "  ", " ", "\n", "'s", "é", "　", "²", "23", "<|endoftext|>", "!", " cat", "\x85", "中"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(8_000)]
    texts += [" " * 300_000, "x" * 50_000, "ab" * 20_000, "\n \t" * 5_000]
    for special in (True, False):
        library, ours = Tokenizer.from_file(tokenizer_path()), byte_bpe(tokenizer_path(), special)
        library.encode_special_tokens = not special
        plain = library.encode_batch(texts, add_special_tokens=False)
        assert [ours.ids(t).tolist() for t in texts] == [e.ids for e in plain]


def test_fullest_combination_is_optimal():
    rng = random.Random(5)
    for _ in range(60):
        counts = Counter(rng.randint(1, 12) for _ in range(rng.randint(0, 9)))
        room = rng.randint(0, 40)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        chosen = packing.fullest(room, counts, sorted(counts, reverse=True))
        assert all(chosen[length] <= counts[length] for length in chosen)
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)


def test_packing_round_trip(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    packed = packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(), with_ids=True)
    rows = packed.collect()
    plain = Tokenizer.from_file(tokenizer_path()).encode_batch(list(docs.values()), add_special_tokens=False)
    want = {d: [*e.ids, 0] for d, e in zip(docs, plain)}
    bins = defaultdict(list)
    back = defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32
        bins[r.sequence_id].append((r.offset, r.length))
        back[r.doc_id].append((r.piece, r.start, r.ids))
    for doc, parts in back.items():
        assert [i for _, _, ids in sorted(parts) for i in ids] == want[doc]
        assert [p for p, _, _ in sorted(parts)] == list(range(len(parts)))
    for parts in bins.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= packing.CAPACITY
    least = -(-sum(map(len, want.values())) // packing.CAPACITY)
    assert least <= len(bins) <= least * 1.01 + 1
    whole = packing.sequences(packed.where("sequence_id = 0")).first()
    assert len(whole.input_ids) == sum(n for _, n in bins[0])


def test_chat_examples_are_reversible(spark):
    rng = random.Random(7)
    parts = [*Template().controls(), "\\", "<", "|", "a", "\n", "é", "[", "/"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 6)):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice([text, None])))
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    examples = prefix_target_examples(frame)
    counts = dict(examples.where("loss_end is not null").groupBy("conv_id").count().collect())
    assert counts == Counter(r[0] for r in rows if r[2] == "assistant")
    import hashlib

    for r in read_back(examples).collect():
        turns = [t for t in rows if t[0] == r.conv_id]
        text = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in turns)
        loss = "".join(t[3] or "" for t in turns if t[2] == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert prefix_target_examples(frame.limit(0)).count() == 0


def test_url_rules(spark):
    rules = spark.createDataFrame(
        [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow")],
        "rule string, verdict string",
    )
    urls = [
        ("http://WWW.Example.com/en/x?a", "www.example.com/en/", "allow"),
        ("http://m.example.com/en/#/fr/", "example.com/en/", "block"),
        ("http://notexample.com/en/", "com/", "allow"),
        ("http://example.com", None, "allow"),
        ("example.com/en/", None, "allow"),
        (None, None, "allow"),
        ("", None, "allow"),
    ]
    pages = spark.createDataFrame(
        [(i, u, "h") for i, (u, _, _) in enumerate(urls)], "page_id long, url string, host string"
    )
    for file_rules in (1, 1000):
        got = filter_urls(pages, url_index(rules, file_rules)).collect()
        assert [(r.rule, r.verdict) for r in sorted(got)] == [(rule, v) for _, rule, v in urls]
    assert filter_urls(pages.limit(0), url_index(rules)).count() == 0
    assert filter_urls(pages, url_index(rules.limit(0))).where("rule is not null").count() == 0


def test_template_windows_and_slots(spark):
    item = "Tom has 12 apples, and gives Anna 5 apples; how many km did Tom run in 12 days then?"
    texts = {
        1: f"So {item} ok",
        2: "Well Bob has 30 apples, and gives Mary 7 apples; how many km did Bob run in 30 days then? ok",
        3: "Well Bob has 30 apples, and gives Mary 7 apples; how many km did Zed run in 9 days then? ok",
        4: "Nothing of that kind is written in this document about apples or days at all.",
    }
    bench = spark.createDataFrame([(9, item), (10, item)], "item_id long, text string")
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.verbatim for r in find_leaks(frame, bench).collect()}
    assert got == {(1, 9): True, (1, 10): True, (2, 9): False, (2, 10): False}
    template, _ = canonical(F.col("text"))
    words = frame.select(template.alias("t")).first().t.split()
    assert words.count("<name>") == 3 and words.count("<num>") == 3 and words.count("<unit>") == 1


def test_leaks_equal_brute_force(spark, sf_dir, docs):
    items = {r[0]: r[1] for r in read(spark, sf_dir, "benchmark").select("item_id", "text").collect()}
    want = {(d, i) for d, text in docs.items() for i, item in items.items() if item in text}
    got = LLM_CHECKS["op1_decontamination"][0](spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


def test_leaks_in_other_capitals(spark):
    item = "Tom has 12 apples, and Anna gives Bob 5 apples; how many, if Carl takes none, does Tom have?"
    texts = {1: item.upper(), 2: item.lower(), 3: f"so {item.title()} ok", 4: "NOTHING OF IT IS HERE AT ALL, TOM"}
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.coverage, r.verbatim) for r in find_leaks(frame, bench).collect()}
    assert got == {(1, 1.0, True), (2, 1.0, True), (3, 1.0, True)}


def test_leaks_equal_brute_force_whatever_the_capitals(spark, sf_dir, docs):
    items = {r[0]: r[1].lower() for r in read(spark, sf_dir, "benchmark").select("item_id", "text").collect()}
    want = {(d, i) for d, text in docs.items() for i, item in items.items() if item in (text or "").lower()}
    got = LLM_CHECKS["op1_decontamination"][0](spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


def test_names_at_the_start_and_items_without_a_window(spark):
    items = {
        9: "Tom has 12 apples. Tom gives Anna 5 apples. How many apples does Tom have left?",
        10: "What is 12 + 35 * 2 - 7?",
        11: "Add 1 2 3 4 5 6 7 8 9 10",
    }
    texts = {
        1: "Read this. Bob has 30 apples. Bob gives Mary 7 apples. How many apples does Bob have left? Ok",
        2: "Read this. Bob has 30 apples. Bob gives Mary 7 apples. How many apples does Zed have left? Ok",
        3: "They ask: what is 12 + 35 * 2 - 7? Nobody knows.",
        4: "They ask: what is 12 + 35 * 2 - 8? Nobody knows.",
        5: "please add 1 2 3 4 5 6 7 8 9 10 now",
        6: "please add 1 2 3 4 5 6 7 8 9 11 now",
    }
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.verbatim) for r in find_leaks(frame, bench).collect()}
    assert got == {(1, 9, False), (3, 10, True), (5, 11, True)}


def test_leaks_with_words_put_in_or_left_out(spark):
    item = (
        "Tom drives 60 km from the old mill to the grey harbour, and meets Anna there at 5 o'clock; "
        "how many km did Tom drive before the sun went down behind the hills that day?"
    )
    swapped = item.replace("Tom", "Bob").replace("60", "75").replace("5 o'clock", "7 o'clock")
    texts = {
        1: item.replace("there at", "there just at"),
        2: item.replace("meets Anna there", "meets there"),
        3: swapped.replace("Anna", "Mary Ann").replace("75 km", "75km"),
        4: swapped.replace("Anna", "Mary Ann").replace("there at", "there just at"),
        5: "Well so " + item,
        6: swapped.replace("did Bob", "did Zed").replace("there at", "there just at"),
    }
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in find_leaks(frame, bench).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[3].coverage == got[5].coverage == 1.0 and got[5].start_word == 2
    assert got[5].verbatim and not got[3].verbatim and not got[4].verbatim


def test_repeated_forms_do_not_spoil_an_alignment(spark):
    item = " ".join(f"So {n} has just {i} red apples in the box." for i, n in enumerate(["Tom", "Anna", "Carl", "Eve"], 3))
    other = item.replace("Tom", "Bob").replace("6 red", "9 red")
    words = other.split()
    frame = spark.createDataFrame(
        [(1, other), (2, " ".join([*words[:20], "really", *words[20:]]))], "doc_id long, text string"
    )
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = {r.doc_id: r.coverage for r in find_leaks(frame, bench).collect()}
    assert got[1] == 1.0 and 0.5 <= got[2] < 1.0


def test_licenses_equal_brute_force(spark, sf_dir, docs):
    notices = {n: t for n, t in TEMPLATES.items() if n.endswith("notice")}
    want = {(d, n) for d, text in docs.items() for n, notice in notices.items() if notice in text}
    got = {(r.doc_id, r.license) for r in LLM_CHECKS["op7_licenses"][0](spark, sf_dir).collect()}
    assert got == want


def test_edited_license_is_found():
    words = TEMPLATES["MIT"].split()
    edited = ["a", "b", *words[:10], *words[12:40], "extra", "words", *words[40:]]
    index = build_index(TEMPLATES)
    ((number, share, _, start, end),) = scan_text(" ".join(edited), index, 0.8)
    assert index.names[number] == "MIT" and share > 0.95 and (start, end) == (2, len(edited) + 1)


def test_bk_tree_equals_a_scan():
    rng = random.Random(11)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = sorted({rng.choice(centres) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)})
    tree = BKTree()
    for value in values:
        tree.add(value)
    for value in values[:40]:
        near = {v for v in values if (v ^ value).bit_count() <= 2}
        assert {tree.values[i] for i in tree.within(value, 2)} == near
    assert len(spanning_links(values)) < len(values)


def test_simhash_equals_brute_force(spark, sf_dir, docs):
    def bits(text):
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {d: bits(t) for d, t in docs.items()}
    group = {d: d for d in docs}
    ids = sorted(docs)
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                    low, high = sorted((group[a], group[b]))
                    group = {d: low if g == high else g for d, g in group.items()}
                    changed = True
    for r in LLM_CHECKS["op9_simhash"][0](spark, sf_dir).collect():
        assert int(r.fingerprint, 16) == prints[r.doc_id] and r.component_id == group[r.doc_id]


def test_overfull_shards_are_divided(spark):
    from lakebook.llm.simhash import links

    rng = random.Random(13)
    values = {0}
    for _ in range(400):
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(64)))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = links(spark.createDataFrame(signed, "bits long"), shard=4).collect()
    reach = {s[0]: s[0] for s in signed}

    def root(x):
        while reach[x] != x:
            x = reach[x]
        return x

    for u, v in found:
        reach[root(u)] = root(v)
    assert len({root(s[0]) for s in signed}) == 1


def test_toxicity_on_held_out_rows(spark, sf_dir):
    scored = score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    rows = scored.join(read(spark, sf_dir, "labels"), "doc_id").where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = sum(r.toxic == r.predicted for r in rows)
    assert right >= 0.9 * len(rows)


def test_shards_are_near_equal(spark, sf_dir, docs):
    rows = LLM_CHECKS["op10_shards"][0](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 24
    mean, longest = sum(sizes.values()) / 24, max(r["size"] for r in rows)
    assert max(abs(s - mean) for s in sizes.values()) <= longest


def test_hot_text_is_subdivided(spark):
    frame = spark.range(6_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "copy").otherwise(F.col("id").cast("string")).alias("text")
    )
    sizes = shard_by_bytes(frame, 8).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(sizes) == 8 and max(r.s for r in sizes) - min(r.s for r in sizes) <= 24


def test_sample_grows_with_the_corpus():
    assert [substrings.sample_share(n) for n in (0, 10_000, 1_000_000)] == [1, 1, 0.01]
    assert substrings.sample_share(10**12) == substrings.SAMPLE_SHARE


def test_most_frequent_anchors_are_held(spark):
    texts = [" ".join(["a b c d e f g h i j k l m"] * (2 if i % 2 else 1) + [f"x{i}"]) for i in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    every = substrings.frequent_anchors(frame)
    assert len(every) > 1 and (np.diff(every) > 0).all()
    two = substrings.frequent_anchors(frame, held=2)
    assert len(two) == 2 and set(two) <= set(every)
    assert len(substrings.frequent_anchors(frame, held=0)) == 0


@pytest.mark.parametrize("held", [0, 2, substrings.HELD])
def test_frequent_passages_equal_brute_force(spark, monkeypatch, held):
    """Passages in most documents, alone and between other words: frequent anchors."""
    monkeypatch.setattr(substrings, "frequent_anchors", partial(substrings.frequent_anchors, held=held))
    rng = random.Random(17)
    passages = [[f"p{k}w{i}" for i in range(n)] for k, n in ((0, 40), (1, 14), (2, 12))]
    texts = {}
    for doc in range(120):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 9))]
            passage = list(rng.choice(passages))
            if rng.random() < 0.3:
                passage[rng.randrange(len(passage))] = "edit"
            words += passage
        texts[doc] = words
    owner = {}
    for doc, words in texts.items():
        for i in range(len(words) - 12):
            owner.setdefault(tuple(words[i : i + 13]), doc)
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string")
    for r in dedup_substrings(frame).collect():
        words = texts[r.doc_id]
        gone = set()
        for i in range(len(words) - 12):
            if owner[tuple(words[i : i + 13])] < r.doc_id:
                gone.update(range(i, i + 13))
        assert r.kept_text.split() == [w for i, w in enumerate(words) if i not in gone]
        assert [i for a, b in r.spans for i in range(a, b)] == sorted(gone)
