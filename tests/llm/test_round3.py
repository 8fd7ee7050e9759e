"""Spelling variants, exact dedup and token alignment against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakebook.llm import spelling
from lakebook.llm.alignment import align_documents, align_texts
from lakebook.llm.common import read
from lakebook.llm.exact import distinct_texts, exact_groups
from lakebook.llm.queries import LLM_CHECKS, tokenizer_path
from lakebook.llm.spelling import GramIndex, list_keys, near_words, one_edit, spelling_variants

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
LONG = " ".join(f"w{i} größe" for i in range(20_000))
ODD = "doc_id long, text string, TEXT string, word string, digest string, chunk int, pair long, key string, n int"
ODD_ROWS = [
    (1, None), (2, ""), (3, "similar spelling similar spelling"), (3, "similar spelling similar spelling"),
    (None, "similar spelling similar spelling"), (4, "simular Simular"), (5, LONG), (6, " \n\t "), (None, None),
    (7, "a ▁ mark"), (8, "</s> <|endoftext|> \x00 end"),
]


@pytest.fixture(scope="module")
def odd(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    yield spark.createDataFrame([(*r, "x", "w", "d", 1, 2, "k", 3) for r in ODD_ROWS], ODD)
    spark.conf.set("spark.sql.caseSensitive", "false")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r[0]: r[1] for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()}


OPERATORS = {
    "exact": exact_groups,
    "distinct": distinct_texts,
    "align": lambda d: align_documents(d, A, B),
    "spelling": spelling_variants,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(spark, odd, name):
    assert OPERATORS[name](odd.limit(0)).collect() == []


def test_exact_groups_of_odd_rows(odd):
    rows = exact_groups(odd).collect()
    assert len(rows) == len(ODD_ROWS)
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows if r.digest == empty} == {
        (1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False)
    }
    same = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows if r.group_size == 3 and r.digest != empty]
    assert sorted(same, key=str) == [(3, 3, 3, True), (3, 3, 3, True), (None, 3, 3, False)]
    alone = odd.where("doc_id is null")
    assert {(r.keep_id, r.kept) for r in exact_groups(alone).collect()} == {(None, True)}
    kept = {(r.doc_id, r.copies) for r in distinct_texts(odd).collect()}
    assert kept == {(2, 3), (3, 3), (4, 1), (5, 1), (6, 1), (7, 1), (8, 1)}


def test_texts_of_one_digest_stay_apart(spark):
    """A digest of one letter: only the content tells the texts apart."""
    rng = random.Random(1)
    rows = [(i, rng.choice("ab") + str(rng.randrange(20))) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    best, sizes = {}, Counter(t for _, t in rows)
    for i, t in rows:
        best[t] = max(best.get(t, 0), i)
    weak = exact_groups(frame, digest=lambda t: F.substring(t, 1, 1)).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in weak} == {
        (i, best[t], sizes[t], best[t] == i) for i, t in rows
    }
    folded = exact_groups(frame, normal=lambda t: F.substring(t, 1, 1)).collect()
    assert {r.group_size for r in folded} == set(Counter(t[0] for _, t in rows).values())


def plain_alignment(text, left, right):
    """Both sides as (id, first byte, end), or None; straight from the libraries."""
    if not text:
        return None
    raw = f" {text}".encode()
    back = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    back |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in back.values())}
    sides = []
    ids = left.encode(f" {text}", add_special_tokens=False).ids
    spelled = [bytes(back[c] for c in left.id_to_token(i)) for i in ids]
    pieces = right.encode(text, out_type=str)
    other = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and right.is_byte(right.piece_to_id(p)) else p.replace("▁", " ").encode() for p in pieces]
    for tokens, parts in ((ids, spelled), (right.encode(text), other)):
        if b"".join(parts) != raw:
            return None
        at, side = 0, []
        for token, part in zip(tokens, parts):
            side.append((token, at, at + len(part)))
            at += len(part)
        sides.append(side)
    return sides


def brute_alignment(docs):
    left = Tokenizer.from_file(A)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=B)
    counts, links, out = Counter(), {}, {}
    for doc, text in docs.items():
        both = plain_alignment(text, left, right)
        if both is None:
            out[doc] = (0, 0, 0, "")
            continue
        a, b = both
        found, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            found.append((a[i][0], b[j][0]))
            ea, eb = a[i][2], b[j][2]
            i, j = i + (ea <= eb), j + (eb <= ea)
        groups, start = [], 0
        for end in sorted({x[2] for x in a} & {x[2] for x in b}):
            groups.append("|".join(",".join(str(t) for t, s, e in side if start <= s and e <= end) for side in ([x for x in a if start <= x[1] < end], [x for x in b if start <= x[1] < end])))
            start = end
        links[doc] = found
        counts.update(set(found))
        out[doc] = (len(a), len(b), len(groups), ";".join(groups))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    return {
        d: (*out[d][:3], len(links.get(d, ())), sum(counts[p] == best[p[0]] for p in links.get(d, ())),
            sum(counts[p] for p in links.get(d, ())),
            hashlib.sha256(out[d][3].encode()).hexdigest() if out[d][3] else "")
        for d in docs
    }


def test_alignment_equals_brute_force(spark, docs):
    # Texts of 4,000 characters at most, as the plain version is quadratic.
    some = {d: t for d, t in docs.items() if len(t or "") <= 4_000}
    some |= {-1: "x </s> <|endoftext|> y", -2: "tab\there  two", -3: "\x00", -4: "▁", -5: "é中😀 " * 5, -6: " ", -7: "x"}
    frame = spark.createDataFrame(list(some.items()), "doc_id long, text string").repartition(6)
    want = brute_alignment(some)
    for links in (3_000, 10**6):
        for r in align_documents(frame, A, B, chunk_links=links).collect():
            assert tuple(r[1:]) == want[r.doc_id], r.doc_id


def test_alignment_query_and_real_outputs(spark, sf_dir, docs):
    rows = LLM_CHECKS["op13_alignment"][0](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups and r.n_best <= r.n_links <= r.count_sum for r in rows)
    frame = spark.createDataFrame([(1, "a house"), (2, "a house")], "doc_id long, text string")
    aligned = align_texts(frame, A, B, with_groups=True)
    (text,), pairs = aligned.texts.collect(), aligned.pairs.collect()
    left = Tokenizer.from_file(A).encode(" a house", add_special_tokens=False).ids
    right = sentencepiece.SentencePieceProcessor(model_file=B).encode("a house")
    assert len(left) == len(right) == 2 and text.groups == f"{left[0]}|{right[0]};{left[1]}|{right[1]}"
    assert {(p.a, p.b, p.docs, p.best) for p in pairs} == {(*pair, 2, True) for pair in zip(left, right)}


def test_alignment_of_odd_rows(odd):
    rows = align_documents(odd, A, B).collect()
    assert len(rows) == len(ODD_ROWS)
    none = [r for r in rows if r.groups_sha256 == ""]
    assert {r.doc_id for r in none} == {1, 2, None, 7} and all(sum(r[1:7]) == 0 for r in none)
    same = {tuple(r[1:]) for r in rows if r.doc_id == 3 or (r.doc_id is None and r.n_a)}
    assert len(same) == 1


def brute_words(docs):
    seen = Counter()
    for doc, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def brute_near(words):
    """All words one edit apart, through the strings each leaves after one deletion."""
    met, near = defaultdict(set), defaultdict(set)
    for w in words:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            met[x].add(w)
    for group in met.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def brute_variants(docs):
    words = brute_words(docs)
    near, out, form = brute_near(words), {}, {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def test_one_edit():
    import duckdb

    rng = random.Random(2)
    pairs = [tuple("".join(rng.choice("abé") for _ in range(rng.randint(0, 4))) for _ in "xy") for _ in range(2_000)]
    for a, b in pairs:
        same = len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        shorter = len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))
        assert one_edit(a, b) == (same or shorter)


def test_one_edit_leaves_as_many_grams_as_the_bound_says():
    """Every edit of words over a small alphabet, whatever the frequent grams."""
    rng = random.Random(3)
    for _ in range(60):
        base = Counter()
        for _ in range(200):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(4, 9)))
            base.update(word[i : i + q] for q in range(2, 6) for i in range(len(word) - q + 1))
        index = GramIndex.of({g: n for g, n in base.items() if n > rng.choice([4, 15, 40])}, (2, 6))
        if any(g[:-1] not in index.frequent for g in index.frequent if len(g) > 2):
            index = GramIndex.of({g: n for g, n in base.items() if n > 15}, (2, 6))
        for _ in range(12):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(4, 9)))
            grams, bound = index.decompose(word), index.affected(word, index.decompose(word))
            for i in range(len(word) + 1):
                others = [word[:i] + c + word[i:] for c in "abcd"] + [word[:i] + word[i + 1 :]]
                others += [word[:i] + c + word[i + 1 :] for c in "abcd"]
                for other in others:
                    if not one_edit(word, other):
                        continue
                    theirs = index.decompose(other)
                    left = {(s, other[s:e]) for s, e in theirs}
                    right = {(len(other) - s, other[s:e]) for s, e in theirs}
                    common = sum(
                        (e <= i and (s, word[s:e]) in left) or (s >= i and (len(word) - s, word[s:e]) in right)
                        for s, e in grams
                    )
                    assert common >= len(grams) - bound
                    (mine, ok), (its, ok2) = index.rarest(word), index.rarest(other)
                    if ok or ok2:
                        assert set(list_keys(word, mine)) & set(list_keys(other, its))


@pytest.mark.parametrize("frequent", [3, 30, 10**6])
def test_near_words_equal_brute_force(spark, docs, frequent):
    words = brute_words(docs.items())
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(4)
    got = {(r.word, r.near) for r in near_words(frame, frequent=frequent).collect()}
    assert got == {(a, b) for a, near in brute_near(words).items() for b in near}


def test_variants_equal_brute_force(spark, sf_dir, docs):
    got = {r.word: tuple(r[1:]) for r in LLM_CHECKS["op11_spelling"][0](spark, sf_dir).collect()}
    assert got == brute_variants(docs.items())
    assert any(form for form, *_ in got.values())


def test_roots_end_chains(spark):
    """Each form ten times as often: one chain of six words, and a fork into it."""
    chain = ["spelling", "spellings", "spellingsa", "spellingsab", "spellingsabc", "spellingsabcd"]
    counts = {w: 2 * 10 ** (len(chain) - 1 - i) // 10 for i, w in enumerate(chain[:-1])} | {"xpellingsab": 2}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: tuple(r[1:]) for r in spelling_variants(frame).collect()}
    assert got == brute_variants(rows) and sum(form != root for form, root, *_ in got.values() if form) >= 2


def test_variants_of_odd_rows(odd):
    got = {r.word: tuple(r[1:]) for r in spelling_variants(odd).collect()}
    assert got == brute_variants(ODD_ROWS) and {"similar", "spelling"} <= set(got)


@pytest.mark.parametrize("compared,most", [(0, 10**6), (16, 40), (10**6, 10**6)])
def test_lists_of_every_size_are_merged_alike(spark, docs, monkeypatch, compared, most):
    monkeypatch.setattr(spelling, "COMPARED", compared)
    monkeypatch.setattr(spelling, "LIST", most)
    words = brute_words(docs.items())
    want = {tuple(sorted(p)) for p in ((a, b) for a, near in brute_near(words).items() for b in near)}
    some = sorted(words)[:3_000]
    assert set(spelling.near_in(some)) == {p for p in want if set(p) <= set(some)}
    assert set(spelling.near_in(["ab", "b", "a", "aab", "abb", "c"] * 1)) == {
        ("a", "ab"), ("ab", "b"), ("a", "b"), ("a", "c"), ("b", "c"), ("aab", "ab"), ("ab", "abb"), ("aab", "abb")
    }
    if most == 40:
        frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(4)
        assert {tuple(sorted(r)) for r in near_words(frame, frequent=10**6).collect()} == want


def test_a_word_with_very_many_variants(spark):
    """One word's variants fill a list far beyond what is compared in one place."""
    rng = random.Random(5)
    base = "abcdefghij"
    words = {base + "".join(rng.choice("klmnopqrst") for _ in range(3)) for _ in range(700)}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    got = {(r.word, r.near) for r in near_words(frame, frequent=100_000).collect()}
    assert got == {(a, b) for a, near in brute_near(words).items() for b in near} and len(got) > 700
