"""The training-data operators against brute force, on a small table with every awkward case."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shelfmark.llm import ann, bpe, fingerprint, katz, line_dedup, minhash, mixing, queries, sharding, substring, toxicity
from shelfmark.llm.common import SHUFFLE_CLEANUP, Staging

SCHEMA = "doc_id long, text string, source string, id string, bucket int, component long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def corpus():
    """Rows ``(doc_id, text, source)``: copies, near copies, shared passages, NULL and odd texts."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    fresh = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [fresh(rng.randint(30, 90)) for _ in range(40)]
    for i in range(6):  # near copies: one word changed at an end, so few shingles differ
        changed = texts[i].split()
        changed[-1] = "changed"
        texts.append(" ".join(changed))
    texts += [texts[7]] * 8
    passage = fresh(70)
    texts += [f"{fresh(20)} {passage} {fresh(15)}" for _ in range(3)]
    line = "the quick brown fox jumps over the lazy dog near the river bank today"
    texts += [f"{fresh(9)}\n{line}\n{fresh(8)}", f"{line.replace('today', 'todaz')}\n{fresh(12)}", f"{fresh(7)}\n{line.upper()}"]
    texts += [None, "", "   \n\t", "one two", "ONE two", "café 你好 \U0001f600‍\U0001f600  x", fresh(6000)]
    sources = ["a", "a", "a", "b", None]
    return [(3 * i + 1, t, sources[i % 5]) for i, t in enumerate(texts)]


ROWS = corpus()
TEXT = {i: t for i, t, _ in ROWS}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in ROWS], SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


class Groups(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def link(self, x, y):
        x, y = sorted((self.root(x), self.root(y)))
        self[y] = x


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_minhash(docs, empty):
    sets, groups = {i: shingles(t) for i, t in TEXT.items()}, Groups()
    for i in sets:
        groups.root(i)
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                groups.link(i, j)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == {(i, len(s), groups.root(i), groups.root(i) == i) for i, s in sets.items()}
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in sets if groups.root(i) == i}
    assert minhash.near_duplicates(empty).collect() == []


def test_minhash_null_and_repeated_keys(spark):
    rows = [(None, "a b c d e f", None), (4, "a b c d e f", "s"), (4, "a b c d e f", "s"), (2, "a b c d e f", "s")]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    got = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == Counter({(None, None, True): 1, (4, 2, False): 2, (2, 2, True): 1})


def edits(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        before, row = row, [i]
        for j, b in enumerate(y, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return row[-1]


#: Of the four blocks of a SimHash.
BLOCK_BITS = (0x0F0F0F0F, 0x0F0F0F0F << 32, 0xF0F0F0F0, 0xF0F0F0F0 << 32)


def simhash(w):
    """32 bits of the distinct words of each half of a line, from the lower four of each byte of their hashes: those that
    more than half of the words have; at exactly half, the word with the largest (signed) hash decides."""
    out = 0
    middle = (len(w) + 1) // 2
    for shift, part in ((0, w[:middle]), (4, w[middle:])):
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in set(part)]
        top = max(hashes, key=lambda h: h - (1 << 64) if h >> 63 else h)
        for k in (k for k in range(64) if k % 8 < 4):
            ones = sum(h >> k & 1 for h in hashes)
            out |= (1 if 2 * ones > len(hashes) else top >> k & 1 if 2 * ones == len(hashes) else 0) << k + shift
    return out


def test_line_dedup_finds_lines_with_one_changed_word(spark):
    """Of 150 pairs a length that differ in one letter, and of those with a word more, measured by brute force."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(3, 9)))
    for length in (8, 12, 25, 40):
        pairs = []
        for k in range(150):
            line = [word() for _ in range(length)]
            other, at = list(line), rng.randrange(length)
            other[at] = other[at][:-1] + rng.choice(letters.replace(other[at][-1], ""))
            pairs += [(3 * k, " ".join(line)), (3 * k + 1, " ".join(other))]
        found = line_dedup.line_groups(spark.createDataFrame(pairs, "doc_id long, text string")).where("NOT kept").collect()
        assert all(r.doc_id == r.first_doc_id + 1 for r in found)
        assert len(found) >= 0.9 * 150, (length, len(found))


def test_line_dedup_finds_few_edits_wherever_they_are(spark):
    """Pairs that are similar enough and differ in both halves, in length, in short lines, or on both sides of ``LONG``."""
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(4, 9)))
    changed = lambda w: w[:-1] + rng.choice(letters.replace(w[-1], ""))
    pairs = []
    for n in (2, 3, 5, 7, 8, 9, 12, 25, 40, 70, 130):
        for _ in range(25):
            line = [word() for _ in range(n)]
            two = list(line)
            for at in rng.sample(range(n), 2):
                two[at] = changed(two[at])
            spread = [*line[: n // 3], changed(line[n // 3]), *line[n // 3 + 1 :]]
            if n >= 12:
                spread.insert(rng.randrange(n), "new")
            pairs += [(line, two), (spread, line)]
    for _ in range(25):  # 64 and 65 words
        line = [word() for _ in range(line_dedup.LONG)]
        pairs.append((line, [*line[:20], "one", *line[20:]]))
    pairs = [(" ".join(x), " ".join(y)) for x, y in pairs]
    by_word = lambda x, y: min(x.count(" "), y.count(" ")) >= line_dedup.LONG
    pairs = [(x, y) for x, y in pairs if by_word(x, y) or edits(x, y) <= 0.1 * max(len(x), len(y))]
    assert len(pairs) > 450
    rows = [(2 * i + j, line) for i, pair in enumerate(pairs) for j, line in enumerate(pair)]
    found = line_dedup.line_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    firsts = {r.doc_id: r.first_doc_id for r in found.collect()}
    assert [pairs[i] for i in range(len(pairs)) if firsts[2 * i + 1] != firsts[2 * i]] == []


def test_line_dedup_finds_up_to_seven_edited_words_and_all_similar_lines_of_few_letters(spark):
    """Edits spread over the whole line, pairs that are similar enough by letters or, over ``LONG`` words, by words."""
    rng = random.Random(23)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda low=4, high=9: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
    changed = lambda w: w[:-1] + rng.choice(letters.replace(w[-1], ""))
    pairs = []
    for n in (30, 40, 64, 65, 100, 300):
        for _ in range(10):
            line = [word() for _ in range(n)]
            other = list(line)
            edited = min(n // 10, 2 * line_dedup.SIDE - 1)
            for k in range(edited):
                at = k * n // edited + rng.randrange(n // edited)
                other[at] = word() if n > line_dedup.LONG else changed(other[at])
            pairs.append((" ".join(line), " ".join(other)))
    for n in (8, 10, 12):
        for _ in range(15):
            line = [word(3, 5) for _ in range(n)]
            other = list(line)
            for at in rng.sample(range(n), len(" ".join(line)) // 10):
                other[at] = changed(other[at])
            pairs.append((" ".join(line), " ".join(other)))
    pairs = [p for p in pairs if p[0].count(" ") >= 20 or len(p[0]) <= line_dedup.LETTERS]
    assert len(pairs) > 95
    rows = [(2 * i + j, line) for i, pair in enumerate(pairs) for j, line in enumerate(pair)]
    found = line_dedup.line_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    firsts = {r.doc_id: r.first_doc_id for r in found.collect()}
    assert [len(pairs[i][0].split()) for i in range(len(pairs)) if firsts[2 * i + 1] != firsts[2 * i]] == []


def test_line_dedup_compares_only_lines_of_like_length(spark, monkeypatch):
    """Lines of one word repeated share a SimHash: a link needs lengths within a tenth, others are never paired."""
    made, keep = {}, line_dedup.Staging.keep
    monkeypatch.setattr(line_dedup.Staging, "keep", lambda self, df, name: made.setdefault(name, keep(self, df, name).cache()))
    lengths = [8 * 5**i for i in range(4)] + [8 * 5**i + k * 5**i for i in range(4) for k in (2, 4)]
    lines = [" ".join(["one two"] * n) for n in lengths]
    found = line_dedup.line_groups(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    assert {(r.doc_id, r.first_doc_id) for r in found.collect()} == {(i, i) for i in range(len(lines))}
    assert "likely-rest" not in made or made["likely-rest"].count() == 0


def test_line_dedup_pairs_few_lines_that_share_a_passage_and_stores_buckets_no_longer_than_needed(spark, monkeypatch):
    """Lines of like length that share a passage are compared only if their letters, or words, are nearly the same ones."""
    rng, made, dropped = random.Random(7), {}, []
    keep, drop = line_dedup.Staging.keep, line_dedup.Staging.drop
    monkeypatch.setattr(line_dedup.Staging, "keep", lambda self, df, name: made.setdefault(name, keep(self, df, name).cache()))
    monkeypatch.setattr(line_dedup.Staging, "drop", lambda self, name: (dropped.append((name, set(made))), drop(self, name)))
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5))
    lines = []
    for n in (30, 100):
        passage = [word() for _ in range(n // 3)]
        lines += [passage + [word() for _ in range(n - n // 3)] for _ in range(30)]
        lines.append([*lines[-1][:-1], word()])
    found = line_dedup.line_groups(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string"))
    firsts = {r.doc_id: r.first_doc_id for r in found.collect()}
    assert {i: first for i, first in firsts.items() if i != first} == {30: 29, 61: 60}
    assert "likely-rest" not in made or made["likely-rest"].count() <= 31
    assert [before for name, before in dropped if name == "keyed" and not any(x.startswith("likely") for x in before)]


def test_line_dedup_keeps_one_bucket_of_those_with_the_same_lines(spark, monkeypatch):
    """Lines that share a passage share many buckets; a pair is made in one of them, also where sets overlap."""
    rows = [(bucket, i) for bucket, ids in ((3, (1, 2, 5)), (4, (1, 2, 5)), (6, (1, 2, 5)), (8, (1, 3, 5)), (9, (1, 5)), (10, (1, 5)), (11, (2, 1, 5, 7))) for i in ids]
    mates = spark.createDataFrame(rows, "bucket long, id long").withColumn("hub", F.lit(1))
    kept = line_dedup.distinct_buckets(mates, "bucket & 1L = 0").collect()
    assert sorted((r.bucket, r.id) for r in kept) == [r for r in sorted(rows) if r[0] not in (4, 6, 10)]
    rng, made, keep = random.Random(5), {}, line_dedup.Staging.keep
    monkeypatch.setattr(line_dedup.Staging, "keep", lambda self, df, name: made.setdefault(name, keep(self, df, name).cache()))
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    line = [word() for _ in range(60)]
    lines = [" ".join([*line[:29], word(), *line[30:]]) for _ in range(40)]
    found = line_dedup.line_groups(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    assert {r.first_doc_id for r in found.collect()} == {0}
    assert made["mates"].select("bucket").distinct().count() < sum(made[f"buckets-{i}"].count() for i in range(line_dedup.SLICES)) / 2


def test_line_dedup_compares_few_lines_of_one_origin_that_were_edited_in_many_places(spark, monkeypatch):
    """Lines that are too far from one another are told by their rarest words, and long ones by all their words."""
    rng, made, keep = random.Random(11), {}, line_dedup.Staging.keep
    monkeypatch.setattr(line_dedup.Staging, "keep", lambda self, df, name: made.setdefault(name, keep(self, df, name).cache()))
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5))
    edited = lambda line, edits: [word() if i in edits else w for i, w in enumerate(line)]
    lines, copies = [], {}
    for n in (40, 100):
        origin = [word() for _ in range(n)]
        some = [edited(origin, rng.sample(range(n), 9)) for _ in range(60)]
        copies |= {len(lines) + 60 + i: len(lines) + i for i in range(20)}
        lines += some + [edited(x, rng.sample(range(n), 2)) for x in some[:20]]
    found = line_dedup.line_groups(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string"))
    firsts = {r.doc_id: r.first_doc_id for r in found.collect()}
    assert all(firsts[i] == firsts[of] for i, of in copies.items())
    assert "likely-rest" not in made or made["likely-rest"].count() < 40


def test_toxicity_learns_from_a_few_texts_at_once():
    words = [f"word{i}" for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"t": [" ".join(words)] * 150, "toxic": pa.array([1, 0, 1] * 50, type=pa.int32())})
    parts = list(toxicity._taught(iter([batch])))
    assert max(p.num_rows for p in parts) <= toxicity.TAUGHT_ROWS * len(toxicity.features(" ".join(words)))
    counts = Counter((t, y) for p in parts for t, y in zip(*p.to_pydict().values(), strict=True))
    assert counts == Counter({(t, y): 100 if y else 50 for t in toxicity.features(" ".join(words)) for y in (0, 1)})


def test_marks_differ_by_twice_the_edits_at_most(spark):
    rng = random.Random(8)
    rows = []
    for n, alphabet in ((40, "ab e"), (300, "abcxyz ."), (900, "ae"), (80, "жаé a漢")):
        x = "".join(rng.choices(alphabet, k=n))
        y = list(x)
        for _ in range(9):
            at = rng.randrange(len(y))
            y[at : at + rng.randrange(2)] = rng.choices(alphabet + "q", k=rng.randrange(2))
        rows.append((x, "".join(y)))
    words = lambda c: f"split({c}, '')"
    df = spark.createDataFrame(rows, "x string, y string").selectExpr(
        "levenshtein(x, y) AS edits",
        *[f"{line_dedup.letter_marks(c)} AS l{c}" for c in "xy"],
        *[f"{line_dedup.word_marks(words(c))} AS w{c}" for c in "xy"],
    )
    for r in df.selectExpr("edits", f"{line_dedup.marks_apart('lx', 'ly')} AS letters", f"{line_dedup.marks_apart('wx', 'wy')} AS words").collect():
        assert 0 <= r.letters <= 2 * r.edits and 0 < r.words <= 2 * r.edits


def test_line_dedup_leaves_only_its_result_on_disk(spark, monkeypatch):
    cleared, clear = [], line_dedup.Staging.clear
    monkeypatch.setattr(line_dedup.Staging, "clear", lambda self: (cleared.append(self.folder), clear(self)))
    found = line_dedup.line_groups(spark.createDataFrame([(1, "a line of words"), (2, "a line of wordz")], "doc_id long, text string"))
    assert len(cleared) == 1 and not os.path.exists(cleared[0].removeprefix("file:"))
    assert found.where("kept").count() == 1


def test_pipeline_drops_lines_edited_in_both_halves(spark):
    line = "an early line of eleven words that ends in the same harbour"
    rows = [(1, line), (2, f"kept as it is\n{line.replace('early', 'earlx').replace('harbour', 'harbous')}"), (3, "page one"), (4, "an0ther line\nanother line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, df, "").collect()}
    assert kept == {1: line, 2: "kept as it is", 3: "page one", 4: "an0ther line"}


def test_rows_that_share_a_key_lose_only_their_own(spark):
    line = "one line of ten plain words that stands in two"
    rows = [(1, line), (5, line), (5, "the only copy of this text of ten plain words"), (None, line), (None, line), (6, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in line_dedup.drop_repeated_lines(df).collect())
    assert kept == Counter({**Counter(rows), (5, line): 0}) + Counter([(5, "")])
    kept = Counter((r.doc_id, r.text) for r in minhash.keep_first(df).collect())
    assert kept == Counter(r for r in rows if r != (5, line))
    found = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert found == Counter({(1, 1, True): 1, (5, 1, False): 1, (5, 5, True): 1, (None, None, True): 2, (6, 6, True): 2})


def test_line_dedup(docs, empty):
    lines = {(i, n): WORD.findall(line.lower()) for i, t in TEXT.items() for n, line in enumerate((t or "").split("\n"))}
    lines = {at: w for at, w in sorted(lines.items()) if w}
    got = {(r.doc_id, r.line_no): ((r.first_doc_id, r.first_line_no), r.kept) for r in line_dedup.line_groups(docs).collect()}
    assert got.keys() == lines.keys()
    firsts, groups = {}, Groups()
    for at, w in lines.items():
        groups.link(firsts.setdefault(tuple(w), at), at)
    hashes = {w: simhash(w) for w in firsts if len(w) >= line_dedup.WORDS[0]}
    fuzzy = 0
    for x, y in combinations(hashes, 2):
        apart = hashes[x] ^ hashes[y]
        if apart.bit_count() <= line_dedup.BITS and sum(not apart & block for block in BLOCK_BITS) >= line_dedup.AGREE:
            by_word = [len(z) > line_dedup.LONG for z in (x, y)]
            a, b = (x, y) if by_word[0] else (" ".join(x), " ".join(y))
            if by_word[0] == by_word[1] and edits(a, b) <= 0.1 * max(len(a), len(b)):
                groups.link(firsts[x], firsts[y])
                fuzzy += 1
    assert fuzzy
    assert got == {at: (groups.root(at), groups.root(at) == at) for at in lines}
    kept = line_dedup.drop_repeated_lines(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    texts = {r.doc_id: r.text for r in kept.collect()}
    for i, t in TEXT.items():
        left = [line for n, line in enumerate((t or "").split("\n")) if got.get((i, n), (0, True))[1]]
        assert (texts[i] or "") == "\n".join(left)
    assert line_dedup.line_groups(empty).collect() == []


def test_fingerprint(docs, empty):
    got = {r.doc_id: r for r in fingerprint.compare_edits(docs).collect()}
    order = sorted(TEXT, reverse=True)
    prints = {}
    for i, after in zip(order, [*order[1:], order[0]], strict=True):
        own, following = TEXT[i] or "", TEXT[after] or ""
        third = len(own) // 3
        edited = own[: len(own) - third] + following[:third]
        assert got[i].n_chars == len(own)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        x, y, z = Counter(words(own)), Counter(words(edited)), Counter(words(following))
        for likeness, other in ((got[i].near_edited, y), (got[i].near_next, z)):
            assert 0 <= likeness <= 1
            if len(x) > 20 and len(other) > 20:
                exact = sum((x & other).values()) / sum((x | other).values())
                assert abs(likeness - exact) < 0.28
        assert prints.setdefault(own, got[i].fingerprint) == got[i].fingerprint
    assert fingerprint.compare_edits(empty).collect() == []


def test_edit_fingerprints_are_those_of_both_texts(spark):
    """Words drawn once for both versions give what each version gives by itself, wherever the cut falls."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(0, "", ""), (1, "", "a b"), (2, "a b", ""), (3, "ab", "ac"), (4, "a b", "a c"), (5, " \n ", " \nx"), (6, "é" * 9000 + " z", "é" * 8999 + "y z")]
    for i in range(7, 60):
        own = " ".join(rng.choices(vocabulary, k=rng.randint(1, 80))) + rng.choice(["", " ", "\n"])
        cut = rng.randint(0, len(own))
        rows.append((i, own, own[:cut] + " ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))))
    same = [next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for _, a, b in rows]
    pairs = spark.createDataFrame([(*r, n) for r, n in zip(rows, same, strict=True)], "i int, a string, b string, n int")
    got = {r.i: r for r in fingerprint.edit_fingerprints(pairs, ["i"], "a", "b", "n").collect()}
    for name, column in (("a", "own"), ("b", "edited")):
        plain = {r.i: r.samples for r in fingerprint.fingerprints(pairs, ["i"], name).collect()}
        assert {i: r[column] for i, r in got.items() if r[column] is not None} == plain


def test_likeness_is_generalised_jaccard(spark):
    """Over many pairs the mean error is small and errors spread as the number of places says."""
    rng = random.Random(3)
    rows = []
    for i in range(300):
        vocabulary = [f"v{i}-{n}" for n in range(120)]  # its own words, so that errors are independent
        own = rng.choices(vocabulary, weights=[1 / (n + 1) for n in range(120)], k=100)
        kept = rng.randint(0, 100)
        rows.append((i, " ".join(own), " ".join(own[:kept] + rng.choices(vocabulary, k=100 - kept))))
    pairs = spark.createDataFrame([(*r, 0) for r in rows], "i int, a string, b string, n int")
    got = fingerprint.edit_fingerprints(pairs, ["i"], "a", "b", "n")
    got = {r.i: r.near for r in got.select("i", fingerprint.likeness("own", "edited").alias("near")).collect()}
    errors = []
    for i, a, b in rows:
        x, y = Counter(words(a)), Counter(words(b))
        errors.append(got[i] - sum((x & y).values()) / sum((x | y).values()))
    assert abs(sum(errors)) / 300 < 0.012 and sum(e * e for e in errors) / 300 < 0.0625**2 * 1.2


def test_fingerprint_edge_cases(spark):
    """Rows without key come last, rows sharing one follow each other, equal rows are reported as often as they occur."""
    rows = [(None, "last one"), (5, "x y z"), (5, "x y z"), (5, "other words here"), (9, None), (9, ""), (2, "a" * 3000)]
    table = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, source string, third int")
    got = fingerprint.compare_edits(table).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == sorted((i or -1, len(t or "")) for i, t in rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    last = next(r for r in got if r.doc_id is None)  # followed by the first in order, the empty text of 9
    assert last.edited_sha256 == hashlib.sha256(b"last o").hexdigest()


def test_sharding(docs, empty):
    limit = 2_000
    rows = sharding.extendible_shards(docs, limit).collect()
    assert sorted(r.doc_id for r in rows) == sorted(TEXT)
    total, members = Counter(), defaultdict(set)
    for r in rows:
        assert r.bytes == len((TEXT[r.doc_id] or "").encode()) and len(r.shard) == r.depth
        total[r.shard] += r.bytes
        members[r.shard].add(r.doc_id)
    names = sorted(total)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))
    for r in rows:
        assert r.shard_bytes == total[r.shard] and r.oversized == (total[r.shard] > limit)
        assert not r.oversized or len(members[r.shard]) == 1
    for a in names:  # only full buckets split: a shard and its sibling would not fit together
        if a:
            sibling = a[:-1] + ("1" if a[-1] == "0" else "0")
            assert sum(n for s, n in total.items() if s.startswith(a[:-1])) > limit or not any(s.startswith(sibling) for s in names)
    assert sharding.extendible_shards(empty, limit).collect() == []


def test_source_mix(docs, empty):
    rows = mixing.mix_sources(docs).collect()
    source = {i: s for i, _, s in ROWS}
    sizes = Counter()
    for i, t, s in ROWS:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights, open_, left = dict(zip(names, (5, 2, 1), strict=True)), set(names), Fraction(sum(sizes.values()))
    targets = {}
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not full:
            targets |= share
            break
        for s in full:
            targets[s] = Fraction(3 * sizes[s])
            left -= targets[s]
        open_ -= full
    taken = Counter()
    for r in rows:
        assert r.size == len(WORD.findall(TEXT[r.doc_id] or "")) and r.source_size == sizes[source[r.doc_id]]
        assert math.isclose(r.target, targets[source[r.doc_id]])
        assert r.taken <= 3 * r.size and (r.taken == 0 or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
    for s in names:
        assert targets[s] - 100 < taken[s] <= targets[s] + 100
    assert sorted(rows) == sorted(mixing.mix_sources(docs).collect())
    out = mixing.take(docs)
    assert out.columns == docs.columns
    uses = Counter(r.doc_id for r in out.collect())
    assert all(uses[r.doc_id] * r.size == r.taken for r in rows)
    assert mixing.mix_sources(empty).collect() == []


def test_katz(docs, empty):
    rows = katz.score_texts(docs, queries.held_out(10, 0)).collect()
    held = {i: crc32(str(i).encode()) % 10 == 0 for i in TEXT}
    end = object()
    tokens = {i: [*words(t), end] for i, t in TEXT.items()}
    c = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    pairs = Counter((v, w) for i, t in tokens.items() if not held[i] for v, w in zip([None, *t[:-1]], t, strict=True))
    n, distinct = sum(c.values()), len(c)
    d1 = [*katz.discounts([sum(x == r for x in c.values()) for r in range(1, katz.K + 2)]), *[1.0]]
    d2 = [*katz.discounts([sum(x == r for x in pairs.values()) for r in range(1, katz.K + 2)]), *[1.0]]
    cut = lambda d, r: d[min(r, katz.K + 1) - 1] * r
    unknown = 1 - sum(cut(d1, x) for x in c.values()) / (n + 1)
    p1 = lambda w: cut(d1, c[w]) / (n + 1) if c[w] else unknown
    starts = sum(not h for h in held.values())
    after = defaultdict(dict)
    for (v, w), r in pairs.items():
        after[v][w] = r

    def p2(v, w):
        times = starts if v is None else c[v]
        if w in after[v]:
            return cut(d2, after[v][w]) / (times + 1)
        spare = 1 - sum(cut(d2, r) for r in after[v].values()) / (times + 1)
        return spare / (1 - sum(p1(x) for x in after[v])) * p1(w)

    for v in [None, tokens[1][0], "nowhere"]:  # exactly normalised, all unknown words being one
        assert math.isclose(sum(p2(v, w) for w in [*c, "unseen"]), 1.0, rel_tol=1e-9)
    assert len(rows) == len(TEXT)
    for r in rows:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (distinct + 1))) for w in t), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(p2(v, w)) for v, w in zip([None, *t[:-1]], t, strict=True)), rel_tol=1e-9)
    assert katz.score_texts(empty, queries.held_out(10, 0)).collect() == []


def test_stored_tables_leave_no_shuffle_files(spark):
    """What a job shuffled is deleted when its result is stored, and katz keeps only what is read later."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: set(re.findall(r"shuffle_\w+", manager.getAllFiles().mkString(" ")))
    staging, setting = Staging(spark), spark.conf.get(SHUFFLE_CLEANUP)
    before = files()
    counts = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert staging.keep(counts.repartition(3, "count"), "counts").count() == 10
    assert not [f for f in files() - before if f.endswith("data")] and spark.conf.get(SHUFFLE_CLEANUP) == setting
    scored = katz.score_texts(spark.createDataFrame([(1, "a b a"), (2, "a b")], "doc_id long, text string"), "doc_id = 2")
    assert scored.count() == 2
    folders = {p.split("/")[-2] for p in scored.inputFiles()}
    assert "sums" in folders and not folders & {"coded", "words", "answered"}


def test_bpe(docs, empty):
    path = public_tokenizers.path(queries.VOCABULARY)
    known = Tokenizer.from_file(path)
    known.no_truncation()
    known.no_padding()
    coded = bpe.encode_texts(docs, path)
    rows = coded.select("doc_id", "ids", bpe.decode_ids("ids", path).alias("back"), bpe.ids_digest("ids").alias("sha")).collect()
    assert len(rows) == len(TEXT)
    for r in rows:
        ids = known.encode(TEXT[r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.back == known.decode(ids, skip_special_tokens=False)
        assert r.sha == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
    assert bpe.encode_texts(empty, path).collect() == []


def test_ann(spark):
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=16).tolist() for i in range(400)}
    vectors |= {400 + i: vectors[0] for i in range(30)}
    odd = {900: None, 901: [0.0] * 16, 902: [float("nan")] * 16, 903: [None] + [1.0] * 15}
    df = spark.createDataFrame(list({**vectors, **odd}.items()), "vec_id long, embedding array<double>")
    rows = ann.nearest(df, df.where("vec_id % 20 = 0")).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert math.isclose(r.score, float(np.dot(vectors[r.query_id], vectors[r.vec_id])), rel_tol=1e-12, abs_tol=1e-12)
        got[r.query_id].append(r.vec_id)
    assert got.keys() == {i for i in vectors if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        exact = sorted((i for i in vectors if i != q), key=lambda i: (-round(float(np.dot(vectors[q], vectors[i])), 9), i))[:20]
        assert len(found) == 20 and q not in found
        hits += len(set(found) & set(exact))
    assert hits >= 0.9 * 20 * len(got)
    assert ann.nearest(df.limit(0), df.limit(0)).collect() == []


def test_substring(docs, empty):
    rows = substring.repeated_passages(docs).collect()
    shared = [i for i, t, _ in ROWS if t and len(t.split()) == 105]
    found = {(r.first_doc_id, r.doc_id) for r in rows}
    assert {(shared[0], i) for i in shared[1:3]} <= found
    for r in rows:
        assert r.first_doc_id < r.doc_id and r.n_words >= 50 and r.first_n_words >= 50 and 0.75 <= r.similarity <= 1
        x = words(TEXT[r.doc_id])[r.start_word : r.start_word + r.n_words]
        y = words(TEXT[r.first_doc_id])[r.first_start_word : r.first_start_word + r.first_n_words]
        assert sum((Counter(x) & Counter(y)).values()) >= 0.7 * max(len(x), len(y))
    assert substring.repeated_passages(empty).collect() == []


def test_substring_against_all_pairs(spark):
    """Runs of 50 equal words and more of any two documents, found by brute force, are covered by rows."""
    rng = random.Random(17)
    fresh = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    phrases = [fresh(9) for _ in range(60)]  # common phrases: long passages are made of them
    common = lambda n: [w for _ in range(n) for w in rng.choice(phrases)]
    passages = [fresh(rng.randint(50, 140)) for _ in range(5)] + [common(rng.randint(7, 14)) for _ in range(5)]
    texts = [fresh(20) + common(rng.randint(1, 3)) + fresh(20) for _ in range(150)]
    for _ in range(40):
        texts.append([w for p in rng.sample(passages, 3) for w in p + fresh(rng.choice([0, 30, 90, 130, 400]))])
    rng.shuffle(texts)
    documents = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    covered = {}
    for r in substring.repeated_passages(documents).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    wanted = hit = runs = 0
    for j, y in enumerate(texts):
        places = {}
        for at, w in enumerate(y):
            places.setdefault(w, []).append(at)
        for x in texts[:j]:
            length = {}
            for w in x:  # lengths of the equal runs that end at each place of y
                now = {at: length.get(at - 1, 0) + 1 for at in places.get(w, [])}
                for at, n in length.items():
                    if n >= 50 and at + 1 not in now:
                        runs, wanted = runs + 1, wanted + n
                        hit += len(covered.get(j, set()) & set(range(at - n + 1, at + 1)))
                length = now
    assert runs > 100 and hit >= 0.97 * wanted


def test_substring_chains_and_odd_rows(spark):
    rng = random.Random(3)
    fresh = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    first, second, phrase = fresh(120), fresh(70), fresh(120).split()
    near = list(range(0, 120, 8)) + list(range(250, 320, 8))
    assert [len(c) for c in substring.chains(near, near)] == [15, 9]
    rows = [(1, f"{first} {fresh(130)} {second}"), (2, f"{first} {fresh(130)} {second}")]
    rows += [(3, f"{second} {fresh(90)} {first}"), (4, f"{second} {fresh(90)} {first}")]
    rows += [(None, first), (None, first), (5, None), (5, ""), (6, "x" * 200_000), (7, "a " * 30_000), (8, "a " * 30_000)]
    rows += [(100 + i, " ".join([fresh(9), *phrase[i % 114 : i % 114 + 6], fresh(9)])) for i in range(500)]
    rows += [(900, f"{fresh(20)} {' '.join(phrase)} {fresh(9)}"), (901, f"{fresh(7)} {' '.join(phrase)}")]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, seed int, a int")
    found = {(r.doc_id, r.start_word, r.n_words) for r in substring.repeated_passages(table).collect()}
    assert {(2, 0, 120), (2, 250, 70), (4, 0, 70), (4, 160, 120), (901, 7, 120)} <= found
    assert {d for d, _, _ in found} <= {2, 3, 4, 8, 901}


def test_toxicity(spark, empty):
    folder = "/root/testdata/sf0.001"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = queries.op2_toxicity(spark, folder)
    assert scored.count() == documents.count()
    both = scored.where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").where("toxic IS NOT NULL").collect()
    right = sum(int(r.toxic) == r.predicted for r in both)
    assert both and right >= 0.9 * len(both)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scored.collect())
    lexicon = toxicity.learn(documents, labels)
    rows = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string")
    assert [r.score for r in toxicity.score_toxicity(rows, lexicon).collect()] == [0, 0, 0]
    assert toxicity.drop_toxic(empty, lexicon).collect() == []


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "bpe":
            path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}-{random.getrandbits(40)}"
            out.write.parquet(path)
            out = spark.read.parquet(path)
            assert out.columns == columns
        if name in ("toxicity", "minhash"):
            assert 0 < out.count() <= docs.count()
        if name == "line_dedup":
            assert out.count() == docs.count()
        if name == "bpe":
            assert out.count() == docs.count() and out.where("size(ids) != n_tokens").count() == 0
        docs = out
    assert before > 0


def test_empty_tables_through_the_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0, name


def test_queries_are_registered():
    import __spark_entry__ as entry

    assert {f"op{i}" for i in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_decoding_needs_only_the_names_of_tokens(spark, monkeypatch):
    """More rows than are decoded at once, with NULL and empty ones; without the tables of an encoder."""
    path = public_tokenizers.path(queries.VOCABULARY)
    names = {i: t for t, i in Tokenizer.from_file(path).get_vocab().items()}
    rng = random.Random(3)
    rows = [None, []] + [[rng.randrange(len(names)) for _ in range(rng.randrange(9))] for _ in range(3 * bpe.DECODED_ROWS)]
    monkeypatch.setattr(bpe, "encoder", None)
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, ids array<int>").coalesce(1)
    got = {r.id: r.text for r in df.select("id", bpe.decode_ids("ids", path).alias("text")).collect()}
    assert got == {i: None if r is None else " ".join(names[x] for x in r) for i, r in enumerate(rows)}


def test_bpe_of_control_characters():
    """U+001C to U+001F are signs, not white space, as in the library."""
    path = public_tokenizers.path(queries.VOCABULARY)
    library, rng = Tokenizer.from_file(path), random.Random(2)
    texts = ["".join(rng.choice("ab1 .\x1c\x1d\x1e\x1f\x85\xa0é'll") for _ in range(rng.randint(0, 20))) for _ in range(5000)]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [list(ids) for ids in bpe.WordBpe(path).encode(texts)] == expected


def test_folding_long_digit_runs():
    """A million digits are read once; runs before a letter fold as before."""
    assert toxicity.fold("1" * 1_000_000) == f" {'1' * 1_000_000} "
    assert toxicity.fold("b4d 44 x4_4y") == toxicity.fold("bad 44 xa_ay")
