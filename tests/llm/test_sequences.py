"""Packing, hard negatives and token alignment against brute force, on small tables with awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import alignment, mining, packing, queries
from shelfmark.llm.bpe import byte_letters
from shelfmark.llm.tokens import ByteBpe

BYTES, PIECES = public_tokenizers.path(queries.BYTE_VOCABULARY), public_tokenizers.path(queries.PIECE_VOCABULARY)
LIMIT = 64


def corpus():
    """``(doc_id, text)``: NULL and repeated keys, copies, odd and very long texts."""
    rng = random.Random(11)
    vocabulary = ["alpha", "beta", "gamma", "delta", "naïve", "你好", "don't", "x1", "  ", "\n", "end."]
    fresh = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [fresh(rng.randint(1, 60)) for _ in range(60)] + [fresh(25)] * 30
    texts += [None, "", " ", "\t\n ", "a<|endoftext|>b", "<s>x</s>", "mark ▁ sign", "<0x41> A", "é̂😀‍😀", "\x00\x1c\x85 z"]
    texts += [" " * 50_000 + "x", "long" * 20_000, "7" * 30_000, fresh(5_000)]
    ids = list(range(0, 3 * len(texts), 3))
    ids[5] = ids[4]
    ids[7] = ids[8] = None
    return list(zip(ids, texts, strict=True))


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "x", 0, 0) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, id int, chunk string, packer int, piece int").repartition(5).cache()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def test_byte_bpe_equals_the_library(library):
    rng = random.Random(3)
    pool = [*"ab1 .,\n\t'séß你😀‍  \x1c", "'ll", "<|endoftext|>", " the", "  "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [t for _, t in ROWS if t]
    bpe = ByteBpe(BYTES)
    assert all(bpe.encode(t, marks=True).tolist() == library.encode(t, add_special_tokens=False).ids for t in texts)
    plain = Tokenizer.from_file(BYTES)
    plain.encode_special_tokens = True
    assert all(bpe.encode(t, marks=False).tolist() == plain.encode(t, add_special_tokens=False).ids for t in texts)


@given(st.lists(st.integers(1, 20), max_size=80), st.integers(1, 6))
@settings(max_examples=200, deadline=None)
def test_best_fit_follows_its_rule(lengths, open_bins):
    """Against a plain list of open bins: the least space that suffices, else the fullest closes."""
    bins, places, fill = packing.best_fit(lengths, 20, open_bins)
    free, at = {}, defaultdict(int)
    for length, chosen, place in zip(lengths, bins, places, strict=True):
        room = [f for f in free.values() if f >= length]
        if chosen in free:
            assert room and free[chosen] == min(room)
        else:
            assert not room
            if len(free) == open_bins:
                del free[min((b for b in free if free[b] == min(free.values())), key=lambda b: (b in bins[len(at) :], b))]
        assert place == at[chosen]
        at[chosen] += length
        free[chosen] = 20 - at[chosen]
        if not free[chosen]:
            del free[chosen]
        if len(set(free.values())) < len(free):
            return  # several bins are equally full: which of them closes is not laid down
    assert fill == [at[b] for b in range(len(fill))]


def _packed(rows, library):
    """Checks every piece and place; returns the number of sequences and of ids."""
    given_rows = defaultdict(Counter)
    encoded = defaultdict(list)
    for i, t in ROWS:
        encoded[i].append(library.encode(t or "", add_special_tokens=False).ids + [0])
    sequences = defaultdict(list)
    for r in rows:
        matching = [ids for ids in encoded[r.doc_id] if zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
        assert matching and 1 <= r.length <= LIMIT
        given_rows[r.doc_id][(r.piece, r.start, r.length)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, texts in encoded.items():
        expected = Counter()
        for ids in texts:
            start = 0
            for piece, length in enumerate(packing.cut_lengths(len(ids), LIMIT)):
                expected[(piece, start, length)] += 1
                start += length
        assert given_rows[i] == expected
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= LIMIT
    return len(sequences), sum(len(ids) for texts in encoded.values() for ids in texts)


@pytest.mark.parametrize(("per_packer", "open_bins"), [(10_000, 1024), (200, 64), (40, 4)])
def test_packing(docs, library, per_packer, open_bins):
    rows = packing.pack_documents(docs, BYTES, LIMIT, open_bins=open_bins, per_packer=per_packer).collect()
    used, total = _packed(rows, library)
    assert used <= -(-total // LIMIT) * (1.02 if open_bins > 4 else 1.05) + 1


def test_packing_repeats_and_keeps_ids(docs, library):
    stored = packing.pack_documents(docs, BYTES, LIMIT, with_ids=True)
    whole = packing.sequences(stored).collect()
    assert all(len(r.ids) == r.length == sum(d.length for d in r.documents) for r in whole)
    assert sum(r.length for r in whole) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ROWS)
    digest = {r.sequence_id: r.ids for r in whole}
    for r in stored.collect():
        assert digest[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, BYTES).collect() == []
    assert alignment.align_tokens(docs, BYTES, PIECES).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert mining.hard_negatives(vectors).collect() == []


def _alignment():
    """Rows as a plain reading of the definition gives them."""
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(byte_letters())}
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def bytes_b(i):
        piece = model.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    rows, counts = [], Counter()
    for doc_id, text in ROWS:
        a = library.encode(" " + (text or ""), add_special_tokens=False).ids
        b = model.encode(text or "")
        tokens_a, tokens_b = [bytes(letters[c] for c in library.id_to_token(i)) for i in a], [bytes_b(i) for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(tokens_a) != whole or b"".join(tokens_b) != whole:
            rows.append((doc_id, [], [], [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(t) for t in tokens_a]).tolist(), np.cumsum([len(t) for t in tokens_b]).tolist()
        at_a, at_b = {e: k for k, e in enumerate(ends_a)}, {e: k for k, e in enumerate(ends_b)}
        links, groups, last_a, last_b = [], [], 0, 0
        for end in sorted(at_a.keys() & at_b.keys()):
            next_a, next_b = at_a[end] + 1, at_b[end] + 1
            links.append((a[next_a - 1], b[next_b - 1]))
            groups.append(",".join(map(str, a[last_a:next_a])) + "|" + ",".join(map(str, b[last_b:next_b])))
            last_a, last_b = next_a, next_b
        counts.update(links)
        rows.append((doc_id, a, b, links, ";".join(groups)))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (i, len(a), len(b), len(k), len(k), sum(counts[x] == highest[x[1]] for x in k), sum(counts[x] for x in k), g) for i, a, b, k, g in rows
    ]


@pytest.mark.parametrize("chunk", [alignment.CHUNK, 300])
def test_alignment(docs, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    got = alignment.align_tokens(docs, BYTES, PIECES, keep_groups=True).collect()
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    expected = _alignment()
    assert Counter(tuple(r[c] for c in columns) for r in got) == Counter(expected)
    assert all(r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in got)
    assert sum(not r[1] for r in expected) == 3  # NULL, empty, and the sign that B reads as a space


@given(st.lists(st.integers(1, 9), min_size=1, max_size=60), st.data())
@settings(max_examples=200, deadline=None)
def test_pointer_jumping(sizes, data):
    """Groups are the runs between common ends, however long the chains."""
    ends_a = np.cumsum(sizes)
    inner = data.draw(st.sets(st.integers(1, int(ends_a[-1]))))
    ends_b = np.array(sorted(inner | {int(ends_a[-1])}))
    common = np.array(sorted(set(ends_a.tolist()) & set(ends_b.tolist())))
    group_a, group_b = alignment.jump_groups(ends_a, ends_b)
    assert group_a.tolist() == np.searchsorted(common, ends_a).tolist()
    assert group_b.tolist() == np.searchsorted(common, ends_b).tolist()


def _negatives(rows, anchors):
    """The definition, row by row; rows are told apart by their place."""
    usable = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        usable.append((i, (label + 1) % 10 if i % 7 == 0 else label, whole))
    out = Counter()
    for n, (i, label, v) in enumerate(usable):
        if i % anchors:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), j, k, own) for k, (j, own, w) in enumerate(usable) if k != n and len(w) == len(v)]
        for s, j, _, own in sorted(x for x in scored if x[3] == label)[:5]:
            near = sorted(x for x in scored if x[3] != label and 80 * -s <= 100 * -x[0] <= 100 * -s)[:5]
            out.update((i, j, rank, b, -s, -t) for rank, (t, b, _, _) in enumerate(near, 1))
    return out


@pytest.mark.parametrize(("block_rows", "anchor_rows"), [(8192, 2048), (90, 7)])
def test_hard_negatives(spark, block_rows, anchor_rows):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist(), int(rng.integers(0, 4))) for i in range(500)]
    rows += [(i, rows[3][1], i % 3) for i in range(500, 700)]  # ties: copies under several labels
    rows += [(700, None, 1), (701, [1.0] * 8, None), (710, [float("nan")] * 8, 1), (720, [None] + [1.0] * 7, 1), (None, [1.0] * 8, 1)]
    rows += [(730, [0.0] * 8, 2), (740, [-1.0] * 8, 1), (750, [float("inf")] * 8, 1), (760, [], 1), (770, [1.0, 2.0], 3), (773, [1.0, 2.0], 3)]
    rows += [(780, [1.0, 1.9], 0), (10, rows[11][1], 2), (10, rows[12][1], 3)]
    rows += [(790, [3.0e5] * 8, 1), (791, [2.9e5] * 8, 1), (792, [2.8e5] * 8, 2)]  # products beyond exact doubles
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, id string, row int").repartition(3)
    relabel = "CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
    found = mining.hard_negatives(table, "id % 10 = 0", relabel, block_rows=block_rows, anchor_rows=anchor_rows).collect()
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert Counter(tuple(r[c] for c in columns) for r in found) == _negatives(rows, 10)


def test_hard_negatives_query(spark, compare):
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    compare(queries.op12_hard_negatives(spark, folder), connection, queries.ORACLE_SQL["op12_hard_negatives"])


def test_search_stops_early_where_bounds_prove_it():
    """Tight, well separated clusters: a fraction of the rows is scored, and the answer stays exact."""
    rng = np.random.default_rng(9)
    centres = np.array([[*(500 * np.eye(4)[i]), *(500 * np.eye(4)[j])] for i in range(4) for j in range(4)])
    vectors = np.floor(centres[rng.integers(0, 16, 8000)] + rng.normal(size=(8000, 8))).astype("i8")
    books = tuple(mining.fit_codebook(part.astype("f8"), 16) for part in (vectors[:, :4], vectors[:, 4:]))
    index, ids, labels = mining.MultiIndex(vectors, books), np.arange(8000), np.arange(8000) % 2
    scored = sum(len(p) for p, _, bound in index.visit(vectors[0]) if bound > 400_000)
    found = mining.positives_of(index, ids, ids, labels, vectors[0], 0, 0, 5)
    exact = vectors @ vectors[0]
    order = [int(i) for i in np.lexsort((ids, -exact)) if i != 0 and labels[i] == 0][:5]
    assert [f[1] for f in found] == order
    assert scored < 4000
