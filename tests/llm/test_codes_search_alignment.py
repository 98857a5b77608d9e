"""Vector codes, top-k search and tokenizer alignment against plain Python, edge cases included."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, pivotcodes, topk
from tidemark.llm.catalog import QUERIES

BYTE, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, score string, _row string, x string, id string"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def vector_rows(seed, count, width, step):
    """Rows with ties and copies among them, and with every kind of unusable vector."""
    rng = np.random.default_rng(seed)
    x = (rng.integers(-4, 5, (count, width)) * step).tolist()
    rows = [(i * 10, v, int(i % 3) if i % 4 else None, "s", "r", "x", "i") for i, v in enumerate(x)]
    rows += [rows[5], rows[5], (5, None, 1, *"srxi"), (6, [1.0, None] * (width // 2), 1, *"srxi"), (7, [NAN] * width, 1, *"srxi")]
    return rows + [(8, [INF] + [0.0] * (width - 1), 1, *"srxi"), (13, [1.0, 2.0], 1, *"srxi"), (14, [], None, *"srxi")]


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = sorted(((r[0], r[1], r[2]) for r in rows if usable(r[1])), key=lambda r: (r[0], r[1]))
    width = len(kept[0][1])
    kept = [(i, [math.floor(4096 * float(np.float32(c))) for c in v], lab) for i, v, lab in kept if len(v) == width]
    cuts = [(p * width // parts, (p + 1) * width // parts) for p in range(parts)]
    books = [[v[a:b] for _, v, _ in kept[:entries]] for a, b in cuts]

    def assign():
        return [
            [min((sum((s - t) ** 2 for s, t in zip(v[a:b], e)), k) for k, e in enumerate(book)) for book, (a, b) in zip(books, cuts)]
            for _, v, _ in kept
        ]

    for _ in range(rounds):
        found = assign()
        for p, (a, b) in enumerate(cuts):
            for e in range(len(books[p])):
                mine = [v[a:b] for (_, v, _), f in zip(kept, found) if f[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] += e
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted((i, "".join(f"{k:02x}" for _, k in f), e, by_label[lab], sha) for (i, _, lab), f, e in zip(kept, found, errors))


@pytest.mark.parametrize("count,width,step", [(60, 16, 0.0625), (9, 8, 0.25), (40, 10, 0.001)])
def test_codes_against_plain_python(spark, count, width, step):
    rows = vector_rows(1, count, width, step)
    got = pivotcodes.compress(spark.createDataFrame(rows, VECTORS).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == plain_codes(rows)


def test_pivots_save_evaluations_and_change_nothing():
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (16, 8))
    x = centres[rng.integers(0, 16, 3000)] + rng.integers(-200, 200, (3000, 8))
    x = np.concatenate([x, centres[:3], centres[:3]])
    book = np.concatenate([centres[:15], centres[3:4]])  # two equal entries: the lower wins
    pivots = pivotcodes.spread(centres, 4)
    at, best, evaluated = pivotcodes.nearest(x, pivotcodes.distances(x, pivots), book, pivotcodes.distances(book, pivots))
    squares = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    assert (at == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()
    assert evaluated < 0.5 * squares.size


def test_whole_roots_are_exact():
    n = np.array([0, 1, 2, 3, 4, 10**6, 2**27], np.int64)
    for squares in (n * n, n * n + 2 * n, np.maximum(n * n - 1, 0)):
        assert pivotcodes.root(squares).tolist() == [math.isqrt(s) for s in squares.tolist()]


def test_codes_of_nothing(spark):
    assert pivotcodes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    assert pivotcodes.compress(spark.createDataFrame([(1, None, 1, *"srxi"), (2, [NAN], 1, *"srxi")], VECTORS)).count() == 0
    alone = pivotcodes.compress(spark.createDataFrame([(None, [0.5] * 8, None, *"srxi")], VECTORS)).first()
    assert (alone["vec_id"], alone["code"], alone["error"], alone["label_error"]) == (None, "00" * 8, 0, 0)


def plain_top(rows, k=5, every=50, scale=256):
    kept = [(r[0], [math.floor(scale * float(np.float32(c))) for c in r[1]]) for r in rows if r[0] is not None and usable(r[1])]
    out = []
    for n, (q, v) in enumerate(kept):
        if q % every == 0:
            others = [(-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(kept) if m != n and len(w) == len(v)]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(others)[:k])]
    return sorted(out)


@pytest.mark.parametrize("count,tile,bins", [(60, 7, 3), (60, 8192, 512), (6, 2, 2)])
def test_top_k_against_plain_python(spark, count, tile, bins):
    rows = vector_rows(3, count, 6, 0.0625) + [(None, [9.0] * 6, 1, *"srxi")] + [(1000 + i, [0.5] * 6, 1, *"srxi") for i in range(12)]
    vectors = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = topk.top_products(vectors, F.pmod("vec_id", F.lit(50)) == 0, tile=tile, bins=bins)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain_top(rows)


def test_top_k_of_nothing_and_of_too_much(spark):
    asks = F.col("vec_id") % 50 == 0
    assert topk.top_products(spark.createDataFrame([], VECTORS), asks).count() == 0
    assert topk.top_products(spark.createDataFrame([(50, [1.0], 1, *"srxi")], VECTORS), asks).count() == 0
    assert topk.top_products(spark.createDataFrame([(51, [1.0], 1, *"srxi")], VECTORS), asks).count() == 0
    large = [(50, [2.0**21, 1.0], 1, *"srxi"), (51, [2.0**21, 3.0], 1, *"srxi")]  # beyond exact doubles
    assert topk.top_products(spark.createDataFrame(large, VECTORS), asks).first()["score"] == 2**58 + 3 * 2**16
    huge = [(50, [1e30], 1, *"srxi"), (51, [1e30], 1, *"srxi")]
    with pytest.raises(Exception):
        topk.top_products(spark.createDataFrame(huge, VECTORS), asks).collect()


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE)


def plain_alignment(docs, tokenizers):
    a, b = tokenizers
    own = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    byte_of = {chr(c): c for c in own} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in own)}

    def spans(text):
        raw = (" " + (text or "")).encode()
        left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(raw.decode(), add_special_tokens=False).ids]
        right = [
            (i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
            for i in b.encode(text or "")
        ]
        if not text or any(b"".join(x for _, x in side) != raw for side in (left, right)):
            return [], []
        out = []
        for side in (left, right):
            end, found = 0, []
            for i, x in side:
                found.append((i, end, end + len(x)))
                end += len(x)
            out.append(found)
        return out

    counts, rows = Counter(), []
    for key, text in docs:
        left, right = spans(text)
        links, first = [], 0
        for i, start, end in left:
            while right[first][2] <= start:
                first += 1
            at = first
            while at < len(right) and right[at][1] < end:
                links.append((i, right[at][0]))
                at += 1
        counts.update(links)
        groups = defaultdict(lambda: ([], []))
        cuts = sorted({s[2] for s in left} & {s[2] for s in right})
        for n, side in enumerate((left, right)):
            for i, _, end in side:
                groups[np.searchsorted(cuts, end)][n].append(str(i))
        text_ = ";".join(",".join(groups[g][0]) + "|" + ",".join(groups[g][1]) for g in range(len(cuts)))
        rows.append((key, len(left), len(right), len(cuts), links, hashlib.sha256(text_.encode()).hexdigest() if left else ""))
    best = Counter()
    for (_, i), n in counts.items():
        best[i] = max(best[i], n)
    return sorted(
        ((k, na, nb, ng, len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), h) for k, na, nb, ng, x, h in rows),
        key=repr,
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    None, "", " ", "  ", "\n", "\t x", "a", " a", "a ", "a  b", "one two\nthree\r\nfour\r five", "nul\x00 x", "  wide space 　 x",
    "<|endoftext|> <s></s><unk> <0x41>", "low ▁line▁", "naïve Äußerung 日本語の文 🙂🙂 ﻿", "x" * 500, "!" * 300 + "?" * 300,
    "it's 1,234.50 or 99%", " \n \n\t\t  mixed\n\n\n   white   space\n", "é ﬁ ½ ①", "tail\n", "same same same same", "same same same same",
]


@pytest.mark.parametrize("frequent", [1 << 20, 20, 0])
def test_alignment_edges(spark, tokenizers, frequent):
    docs = [(i if i % 7 else None, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (3, "again")]
    frame = spark.createDataFrame([(i, t, "r", "n", "c") for i, t in docs], "doc_id long, text string, row string, n string, code string")
    got = alignment.align(frame.repartition(3), BYTE, PIECE, frequent=frequent)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == plain_alignment(docs, tokenizers)


def test_alignment_of_nothing(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), BYTE, PIECE).count() == 0
    assert alignment.align(spark.createDataFrame([(1, None)], "doc_id long, text string"), BYTE, PIECE).first()["n_a"] == 0


def test_alignment_query(spark, small, tokenizers):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_shared_cuts"](spark, small)
    assert sorted(map(tuple, got.select(COLUMNS).collect()), key=repr) == plain_alignment(docs, tokenizers)


def test_units_give_the_ids_of_whole_texts(tokenizers, monkeypatch):
    """Unit by unit, with a memory that starts anew, and cut into chunks."""
    a, b = tokenizers
    known = alignment.Tokenizers(BYTE, PIECE)
    monkeypatch.setattr(alignment, "MEMORY", 200)
    monkeypatch.setattr(alignment, "CHUNK", 40)
    rng = np.random.default_rng(4)
    signs = list("aabcdeéß日🙂 019.,'!\n\t  \r ") + [" the", " of", "ing", "'s", "tion"]
    for _ in range(400):
        text = "".join(rng.choice(signs, rng.integers(1, 120)))
        want = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        chunks = known.encode(text)
        assert np.frombuffer(b"".join(x for x, _ in chunks), np.uint16).tolist() == want[0]
        assert np.frombuffer(b"".join(y for _, y in chunks), np.uint16).tolist() == want[1]


def test_long_stretches_without_a_cut():
    """Cuts far from the middle, on either side, and none at all."""
    a = np.concatenate([[2], np.arange(3, 2000, 2), [2000, 2002], np.arange(2003, 2300, 2), [2300]])
    b = np.concatenate([np.arange(2, 2001, 2), [2002], np.arange(2004, 2301, 2)])
    cuts_a, cuts_b = alignment.shared_cuts(a, b, np.array([len(a)]), np.array([len(b)]))
    assert a[cuts_a].tolist() == b[cuts_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
