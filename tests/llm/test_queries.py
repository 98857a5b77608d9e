"""Registered queries against their SQL, or against brute force where SQL cannot say it."""

import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from tidemark.llm import rules
from tidemark.llm.catalog import QUERIES, SQL
from tidemark.llm.textstats import COUNTS, text_counts


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.fixture(scope="module")
def rows(con):
    return con.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, small, con, name):
    assert compare.difference(QUERIES[name](spark, small), con, SQL[name]) is None


def encoder():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda texts: [e.ids + [1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_packing(pieces, docs, waste=1.02):
    """Every piece of every document once, in gapless sequences of at most 4,096 tokens, nearly as few as can be."""
    ids = dict(zip([i for i, _ in docs], encoder()([t for _, t in docs])))
    want = {
        (i, p): (p * 4096, len(x[p * 4096 : (p + 1) * 4096]), zlib.crc32(np.array(x[p * 4096 : (p + 1) * 4096], "<u4").tobytes()))
        for i, x in ids.items()
        for p in range(-(-len(x) // 4096))
    }
    bins, count = defaultdict(list), 0
    for r in pieces:
        assert want[(r["doc_id"], r["piece"])] == (r["start"], r["length"], r["ids_crc32"])
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        count += r["length"]
    for placed in bins.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) <= max(-(-count // 4096) + 1, waste * count / 4096)
    return want


def test_packing(spark, small, rows):
    found = QUERIES["op2_sum_of_squares_packing"](spark, small).collect()
    want = check_packing(found, [(i, t) for i, t, _ in rows])
    assert sorted((r["doc_id"], r["piece"]) for r in found) == sorted(want)


def test_page_texts(spark, small, con):
    want = {i: brute.article(h) for i, h in con.execute("SELECT page_id, html FROM pages").fetchall()}
    found = QUERIES["op5_page_templates"](spark, small).collect()
    assert {r["page_id"]: (r["text"], r["n_chars"]) for r in found} == {i: (t, len(t)) for i, t in want.items()}


def test_shards(spark, small, rows):
    want = brute.byte_shards([(i, t) for i, t, _ in rows], 40)
    found = QUERIES["op6_byte_shards"](spark, small).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in found} == want
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}


def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    scored = QUERIES["op8_subword_classifier"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality IS NOT NULL")
    found = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 40
    assert np.mean([r["predicted"] == r["quality"] for r in found]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored.collect())


def test_mix_against_the_description(spark, small, rows):
    taken, target, size, whole = brute.mix_taken(rows)
    found = QUERIES["op10_low_discrepancy_mix"](spark, small).collect()
    assert {r["doc_id"]: (r["size"], r["taken"]) for r in found} == {i: (size[i], taken[i]) for i in taken}
    for s in target:
        mine = [i for i, _, x in rows if x == s]
        assert abs(sum(taken[i] for i in mine) - target[s]) <= max(1, 0.01 * target[s])
        assert all(taken[i] <= 3 * size[i] for i in mine)


def quality_kept(spark, folder, rows):
    """Base rules by brute force; the learned list applied in numpy."""
    from tidemark.llm.textstats import add_counts

    counts = add_counts(spark.read.parquet(f"{folder}/documents.parquet"))
    learned = rules.fit_rules(counts, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = {}
    for i, text, _ in rows:
        n = dict(zip(COUNTS, text_counts(text)))
        values = {k: np.array([n[a] / max(n[b], 1) if b else float(n[a])]) for k, (a, b) in rules.RATIOS.items()}
        hit = any(all(c.holds(values)[0] for c in rule) for rule in learned)
        failed = n["n_words"] < 50 or 100 * n["n_repeat_words"] > 50 * n["n_words"]
        kept[i] = (failed, not failed and not hit)
    return kept


def test_rules(spark, small, rows):
    found = QUERIES["op9_decision_list"](spark, small).collect()
    want = quality_kept(spark, small, rows)
    assert {r["doc_id"]: (r["base_failed"], r["kept"]) for r in found} == want
    counts = {r["doc_id"]: tuple(r[c] for c in COUNTS[:5]) for r in found}
    assert counts == {i: brute.base_counts(t) for i, t, _ in rows}


def test_rules_keep_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = QUERIES["op9_decision_list"](spark, folder).join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r for r in found if r["quality"] == 1]
    low = [r for r in found if r["quality"] == 0]
    assert np.mean([r["kept"] for r in good]) >= 0.98
    assert np.mean([not r["kept"] for r in low]) >= 0.8


def test_pipeline(spark, small, rows):
    """All five stages by brute force on the small table."""
    kept = quality_kept(spark, small, rows)
    docs = [r for r in rows if kept[r[0]][1]]
    cut = brute.line_dedup([(i, t) for i, t, _ in docs])
    docs = [(i, cut[i][2], s) for i, t, s in docs if cut[i][1] == 0 or cut[i][1] < cut[i][0]]
    groups = brute.near_duplicates([(i, t) for i, t, _ in docs], 5, 80)
    docs = [r for r in docs if groups[r[0]][1] == r[0]]
    taken, _, size, _ = brute.mix_taken(docs)
    often = {i: int(taken[i] / size[i] + 0.5) if size[i] else 0 for i in taken}
    found = corpus_pipeline.run(spark, small).collect()
    want = check_packing(found, [(i, t) for i, t, _ in docs], waste=1.03)
    assert sorted((r["doc_id"], r["piece"]) for r in found) == sorted(k for k in want for _ in range(often[k[0]]))


def test_stages_return_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, small)
        assert found.columns == docs.columns, name
        assert [t for _, t in found.dtypes] == [t for _, t in docs.dtypes], name
        assert found.where(F.length("text") != F.col("n_chars")).count() == 0, name
