"""Nulls, empty and very long texts, ties and repeated rows, empty tables and columns whose names could clash."""

import time
import math
import random
import shutil
import tracemalloc

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import classifier, lines, minhash, mixing, packing, pages, rules, sharding, substrings, vectors
from tidemark.llm.components import connected_components
from tidemark.llm.textstats import repeated_words

CLASHING = ["id", "n", "size", "slot", "rank", "pos", "kept", "component_id", "length", "n_lines", "n_words", "_row", "_0"]
LONG = " ".join(f"w{i % 7000}x{i}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = {
    1: None, 2: "", 3: " \t\n \x0b", 4: "one", 5: "one two", 6: LONG, 7: LONG, 8: "Straße an der Elbe.\r\n", 9: "a b c " * 40,
    10: "first line of some sixty characters, or a few more than that, says it\nshort\n\nother\nend",
    11: "other\nend\nfirst line of some sixty characters, or a few more than that, says it\nshort",
}


def documents(spark, rows, extra=()):
    df = spark.createDataFrame(
        [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows], SCHEMA
    )
    return df.withColumns({c: F.lit("x") for c in extra}) if extra else df


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, ["a", "b", None][i % 3]) for i, t in TEXTS.items()]
    return documents(spark, rows, CLASHING).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, 0) for i in TEXTS], "doc_id long, quality int, toxic int")


def tokens(docs):
    return packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"))


def test_empty_tables(spark, empty, labels):
    assert minhash.near_duplicates(empty).count() == 0
    assert substrings.remove_repeats(empty).count() == 0
    assert lines.line_dedup(empty).count() == 0
    assert packing.pack(tokens(empty)).count() == 0
    assert sharding.assign_shards(empty.select("doc_id"), ["doc_id"], F.lit(1), 4).count() == 0
    assert all(df.count() == 0 for df in mixing.mix(empty))
    assert rules.judge(empty, labels)[0].count() == 0
    assert rules.judge(empty, labels.limit(0))[1] == []
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    model = classifier.fit(empty, labels)
    assert classifier.score(empty, model).count() == 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0, name


def test_near_duplicates(spark, odd):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(odd, 3, 85, 12).collect()}
    assert found == brute.near_duplicates(TEXTS.items(), 3, 85)
    assert found[7][1] == 6 and found[1] == (0, 1)


def test_near_duplicates_repeated_and_unnamed_rows(spark):
    text = "the very same words stand in all of these three rows here"
    rows = [(5, text, "a"), (5, text, "a"), (7, text, "a"), (None, text, "a"), (None, None, "a"), (8, "other", "a")]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in found) == [
        (0, 0, True), (0, 5, False), (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True),
    ]


def edited(seed, words=120, edits=1):
    base = [f"word{i}" for i in range(words)]
    rng = np.random.default_rng(seed)
    for at in rng.choice(words, edits, replace=False):
        base[at] = f"edit{seed}"
    return " ".join(base)


def test_near_duplicates_chain_and_large_group(spark):
    # Copies that are not all close to the smallest id: links between others must be found too.
    rows = [(1000 + i, edited(i, 120, 1 + i % 6), "a") for i in range(150)] + [(i, edited(900 + i, 120, 9), "a") for i in range(5)]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert found == brute.near_duplicates([(i, t) for i, t, _ in rows], 5, 80)


def test_similarity_at_the_threshold(spark):
    # 20 shingles each; 17 of 20 shared is 17/23, 85 of 100 exactly needs sets of 37 with 34 shared.
    a = [f"a{i}" for i in range(39)]
    b = a[:36] + ["x", "y", "z"]
    rows = [(1, " ".join(a), "s"), (2, " ".join(b), "s")]
    exact = 100 * 34 >= 85 * 40
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(spark, rows), 3, 85, 12).collect()}
    assert found == {1: 1, 2: 1 if exact else 2}


def test_substrings(spark, odd):
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(odd).collect()}
    assert found == brute.substrings(TEXTS.items())
    assert found[7][1] == 60_000


def test_substrings_shared_passages(spark):
    rng = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(55)]
    rows = []
    for i in range(60):
        w = [f"v{x}" for x in rng.integers(0, 400, 150)]
        at = int(rng.integers(0, 150))
        cut = int(rng.integers(0, 30))
        w[at:at] = passage[cut : cut + 25 + int(rng.integers(0, 30))] * int(rng.integers(0, 3))
        rows.append((i, " ".join(w), "a"))
    rows += [(100, "echo " * 300, "a"), (101, "x y " * 50 + "echo " * 30, "a")]
    found = substrings.remove_repeats(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == brute.substrings(
        [(i, t) for i, t, _ in rows]
    )


def test_substrings_repeated_and_unnamed_rows(spark):
    text = " ".join(f"q{i}" for i in range(30))
    rows = [(3, text, "a"), (3, text, "a"), (4, text + " more", "a"), (None, text, "a")]
    found = substrings.remove_repeats(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in found) == [(0, 0), (3, 0), (3, 0), (4, 30)]


def test_lines(spark, odd):
    found = lines.line_dedup(odd)
    assert found.columns == [c for c in odd.columns if c != "n_lines"] + ["n_lines", "n_removed", "n_runs"]
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"], r["n_runs"]) for r in found.collect()}
    assert got == brute.line_dedup(TEXTS.items())
    assert got[7][1] == 1 and got[11][1] == 4
    assert found.where("rank <> 'x' OR _row <> 'x' OR _0 <> 'x'").count() == 0


def test_lines_of_random_letters(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "\n".join(rng.choice(list("abc "), int(rng.integers(0, 25)))), "a") for i in range(60)]
    rows += [(70, rows[3][1], "a"), (71, "\n".join("ab" * 40), "a")]
    for least, long_line in ((1, 60), (2, 1), (3, 60), (4, 60)):
        found = lines.line_dedup(documents(spark, rows), min_lines=least, long_line=long_line).collect()
        want = brute.line_dedup([(i, t) for i, t, _ in rows], least, long_line)
        assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"], r["n_runs"]) for r in found} == want


def test_lines_count_maximal_runs(spark):
    """Adjacent and overlapping copies of different earlier runs are told apart; a long single line is a run."""
    long, short = "a line long enough to count alone", "short"
    rows = [(1, "a\nb\nc\nd", "a"), (2, "p\nq\nr", "a"), (3, "c\nd\ne\nf\ng", "a"), (4, f"{long}\n{short}", "a")]
    rows += [(5, "a\nb\nc\np\nq", "a"), (6, "b\nc\nd\ne\nf", "a"), (7, f"x\n{long}\ny\n{short}\nz", "a")]
    found = {r["doc_id"]: (r["n_removed"], r["n_runs"]) for r in lines.line_dedup(documents(spark, rows)).collect()}
    assert found == {1: (0, 0), 2: (0, 0), 3: (2, 1), 4: (0, 0), 5: (5, 2), 6: (5, 2), 7: (1, 1)}


def test_suffix_ranks_sort_suffixes(spark):
    """Suffixes of one rank share their first lines; ranks of a level order suffixes alike at every level above."""
    rng = np.random.default_rng(8)
    rows = [(i, "\n".join(rng.choice(list("ab"), 12)), "a") for i in range(12)]
    base = documents(spark, rows).select("text", F.col("doc_id").alias("_key"), F.col("doc_id").alias("_row"))
    table = lines.line_table(base, 60).cache()
    sequence = {i: t.split("\n") for i, t, _ in rows}
    symbol = {r["h1"]: None for r in table.select("h1", "h2").distinct().orderBy("h1", "h2").collect()}
    order = {h: k for k, h in enumerate(symbol)}
    name = {sequence[r["_row"]][r["pos"]]: order[r["h1"]] for r in table.collect()}
    for level, shared in enumerate(lines.suffix_ranks(table)):
        width = 2**level
        got = [(r["rank"], [name[x] for x in sequence[r["_row"]][r["pos"] : r["pos"] + width]]) for r in shared.collect()]
        for a, x in got:
            for b, y in got:
                assert (a < b) == (x < y) and (a == b) == (x == y)


def test_lines_reject_other_run_lengths(odd):
    with pytest.raises(ValueError):
        lines.line_dedup(odd, min_lines=0)


def test_packing_edges(spark, odd):
    pieces = tokens(odd.withColumn("offset", F.lit("x")))
    extra = pieces.withColumns({"_0": F.lit("x"), "offset": F.lit("x"), "rank": F.lit(1)})
    found = packing.pack(extra)
    assert found.columns == [*pieces.columns, "_0", "rank", "sequence_id", "offset"]
    rows = found.collect()
    assert {r["doc_id"]: r["length"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1: 1, 2: 1, 3: 1}
    long = sorted((r["piece"], r["start"], r["length"]) for r in rows if r["doc_id"] == 6)
    assert [p for p, _, _ in long] == list(range(len(long)))
    assert all(s == 4096 * p and (n == 4096 or p == len(long) - 1) for p, s, n in long)


def test_sum_of_squares_rule():
    # Gaps 30, 30 and 20 are open. A 10 goes into the 20, the first 20 into a 30; for the second, a
    # third gap of 10 would cost more squares than a new bin.
    bins, offsets = packing.sum_of_squares(np.array([70, 70, 80, 10, 20, 20]), 100)
    assert offsets.tolist() == [0, 0, 0, 80, 70, 0] and bins[3] == bins[2] and bins[5] == 3
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 40, 300)
    bins, offsets = packing.sum_of_squares(sizes, 40)
    open_, used = {}, []
    for size, at, offset in zip(sizes.tolist(), bins.tolist(), offsets.tolist()):
        def squares(gap, taken=size):
            now = dict(open_)
            if gap != 40:
                now[gap] -= 1
            if gap - taken:
                now[gap - taken] = now.get(gap - taken, 0) + 1
            return sum(v * v for v in now.values())

        choices = [g for g, n in open_.items() if n and g >= size] + [40]
        gap = 40 - offset
        assert squares(gap) == min(squares(g) for g in choices)
        if gap != 40:
            open_[gap] -= 1
        if gap - size:
            open_[gap - size] = open_.get(gap - size, 0) + 1
        used.append(at)
    assert max(used) + 1 <= math.ceil(sizes.sum() / 40) * 1.1 + 1


def test_packed_ids_round_trip(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.tokenize(odd, path, capacity=512, with_ids=True)
    packed = packing.pack(pieces, capacity=512).cache()
    held = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert held[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]


def test_shards_of_repeated_rows(spark):
    df = spark.range(1000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x").alias("shard"), F.lit(None).cast("long").alias("slot"))
    found = sharding.assign_shards(df, ["doc_id"], F.lit(10), 8).groupBy("shard").agg(
        F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b")
    ).collect()
    assert sorted((r["shard"], r["n"], r["a"], r["b"]) for r in found) == [(k, 125, 0, 124) for k in range(8)]


def test_mix_edges(spark, odd):
    rows = [(i, t, ["a", "b", None][i % 3]) for i, t in TEXTS.items()]
    taken, target, size, whole = brute.mix_taken(rows)
    per_doc, slots = mixing.mix(odd)
    got = {r["doc_id"]: (r["size"], r["source_size"], r["target"], r["taken"]) for r in per_doc.collect()}
    source = {i: s for i, _, s in rows}
    assert got == {i: (size[i], whole[source[i]], target[source[i]], taken[i]) for i in TEXTS}
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(odd)[0].collect()}
    assert again == taken
    assert slots.agg(F.sum("words")).first()[0] == sum(taken.values())
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_rules_and_counts(odd, labels):
    judged, learned = rules.judge(odd, labels)
    found = {r["doc_id"]: r for r in judged.collect()}
    for i, t in TEXTS.items():
        assert tuple(found[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute.base_counts(t)
    assert learned == [] and found[1]["base_failed"] and found[6]["kept"] and found[9]["base_failed"]
    kept = rules.filter_quality(odd, labels)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [6, 7]


def test_repeated_words():
    assert repeated_words(np.array([0, 1, 2, 3, 0, 1, 2])) == 6
    assert repeated_words(np.array([0, 0, 0, 0])) == 4
    assert repeated_words(np.array([0, 1])) == 0


def test_rules_find_a_planted_conjunction():
    rng = np.random.default_rng(1)
    values = {n: rng.random(4000) for n in ("words", "upper_share", "repeat_share")}
    bad = (values["upper_share"] >= 0.6) & (values["repeat_share"] < 0.5)
    learned = rules.learn(values, bad)
    hit = np.zeros(4000, bool)
    for rule in learned:
        hit |= rules._covers(rule, values, 4000)
    assert (hit == bad).mean() > 0.97


def test_classifier_edges(odd, labels):
    model = classifier.fit(odd, labels)
    scores = {r["doc_id"]: r["score"] for r in classifier.score(odd, model).collect()}
    assert set(scores) == set(TEXTS) and all(0 <= s <= 1 for s in scores.values())
    assert scores[1] == scores[2] == scores[3]


def test_classifier_features_stay_in_words():
    s = classifier.Settings(buckets=1 << 30)
    a, b = classifier.features("abcd efg", s), classifier.features("efg  \n abcd", s)
    # Words and n-grams are the same; only the pair of neighbours differs.
    assert len(a) == len(b) and len(set(a) ^ set(b)) == 2
    assert len(classifier.features("abcd", s)) == 1 + 4 + 3 + 2


def test_pages_edges(spark):
    body = "<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav>{}<footer>Imprint</footer></body>"
    rows = [
        (1, "http://a.example/1", None),
        (2, None, ""),
        (3, "http://a.example/3", body.format("<article><h1>A &amp; B</h1><p>x <b>y<br>z<p>ä &lt;&nbsp;&copy</article>")),
        (4, "http://a.example/4", body.format("<main><p>main text<div class='comments'><p>first!</div></main>")),
        (5, "http://a.example/5", body.format("<div id=cookie-notice>We use</div><div><p>plain text, with 1 < 2</div><aside>Side</aside>")),
        (6, "not a url", "no markup at all"),
        (6, "not a url", "no markup at all"),
        (7, "http://a.example/7", "<article><p>cut <script>if (a<b) '</p>'</script>off <!-- <p>note</p> --> here <form>Name</form><p>" + LONG),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x"))
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in pages.extract(df).collect()}
    want = {
        1: "", 2: "", 3: "A & B\nx y z\nä < ©", 4: "main text", 5: "plain text, with 1 < 2", 6: "no markup at all",
        7: "cut off here\n" + LONG,
    }
    assert found == {i: (t, len(t)) for i, t in want.items()}


def test_page_template_without_marks(spark):
    """On a host without article or main elements the template shows what is furniture and where the text is."""
    page = (
        "<body><div class=top>Our site</div><div class=links><a href=/a>One</a> <a href=/b>Two</a></div>"
        "<div class=c1><p>Posted by us</p><p>{}</p><p>{}</p></div><div class=low>All rights</div></body>"
    )
    texts = [(f"story number {i} goes on " * 4, f"and ends with {i * i} " * 3) for i in range(12)]
    rows = [(i, f"https://b.example/{i}", page.format(*t)) for i, t in enumerate(texts)]
    found = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: "\n".join(x.strip() for x in t) for i, t in enumerate(texts)}


def test_vectors(spark):
    rng = np.random.default_rng(4)
    rows, centre = [], rng.normal(size=32)
    for i in range(400):
        near = i % 3 == 0
        v = centre + rng.normal(size=32) * (0.12 if near else 3)
        rows.append((i, [float(np.float32(x)) for x in v], i % 2))
    rows += [
        (500, rows[0][1], 0), (501, rows[0][1], None), (502, None, 0), (503, [0.0] * 32, 0), (504, [float("nan")] * 32, 0),
        (505, [float("inf")] + [1.0] * 31, 0), (506, [None] + [1.0] * 31, 0), (507, rows[0][1][:16], 0), (508, [], 0),
        (509, [x * 1e-30 for x in rows[0][1]], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"t": F.lit("x"), "node": F.lit(1)})
    good = {}
    for i, v, label in rows:
        x = np.array(v if v and None not in v else [0.0], np.float32).astype(float)
        if label is not None and np.isfinite(x).all() and np.abs(x).max() > 0:
            good[i] = (label, x / np.linalg.norm(x))
    links = [
        (a, b) for a in good for b in good
        if a < b and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= 0.98
    ]
    assert len(links) > 1000
    low = brute.components([r[0] for r in rows], links)
    count = {r[0]: 0 for r in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(df).collect()}
    assert found == {i: (count[i], low[i], low[i] == i) for i in low}


def test_vector_labels_and_repeated_ids(spark):
    """Labels of any type keep vectors apart; vectors under one id are rows of their own."""
    a, b, c = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [1.0, 0.01, 0.0, 0.0]
    for x, y, kind in (("red", "blue", "string"), (1.2, 1.7, "double")):
        rows = [(9, a, x), (2, a, y), (3, c, x), (4, c, y), (5, b, x), (5, a, x)]
        found = vectors.near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()
        want = [(2, 1, 2, True), (3, 2, 3, True), (4, 1, 2, False), (5, 0, 5, True), (5, 2, 3, False), (9, 2, 3, False)]
        assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found) == want


def test_shards_keep_columns_of_any_name(spark):
    rows = [(i, i % 5, "a" * i) for i in range(40)]
    names = ["_row", "_size", "_tie", "_part", "_before", "_total", "_first", "c0"]
    df = spark.createDataFrame(rows, "doc_id long, k long, text string").withColumns({n: F.col("doc_id") * 7 for n in names})
    found = sharding.assign_shards(df, ["doc_id"], F.col("k") + 1, 4).collect()
    assert sorted(found[0].asDict()) == sorted([*df.columns, "shard", "slot"])
    assert len(found) == 40 and all(r[n] == r["doc_id"] * 7 for r in found for n in names)


def test_vector_blocks(spark, monkeypatch):
    """A cell far above the block size is counted in block pairs, each pair of vectors once."""
    from tidemark.llm import blocks

    monkeypatch.setattr(blocks.block_pairs, "__defaults__", (16,))
    rng = np.random.default_rng(6)
    centre = rng.normal(size=8)
    rows = [(i, [float(x) for x in centre + rng.normal(size=8) * 0.02], 1) for i in range(150)]
    found = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = ((x @ x.T) >= 0.98).sum(axis=1) - 1
    assert {r["vec_id"]: r["n_links"] for r in found} == dict(enumerate(want.tolist()))


def test_vector_recall():
    """Pairs exactly at the threshold are found by the eight tables."""
    rng = np.random.default_rng(9)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    x = unit(rng.normal(size=(4000, 64)))
    t = rng.normal(size=x.shape)
    t = unit(t - (t * x).sum(axis=1, keepdims=True) * x)
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * t
    a, b = vectors.cells(x, 8, 2, 4), vectors.cells(y, 8, 2, 4)
    met = (a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)
    assert met.any(axis=1).all() and met.mean() > 0.9


def test_components(spark):
    rng = np.random.default_rng(12)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, 5000 + i) for i in range(1, 300)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    low = brute.components({x for e in edges for x in e}, edges)
    assert {r["id"]: r["component_id"] for r in found} == {i: c for i, c in low.items() if i != c}


def page_texts(spark, sources, host="c.example"):
    rows = [(i, f"https://{host}/{i}", h) for i, h in enumerate(sources)]
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["page_id"])]


def test_page_template_decides_over_tags(spark):
    """Teasers as articles, beside a main text in a plain element or in an article of its own, are not the article."""
    story = lambda i: (f"<p>{f'story {i} goes on and on ' * 8}</p><p>{f'and ends with {i * i} ' * 5}</p>")
    cards = lambda i: "".join(f"<article class=card><p>teaser {i * 7 + k} of another</p></article>" for k in range(3))
    lines = lambda i: "\n".join([(f"story {i} goes on and on " * 8).strip(), (f"and ends with {i * i} " * 5).strip()])
    for page in (
        "<body><main><div class=text>{}</div>{}</main></body>",
        "<body><div class=wrap><div class=text>{}</div>{}</div></body>",
        "<body><main><article class=post>{}</article>{}</main></body>",
    ):
        found = page_texts(spark, [page.format(story(i), cards(i)) for i in range(12)])
        assert found == [lines(i) for i in range(12)], page
    # Posts with ids of their own.
    posts = [f"<body><main><article id=post-{i} class='post n{i}'>{story(i)}</article>{cards(i)}</main></body>" for i in range(12)]
    assert page_texts(spark, posts) == [lines(i) for i in range(12)]
    # Pages without the template's slot, without tags and without a source are read by their marks or give nothing.
    odd = [f"<body><div class=text>{story(i)}</div>{cards(i)}</body>" for i in range(30)]
    assert page_texts(spark, [*odd, "", None, "plain"]) == [*[lines(i) for i in range(30)], "", "", "plain"]


def test_page_copies_are_no_template(spark):
    """Copies of one article on a host, all pages or half of them, keep their text; so do copies under differing furniture."""
    copy = "<body><nav>{}</nav><article><h1>One story</h1><p>told again and again</p></article></body>"
    assert page_texts(spark, [copy.format("Menu")] * 12) == ["One story\ntold again and again"] * 12
    assert page_texts(spark, [copy.format(i) for i in range(12)]) == ["One story\ntold again and again"] * 12
    half = "<body><div class=top>Our site</div><div class={}><p>{}</p></div></body>"
    other = [f"number {i} of the other stories" for i in range(12)]
    sources = [half.format("post-12", "told again")] * 14 + [half.format("post", t) for t in other]
    assert page_texts(spark, sources) == ["told again"] * 14 + other


def test_page_marks_in_words_of_wrappers(spark):
    """A word in the class of an element that holds the text marks nothing; the template overrules marks around its slot."""
    story = "<p>a story that goes on and on, with many words in it</p>"
    want = "a story that goes on and on, with many words in it"
    whole = [
        "<body class='has-sidebar'>{}</body>", "<body class='no-header'><div>{}</div></body>",
        "<body><div id='content-sidebar-wrap'>{}<div class=sidebar>Side</div></div></body>",
        "<body><div class='side-by-side'>{}</div><div class=social>Share</div></body>",
        "<body><article class='post social'>{}</article></body>", "<body><div class=header><main>{}</main></div></body>",
    ]
    for page in whole:
        assert "\n".join(pages.main_blocks(page.format(story), None, set())) == want, page
    ad = "<body><div class=ad>an advert longer than the whole article is</div><article><p>short</p></article></body>"
    assert pages.main_blocks(ad, None, set()) == ["short"]
    # Long side columns on some pages of a host: the template knows where the text is.
    page = "<body><div class='col-side'><div class=text><p>story {}</p></div></div><p>{}</p></body>"
    sources = [page.format(f"{i} goes on and on " * 20, "Home") for i in range(11)] + [page.format("cut", "much else " * 9)]
    assert page_texts(spark, sources) == [*[("story " + f"{i} goes on and on " * 20).strip() for i in range(11)], "story cut"]


def test_page_elements_around_and_in_the_article(spark):
    """A form around the page, the header of an article and inline elements keep the article's text; plain forms go."""
    story = lambda i: f"<h1>Story {i}</h1><p>{f'story {i} goes <b>on</b> and <i>on</i>, ' * 8}</p>"
    text = lambda i: f"Story {i}\n" + (f"story {i} goes on and on, " * 8).strip()
    around = "<body><form id=aspnet><div class=text>{}</div><div class=footer>Imprint</div></form></body>"
    assert page_texts(spark, [around.format(story(i)) for i in range(12)]) == [text(i) for i in range(12)]
    assert "\n".join(pages.main_blocks(around.format(story(3)), None, set())) == text(3)
    assert pages.main_blocks("<body><form>Your name <input> and more</form></body>", None, set()) == []
    assert pages.main_blocks("<body><p>It is short</p><form>Your <b>name</b> here</form></body>", None, set()) == ["It is short"]
    headed = "<article><header class=entry-header><h1>Head</h1><span>by us</span><nav><h2>No</h2></nav></header><p>text</p></article>"
    assert pages.main_blocks(headed, None, set()) == ["Head", "text"]
    assert pages.main_blocks("<header><h1>Site</h1></header><p>text</p>", None, set()) == ["text"]
    inline = "<p>a <label>b</label> c<b>d</b>e <span class=share>f <i>g</i></span><svg/>h</p>"
    assert pages.main_blocks(inline, None, set()) == ["a cde h"]


def test_page_comments_longer_than_the_article(spark):
    story = lambda i: f"<article><h1>Story {i}</h1><p>{f'story {i} goes on ' * 4}</p></article>"
    text = lambda i: f"Story {i}\n" + (f"story {i} goes on " * 4).strip()
    for word in ("commentlist", "c7"):
        said = lambda i: "".join(f"<li><p>{f'reader {i + k} thinks so ' * 9}</p></li>" for k in range(4))
        sources = [f"<body><main>{story(i)}<ol class={word}>{said(i)}</ol></main></body>" for i in range(12)]
        assert page_texts(spark, sources) == [text(i) for i in range(12)], word


def test_page_markup_is_read_once():
    """Markup that never ends, quotes that never end and elements without end take time in proportion to the page."""
    begin = time.monotonic()
    n = 50_000
    for odd in ("<a ", "<script ", "<!", "<div>", "<li>", "<b>", "<a \">\"", "<a '", "<div class=ad>", "</script", "<svg>", "<x y='>"):
        pages.parse("<p>start</p>" + odd * n + "<p>end")
    assert time.monotonic() - begin < 60
    assert [b.text for b in pages.parse("<div>" * n + "deep" + "</div>" * n + "<p>end").blocks] == ["deep", "end"]
    assert [b.text for b in pages.parse("<p>a < b</p><p title='x>y'>c</p><p title=\"z>d").blocks] == ["a < b", "c", "d"]
    assert [b.text for b in pages.parse("<p>a<!-- <p>no").blocks] == ["a"]
    assert [b.text for b in pages.parse("a <b").blocks] == ["a <b"]


def test_stages_keep_null_and_repeated_ids(spark):
    """Rows without an id and different texts under one id are documents of their own in both stages."""
    text = lambda k: " ".join(f"{k}w{i}" for i in range(40))
    rows = [(None, text("a"), "s"), (None, text("b"), "s"), (None, text("b"), "s"), (5, text("c"), "s"), (5, text("d"), "s"),
            (5, text("d"), "s"), (6, text("d"), "s"), (3, text("e"), "s"), (None, text("e"), "s")]
    docs = documents(spark, rows)
    found = corpus_pipeline.minhash_dedup(spark, docs, "")
    assert found.columns == docs.columns
    want = [("", text("a")), ("", text("b")), ("3", text("e")), ("5", text("c")), ("5", text("d"))]
    assert sorted((str(r["doc_id"] or ""), r["text"]) for r in found.collect()) == want
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    assert mixed.columns == docs.columns
    # The mix has as many words as the documents, so a single source is taken once.
    assert sorted((r["doc_id"] or 0, r["text"]) for r in mixed.collect()) == sorted((i or 0, t) for i, t, _ in rows)


def test_added_tokens_in_texts(spark):
    """Literals of added tokens get the ids of the tokenizer as loaded."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["a <|endoftext|> b", "a<|startoftext|><|endoftext|>b c", "<|ENDOFTEXT|> <|endoftext", "no literal"]
    found = packing.tokenize(documents(spark, [(i, t, "s") for i, t in enumerate(texts)]), path, with_ids=True).collect()
    whole = Tokenizer.from_file(path)
    assert {r["doc_id"]: r["ids"] for r in found} == {i: whole.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}


def test_encoder_forgets_words_by_their_bytes(monkeypatch, tmp_path):
    """Words that do not come again take no more memory the more there are of them, however long they are."""
    from tokenizers import Tokenizer

    for name in ("WORDS", "PARTS"):
        monkeypatch.setattr(packing, name, 500_000, raising=False)
    path = str(tmp_path / "vocabulary.json")
    shutil.copy(public_tokenizers.path("word_bpe_49k.json"), path)
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("aeinorstÄéñ", k=300))
    texts = [None, "", *(f"The first, {word()} don't\n{word()}, {' '.join(word() for _ in range(8))}" for _ in range(2000))]
    whole = Tokenizer.from_file(path)
    list(packing.encode(["The"], path))
    tracemalloc.start()
    try:
        most = 0
        for at, ids in enumerate(packing.encode(texts, path)):
            if at % 100 == 0:
                assert list(np.frombuffer(ids, "<u4")) == whole.encode(texts[at] or "", add_special_tokens=False).ids
            most = max(most, tracemalloc.get_traced_memory()[0])
    finally:
        tracemalloc.stop()
    assert most < 8_000_000, most
