"""Corpus operators against brute force, on odd rows and on small tables."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlens.llm import (
    components, decontaminate, embedding_dedup, jaccard_join, kneser_ney, line_dedup, lm_scoring, quality, queries,
    substring_dedup, toxicity,
)
from marketlens.llm.scratch import Scratch
from marketlens.llm.words import Words

FOLDER = "/root/testdata/sf0.001"


def words_of(text):
    return (text or "").encode().lower().split()


def least_reachable(nodes, edges):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components.connected(df, Scratch(spark, "test"), "c").collect()}
    wanted = least_reachable({n for e in edges if e[0] != e[1] for n in e}, edges)
    assert found == wanted
    assert components.connected(df.limit(0), Scratch(spark, "test"), "c").count() == 0


def test_components_end_when_only_stars_are_left(spark, monkeypatch):
    kept, keep = [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name, *a, **b: kept.append(name) or keep(self, df, name, *a, **b))

    def found(edges):
        kept.clear()
        df = spark.createDataFrame(edges, "a long, b long")
        return {r.node: r.component for r in components.connected(df, Scratch(spark, "test"), "c").collect()}

    assert found([(1, n) for n in range(2, 9)] + [(20, 21), (20, 20)]) == {**{n: 1 for n in range(1, 9)}, 20: 20, 21: 20}
    assert kept == ["c-0"]
    assert found([]) == {} and kept == ["c-0"]
    # The larger ends meet in one node, and a path: neither is a star yet.
    assert found([(1, 9), (2, 9)]) == {1: 1, 2: 1, 9: 1} and len(kept) == 2
    assert found([(3, 2), (2, 1)]) == {1: 1, 2: 1, 3: 1} and len(kept) == 2


def test_lines_on_odd_rows(spark, odd_documents):
    found = line_dedup.drop_repeated_lines(odd_documents, min_documents=3, batches=3)
    assert found.columns == [*odd_documents.columns, "n_lines", "n_dropped"]
    rows = odd_documents.collect()
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(line_dedup.UPPER, line_dedup.UPPER.lower()))
    docs = [[(line, key(line)) for line in (r.text or "").split("\n")] for r in rows]
    uses = {}
    for lines in docs:
        for k in {k for _, k in lines if k}:
            uses[k] = uses.get(k, 0) + 1
    wanted = sorted(
        (str(r.doc_id), "\n".join(line for line, k in lines if uses.get(k, 0) < 3), len(lines), sum(uses.get(k, 0) >= 3 for _, k in lines))
        for r, lines in zip(rows, docs)
    )
    assert sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in found.collect()) == wanted
    first = line_dedup.drop_repeated_lines(odd_documents, min_documents=3, keep_first=True).where("doc_id = 3").collect()
    assert all(r.n_dropped == 0 for r in first)
    assert line_dedup.drop_repeated_lines(odd_documents.limit(0)).count() == 0


def test_runs_keep_levels_and_find_new_lines(spark):
    runs = line_dedup.LineRuns(spark, Scratch(spark, "test").path("runs"), fanout=2, buckets=3)
    for batch in range(5):
        keys = spark.range(batch, batch + 10).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.struct(F.lit(False).alias("none"), F.lit(batch).cast("long").alias("id")).alias("first"))
        runs.add(keys)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    lines = spark.range(0, 20).select(F.col("id").alias("h1"), F.col("id").alias("h2"))
    assert {r.h1 for r in runs.unseen(lines).collect()} == set(range(14, 20))
    total = {r.h1: (r.n_docs, r.first.id) for r in runs.compact().collect()}
    assert total == {k: (sum(b <= k < b + 10 for b in range(5)), min(b for b in range(5) if b <= k < b + 10)) for k in range(14)}
    runs.close()


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80), (2, 30)])
def test_jaccard_on_odd_rows(spark, odd_documents, width, percent):
    rows = odd_documents.collect()
    sets = []
    for r in rows:
        w = words_of(r.text)
        sets.append({tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
    edges = [
        (i, j) for i, j in itertools.combinations(range(len(rows)), 2)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    group = least_reachable(range(len(rows)), edges)
    low = {}
    for k, g in group.items():
        if rows[k].doc_id is not None:
            low[g] = min(low.get(g, rows[k].doc_id), rows[k].doc_id)
    wanted = sorted((str(r.doc_id), len(s), str(low.get(group[k])) if s else str(r.doc_id)) for k, (r, s) in enumerate(zip(rows, sets)))
    found = jaccard_join.near_duplicate_components(odd_documents, width, percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == wanted
    assert jaccard_join.near_duplicate_components(odd_documents.limit(0), width, percent).count() == 0


def test_divide_skip_equals_plain_overlap():
    random = np.random.default_rng(3)
    for _ in range(30):
        base = np.unique(random.integers(0, 400, 120).astype(np.uint64))
        sets = [np.unique(np.concatenate((random.choice(base, len(base) - k % 40, replace=False), random.integers(400, 900, k % 50).astype(np.uint64)))) for k in range(40)]
        wanted = [100 * len(set(base) & set(s)) >= 80 * len(set(base) | set(s)) for s in sets]
        assert jaccard_join.overlaps(base, sets, 80).tolist() == wanted


def hits(words, windows):
    spans = [(i, i + len(w)) for w in windows for i in range(len(words) - len(w) + 1) if words[i : i + len(w)] == w]
    return {p for a, b in spans for p in range(a, b)}, bool(spans)


def test_contamination_on_odd_rows(spark, odd_documents):
    items = [
        (1, "quick brown fox jumps over the lazy dog while seven wizards"), (2, "another text"), (2, "w5 w6"), (3, None), (4, "!!"),
        (None, "same same"), (10, "absent words only"), (12, "Strange Potions; near"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = [(i, [w] if len(w) < 10 else [w[k : k + 10] for k in range(len(w) - 9)]) for i, t in items if (w := split(t))]
    wanted = []
    for r in odd_documents.collect():
        words = split(r.text)
        covered, found = set(), set()
        for item, own in windows:
            at, any_ = hits(words, own)
            covered |= at
            if any_ and item is not None:
                found.add(str(item))
        wanted.append((str(r.doc_id), len(words), len(covered), sorted(found)))
    found = decontaminate.find_contamination(odd_documents, benchmark).collect()
    assert sorted((str(r.row.doc_id), r.n_words, r.n_hit, r["items"]) for r in found) == sorted(wanted)
    empty = decontaminate.find_contamination(odd_documents, benchmark.limit(0))
    assert empty.where("n_hit > 0").count() == 0 and empty.count() == len(wanted)
    assert decontaminate.find_contamination(odd_documents.limit(0), benchmark).count() == 0


def test_proximity_is_told_from_phrases(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "alpha beta x gamma delta"), (3, "alpha q r s t u gamma")], "doc_id long, text string")
    item = spark.createDataFrame([(9, "alpha beta gamma delta")], "item_id long, text string")
    found = {r.row.doc_id: (r.n_hit, r.n_near) for r in decontaminate.find_contamination(docs, item, slop=2).collect()}
    assert found[1] == (4, 0) and found[2][0] == 0 and found[3] == (0, 0)


@pytest.mark.parametrize("width", [3, 7, 20])
def test_repeats_on_odd_rows(spark, odd_documents, width):
    rows = odd_documents.collect()
    texts = [(r.text or "").encode().split() for r in rows]
    starts = {}
    for d, w in enumerate(texts):
        for i in range(len(w) - width + 1):
            starts.setdefault(tuple(w[i : i + width]), []).append((d, i))
    gone = [set() for _ in rows]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + width))
    wanted = sorted((str(r.doc_id), len(w), len(g), b" ".join(x for p, x in enumerate(w) if p not in g).decode()) for r, w, g in zip(rows, texts, gone))
    found = substring_dedup.remove_repeats(odd_documents, width).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in found) == wanted
    assert substring_dedup.remove_repeats(odd_documents.limit(0), width).count() == 0


def test_every_window_has_a_symbol_of_its_own():
    """Repeated windows share a name wherever they stand, in random and in periodic texts."""
    import pyarrow as pa

    random = np.random.default_rng(5)
    for kinds, width in ((3, 9), (50, 12), (2, 7)):
        texts = [" ".join(f"w{k}" for k in random.integers(0, kinds, 150)) for _ in range(4)] + ["w1 " * 100, "w1 w2 " * 80]
        words = Words(pa.array(texts))
        first = words.first.astype(np.int64)
        name, text, begin, end, verifying = substring_dedup.symbols_of(words.hashes(), first, width)
        uses = dict(zip(*np.unique(name, return_counts=True)))
        open_ = {}
        for n, t, b, e, v in zip(name, text, begin, end, verifying):
            if not v:
                for p in range(b, e):
                    open_[p] = open_.get(p, False) or uses[n] > 1
        tokens = " ".join(texts).split()
        seen = {}
        for t in range(len(texts)):
            for i in range(first[t], first[t + 1] - width + 1):
                seen.setdefault(tuple(tokens[i : i + width]), []).append(i)
        for places in seen.values():
            if len(places) > 1:
                assert all(open_.get(i + width // 2) for i in places)


def test_symbols_do_not_depend_on_empty_texts():
    """A passage has the same names in a batch filled with empty texts as in one without."""
    import pyarrow as pa

    random = np.random.default_rng(6)
    texts = [" ".join(f"w{k}" for k in random.integers(0, 10**6, 60)) for _ in range(20)]

    def names(column):
        words = Words(pa.array(column))
        name, _, _, _, verifying = substring_dedup.symbols_of(words.hashes(), words.first.astype(np.int64), 35)
        return sorted(zip(name.tolist(), verifying.tolist()))

    assert names(texts + [None, ""] * 5000) == names([""] * 9000 + texts) == names(texts)


def test_vectors_on_odd_rows(spark):
    random = np.random.default_rng(2)
    base = random.normal(size=(6, 8))
    rows = [(k, (base[k % 6] + random.normal(size=8) * 0.15).tolist(), k % 2) for k in range(120)]
    rows += [(200, [0.0] * 8, 0), (201, None, 0), (202, [1.0, None] + [0.0] * 6, 0), (203, [float("nan")] * 8, 0), (204, base[0].tolist(), None)]
    rows += [(205, base[1].tolist(), 1), (206, base[1].tolist(), 1), (207, (base[1] * 1e-3).tolist(), 1), (208, [1.0, 2.0], 1), (209, [float("inf")] * 8, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, at string")
    ok = {r[0]: np.array(r[1], float) for r in rows if r[1] is not None and r[2] is not None and None not in r[1]}
    ok = {k: v for k, v in ok.items() if np.isfinite(v).all() and v.any()}
    label = {r[0]: r[2] for r in rows}
    edges = [
        (a, b) for a, b in itertools.combinations(ok, 2)
        if label[a] == label[b] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= 0.93
    ]
    low = least_reachable([r[0] for r in rows], edges)
    wanted = sorted((k, sum(k in e for e in edges), low[k], low[k] == k) for k in low)
    found = embedding_dedup.near_duplicate_vectors(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == wanted
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def test_kneser_ney_sums_to_one(spark):
    """The shards' tables give the probabilities of the plain recursion, which sum to one."""
    import pyarrow as pa

    texts = ["a b a c a b d", "b a b a c", "c c a b a d a b"] * 3 + ["d a d b"]
    training = spark.createDataFrame([(t, 0) for t in texts], "text string, model int")
    vocabulary = kneser_ney.learn_vocabulary(training, 100, False, False)
    tables = kneser_ney.train(training, vocabulary, 1, Scratch(spark, "test")).toPandas()
    find = {kind: dict(zip(own["key"], own["value"])) for kind, own in tables.groupby("kind")}
    unigrams = vocabulary.unigrams[0]
    assert unigrams.sum() == pytest.approx(1, abs=1e-6)

    def p(key):
        u_v, v, v_w, w = key >> 14, (key >> 14) & 16383, key & ((1 << 28) - 1), key & 16383
        lower = find[2].get(v_w, find[3].get(v, 1.0) * unigrams[w])
        return find[0].get(key, 0.0) + find[1].get(u_v, 1.0) * lower

    keys, _, _ = kneser_ney.trigrams(pa.array(["a b a"]), vocabulary)
    for key in keys.tolist():
        assert sum(p((key >> 14 << 14) | w) for w in range(vocabulary.size)) == pytest.approx(1, abs=1e-4)
    docs = spark.createDataFrame([(1, 5, "a b a c"), (2, 6, None), (None, 7, "d d")], "doc_id long, mark long, text string")
    spread = spark.createDataFrame(tables)
    found = {r.mark: r for r in kneser_ney.log_likelihoods(docs, spread, vocabulary, 1).collect()}
    keys, _, _ = kneser_ney.trigrams(pa.array(["a b a c"]), vocabulary)
    assert found[5].log_likelihood[0] == pytest.approx(sum(np.log(p(k)) for k in keys.tolist()), rel=1e-4)
    assert found[6].n_words == 0 and found[6].log_likelihood[0] == 0 and found[7].doc_id is None


def test_quality_separates_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op1_quality_classifier"](spark, folder).join(queries.table(spark, folder, "labels"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2


def test_quality_rejects_gibberish(spark):
    """Words that nobody knows are no better than clean text because their shapes are frequent."""
    folder = "/root/testdata/sf0.01"
    docs, random = queries.table(spark, folder, "documents"), np.random.default_rng(4)
    noise = [" ".join("".join(chr(c) for c in random.integers(97, 123, random.integers(4, 9))) for _ in range(150)) for _ in range(20)]
    planted = spark.createDataFrame([(-1 - k, t, lang) for k, t in enumerate(noise) for lang in ("en", None)], "doc_id long, text string, lang string")
    found = quality.classify(docs.select("doc_id", "text", "lang").unionAll(planted), queries.table(spark, folder, "labels"))
    rows = found.where("n_words > 0").collect()
    typical = np.median([r.perplexity for r in rows if r.doc_id >= 0])
    assert sum(r.kept for r in rows if r.doc_id < 0) == 0 and min(r.perplexity for r in rows if r.doc_id < 0) > typical


def test_quality_learns_from_every_trusted_document_of_its_half(spark):
    docs = spark.range(7000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id") % 50).alias("text"))
    found = quality.perplexity(docs, docs.where("doc_id % 100 <> 0").select("doc_id"))
    wanted = docs.where("doc_id % 100 <> 0").where(F.xxhash64("doc_id") % 2 == 0)
    assert found.where("trained").count() == wanted.count() > 3000


def test_fewer_rare_words_leave_more_to_letters(spark):
    text = " ".join(f"w{k}" for times in range(4) for k in range(40) if times <= k % 4)
    training = spark.createDataFrame([(text, 0)], "text string, model int")
    for most, kept in ((40, 40), (39, 30), (20, 20), (19, 10), (5, 0)):
        vocabulary = kneser_ney.Vocabulary(np.empty(0, np.uint64), False, False)
        kneser_ney.learn_letters(training, vocabulary, Scratch(spark, "letters"), most)
        words, shares = vocabulary.rare
        assert len(words) == kept and np.exp(shares).sum() + np.exp(vocabulary.left) == pytest.approx(1)


def test_letters_sum_to_one():
    import pyarrow as pa

    words = Words(pa.array(["ab abc b", None, "ca \u00e9"]))
    keys, word = kneser_ney.letters_of(words, np.arange(5))
    assert np.bincount(word).tolist() == [3, 4, 2, 3, 3]
    letters = kneser_ney.Letters(*np.unique(keys, return_counts=True))
    for context in (0, 98, 98 << 9 | 99, 5 << 9 | 7):
        assert letters.probabilities(np.arange(257) | context << 9).sum() == pytest.approx(1)
    none = kneser_ney.Letters(np.empty(0, np.int64), np.empty(0, np.int64))
    assert none.probabilities(np.arange(257)).sum() == pytest.approx(1)


def test_quality_on_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(3, 1, 0), (9, 1, 0), (5, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.classify(odd_documents, labels).count() == odd_documents.count()
    kept = quality.keep_good(odd_documents, labels)
    assert kept.columns == odd_documents.columns and kept.where("text IS NULL OR trim(text) = ''").count() == 0
    none = quality.classify(odd_documents, labels.limit(0))
    assert none.where("n_words > 0 AND NOT kept").count() == 0
    assert quality.classify(odd_documents.limit(0), labels).count() == 0


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op5_toxicity"](spark, folder).join(queries.table(spark, folder, "labels"), "doc_id").where("held_out").collect()
    toxic = [r.score for r in rows if r.toxic == 1]
    clean = [r.score for r in rows if r.toxic == 0]
    wins = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert len(toxic) > 3 and wins > 0.8


def test_toxicity_on_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(12)], "doc_id long, quality int, toxic int")
    found = toxicity.score_toxicity(odd_documents, labels).collect()
    assert len(found) == odd_documents.count() and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in toxicity.score_toxicity(odd_documents, labels.limit(0)).collect()} == {0.5}
    assert toxicity.score_toxicity(odd_documents.limit(0), labels).count() == 0


def test_network_learns_and_scores_odd_rows(spark, odd_documents):
    docs = queries.table(spark, FOLDER, "documents")
    total = lambda epochs: lm_scoring.pseudo_likelihood(docs, share=2, epochs=epochs).agg(F.sum("log_probability") / F.sum("n_words")).first()[0]
    assert total(2) > total(0) + 0.02
    found = lm_scoring.pseudo_likelihood(odd_documents, share=1, epochs=1).collect()
    assert len(found) == odd_documents.count() and all(np.isfinite(r.log_probability) for r in found)
    assert all(r.log_probability == 0 for r in found if r.n_words == 0)
    assert lm_scoring.pseudo_likelihood(odd_documents.limit(0)).count() == 0


def test_network_scores_words_and_not_their_shapes(spark):
    """Before training a word's probability is its share of the corpus; random strings are not likely."""
    random = np.random.default_rng(11)
    own = [f"w{k}" for k in range(lm_scoring.KNOWN)]
    rare = [f"rare{k}" for k in range(300)]
    texts = [" ".join(own), " ".join(own[::-1]), " ".join(rare), " ".join(rare[:100] + rare[:50]), rare[7] + " " + rare[7]]
    counts = {}
    for t in texts:
        for w in t.split():
            counts[w] = counts.get(w, 0) + 1
    counts[rare[7]] -= 1  # a repetition of the word before
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3])]
    for w in texts[3].split():
        counts[w] += 1
    total = sum(counts.values()) + 1 + 0.5 * lm_scoring.CLASSES * lm_scoring.MEMBERS
    # All words but the 764 most frequent ones have one shape and length, of which they are a share.
    top = dict(sorted(counts.items(), key=lambda c: -c[1])[: lm_scoring.KNOWN])
    found = lm_scoring.pseudo_likelihood(spark.createDataFrame(rows, "doc_id long, text string"), share=10**9, epochs=0).collect()
    assert sorted(top.values())[0] == 2 and sum(c == 2 for c in counts.values()) > sum(c == 2 for c in top.values())
    likely = {r.doc_id: r.log_probability / r.n_words for r in found}
    assert likely[2] < np.log(4 / total) and all(np.isfinite(list(likely.values())))
    assert found[3].log_probability == found[5].log_probability or len({r.log_probability for r in found if r.doc_id == 3}) == 1

    docs = queries.table(spark, FOLDER, "documents").select("doc_id", "text")
    noise = [(-k, " ".join("".join(chr(c) for c in random.integers(97, 123, random.integers(4, 9))) for _ in range(200))) for k in range(1, 21)]
    rows = lm_scoring.pseudo_likelihood(docs.unionAll(spark.createDataFrame(noise, docs.schema)), epochs=1).where("n_words >= 20").collect()
    real = [r.log_probability / r.n_words for r in rows if r.doc_id > 0]
    assert max(r.log_probability / r.n_words for r in rows if r.doc_id < 0) < np.quantile(real, 0.05)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    """A near copy goes alone: rows that share its id or its lack of one stay."""
    random = np.random.default_rng(8)
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in random.integers(0, 10**6, 60)) for x in "abcde")
    rows = [
        (3, a), (None, a + " end"), (None, b), (None, c), (None, c + " end"), (7, a + " last"), (7, d), (8, e), (8, e), (9, e + " x"),
        (8, e + " y"), (None, None), (10, ""), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.ngram_jaccard_join(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(kept) == len(set(kept))
    fixed = {(3, a), (None, b), (7, d), (None, None), (10, "")}
    assert fixed <= set(kept) and len(kept) == len(fixed) + 2
    assert len({(None, c), (None, c + " end")} & set(kept)) == 1 and len({(8, e), (8, e + " y")} & set(kept)) == 1


def test_short_benchmark_items_are_found_whole(spark, tmp_path):
    items = [(1, "what is the boiling point"), (2, "it melts"), (3, "one two three four five six seven eight nine ten eleven")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = ["He asked: What is the boiling point of tin?", "what is the melting point", "then it melts away", "it never melts", "two three four five six seven eight nine ten eleven", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()) == [1, 3, 5]


def test_pipeline_stages(spark):
    """Each stage on its own input: columns stay, decisions take effect, clean documents stay."""
    docs = queries.table(spark, FOLDER, "documents").cache()
    sizes = [docs.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER).cache()
        sizes.append(out.count())
        if number < 4:
            assert out.columns == docs.columns
            assert out.join(docs, "doc_id", "left_anti").count() == 0
            docs = out
    assert sizes[0] > sizes[1] >= sizes[2] > sizes[3] >= sizes[4] == sizes[5] > 0.5 * sizes[0]
    left = jaccard_join.near_duplicate_components(docs)
    assert left.where("doc_id <> component_id").count() == 0
    assert out.count() == queries.QUERIES["pipeline"](spark, FOLDER).count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in out.collect())
