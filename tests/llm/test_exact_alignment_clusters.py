"""Exact duplicates, token alignment and centroid clusters against plain versions of their rules."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import centroids, digests, exact_dedup, queries, token_alignment

FOLDER = "/root/testdata/sf0.001"
A, B = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")


def rows_of(df, key):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in key(r)))


# -- exact duplicates --------------------------------------------------------------------------


def plain_exact(rows):
    """doc_id, keep_id, group_size and hash per row, and how many rows of each group are kept."""
    content = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for doc, text in rows:
        groups[content(text)].append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for doc, text in rows:
        own = groups[content(text)]
        out.append((doc, min(own)[3], len(own), hashlib.sha256(content(text).encode()).hexdigest()))
    return out, len(groups)


def check_exact(df, **options):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want, groups = plain_exact(rows)
    found = exact_dedup.exact_duplicates(df, **options)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = [tuple(r) for r in found.collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted([(d, k, n, h) for d, k, n, _, h in got], key=order) == sorted(want, key=order)
    kept = [r for r in got if r[3]]
    assert len(kept) == groups == len({r[4] for r in kept}) and all(r[0] == r[1] for r in kept)


def test_exact_odd_rows(spark, odd_documents):
    check_exact(odd_documents)
    check_exact(odd_documents.limit(0))


def test_exact_ties_and_white_space(spark):
    texts = ["a b", "ab", " a\tb\n", "a b", "ab", None, "", " \r\n", "AB", "\U0001f642 x", "\U0001f642x  "]
    rows = [(k if k != 4 else None, t, k, "x") for k, t in enumerate(texts)] + [(1, "ab", 0, "y")] * 3
    check_exact(spark.createDataFrame(rows, "doc_id long, text string, key int, content string"))


@pytest.mark.parametrize("weak", [lambda d: F.lit(b"same"), lambda d: F.substring(d, 1, 1).cast("binary")])
def test_exact_collisions_are_told_apart(spark, weak):
    """Keys that collide change nothing: bytes decide."""
    rows = [(k, f"text {k % 7} {'x' * (k % 3)}") for k in range(60)]
    check_exact(spark.createDataFrame(rows, "doc_id long, text string"), key=weak)


def test_exact_hot_group(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot text' ELSE concat('t', id % 700) END AS text")
    check_exact(rows.repartition(9))


# -- token alignment ---------------------------------------------------------------------------


def plain_alignment(texts):
    """Whole texts through both libraries, byte by byte."""
    aligner = token_alignment.Aligner(A, B)
    documents, held = [], Counter()
    for text in texts:
        want = f" {text or ''}".encode()
        ids_a = aligner.a.encode(f" {text}", add_special_tokens=False).ids if text else []
        ids_b = aligner.b.encode(text) if text else []
        if not text or b"".join(aligner.a_bytes[k] for k in ids_a) != want or b"".join(aligner.b_bytes[k] for k in ids_b) != want:
            documents.append(None)
            continue
        owner_a = [k for k, i in enumerate(ids_a) for _ in aligner.a_bytes[i]]
        owner_b = [k for k, i in enumerate(ids_b) for _ in aligner.b_bytes[i]]
        links = sorted(set(zip(owner_a, owner_b)))
        groups, begin = [], 0
        for at in range(1, len(want) + 1):
            if at == len(want) or owner_a[at] != owner_a[at - 1] and owner_b[at] != owner_b[at - 1]:
                names = ([str(ids[k]) for k in sorted(set(owner[begin:at]))] for ids, owner in ((ids_a, owner_a), (ids_b, owner_b)))
                groups.append("|".join(map(",".join, names)))
                begin = at
        pairs = [(ids_a[x], ids_b[y]) for x, y in links]
        held.update(set(pairs))
        documents.append((len(ids_a), len(ids_b), groups, pairs))
    highest = defaultdict(int)
    for (a, _), n in held.items():
        highest[a] = max(highest[a], n)
    out = []
    for found in documents:
        if found is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, pairs = found
            out.append((n_a, n_b, len(groups), len(pairs), sum(held[p] == highest[p[0]] for p in pairs), sum(held[p] for p in pairs), ";".join(groups)))
    return out, {(a, b, n, n == highest[a]) for (a, b), n in held.items()}


ODD_TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n  b", "\n\n", "\t x", "x  y", "x 　y", "▁", "a ▁b c", "a▁ b",
    "<s> hello </s> <unk> <|endoftext|> <0x0A>", "héllo ☃ 🙂x 🙂🙂 𝒳𝒴 漢字かな交じり文 ", "naïve café́ x\u0000y z﻿", "don't I'll we've  it's",
    "١٢٣ 123456 1e10 a1b2", "🏳️‍🌈 👩‍👩‍👧 ȩ́ ​ ‍", "x" * 3000, "word " * 2000, "a\r\nb\x0bc\x0cd \x1c e \x85 f", "😀" * 50, " lead", "tail\n ", " \U000f0000 ؀",
]


def check_alignment(df, **options):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want, pairs = plain_alignment([t for _, t in rows])
    found, table = token_alignment.align_tokens(df, A, B, **options)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([tuple(r) for r in found.collect()], key=key) == sorted([(d, *w) for (d, _), w in zip(rows, want)], key=key)
    assert {tuple(r) for r in table.collect()} == pairs


def test_alignment_odd_texts(spark):
    rows = [(k if k != 7 else None, t, "x", k) for k, t in enumerate(ODD_TEXTS)] + [(3, "a  b", "x", 1)] * 3
    check_alignment(spark.createDataFrame(rows, "doc_id long, text string, block string, codes int").repartition(3))


def test_alignment_odd_rows(spark, odd_documents):
    check_alignment(odd_documents)
    check_alignment(odd_documents.limit(0))


def test_alignment_of_documents_in_small_blocks(spark, monkeypatch):
    """Blocks of a few documents and a small memory of chunks give the same rows."""
    monkeypatch.setattr(token_alignment, "REMEMBERED", 500)
    docs = queries.table(spark, FOLDER, "documents")
    check_alignment(docs.select("doc_id", "text"), block_bytes=20_000)
    digest = {r["doc_id"]: r["groups_sha256"] for r in queries.QUERIES["op12_token_alignment"](spark, FOLDER).collect()}
    for doc, text in [(r["doc_id"], r["text"]) for r in docs.collect()]:
        [(*_, groups)] = plain_alignment([text])[0]
        assert digest[doc] == digests.sha256(groups)


def test_forgotten_chunks_keep_the_others():
    align = token_alignment.Aligner(A, B)
    for chunk in ["one", "two", "naïve☃", "▁", "four\nfive"]:
        align.index[chunk]
    align.settle()
    before = {n: (align.known.numbers[k].tolist(), align.known.groups[k]) for n, k in align.index.items()}
    kept = align.known.taken(np.array([3, 1, 2]))
    assert {n: (kept.numbers[k].tolist(), kept.groups[k]) for k, n in enumerate(kept.names)} == {n: before[n] for n in kept.names}
    assert len(kept.codes) == kept.numbers[:, 3].sum()


def test_refined_ends_inside_characters():
    """A character in three tokens: only the last has a coarse end that holds."""
    begin, end = np.array([0, 1, 1, 1, 4]), np.array([1, 4, 4, 4, 6])
    got = token_alignment.refined(begin, end, np.array([1, 1, 1, 1, 2]), np.zeros(5, bool))
    assert got.tolist() == [1, 2, 3, 4, 6]


# -- centroids ---------------------------------------------------------------------------------


def plain_clusters(vectors, k, rounds, seed):
    order = sorted(range(len(vectors)), key=lambda r: (hashlib.sha256(f"{seed}:{vectors[r][0]}".encode()).hexdigest(), vectors[r][1]))
    own = [list(vectors[r][1]) for r in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(own))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in vectors:
            members[nearest(v)[1]].append(v)
        for n, inside in members.items():
            own[n] = [sum(column) // len(inside) for column in zip(*inside)]
    return [(i, *reversed(nearest(v))) for i, v in vectors], own


def test_clusters_against_plain_rounds(spark):
    rng = np.random.Generator(np.random.PCG64(5))
    rows = [(k, [float(x) for x in rng.normal(0, 1, 4) + 3 * (k % 3)], "x") for k in range(150)]
    rows += [(7, rows[7][1], "y"), (200, None, "x"), (201, [1.0, 2.0], "x"), (202, [1.0, None, 1.0, 1.0], "x"), (203, [float("nan"), 0.0, 0.0, 0.0], "x")]
    rows += [(204, [float("inf"), 0.0, 0.0, 0.0], "x"), (205, [1e300, 0.0, 0.0, 0.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string").repartition(4)
    vectors = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows[:151]]
    want, own = plain_clusters(vectors, 6, 5, 2)
    found, final = centroids.cluster_vectors(df, k=6, dimensions=4, block_rows=16)
    got = found.collect()
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == sorted(want)
    assert final.tolist() == own
    sums = Counter()
    for _, cluster, distance in want:
        sums[cluster] += distance
    assert all(r["cluster_inertia"] == sums[r["cluster"]] and r["inertia"] == sum(sums.values()) for r in got)


def test_clusters_wide_values_stay_exact(spark):
    """Sums beyond 32 bits, equal vectors, and centroids that lose all their vectors."""
    rows = [(k, [float(v), -float(v)]) for k, v in enumerate([1e5, 1e5, 1e5, -1e5, 0.1, 5e5, 5e5 - 1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    want, own = plain_clusters(vectors, 5, 3, 2)
    found, final = centroids.cluster_vectors(df, k=5, rounds=3, dimensions=2)
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in found.collect()) == sorted(want) and final.tolist() == own


def test_clusters_without_or_with_few_vectors(spark):
    df = spark.createDataFrame([(None, [0.5, 0.5]), (1, [0.25, 0.0])], "vec_id long, embedding array<float>")
    found = centroids.clusters_with_digests(df, dimensions=2)
    assert {(r["vec_id"], r["distance"]) for r in found.collect()} == {(None, 0), (1, 0)}
    for empty in (df.limit(0), df.where("vec_id = 9")):
        found = centroids.clusters_with_digests(empty, dimensions=2)
        assert found.collect() == [] and "centroid_sha256" in found.columns
