"""What the operators move and keep, beside right results."""

import pytest

from marketlens.llm import jaccard_join, quality
from marketlens.llm.scratch import Scratch


@pytest.fixture
def kept(monkeypatch):
    """Tables between steps, in order: their rows, those that were there when each was written, whether it went."""
    tables, keep, drop = [], Scratch.keep, Scratch.drop

    def noted(self, df, name, *partitions, **settings):
        there = {t["name"] for t in tables if not t["dropped"]}
        out = keep(self, df, name, *partitions, **settings)
        tables.append({"name": name, "rows": out.collect(), "there": there, "dropped": False})
        return out

    def gone(self, *names):
        for table in tables:
            table["dropped"] |= table["name"] in names
        drop(self, *names)

    monkeypatch.setattr(Scratch, "keep", noted)
    monkeypatch.setattr(Scratch, "drop", gone)
    return tables


def test_shingles_of_one_class_are_not_kept(spark, kept):
    alone = [f"n{k}x{i}" for k in range(3) for i in range(200)]
    rows = [(k, " ".join(alone[200 * k : 200 * k + 200])) for k in range(3)]
    near = [f"p{i}" for i in range(200)]
    rows += [(10, " ".join(near)), (11, " ".join([*near, "more"])), (12, " ".join(near))]
    found = jaccard_join.near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in found} == {0: 0, 1: 1, 2: 2, 10: 10, 11: 10, 12: 10}
    lists = [(t["name"], len(v)) for t in kept if not t["dropped"] for r in t["rows"] for v in r if isinstance(v, list)]
    # A prefix has thirty shingles; those of the three documents that share none are gone.
    assert {name for name, _ in lists} >= {"files"} and not {"rows", "distinct", "prefixes"} & {name for name, _ in lists}
    files = next(t for t in kept if t["name"] == "files")["rows"]
    assert len(files) == 2
    assert len(next(t for t in kept if t["name"] == "texts")["rows"]) <= 3


def test_training_texts_are_gone_when_the_tables_are_made(spark, kept):
    docs = spark.createDataFrame([(k, f"some plain words of text {k % 7} and {k % 5} more", "en") for k in range(60)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1) for k in range(60)], "doc_id long, quality int")
    found = quality.classify(docs, labels).collect()
    assert len(found) == 60 and all(r.n_words == 9 and r.perplexity > 0 for r in found)
    there = next(t for t in kept if t["name"] == "tables")["there"]
    assert {"trigrams", "bigrams"} <= there and not {"training", "rare"} & there


def test_query_with_many_candidates_is_searched_in_shares(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 1)
    words = [f"w{i}" for i in range(200)]
    docs = spark.createDataFrame([(k, " ".join([*words, *[f"x{k}"] * (k > 0)])) for k in range(12)], "doc_id long, text string")
    rank = spark.sparkContext.broadcast(jaccard_join._frequency(docs, 4))
    made = docs.withColumn("mark", docs["doc_id"]).mapInArrow(
        jaccard_join._prefixes(4, 85, rank), "doc_id long, mark long, n_shingles long, class long, prefix array<long>"
    )
    classes = {r.doc_id: r["class"] for r in made.select("doc_id", "class").collect()}
    pairs = spark.createDataFrame([(classes[0], classes[k]) for k in range(1, 12)] + [(classes[1], classes[2])], "a long, b long")
    texts = jaccard_join._texts(docs, made.select("class"), 4)
    found = jaccard_join._linked(pairs, texts, 4, 85).collect()
    # Three shares for the first query, one for the second.
    assert sorted((r.a, r.b) for r in found) == sorted((r.a, r.b) for r in pairs.collect())
