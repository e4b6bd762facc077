"""The corpus pipeline over a small corpus: stages in order, columns, decisions against brute force, empty tables."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_operators import KIND, WORDS, bag_of, jaccard5, sentence, union, word_stats

import corpus_pipeline as P
from gridpulse.llm import mixing, piece_nbest, quality_rules


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(17)
    rows = []
    for i in range(80):
        text = "\n".join(sentence(rng, rng.randint(15, 40)) for _ in range(4))
        if i % 10 == 3:
            text = sentence(rng, 70) + " ###" * 60
        if i % 10 == 7 and i > 10:
            text = rows[i - 5][1].replace(" ", "  ", 1)
        if i % 9 == 5:
            text += "\nThis very line stands in many of the documents of this corpus."
        rows.append((i, text, "en", f"s{i % 4}" if i % 6 else None, len(text), "n", "k"))
    rows += [(80, None, None, None, None, None, None), (81, "", "en", "s1", 0, "n", "k"), (82, "short", "en", "s1", 5, "n", "k")]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, KIND).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 10 != 3), 0) for i in range(0, 80)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows


def test_stages(spark, folder):
    path, rows = folder
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "MinHash near-dedup", "mixing sources", "SentencePiece encoding"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, seen[-1], path)
        out.write.parquet(f"{path}/out-{k}")
        seen.append(spark.read.parquet(f"{path}/out-{k}"))
        assert k == 4 or seen[-1].columns == columns
    kept, cleaned, single, mixed, encoded = ({r["doc_id"]: r for r in x.collect()} for x in seen[1:])
    labels = spark.read.parquet(f"{path}/labels.parquet")
    judged = quality_rules.judge(docs, quality_rules.fit(docs, labels)).collect()
    assert set(kept) == {r["doc_id"] for r in judged if r["kept"]} and not any(word_stats(r["text"])[-1] for r in kept.values()) and len(kept) > 60
    # Lines: the first of each class of similar lines stays, of all that the stage got.
    lines = {(d, n): x for d, r in kept.items() for n, x in enumerate(r["text"].split("\n")) if x.strip()}
    classes = union(lines, [(a, b) for a in lines for b in lines if a < b and jaccard5(lines[a].strip(), lines[b].strip()) >= 0.8])
    want = {d: "\n".join(x for n, x in enumerate(r["text"].split("\n")) if classes.get((d, n), (d, n)) == (d, n)) for d, r in kept.items()}
    assert {d: r["text"] for d, r in cleaned.items()} == {d: t for d, t in want.items() if WORDS.search(t)}
    bags = {d: bag_of(r["text"]) for d, r in cleaned.items()}
    near = union(bags, [(a, b) for a in bags for b in bags if a < b and sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values())])
    assert set(single) == set(near.values())
    copies = {r["doc_id"]: r["__copies"] for r in mixing.copies(seen[3]).collect()}
    assert Counter(r["doc_id"] for r in seen[4].collect()) == Counter({d: c for d, c in copies.items() if c})
    assert Counter(r["doc_id"] for r in seen[5].collect()) == Counter(r["doc_id"] for r in seen[4].collect())
    held = piece_nbest.pieces()
    assert all(held.decode(r["pieces"][0]) == mixed[d]["text"] for d, r in encoded.items())
    again = P.run(spark, path)
    assert again.columns == seen[5].columns and Counter(r["doc_id"] for r in again.collect()) == Counter(r["doc_id"] for r in seen[5].collect())


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).where(F.lit(True)).count() == 0
