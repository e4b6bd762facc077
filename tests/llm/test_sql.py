"""Columns of the operators that SQL can express, over whole tables, against DuckDB."""

import pytest

duckdb = pytest.importorskip("duckdb")
from gridpulse.llm import queries  # noqa: E402

DATA = "/root/testdata/sf0.001"

#: crc32 by a table of 256, folded over the bytes of the decimal id.
CRC = """
tab AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS crc FROM documents, tab)
"""
BASE = f"""
WITH {CRC},
tok AS (SELECT doc_id, unnest(list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), NULL)) AS w FROM documents),
trn AS (SELECT coalesce(w, chr(1) || 'end') AS w, count(*) AS c FROM tok JOIN crc USING (doc_id) WHERE crc % 10 <> 0 GROUP BY 1),
tot AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM trn)
SELECT doc_id, any_value(crc % 10 = 0) AS held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, sum(log10((coalesce(c, 0) + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1)))) AS base_score
FROM tok JOIN crc USING (doc_id) LEFT JOIN trn ON trn.w = coalesce(tok.w, chr(1) || 'end'), tot GROUP BY doc_id
"""
COUNTS = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
ln AS (SELECT doc_id, line, count(*) AS k FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1, 2),
dup AS (SELECT doc_id, sum(k - 1)::BIGINT AS n_dup_lines FROM ln GROUP BY 1),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed
FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id)
"""
SIZES = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents)
SELECT doc_id, size, (sum(size) OVER (PARTITION BY source))::BIGINT AS source_size FROM d
"""


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def by_id(rows, names):
    return {r[0]: dict(zip(names[1:], r[1:])) for r in rows}


def test_base_columns_of_op1(spark, duck):
    want = duck.sql(BASE)
    want = by_id(want.fetchall(), want.columns)
    got = {r["doc_id"]: {k: r[k] for k in ("held_out", "n_tokens", "n_known", "train_tokens", "base_score")} for r in queries.op1_lm_scoring(spark, DATA).collect()}
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert got[i] == w | {"base_score": pytest.approx(w["base_score"], rel=1e-9)}
    assert any(w["held_out"] for w in want.values())


def test_counts_of_op7(spark, duck):
    want = duck.sql(COUNTS)
    want = by_id(want.fetchall(), want.columns)
    got = {r["doc_id"]: {k: r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")} for r in queries.op7_quality_rules(spark, DATA).collect()}
    assert got == want and any(w["n_repeat_words"] for w in want.values())


def test_sizes_and_targets_of_op8(spark, duck):
    """Sizes by SQL; targets by sharing out by weight, with sources at three times their size taken out, until none is above."""
    want = duck.sql(SIZES)
    want = by_id(want.fetchall(), want.columns)
    got = queries.op8_mixing(spark, DATA).collect()
    assert {r["doc_id"]: {"size": r["size"], "source_size": r["source_size"]} for r in got} == want
    sizes = dict(duck.sql("SELECT source, sum(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))) FROM documents GROUP BY 1").fetchall())
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        open_ = [s for s in order if s not in fixed]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            break
        fixed |= {s: 3 * sizes[s] for s in above}
    target = fixed | share
    source = dict(duck.sql("SELECT doc_id, source FROM documents").fetchall())
    assert all(r["target"] == pytest.approx(target[source[r["doc_id"]]]) for r in got)
    taken = {s: sum(r["taken"] for r in got if source[r["doc_id"]] == s) for s in order}
    assert all(r["taken"] <= 3 * r["size"] for r in got) and sum(taken.values()) == pytest.approx(total, rel=0.25)
