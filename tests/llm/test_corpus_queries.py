"""The registered queries of the corpus operators, and the pipeline."""

import re
from collections import Counter

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from riskloom.llm import neardup, packing, queries
from tests.compare import difference, duck, rows
from tests.llm.fixtures import awkward_rows, prose


def test_the_operators_and_the_pipeline_are_registered():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(registry.queries()) >= {*queries.QUERIES, "pipeline"}
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_corpus_query_matches_sql(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    cursor = duck(sf_dir).execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    problem = difference(name, rows(df.columns, [tuple(r) for r in df.collect()]),
                         rows(columns, cursor.fetchall()))
    assert problem is None, problem


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark, found):
    return spark.createDataFrame(
        [(d, t, "en", "s", None if t is None else len(t)) for d, t in found],
        "doc_id long, text string, lang string, source string, n_chars int")


@pytest.fixture(scope="module")
def small_corpus(spark, tmp_path_factory):
    """Toxic, copied, leaked and personal documents among clean and awkward ones."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    item = prose(900, 25)
    base = prose(901, 60)
    near = base + " tail"
    found = awkward_rows() + [
        (500, base), (501, near), (502, prose(902, 20) + " " + item), (503, prose(903, 30)),
        (504, "write to someone@example.com " + prose(904, 20))]
    found += [(600 + i, prose(1000 + i, 40) + " idiot") for i in range(40)]
    found += [(700 + i, prose(2000 + i, 40)) for i in range(120)]
    labels = [(i, int(600 <= i < 640)) for i, _ in found if i is not None and i >= 600]
    documents(spark, found).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder, found, item


def test_pipeline_matches_brute_force(spark, small_corpus):
    folder, found, item = small_corpus
    got = corpus_pipeline.run(spark, folder).collect()
    # What each stage must leave, by simple means.
    kept = [(d, t) for d, t in found if "idiot" not in (t or "")]
    sets = {}
    for d, t in kept:
        sets.setdefault(d, []).append(neardup._shingle_set(t or ""))
    parent = {d: d for d in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(parent)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(neardup.similar(s, t, 80) for s in sets[a] for t in sets[b]):
                one, two = find(a), find(b)
                parent[max(one, two)] = min(one, two)
    kept = [(d, t) for d, t in kept if d is None or find(d) == d]
    kept = [(d, t) for d, t in kept if item not in (t or "") or d is None]
    want = Counter()
    encode = packing.encoder()
    for d, t in kept:
        text = (t or "").replace("someone@example.com", "[EMAIL]")
        for k, (start, length) in enumerate(packing.cut_points(len(encode.encode([text])[0]))):
            want[(d, k, start, length)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == want


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns_and_take_empty_tables(spark, small_corpus, name, stage):
    folder, _, _ = small_corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    got = stage(spark, docs, folder)
    assert got.columns == COLUMNS and got.count() == 0


def test_stages_come_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
