import pytest
from cases import ODD, documents, words

import corpus_pipeline
from tallyloom.llm import mixing, secrets

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
KEEP = ["language", "near_duplicates", "secrets", "mix"]


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", KEEP)
def test_stage_keeps_columns(spark, name):
    df = documents(spark, ODD, clash=True)
    assert STAGES[name](spark, df, FOLDER).columns == df.columns
    empty = STAGES[name](spark, documents(spark, []), FOLDER)
    assert empty.columns == documents(spark, []).columns and empty.count() == 0


def test_language_drops_what_it_rejects(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = documents(spark, [(9001, None), (9002, "12 34 !"), (9003, "いろはにほへとちりぬるを" * 20)])
    kept = {r.doc_id for r in STAGES["language"](spark, given.union(odd), FOLDER).collect()}
    assert not kept & {9001, 9002, 9003}
    assert len({r.doc_id for r in given.collect()} - kept) <= 2


def test_one_of_each_group_stays(spark):
    base = words(150, 1)
    rows = [(5, base), (3, base), (9, base + " end"), (3, base), (7, words(150, 2)), (8, ""), (8, ""), (1, None), (None, base), (None, words(80, 9)), (4, "")]
    got = sorted(repr(r.doc_id) for r in STAGES["near_duplicates"](spark, documents(spark, rows), FOLDER).collect())
    assert got == sorted(map(repr, [3, 7, 8, 1, None, 4]))


def test_secrets_are_hidden_and_nothing_else(spark):
    rows = [(1, "calm words"), (2, 'x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y'), (3, None), (4, "")]
    df = documents(spark, rows)
    got = {r.doc_id: r for r in STAGES["secrets"](spark, df, FOLDER).collect()}
    assert got[2].text == 'x [SECRET]" y' and got[2].n_chars == len(got[2].text)
    assert [tuple(got[i]) for i in (1, 3, 4)] == [tuple(r) for r in df.where("doc_id != 2").orderBy("doc_id").collect()]
    again = secrets.find_secrets(spark.createDataFrame([tuple(got[i]) for i in got], df.schema))
    assert all(not r.spans for r in again.collect())


def test_mix_gives_what_it_takes(spark):
    rows = [(i, words(5 + i % 40, i), f"s{i % 5}") for i in range(200)] + [(500, "", "s1"), (501, None, None), (502, "one two", None)]
    df = documents(spark, rows)
    want = {r.doc_id: (r.size, r.taken) for r in mixing.mix(df).collect()}
    texts, out = {i: t for i, t, *_ in rows}, {}
    for r in STAGES["mix"](spark, df, FOLDER).collect():
        out.setdefault(r.doc_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    for i, (size, taken) in want.items():
        given = out.get(i, [])
        assert sum(len(t.split()) for t in given) == taken
        assert all(t == texts[i] for t in given if len(t.split()) == size) and all(texts[i].startswith(t) for t in given)


def test_equal_rows_are_mixed_once(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, "d e", "s")]
    got = STAGES["mix"](spark, documents(spark, rows), FOLDER).collect()
    assert sum(len(r.text.split()) for r in got) == 12  # 1.5 times 8


def test_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    filled = [r[0] for r in got.groupBy("sequence_id").sum("length").select("sum(length)").collect()]
    assert max(filled) == 1024 and sum(filled) > 50_000
    kept = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert got.join(kept, "doc_id", "left_anti").isEmpty()
