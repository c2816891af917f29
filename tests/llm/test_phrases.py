import random
import re
from collections import Counter, defaultdict

import pytest
from cases import CLASHES, ODD, documents, words

from tallyloom.llm import phrases


def brute(rows, least=phrases.LEAST, top=phrases.TOP):
    f, total = defaultdict(Counter), Counter()
    for _, text, _, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for n in (1, 2, 3):
                f[lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, count in f.items():
        held = Counter()
        for g, n in count.items():
            if len(g) == 3 and n >= least:
                for part in (g[:2], g[1:]):
                    held[part] = max(held[part], n)
        found = []
        for g, a in count.items():
            if len(g) > 1 and a >= least and not (len(g) == 2 and 100 * held[g] >= phrases.WITHIN * a):
                score, _, l, r = min((1_000_000 * a * a // (count[g[:k]] * count[g[k:]]), k, count[g[:k]], count[g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def rows_of(seed, n, langs=("en", "de", None), vocabulary=12):
    r = random.Random(seed)
    known = [words(1, i) for i in range(vocabulary)] + ["Zug", "ÉTÉ", "x'y", "a-b"]
    fixed = [" ".join(r.choice(known) for _ in range(60)) for _ in range(3)]
    out = []
    for i in range(n):
        parts = [r.choice(fixed) if r.random() < 0.3 else " ".join(r.choice(known) for _ in range(r.randrange(12))) for _ in range(r.randrange(4))]
        out.append((i, "".join(p + r.choice([". ", ", ", "\n", " \t ", "!?", ": "]) for p in parts), "a", r.choice(langs)))
    return out


def check(spark, rows, **kw):
    # The helper takes no null language, so it is put in afterwards.
    df = spark.createDataFrame([(i, t, lang, "a", 0) for i, t, _, lang in rows], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    for c in CLASHES + ["lang_", "root", "n", "phrase"]:
        df = df.selectExpr("*", f"'x' AS `{c}`") if c not in df.columns else df
    got = phrases.mine(df.repartition(3), **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, **kw)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, rows_of(seed, 400))


def test_odd_rows_and_least_of_two(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 300)
    monkeypatch.setattr(phrases, "WORDS", 7)
    rows = [(i, t, "a", "en") for i, t in ODD] + [(90, "Ha ha ha ha ha. ha ha", "a", "und"), (91, "ha ha", "a", None), (92, " ,; ..", "a", "xx"), (93, "one\ttwo  three", "a", "xx")] * 3
    check(spark, rows, least=2)


def test_frequent_words_and_pairs_are_spread(spark, monkeypatch):
    rows = [(i, "of the w%d of the. of the end" % (i % 90), "a", "en") for i in range(600)] + rows_of(3, 100)
    known = {}
    real = phrases.frequent
    monkeypatch.setattr(phrases, "frequent", lambda *a: known.setdefault("hot", real(*a)))
    check(spark, rows)
    assert "of" in known["hot"][0] and "of the" in known["hot"][1] and "w1" not in known["hot"][0]


def test_long_runs_and_cycles(spark):
    long = " ".join(f"u{i}" for i in range(500))
    ring = " ".join(f"r{i % 3}" for i in range(200))
    check(spark, [(i, f"{long}. {ring}, {ring}", "a", "en") for i in range(12)])


def test_top_is_cut_by_score_count_and_bytes(spark):
    check(spark, rows_of(7, 500, vocabulary=25), top=15)


def test_exact_products(spark):
    """Counts far beyond what a text here can hold: the score alone."""
    from pyspark.sql import functions as F

    cases = [(10**15, 10**15, 10**15), (999_999_999_999_999, 10**15, 10**15), (3_037_000_500, 3_037_000_500, 3_037_000_501), (7 * 10**14, 9 * 10**14, 8 * 10**14 + 1)]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    got = df.select("a", "l", "r", phrases.score(F.col("a"), F.col("l"), F.col("r")).alias("score")).collect()
    assert [r.score for r in got] == [10**6 * r.a * r.a // (r.l * r.r) for r in got]


def test_no_rows(spark):
    assert phrases.mine(documents(spark, [])).count() == 0
    assert phrases.mine(documents(spark, [(1, None), (2, "")])).count() == 0
