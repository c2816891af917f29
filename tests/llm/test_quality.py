import re
from collections import Counter

import pytest
from cases import ODD, documents, words
from tallyloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """The columns of the schema after doc_id."""
    text = text or ""
    ws = WORD.findall(text)
    seen, n_lines, line_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                n_lines, line_chars = n_lines + 1, line_chars + len("".join(WORD.findall(line)))
            seen.add(line)
    out = []
    for n in (3, *quality.NGRAMS):
        grams = [tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)]
        often, before, covered = Counter(grams), set(), [False] * len(ws)
        for i, g in enumerate(grams):
            if often[g] > 1 if n == 3 else g in before:
                covered[i:i + n] = [True] * n
            before.add(g)
        out.append(sum(covered) if n == 3 else sum(len(w) for w, c in zip(ws, covered) if c))
    return [len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), n_lines, out[0], line_chars, *out[1:]]


def verdict(m):
    failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
    shares = [m[5] > quality.MAX_DUP_LINES * max(m[1], 1)] + [c > most * max(m[1], 1) for c, most in zip(m[6:], quality.NGRAMS.values())]
    return failed, not failed and not any(shares)


def rows_of(df):
    return sorted(([-1 if r[0] is None else r[0], *list(r)[1:]] for r in df.collect()))


def want(rows):
    return sorted([-1 if i is None else i, *(m := brute(t)), *verdict(m)] for i, t in rows)


def test_odd_rows_and_clashing_names(spark):
    assert rows_of(quality.judge(documents(spark, ODD, clash=True))) == want(ODD)
    assert quality.judge(documents(spark, [])).count() == 0


def test_repeats(spark):
    line = words(9, 5)
    rows = [(1, words(300, 1)), (2, "\n".join([line] * 20)), (3, words(60, 3) + "\n" + line + "\n" + line), (4, "a b c a b c a b c " + words(80, 4)),
            (5, "\n".join(f"{words(30, i)}\n{line}\r" for i in range(6))), (6, "# $ % " + words(50, 6) + " é|<é>&*")]
    got = rows_of(quality.judge(documents(spark, rows)))
    assert got == want(rows)
    assert not [r for r in got if r[0] == 2][0][-1]


@pytest.mark.parametrize("most", [300, 2_000_000])
def test_given_documents(spark, monkeypatch, most):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = [(t or "").encode() for _, t in rows]
    from tallyloom.llm import wordbytes
    got = [list(map(int, x)) for low, high in wordbytes.slices(texts, most) for x in zip(*quality.measures(texts[low:high]))]
    assert got == [brute(t) for _, t in rows]
