"""Small tables with everything that may be odd about rows."""

from __future__ import annotations

import random

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# Names that operators use for their own columns.
CLASHES = ["row", "size", "start", "part", "position", "key", "cls", "band", "base", "kept", "component_id", "text_hash", "spans", "taken", "score", "list", "i", "j"]


def documents(spark, rows, clash=False):
    """rows: (doc_id, text[, source[, lang]])."""
    rows = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a", len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(rows, DOCS)
    for c in CLASHES if clash else []:
        df = df.selectExpr("*", f"'x' AS `{c}`")
    return df


def words(n, seed, alphabet=("lorem", "ipsum", "dolor", "sit", "amet", "tempor", "magna", "aliqua", "quis", "nostrud")):
    r = random.Random(seed)
    return " ".join(r.choice(alphabet) + r.choice(["", "a", "o", "um", "is"]) for _ in range(n))


ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (4, "word"), (None, "no id here"), (None, None),
    (5, "Ünïcödé 𝒳 words — ok"), (6, words(30_000, 1)), (7, words(200, 2)), (8, words(200, 2)), (9, "x" * 5000),
]

