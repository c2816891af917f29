"""Phrases whose words come together often, from a weighted de Bruijn graph.

A node is two neighbouring words, an edge three words in a row, its weight how often they occur; the last two words of a
piece and the last one end in edges to empty words. So every word of the text is the start of one edge, and counting edges is the
only counting. What is shorter follows from flow: a pair occurs as often as edges leave its node, a word as often as its
pairs occur, edges into empty words (the ends of pieces) included.

Only nodes and edges of the least count can be candidates. Where a node of these has one edge in and one out, the two are
joined: unary paths become single rows that hold their words, the weights of their edges and the flow of their nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.wordbytes import binary, slices
from tallyloom.operators.joins import sent_if_few
from tallyloom.session import materialize

LEAST, WITHIN, TOP = 10, 50, 2000
SCALE = 1_000_000
# Bytes of text, and words of it, whose edges are counted together before they leave a task. Numbers of distinct words fit into 21 bits.
HELD, WORDS, BITS = 8_000_000, 1_000_000, 21
# Documents in which frequent words and pairs are looked for; they only decide how edges are dealt to tasks.
SAMPLE = 5_000
# One node in so many stays a branch, so that paths stay short; pointers along them double so many times. What finds no branch in that
# many steps (2**ROUNDS) remains a path of one edge.
BRANCH, ROUNDS = 8, 5

_END, _BLANK = [ord(c) for c in ".,;:!?\n\x0b\x0c\r"], [ord(" "), ord("\t")]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def counted(texts: list[bytes]) -> Iterator[tuple[pa.Array, pa.Array, pa.Array, np.ndarray]]:
    """The distinct edges of some texts, as three arrays of words, and how often each occurs; a stretch of words at a time."""
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    end = np.isin(data, _END)
    apart = end | np.isin(data, _BLANK)
    turn = np.diff(apart.view(np.int8), prepend=np.int8(1))
    start = np.flatnonzero(turn == -1)
    length = np.flatnonzero(turn == 1) - start
    piece = np.cumsum(end)[start]
    letters, offset = data[~apart], np.concatenate([[0], np.cumsum(length)])
    for low in range(0, len(start), WORDS):
        high = min(low + WORDS, len(start))
        last = min(high + 2, len(start))
        ends = offset[low:last + 1] - offset[low]
        words = pa.LargeStringArray.from_buffers(last - low, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(letters[offset[low]:offset[last]]))).dictionary_encode()
        ids = np.append(words.indices.to_numpy().astype(np.int64) + 1, [0, 0])  # 0 is the empty word
        of = np.append(piece[low:last], [-1, -1])
        n = high - low
        second = np.where(of[1:n + 1] == of[:n], ids[1:n + 1], 0)
        third = np.where(of[2:n + 2] == of[:n], ids[2:n + 2], 0)
        keys, counts = np.unique((ids[:n] << 2 * BITS) | (second << BITS) | third, return_counts=True)
        known = pa.concat_arrays([pa.array([""], pa.large_string()), words.dictionary])
        mask = (1 << BITS) - 1
        yield *(known.take(pa.array(keys >> shift & mask)) for shift in (2 * BITS, BITS, 0)), counts


def stretches(texts: list[bytes], most: int = HELD) -> Iterator[list[bytes]]:
    """The texts in groups of up to ``most`` bytes. A longer one is cut at ends of pieces, where no edge crosses."""
    for low, high in slices(texts, most):
        text, at = texts[low], 0
        while high - low == 1 and len(text) - at > most:
            inside = max(text.rfind(bytes([c]), at, at + most) for c in _END)
            beyond = inside if inside > at else min((x for c in _END if (x := text.find(bytes([c]), at + most)) >= 0), default=len(text))
            yield [text[at:beyond]]
            at = beyond
        yield [text[at:]] if at else texts[low:high]


def edges(docs: DataFrame, hot: tuple[list[str], list[str]] = ([], []), lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, root, rest, n): partial counts of edges, ``root`` and ``rest`` being the three words with blanks between. The root says
    where an edge is counted: its first word; its first two, if the word is one of the frequent ones in ``hot``; all three (rest: null), if the
    pair is frequent too. So what leaves a word or node meets in one place unless there is too much of it."""
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def graph(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (frequent, pairs), blank = (pa.array(h, pa.large_string()) for h in sent.value), pa.scalar(" ", pa.large_string())
        for batch in batches:
            langs = batch.column("lang")
            for lang in langs.unique().to_pylist():
                texts = binary(batch.column("text").filter(pc.equal(langs, lang)))
                for some in stretches(texts):
                    for first, second, third, n in counted(some):
                        spread = pc.is_in(first, frequent)
                        near = pc.binary_join_element_wise(first, second, blank)
                        wide = pc.and_(spread, pc.is_in(near, pairs))
                        root = pc.if_else(wide, pc.binary_join_element_wise(near, third, blank), pc.if_else(spread, near, first))
                        rest = pc.if_else(wide, pa.scalar(None, pa.large_string()), pc.if_else(spread, third, pc.binary_join_element_wise(second, third, blank)))
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), root.cast(pa.string()), rest.cast(pa.string()), pa.array(n, pa.int64())],
                                                         names=["lang", "root", "rest", "n"])

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInArrow(graph, "lang string, root string, rest string, n long")


def frequent(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], list[str]]:
    """Words and pairs that start more than a quarter of an average task's edges in a sample: fewer than four a task of each."""
    spark = docs.sparkSession
    share = 1 / (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = docs.count()
    sample = docs.sample(min(1.0, SAMPLE / n), seed=7) if n else docs
    found = materialize(edges(sample, lang_col=lang_col, text_col=text_col), "sample")
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = (F.col("root"), F.concat_ws(" ", "root", F.substring_index("rest", " ", 1)))
    return tuple([r.key for r in found.groupBy(p.alias("key")).agg(F.sum("n").alias("n")).where(F.col("n") > share * total).collect()] for p in parts)


def counts(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all words, pairs and triples that occur ``least`` times, and (lang, n) of all words.

    Edges are shuffled once, to their roots, and every count is summed up there; what is rare is dropped where its count is whole.
    Counts of frequent words and pairs are in several places and are summed up once more."""
    at = edges(docs, frequent(docs, lang_col, text_col), lang_col, text_col).repartition("lang", "root")
    depth, gram = F.size(F.split("root", " ", -1)), F.concat_ws(" ", "root", "rest")

    def sums(size: int) -> DataFrame:
        return at.groupBy("lang", "root", F.substring_index(gram, " ", size).alias("phrase")).agg(F.sum("n").alias("n"))

    parts = [sums(3).select("lang", "phrase", "n").where(F.col("n") >= least).withColumn("size", F.lit(3))]
    for size in (1, 2):
        some = sums(size).where((depth > size) | (F.col("n") >= least))
        parts.append(some.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least).withColumn("size", F.lit(size)))
    # All parts read the one shuffle, so none may prune or filter what goes into it.
    parts.append(sums(1).groupBy("lang").agg(F.lit("").alias("phrase"), F.sum("n").alias("n")).withColumn("size", F.lit(0)))
    found = materialize(reduce(DataFrame.unionByName, parts), "counts")
    ends = F.endswith("phrase", F.lit(" "))  # words and pairs that end a piece have been counted as edges only
    return found.where((F.col("size") > 0) & ~ends), found.where("size = 0").select("lang", "n")


def _word(phrase: str, i: int) -> Column:
    return F.split_part(F.col(phrase), F.lit(" "), F.lit(i))


def paths(edge: DataFrame, node: DataFrame) -> DataFrame:
    """(lang, words, weights, flows): the edges (lang, phrase, n) joined to unary paths, each edge in one. ``weights`` has a number for
    each edge, ``flows`` one for each node, two of its words."""
    spark = edge.sparkSession
    left, right = F.concat_ws(" ", _word("phrase", 1), _word("phrase", 2)), F.concat_ws(" ", _word("phrase", 2), _word("phrase", 3))
    flow = node.select("lang", F.col("phrase").alias("left"), F.col("n").alias("flow"))
    e = materialize(edge.select("lang", left.alias("left"), right.alias("right"), F.col("n").alias("weight")).join(flow, ["lang", "left"])
                    .withColumn("e", F.monotonically_increasing_id()), "edges")
    into = e.groupBy("lang", F.col("right").alias("node")).agg(F.count("e").alias("ins"), F.min("e").alias("before"))
    out = e.groupBy("lang", F.col("left").alias("node")).agg(F.count("e").alias("outs"), F.min("e").alias("e"))
    unary = into.join(out, ["lang", "node"]).where((F.col("ins") == 1) & (F.col("outs") == 1) & (F.pmod(F.xxhash64("lang", "node"), F.lit(BRANCH)) != 0))
    first = materialize(e.select("e").join(unary.select("e", "before"), "e", "left").select(
        "e", F.coalesce("before", "e").alias("at"), F.col("before").isNotNull().cast("int").alias("steps")), "pointers")
    now = first
    for _ in range(ROUNDS):
        far = now.select(F.col("e").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more"))
        now = materialize(now.join(far, "at").select("e", F.col("next").alias("at"), (F.col("steps") + F.col("more")).alias("steps")), "pointers")
    heads = first.where("steps = 0").select(F.col("e").alias("at"), F.lit(True).alias("head"))
    placed = now.join(heads, "at", "left").select(
        "e", F.when(F.col("head"), F.col("at")).otherwise(F.col("e")).alias("path"), F.when(F.col("head"), F.col("steps")).otherwise(0).alias("step"))
    steps = F.array_sort(F.collect_list(F.struct("step", "left", "right", "weight", "flow")))
    rows = e.join(placed, "e").groupBy("path", "lang").agg(steps.alias("steps")).withColumn("right", F.col("steps")[F.size("steps") - 1]["right"])
    last = node.select("lang", F.col("phrase").alias("right"), F.col("n").alias("last"))
    return rows.join(last, ["lang", "right"]).select(
        "lang", F.concat(F.split(F.col("steps")[0]["left"], " "), F.transform("steps", lambda s: F.split_part(s["right"], F.lit(" "), F.lit(2)))).alias("words"),
        F.col("steps.weight").alias("weights"), F.concat("steps.flow", F.array("last")).alias("flows"))


def score(a: Column, l: Column, r: Column) -> Column:
    """a * a / (l * r) in millionths, rounded down, in decimals of 38 digits: exact up to counts of 10**15."""
    d = lambda c: c.cast("decimal(19,0)")
    squared = (d(a) * d(a)).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", squared.cast("decimal(38,0)"), d(l) * d(r))


def mine(docs: DataFrame, least: int = LEAST, within: int = WITHIN, top: int = TOP, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and these into words at blanks and tabs. A phrase of
    two or three words is a candidate if it occurs ``least`` times. Cut in two, its parts occur l and r times, and its score is a * a / (l * r)
    in millionths, rounded down, at the worst cut (the first of equals). A pair goes if a triple that holds it occurs in ``within`` percent of
    its cases. Ties in score go to the more frequent, then to the smaller phrase.

    Null languages count as ``und``. Null and empty texts have no words; null ids and repeated rows count like others; an empty table
    gives no rows; other columns are ignored. A task holds some MB of text, or one long text."""
    found, total = counts(docs, least, lang_col, text_col)
    word, node, edge = (found.where(F.col("size") == s).select("lang", "phrase", "n") for s in (1, 2, 3))
    path = materialize(paths(edge, node), "paths")
    at = path.select("lang", "words", "weights", "flows", F.posexplode("flows").alias("i", "a"))
    w = lambda i: F.element_at("words", i)
    i = F.col("i")
    triples = at.where(i < F.size("weights")).select(
        "lang", F.concat_ws(" ", w(i + 1), w(i + 2), w(i + 3)).alias("phrase"), F.element_at("weights", i + 1).alias("a"), w(i + 1).alias("first"), w(i + 3).alias("last"),
        F.col("a").alias("front"), F.element_at("flows", i + 2).alias("back"))
    # The heaviest edge beside a node; nodes where paths meet take the heaviest of all of them.
    weight = lambda at: F.coalesce(F.try_element_at("weights", at), F.lit(0))
    beside = at.select("lang", F.concat_ws(" ", w(i + 1), w(i + 2)).alias("phrase"), F.greatest(F.when(i > 0, weight(F.greatest(i, F.lit(1)))).otherwise(0), weight(i + 1)).alias("most"))
    pairs = node.select("lang", "phrase", F.col("n").alias("a"), F.lit(0).cast("long").alias("most")).unionByName(beside.withColumn("a", F.lit(0).cast("long")))
    pairs = pairs.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("most").alias("most")).where(F.col("most") * 100 < F.col("a") * within)
    none = F.lit(None).cast("long")
    pairs = pairs.select("lang", "phrase", "a", _word("phrase", 1).alias("first"), _word("phrase", 2).alias("last"), none.alias("front"), none.alias("back"))
    ends = lambda name, n: sent_if_few(word.select("lang", F.col("phrase").alias(name), F.col("n").alias(n)))
    both = pairs.unionByName(triples).join(ends("first", "n_first"), ["lang", "first"]).join(ends("last", "n_last"), ["lang", "last"])

    def cut(l: Column, r: Column) -> Column:
        return F.struct(score(F.col("a"), l, r).alias("score"), l.alias("l"), r.alias("r"))

    one = F.when(F.col("back").isNull(), cut(F.col("n_first"), F.col("n_last"))).otherwise(cut(F.col("n_first"), F.col("back")))
    two = F.when(F.col("front").isNotNull(), cut(F.col("front"), F.col("n_last")))
    scored = both.select("lang", "phrase", "a", one.alias("one"), two.alias("two")).withColumn(
        "cut", F.when(F.col("two").isNull() | (F.col("one.score") <= F.col("two.score")), F.col("one")).otherwise(F.col("two"))).select("lang", "phrase", "a", "cut.*")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = Window.partitionBy("lang", "part").orderBy(*best)
    few = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(tasks))).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(total), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")  # a row a language

