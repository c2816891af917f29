"""URL filter: rules by host and path, and naive Bayes over words that host and path are segmented into."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.session import materialize, spread

# What teaches the class "block" before any page is seen: words of common block-list categories.
BLOCKED_WORDS = """ads advert banner clicks popup track tracker tracking
adult porn sex xxx escort nude webcam hentai
bet bets betting casino gamble gambling jackpot lottery poker roulette slots
cheap pills pharmacy viagra cialis steroid replica
loan loans payday forex crypto giveaway prize winner
hack hacked crack cracked warez keygen torrent malware phishing spam spammer scam""".split()
# Plain words that hold or resemble those, so segmentation keeps them whole.
PLAIN_WORDS = """news blog shop store home about article archive author books business download downloads upload uploads
threads reads leads heads roads loads pads beads better between alphabet diabetes essex sussex middlesex unisex
forum help learn library local magazine market media music open photo press public recipes research review school science
search service social sport sports support tech tracks travel university video weather wiki world winter window""".split()
# Keys that are sent to the rows that ask for them, at most; the rest of a table meets its rows by shuffle.
HOT = 1000
# Rows of a batch of substrings.
BATCH = 20_000
LONGEST, RARE = 24, 20
# What the classes expect before they see pages, worth PRIOR tokens: "allow" how often a token occurs over all
# pages, "block" the same but for SEED_SHARE, which goes to the blocked words. A token never seen counts as UNSEEN.
PRIOR, SEED_SHARE, UNSEEN = 200, 0.2, 0.01
PIECES = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (verdict, host/path-prefix) and its verdict; null where none does. Equally long rules:
    the smaller text, then block."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, text in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0] != "block"), reverse=True):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


class Segmenter:
    """Splits a name without gaps into the words whose unigram probabilities multiply to most (Viterbi); a stretch no word
    covers costs more with each letter. Words cost the same whatever their length, and a name that is a word stays whole."""

    def __init__(self, counts: dict[str, int], words: int | None = None):
        """``words``: what all counts sum to, where ``counts`` are only those that the names to split can hold."""
        total = math.log((sum(counts.values()) if words is None else words) + 1)
        self.cost = {w: total - math.log(n) for w, n in counts.items()}
        self.unknown = total + 1
        self.split = lru_cache(maxsize=100_000)(self._split)

    def _split(self, name: str) -> tuple[str, ...]:
        if name in self.cost:
            return (name,)
        best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
        for end in range(1, len(name) + 1):
            for start in range(max(0, end - LONGEST), end):
                word = name[start:end]
                cost = self.cost.get(word)
                if cost is None:
                    cost = self.unknown + 2.0 * (end - start)
                if best[start] + cost < best[end]:
                    best[end], back[end] = best[start] + cost, start
        words, end = [], len(name)
        while end:
            words.append(name[back[end]:end])
            end = back[end]
        return tuple(reversed(words))


# Letters of a name whose substrings are gathered, each once, before they are handed on.
AT_ONCE = 4096


def names_of(text: str) -> list[str]:
    """What a host or path is made of before words are looked for; numbers are all one name, which is one token."""
    return ["#" if piece.isdigit() else piece for piece in PIECES.findall(text.lower())]


def _frequent(counts: DataFrame, n: Column, most: int) -> list:
    """The rows of largest ``n``, up to ``most`` of them. Sizes are cut where a histogram of n in eighths of an octave
    says so, and only rows above the cut come to the driver; a step that would go over is left out whole."""
    counts = materialize(counts, "counts")
    step = F.floor(F.log2(n) * 8)
    cut, total = None, 0
    for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("step")).collect():
        total += r.rows
        if total > most:
            break
        cut = r.step
    return [] if cut is None else counts.where(step >= cut).collect()


def _joined(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows with what a table of one row per key says of theirs. The keys most rows share are sent to them, so that no task
    gets all rows of one; every other key has about a thousandth of the rows at most, and they meet by shuffle."""
    hot = [r[key] for r in _frequent(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), F.col("n"), HOT)]
    if not hot:
        return rows.hint("merge").join(table, key)
    is_hot = F.col(key).isin(hot)
    # Files of many like rows are small, and their size says nothing about the rows: they are never sent to all tasks.
    return rows.where(is_hot).join(F.broadcast(table.where(is_hot)), key).unionByName(rows.where(~is_hot).hint("merge").join(table.where(~is_hot), key))


def _word_counts(pages: DataFrame, text_col: str) -> DataFrame:
    """(word, n): all words of all pages' texts, without markup, and the seeds at the weight of a common word."""
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    words = pages.select(F.explode(F.regexp_extract_all(plain, F.lit(r"[a-z]{2,24}"), F.lit(0))).alias("word"))
    counts = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "counts")
    common = max(RARE, (counts.agg(F.sum("n")).first()[0] or 0) // 10_000)
    seeds = pages.sparkSession.createDataFrame([(w, common) for w in BLOCKED_WORDS + PLAIN_WORDS], "word string, n long")
    return materialize(counts.unionByName(seeds).groupBy("word").agg(F.max("n").alias("n")), "words")


def _segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """(id, name, tokens): each name split by the words it holds, which its substrings find among all words. Substrings carry a number
    in place of the name, so a name of any length costs no more than so many words for each of its letters."""
    total = words.agg(F.sum("n")).first()[0]

    def substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[int, str]]:
            for batch in batches:
                for i, name in zip(batch.column("id").to_pylist(), batch.column("name").to_pylist()):
                    for low in range(0, len(name) if name.isascii() else 0, AT_ONCE):
                        yield from ((i, w) for w in {name[at:at + n] for at in range(low, min(low + AT_ONCE, len(name))) for n in range(2, min(LONGEST, len(name) - at) + 1)})

        every = pairs()
        while held := list(islice(every, BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in held], pa.int64()), pa.array([w for _, w in held], pa.string())], names=["id", "word"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = [x for found in batch.column(1).to_pylist() for x in found or ()]
            segmenter = Segmenter({x["word"]: x["n"] for x in known}, total)
            tokens = [("#",) if name == "#" else segmenter.split(name) for name in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(tokens, pa.list_(pa.string()))], names=["id", "name", "tokens"])

    names = materialize(names.select("name", F.monotonically_increasing_id().alias("id")), "names")
    parts = materialize(spread(names).mapInArrow(substrings, "id long, word string"), "substrings")
    found = _joined(parts, words, "word").groupBy("id").agg(F.collect_set(F.struct("word", "n")).alias("found"))
    return materialize(names.join(found, "id", "left").select("name", "found", "id").mapInArrow(split, "id long, name string, tokens array<string>"), "names")


def _log_ratios(sums: DataFrame) -> DataFrame:
    """(token, ratio) of all tokens, from how often pages of the classes hold them (token, bad, good)."""
    bad_all, good_all, kinds = (x or 0 for x in sums.agg(F.sum("bad"), F.sum("good"), F.count(F.lit(1))).first())
    bad, good, seed = F.col("bad"), F.col("good"), F.col("token").isin(BLOCKED_WORDS).cast("int") / len(BLOCKED_WORDS)
    usual = (bad + good + UNSEEN) / (bad_all + good_all + UNSEEN * (kinds + 1 + len(BLOCKED_WORDS)))  # 1: what is in no table
    seeded = (1 - SEED_SHARE) * usual + SEED_SHARE * seed
    return sums.select("token", (F.log((bad + PRIOR * seeded) / (bad_all + PRIOR)) - F.log((good + PRIOR * usual) / (good_all + PRIOR))).alias("ratio"))


def _in_order(x: str) -> Column:
    """The sum of a group, the same however its rows are dealt."""
    return F.aggregate(F.array_sort(F.collect_list(x)), F.lit(0.0), lambda a, b: a + b)


def _scores(rows: DataFrame, words: DataFrame) -> DataFrame:
    """(row, score) of rows that hold a name.

    A page teaches "block" if its host holds a blocked word, else "allow"; its tokens are counted over all pages. The
    tokens that go with blocked words are so learnt from the corpus. Names are split once, and every token counts."""
    named = rows.select("row", F.inline("names"))
    names = _segmented(materialize(named.select("name").distinct(), "distinct"), words)
    held = materialize(_joined(named, names.select("id", "name"), "name").select("row", "id", "in_host", "in_path"), "held")  # a name may be long
    bad = names.where(F.arrays_overlap("tokens", F.array(*map(F.lit, BLOCKED_WORDS)))).select("id")
    blocked = materialize(_joined(held.where("in_host > 0"), bad, "id").select("row", F.lit(True).alias("blocked")).distinct(), "blocked")
    bad_pages, all_pages = blocked.count(), rows.count()
    n, is_blocked = F.col("in_host") + F.col("in_path"), F.col("blocked").isNotNull()
    per_name = held.join(blocked, "row", "left").groupBy("id").agg(
        F.sum(F.when(is_blocked, n).otherwise(0)).alias("bad"), F.sum(F.when(is_blocked, 0).otherwise(n)).alias("good"))
    tokens = names.select("id", F.explode("tokens").alias("token"))
    sums = materialize(tokens.join(per_name, "id").groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "tokens")
    of_name = materialize(_joined(tokens, _log_ratios(sums), "token").groupBy("id").agg(_in_order("ratio").alias("ratio")), "ratios")
    prior = math.log(bad_pages + 1) - math.log(all_pages - bad_pages + 1)
    told = _joined(held.select("row", "id", n.alias("n")), of_name, "id").select("row", (F.col("n") * F.col("ratio")).alias("part"))
    return told.groupBy("row").agg((F.lit(prior) + _in_order("part")).alias("score"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """One row per page: page_id, host, path, rule, score (log odds of block, by naive Bayes) and verdict: the longest
    fitting rule's, else block where the score is above 0. All words and all tokens of all pages count.

    Host and path are empty where the url is null or holds no ://; such a page has no token and is allowed unless a
    rule says otherwise. Null ids and repeated rows are kept; an empty table gives no rows; other columns
    are ignored, whatever their names."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("name", pa.string()), ("in_host", pa.int64()), ("in_path", pa.int64())]))
        for batch in batches:
            found = []
            for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                a, b = Counter(names_of(host)), Counter(names_of(path))
                found.append([{"name": x, "in_host": a[x], "in_path": b[x]} for x in a | b])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=["page_id", "host", "path", "names"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = spread(rows).mapInArrow(named, "page_id long, host string, path string, names array<struct<name: string, in_host: long, in_path: long>>")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "urls")
    out = rows.drop("names").join(_scores(rows, _word_counts(pages, text_col)), "row", "left").withColumn("score", F.coalesce("score", F.lit(-math.inf)))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    by_score = F.when(F.col("score") > 0, "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), "score", F.coalesce(verdict, by_score).alias("verdict"))
