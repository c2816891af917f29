"""Find secrets: fixed patterns, and the entropy of a sliding window. DataFrame functions only."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Fixed patterns, as the contract of the query states them. AKIA... and hex runs are whole runs, so a least
# length inside the pattern finds the same spans as dropping short ones afterwards.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# Matches of one text that are worked off together.
BLOCK = 500
KINDS = ("assign", "access", "hex", "entropy")

# Character classes of the entropy search: pattern of a candidate, least bits a character in some window.
# A window of 20 random characters has about 3.3 bits of 16 symbols and 4.1 of 64; invented or real words stay below 3.6,
# words run together below 4.
WINDOW = 20
CLASSES = {"hex": (r"[0-9A-Fa-f]{20,}", 3.0), "base64": (r"[A-Za-z0-9+/_=-]{20,}", 3.7)}
NO_DIGIT_BITS = 4.0
# What is no secret. Of whole candidates: hex digits that are all digits or all letters; ids in the form of a UUID, and what is judged as hex.
CALM = {"hex": (r"^[0-9]*$", r"^[A-Fa-f]*$"),
        "base64": (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$", r"^[0-9A-Fa-f]*$")}
# Of the parts that / _ = - separate, which are then left out of the judgement: numbers, words of addresses and paths, placeholders.
SEPARATOR = "[/_=-]"
CALM_PART = r"^(?:[0-9]*|[A-Z]?[a-z]{0,15}[0-9]{0,4}|(?i:(?:example|sample|placeholder|dummy|xxxx|1?234567890|0123456789|abcdefgh)[a-z0-9]{0,12}))$"


def _blocks(n: Column) -> Column:
    """Numbers of the blocks that n entries make up."""
    return F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))


def _block(entries: Column, number: Column) -> Column:
    return F.slice(entries, number * BLOCK + 1, F.lit(BLOCK))


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _places(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of the matches, leftmost and not overlapping, in code points: what lies
    between the matches, and the matches themselves, laid end to end."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    kind = "array<struct<start: bigint, end: bigint, hit: string>>"
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("found"))

    def step(acc, pair):
        start = acc["at"] + pair["gap"]
        end = start + F.length(pair["hit"])
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("hit"))).cast(kind)).alias("found"))

    def join(pairs):
        def part(acc, number):  # a block starts where the last one ended; its own list stays short
            inner = F.aggregate(_block(pairs, number), F.struct(acc["at"].alias("at"), F.array().cast(kind).alias("found")), step)
            return _let(inner, lambda b: F.struct(b["at"].alias("at"), F.concat(acc["found"], b["found"]).alias("found")))

        return F.aggregate(_blocks(F.size(pairs)), begin, part, lambda acc: acc["found"])

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    return F.when(text.rlike(pattern), _let(pairs, join)).otherwise(F.array().cast(kind))


def _spans(places: Column, kind: str) -> Column:
    return F.transform(places, lambda p: F.struct(p["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), p["end"].alias("end"), F.lit(kind).alias("kind")))


def window_entropy(word: Column, window: int = WINDOW) -> Column:
    """The most bits a character in any window of an ASCII word of at least ``window`` characters. The window
    slides by one: the counts of the character that leaves and of the one that enters change, and the
    sum of c * log2(c) over the counts c with them."""
    codes = F.transform(F.split(word, ""), lambda c: F.ascii(c))
    weighed = F.array(*(F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(window + 2)))

    def moved(acc, code, by):
        """acc with the count of ``code`` changed by 1 or -1."""
        old = F.get(acc["counts"], code)
        return F.struct(F.transform(acc["counts"], lambda c, i: F.when(i == code, c + by).otherwise(c)).alias("counts"),
                        (acc["sum"] + F.get(weighed, old + by) - F.get(weighed, old)).alias("sum"), acc["least"].alias("least"))

    empty = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("sum"), F.lit(float("inf")).alias("least"))
    first = F.aggregate(F.slice(codes, 1, window), empty, lambda acc, code: moved(acc, code, 1))
    first = F.transform(F.array(first), lambda a: F.struct(a["counts"].alias("counts"), a["sum"].alias("sum"), a["sum"].alias("least")))[0]

    def slide(acc, pair):
        here = F.transform(F.array(acc), lambda a: moved(a, pair["out"], -1))
        here = F.transform(here, lambda a: moved(a, pair["in"], 1))
        return F.transform(here, lambda a: F.struct(a["counts"].alias("counts"), a["sum"].alias("sum"), F.least(a["least"], a["sum"]).alias("least")))[0]

    later = F.slice(codes, window + 1, F.greatest(F.size(codes) - window, F.lit(0)))
    pairs = F.zip_with(F.slice(codes, F.lit(1), F.size(later)), later, lambda o, i: F.struct(o.alias("out"), i.alias("in")))
    return F.aggregate(pairs, first, slide, lambda acc: math.log2(window) - acc["least"] / window)


def _entropy(text: Column, name: str) -> Column:
    pattern, bits = CLASSES[name]

    def suspicious(p):
        calm = reduce(lambda a, b: a | b, (p["hit"].rlike(c) for c in CALM[name]))
        rest = p["hit"] if name == "hex" else F.array_join(F.filter(F.split(p["hit"], SEPARATOR, -1), lambda part: ~part.rlike(CALM_PART)), "")
        needed = F.lit(bits) if name == "hex" else F.when(p["hit"].rlike("[0-9]"), bits).otherwise(NO_DIGIT_BITS)
        return _let(rest, lambda r: F.when(calm | (F.length(r) < WINDOW), F.lit(False)).otherwise(window_entropy(r) >= needed))

    return F.filter(_places(text, pattern), suspicious)


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all columns given, as a struct) and ``spans``: array<struct<start, rank, end, kind>> in order of
    start and kind, in code points, end exclusive.

    Kinds: ``assign`` (a named value of 12 characters or more), ``access`` (access key ids), ``hex`` (16 or more hex
    digits), and ``entropy``: words whose window entropy is high for their character class once the parts that the allow-list
    knows are left out. An entropy span is given whole, also where fixed patterns cover some of it, and not where they cover all.

    Null and empty texts have no spans. Texts are searched whole. Rows are independent: repeated rows give
    repeated results, an empty table none, and names of other columns cannot clash."""
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    long_value = lambda p: F.length(F.regexp_extract(p["hit"], ASSIGN, 2)) >= ASSIGN_VALUE
    found = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).select(
        "row", _spans(F.filter(_places(text, ASSIGN), long_value), "assign").alias("a"),
        _spans(_places(text, ACCESS), "access").alias("k"), _spans(_places(text, HEX), "hex").alias("h"),
        _entropy(text, "hex").alias("e1"), _entropy(text, "base64").alias("e2"))
    base = found.select("row", F.concat("a", "k", "h").alias("base"), _spans(F.concat("e1", "e2"), "entropy").alias("more"))
    base = base.withColumn("base", F.array_sort("base"))
    over = lambda e: F.filter("base", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"]))
    covered = lambda e: F.aggregate(over(e), e["start"], lambda at, b: F.when(b["start"] <= at, F.greatest(at, b["end"])).otherwise(at))
    more = F.filter("more", lambda e: covered(e) < e["end"])
    return base.select("row", F.array_sort(F.concat("base", more)).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by a mark. Spans are worked off in blocks, each on the
    stretch of text it covers, so a long text with many of them is not searched from its start for each."""
    cut = lambda x, start, end: F.substring(x, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def part(acc, number):
        def worked_off(b):
            def step(inner, s):
                kept = F.concat(inner["out"], cut(b["text"], inner["at"] - b["from"], s["start"] - b["from"]), F.lit(mark))
                return F.struct(F.greatest(inner["at"], s["end"]).alias("at"), F.when(s["start"] >= inner["at"], kept).otherwise(inner["out"]).alias("out"))

            return F.aggregate(b["spans"], F.struct(b["from"].alias("at"), F.lit("").alias("out")), step)

        own = _block(spans, number)
        stretch = cut(text, acc["at"], F.aggregate(own, acc["at"], lambda most, s: F.greatest(most, s["end"])))
        block = F.struct(acc["at"].alias("from"), own.alias("spans"), stretch.alias("text"))
        return _let(_let(block, worked_off), lambda b: F.struct(b["at"].alias("at"), F.concat(acc["out"], b["out"]).alias("out")))

    done = F.aggregate(_blocks(F.size(spans)), begin, part, lambda acc: F.concat(acc["out"], cut(text, acc["at"], acc["at"] + F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
