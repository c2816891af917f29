import math
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from tallyloom.llm import queries, urls

SCHEMA = "page_id BIGINT, url STRING, html STRING"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "<p>plain news of the day</p><script>casino()</script>") for i, u in rows], SCHEMA)


def plain(url):
    """host, path, rule of a url, and the rule's verdict."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    best = None
    for verdict, rule in queries.RULES:
        name, _, prefix = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + prefix) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, *(best[::-1] if best else (None, None))


URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12", "http://example.org/en/2", "http://notexample.org/es/3", "http://x.com/fr/", "http://x.com/de/a?b#c", "com/de/",
        "http://com/de/", "ftp://user@x.com:80/de/q", "http://x.com?de/", "http://x.com#/de/", "http://x.net/de/", "", None, "://", "http://", "http://É.Com/fr/é://x.com/de/",
        "http://a.org", "http://a.org/", "mailto:x@y.org", "http://x.example.org/es", "HTTP://X.COM/DE/"]


def test_rules(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[0]), (3, URLS[3])]
    got = urls.judge(pages(spark, rows).selectExpr("*", "'x' AS host", "'y' AS score", "'z' AS token"), queries.RULES).collect()
    assert len(got) == len(rows)
    want = sorted(repr((i, *plain(u)[:3])) for i, u in rows)
    assert sorted(repr((r.page_id, r.host, r.path, r.rule)) for r in got) == want
    for r in got:
        ruled = {u: plain(u)[3] for u in URLS}[URLS[r.page_id if r.page_id is not None else 0]]
        assert r.verdict in ("allow", "block") and (ruled is None or r.verdict == ruled)


def test_words_decide(spark):
    bad = ["http://cheappills.example.net/en/1", "http://www.casino-win.example.net/x", "http://bestpokerslots.example.net/", "http://adult-x.example.net/a"]
    good = [f"http://{h}.example.net/en/{i}" for i in range(8) for h in ("tionsh", "newsthreads", "middlesex", "therha", "uploads", "openresearch")]
    rows = list(enumerate(bad + good))
    got = {r.page_id: r.verdict for r in urls.judge(pages(spark, rows), ()).collect()}
    assert [got[i] for i in range(len(bad))] == ["block"] * len(bad)
    assert {got[i] for i in range(len(bad), len(rows))} == {"allow"}


def test_most_frequent_rows(spark):
    counts = spark.range(1, 1001).selectExpr("id", "1000 div id AS n").repartition(5)
    got = {r.id: r.n for r in urls._frequent(counts, F.col("n"), 60)}
    assert 40 <= len(got) <= 60 and set(got) == set(range(1, len(got) + 1)) and min(got.values()) > 1000 // (max(got) + 1)
    assert len(urls._frequent(counts, F.col("n"), 5000)) == 1000 and urls._frequent(counts.where("n = 1"), F.col("n"), 10) == []


def test_no_rows(spark):
    assert urls.judge(pages(spark, []), queries.RULES).count() == 0


@pytest.mark.parametrize("name", ["cheappills", "bestcasinowin", "threads", "zzqcasino", "pillsnews", "abetterwin", "newsnewsnews"])
def test_segmentation_is_the_cheapest_split(name):
    counts = {"cheap": 50, "pills": 40, "casino": 30, "best": 200, "threads": 9, "read": 70, "news": 500, "better": 60, "bett": 1, "ads": 500, "wins": 3, "window": 2}
    segmenter = urls.Segmenter(counts)

    def cost(words):
        return sum(segmenter.cost[w] if w in counts and len(w) >= 4 else segmenter.unknown + 2.0 * len(w) for w in words)

    got = segmenter.split(name)
    assert "".join(got) == name
    if name in counts:
        assert got == (name,)
        return
    splits = ([name[a:b] for a, b in zip((0, *cuts), (*cuts, len(name)))] for k in range(len(name)) for cuts in combinations(range(1, len(name)), k))
    assert math.isclose(cost(got), min(map(cost, splits)))


def test_all_tokens_count(spark, monkeypatch):
    """Each page's score is that of a plain computation over all words and tokens, also when more keys are equally
    frequent than may be sent, and when some are sent and some are not."""
    from collections import Counter

    names = ["".join(chr(97 + (i // 26 ** k) % 26) for k in range(3)) + "qzvk" for i in range(300)]
    rows = [(i, f"http://{names[i]}.example.net/{names[-i]}/{'casino' if i % 7 == 0 else 'en'}{i}") for i in range(300)]
    rows += [(1000 + i, f"http://{x}.casino-{names[i]}.net/{names[i]}news/{names[i]}") for i, x in enumerate(["www", "m", "blog"] * 8)]
    df = spark.createDataFrame([(i, u, f"<p>plain news of {names[i % 300]} day</p>") for i, u in rows], SCHEMA)
    text = Counter(w for i, _ in rows for w in ("plain", "news", "of", names[i % 300], "day"))
    common = max(urls.RARE, sum(text.values()) // 10_000)
    split = urls.Segmenter(text | {w: max(common, text[w]) for w in urls.BLOCKED_WORDS + urls.PLAIN_WORDS}).split
    tokens = lambda x: [t for name in urls.names_of(x) for t in (("#",) if name == "#" else split(name))]
    seen = {i: (tokens(plain(u)[0]), tokens(plain(u)[1])) for i, u in rows}
    bad, good, pages_of = Counter(), Counter(), Counter()
    for host, path in seen.values():
        blocked = not set(host).isdisjoint(urls.BLOCKED_WORDS)
        pages_of[blocked] += 1
        (bad if blocked else good).update(host + path)
    seeds, every = len(urls.BLOCKED_WORDS), set(bad) | set(good)

    def ratio(t):
        usual = (bad[t] + good[t] + urls.UNSEEN) / (bad.total() + good.total() + urls.UNSEEN * (len(every) + 1 + seeds))
        seeded = (1 - urls.SEED_SHARE) * usual + urls.SEED_SHARE * (t in urls.BLOCKED_WORDS) / seeds
        return math.log((bad[t] + urls.PRIOR * seeded) / (bad.total() + urls.PRIOR)) - math.log((good[t] + urls.PRIOR * usual) / (good.total() + urls.PRIOR))

    want = {i: math.log(pages_of[True] + 1) - math.log(pages_of[False] + 1) + sum(map(ratio, host + path)) for i, (host, path) in seen.items()}
    for hot in (1000, 3):
        monkeypatch.setattr(urls, "HOT", hot)
        got = {r.page_id: (r.score, r.verdict) for r in urls.judge(df, ()).collect()}
        assert got.keys() == want.keys()
        assert all(math.isclose(got[i][0], want[i], abs_tol=1e-9) and got[i][1] == ("block" if want[i] > 0 else "allow") for i in want)


def test_more_tokens_than_a_model_was_let_hold(spark):
    """Over 50,000 tokens that occur once: one of them still tells on its page."""
    many = "-".join("".join(chr(97 + i // 26 ** k % 26) for k in range(4)) + "q" for i in range(51_000))
    rows = [(1, "http://casino.example.net/zzzzz"), (2, "http://casino.example.net/"), (3, f"http://plain.example.net/{many}"), (4, "http://news.example.net/")]
    got = {r.page_id: r.score for r in urls.judge(pages(spark, rows), ()).collect()}
    assert got[1] > got[2]


SHORT = ["hotporn", "sexcams", "xxxads", "topbets", "hotnude", "bestbet", "thebestbet", "mybet", "mycasino", "newpills"]


def test_short_blocked_words_in_names(spark):
    text = "the best of my hot new top cams on plain news of the day essex threads"
    good = ["essex", "threads", "uploads", "alphabet", "newsthreads", "middlesexnews"]
    rows = [(i, f"http://{x}.example.net/en/{i}") for i, x in enumerate(SHORT + good)]
    rows += [(100 + i, f"http://{x}.example.net/en/{i}") for i in range(10) for x in good]
    df = spark.createDataFrame([(i, u, f"<p>{text}</p>") for i, u in rows], SCHEMA)
    got = {r.page_id: r.verdict for r in urls.judge(df, ()).collect()}
    assert [x for i, x in enumerate(SHORT) if got[i] != "block"] == []
    assert [u for i, u in rows if i >= len(SHORT) and got[i] != "allow"] == []


def test_words_of_any_length_cost_their_frequency():
    counts = dict.fromkeys(urls.BLOCKED_WORDS + urls.PLAIN_WORDS, 100) | {"the": 60_000, "best": 700, "hot": 90, "top": 300, "cams": 40, "my": 900, "new": 2000, "other": 900_000}
    split = urls.Segmenter(counts).split
    assert [split(x) for x in SHORT] == [("hot", "porn"), ("sex", "cams"), ("xxx", "ads"), ("top", "bets"), ("hot", "nude"), ("best", "bet"), ("the", "best", "bet"),
                                         ("my", "bet"), ("my", "casino"), ("new", "pills")]
    assert all(split(x) == (x,) for x in ("essex", "threads", "alphabet", "beth", "qbetz", "zads"))


def test_very_long_names(spark):
    """A run of letters far beyond what a batch of names beside their substrings could hold."""
    long = "casinonews" * 20_000
    rows = [(1, f"http://{long}.net/a"), (2, "http://plain.net/" + "q" * 200_000), (3, "http://mycasino.net/x"), (4, "http://daynews.net/")]
    got = {r.page_id: r for r in urls.judge(pages(spark, rows), queries.RULES).collect()}
    assert got[1].host == f"{long}.net" and got[1].verdict == "block" and got[4].verdict == "allow"
