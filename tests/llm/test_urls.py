import itertools
import math

from pyspark.sql import types as T

from chronoweave.llm import urls

PAGE = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def brute_split(label, counts):
    total = sum(counts.values())
    best = None
    for cuts in itertools.product([0, 1], repeat=len(label) - 1):
        at, words = 0, []
        for i, c in enumerate(cuts, 1):
            if c:
                words.append(label[at:i])
                at = i
        words.append(label[at:])
        p = sum(math.log(counts[w]) - math.log(total + 1) if w in counts else -math.log(total + 1) - len(w) * math.log(10) for w in words)
        if best is None or p > best[0] + 1e-9:
            best = (p, words)
    return best


def score(words, counts):
    total = sum(counts.values())
    return sum(math.log(counts[w]) - math.log(total + 1) if w in counts else -math.log(total + 1) - len(w) * math.log(10) for w in words)


def test_viterbi_is_the_best_split():
    counts = {"cheap": 50, "pills": 20, "pill": 5, "s": 3, "che": 1, "ap": 2, "the": 900, "rapist": 2, "therapist": 9, "in": 40}
    for label in ("cheappills", "therapist", "thein", "xqz", "apin", "s", "pillscheap"):
        known = {(i, n): counts[label[i:i + n]] for i in range(len(label)) for n in range(1, len(label) - i + 1) if label[i:i + n] in counts}
        got = urls.segment(label, known, sum(counts.values()))
        assert "".join(got) == label
        assert abs(score(got, counts) - brute_split(label, counts)[0]) < 1e-9
    assert urls.segment("cheappills", {(0, 5): 50, (5, 5): 20}, 100) == ["cheap", "pills"]
    assert urls.segment("x" * 100, {}, 10) == ["x" * 100]


def test_naive_bayes_against_formula():
    rows = [(True, ["spam", "x"]), (True, ["spam"]), (False, ["news", "x", "x"])]
    nb = urls.NaiveBayes(rows)
    v = 3 + 1
    want = math.log((2 + 1) / (3 + v)) - math.log((0 + 1) / (3 + v)) + math.log(1 / (3 + v)) - math.log(1 / (3 + v))
    assert abs(nb.score(["spam", "never"]) - want) < 1e-12
    assert urls.NaiveBayes([(True, ["a"])]).score(["a"]) == 0.0


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h) for i, u, h in rows], PAGE)


def test_hosts_paths_and_rules(spark):
    given = [(1, "HTTP://User@WWW.Example.ORG/es/1?q#f"), (2, "https://example.org/en/12"), (3, "https://a.org?x=/es/"), (4, "x://com/fr/a"),
             (5, "https://shop.com/de/"), (6, None), (7, "no scheme/at/all"), (8, "https://notexample.org/es/1"), (9, "://org/"), (10, ""),
             (11, "a://b://c/d"), (12, "https://É.net/ß"), (None, "https://x.org/"), (2, "https://example.org/en/12")]

    def expect(u):
        if u is None or "://" not in u:
            return "", "", None
        rest = u.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.host + r.path), default=None)
        return host, path, best
    got = urls.filter_urls(pages(spark, [(i, u, "") for i, u in given])).collect()
    have = sorted(((r["page_id"], r["host"], r["path"], r["rule"]) for r in got), key=str)
    want = sorted(((i, h, p, b and b.host + b.path) for i, u in given for h, p, b in [expect(u)]), key=str)
    assert have == want
    verdict = {(r["host"], r["path"]): r["verdict"] for r in got}
    assert all(verdict[h, p] == b.verdict for _, u in given for h, p, b in [expect(u)] if b)
    assert verdict["", ""] == "allow"


def test_concatenated_names_are_caught(spark):
    text = "cheap pills and spam farm words for a garden news page about flower beds " * 3
    rows = [(i, f"https://{h}.net/{i}", f"<p>{text}</p>") for i, h in enumerate(
        ["garden-news"] * 30 + ["flower-beds"] * 30 + ["cheap-pills"] * 8 + ["spam-farm"] * 8)]
    rows += [(900, "https://cheappillsnews.net/1", ""), (901, "https://gardennews.net/2", "")]
    got = {r["page_id"]: r for r in urls.filter_urls(pages(spark, rows)).collect()}
    assert got[900]["host_words"] == "cheap pills news net" and got[900]["verdict"] == "block"
    assert got[901]["host_words"] == "garden news net" and got[901]["verdict"] == "allow"
    labelled = [(r["verdict"] == "block", "pills" in r["host"] or "spam" in r["host"]) for r in got.values()]
    assert sum(a == b for a, b in labelled) / len(labelled) > 0.95


def test_concatenated_hosts_over_the_words_of_real_pages(spark):
    from pyspark.sql import functions as F
    planted = {"casinowin": 1, "freebets": 3, "cheappills": 10, "spamfarm": 100}
    rows = [(10**9 + 1000 * k + i, f"https://{h}.example.net/{i}", f"<p>see {h}.example.net and https://{h}.example.net/{i}</p>")
            for k, (h, n) in enumerate(planted.items()) for i in range(n)]
    given = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select(*PAGE.names).unionByName(pages(spark, rows))
    got = urls.filter_urls(given, rules=()).where(F.col("page_id") >= 10**9).collect()
    assert len(got) == len(rows)
    split = {"casinowin": ["casino", "win"], "freebets": ["free", "bets"], "cheappills": ["cheap", "pills"], "spamfarm": ["spam", "farm"]}
    for r in got:
        want = split[r["host"].split(".")[0]]
        assert r["host_words"].split()[:2] == want and r["verdict"] == "block", r


def test_ordinary_hosts_stay_whole(spark):
    from pyspark.sql import functions as F
    given = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select(*PAGE.names)
    got = urls.filter_urls(given, rules=()).select("host", "host_words", "verdict").distinct().collect()
    for r in got:
        words = r["host_words"].split()
        assert words == [w for w in r["host"].replace("-", ".").split(".") if w], r  # every label of these hosts is one word
        assert (r["verdict"] == "block") == any(w in urls.SEEDS for w in words), r
    assert {r["verdict"] for r in got} == {"allow", "block"}
    n = given.count()
    assert urls.filter_urls(given, rules=()).where(F.col("page_id").isNotNull()).count() == n


def test_the_company_of_seeds_is_learned(spark):
    """Hosts without any seed are told apart by the words that stood next to seeds in others."""
    bad, good = ["jackpot", "meds", "lottery", "poker"], ["garden", "school", "museum", "library"]
    text = "jackpot meds lottery poker garden school museum library palace house corner city " * 3
    rows = [(i, f"https://{s}-{b}.net/{i}", text) for i, (s, b) in enumerate(itertools.product(["casino", "cheap", "free"], bad))]
    rows += [(100 + i, f"https://{a}-{b}.net/{i}", text) for i, (a, b) in enumerate(itertools.product(["city", "old"], good))]
    rows += [(200 + i, f"https://{w}{x}.net/{i}", "") for i, (w, x) in enumerate(itertools.product(bad, ["palace", "corner"]))]
    rows += [(300 + i, f"https://{w}{x}.net/{i}", "") for i, (w, x) in enumerate(itertools.product(good, ["palace", "corner"]))]
    got = {r["page_id"]: r for r in urls.filter_urls(pages(spark, rows), rules=()).collect()}
    held_bad, held_good = [got[200 + i]["score"] for i in range(8)], [got[300 + i]["score"] for i in range(8)]
    assert min(held_bad) > max(held_good)
    assert got[200]["host_words"] == "jackpot palace net"


def test_words_of_a_page():
    html = "<style>p{x}</style><script>var t=1</script><p>Caf\u00e9 AT&amp;T see www.spam.example.com now</p>"
    assert urls.page_words("https://host.com/News/Item-7?ref=x", html) == ["news", "item", "ref", "x", "at", "t", "see", "now"]
    assert urls.page_words("", "") == []


def test_unknown_words_against_formula():
    u = urls.UnknownWords.fit(2, 10, {3: 2, 5: 1}, {"a": 4, "b": 7})
    want = math.log(3 / 12) + math.log(3 / (3 + 63)) + 2 * math.log(5 / 37) + math.log(1 / 37)
    assert abs(u.log("aaz") - want) < 1e-12
    counts, total, more = {"ab": 5, "a": 3, "b": 2}, 10, math.log(0.1)
    for label in ("abba", "aab", "zzz", "abab"):
        def price(words):
            return sum(math.log(counts[w]) - math.log(total + 1) if w in counts else u.log(w) for w in words) + more * (len(words) - 1)
        splits = [[label[a:b] for a, b in zip((0, *cut), (*cut, len(label)))]
                  for k in range(len(label)) for cut in itertools.combinations(range(1, len(label)), k)]
        known = {(i, n): counts[label[i:i + n]] for i in range(len(label)) for n in range(1, len(label) - i + 1) if label[i:i + n] in counts}
        got = urls.segment(label, known, total, u.log, more)
        assert abs(price(got) - max(map(price, splits))) < 1e-9


def test_empty_table(spark):
    assert urls.filter_urls(pages(spark, [])).collect() == []
