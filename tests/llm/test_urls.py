import math
import random
from collections import Counter, defaultdict
from zlib import crc32

from fareflow.llm.urls import CALIBRATION_FOLDS, MIN_CONTEXT, ORDER, RULES, START, SYMBOLS, Rule, judge_urls


def symbols(url):
    rest = url.split("://", 1)[1] if "://" in url else url
    return "".join("0" if c.isdigit() else c if c in "./-" or c.isalpha() else "~" for c in rest.lower())


def parts(url):
    if "://" not in (url or ""):
        return "", ""
    rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
    host, slash, path = rest.partition("/")
    return host.lower(), slash + path


def rule(url):
    host, path = parts(url)
    fitting = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: len(r.name), default=None)


def plain_scores(urls):
    """Mean log ratio of each string under models counted gram by gram."""
    counts = {v: [Counter() for _ in range(ORDER + 1)] for v in ("allow", "block")}
    for url in urls:
        found, s = rule(url), symbols(url)
        if found and crc32(s.encode()) % CALIBRATION_FOLDS:
            for at in range(len(s)):
                text = (START * ORDER + s)[at : at + ORDER + 1]
                for k in range(ORDER + 1):
                    counts[found.verdict][k][text[ORDER - k :]] += 1
    after = {v: [defaultdict(Counter) for _ in range(ORDER + 1)] for v in counts}
    for v, levels in counts.items():
        for k, grams in enumerate(levels):
            for gram, n in grams.items():
                after[v][k][gram[:k]][gram[k]] += n

    def chance(v, gram, k):
        lower = chance(v, gram[1:], k - 1) if k else 1 / SYMBOLS
        seen = {x: sum(after[x][k][gram[:k]].values()) for x in after}
        if seen[v] == 0 or (k and sum(seen.values()) < MIN_CONTEXT):
            return lower
        kinds = len(after[v][k][gram[:k]])
        return (after[v][k][gram[:k]][gram[k]] + kinds * lower) / (seen[v] + kinds)

    scores = {}
    for s in {symbols(u) for u in urls}:
        grams = [(START * ORDER + s)[at : at + ORDER + 1] for at in range(len(s))]
        total = sum(math.log(chance("allow", g, ORDER)) - math.log(chance("block", g, ORDER)) for g in grams)
        scores[s] = total / len(s) if s else None
    return scores


def corpus():
    r = random.Random(4)
    urls = []
    for _ in range(300):
        site = "".join(r.choice(("th", "er", "on", "casino", "spam-")) for _ in range(2))
        host = r.choice(("", "www.", "WWW.")) + site + r.choice((".example.com", ".example.net", ".example.org"))
        urls.append(f"{r.choice(('http', 'https'))}://{host}/{r.choice(('en', 'fr', 'es'))}/{r.randrange(1000)}{r.choice(('', '?a=b', '#top'))}")
    return urls


def judged(spark, rows):
    pages = spark.createDataFrame([(k, u, "clash") for k, u in rows], "page_id long, url string, host string")
    return {r.page_id: r for r in judge_urls(pages).collect()}


def test_rules_and_scores_as_counted_by_hand(spark):
    urls = corpus()
    scores, found = plain_scores(urls), judged(spark, enumerate(urls))
    free = []
    for k, url in enumerate(urls):
        r, fit = found[k], rule(url)
        assert (r.host, r.path) == parts(url)
        assert r.rule == (fit.name if fit else None)
        assert abs(r.score - scores[symbols(url)]) < 1e-9
        if fit:
            assert r.verdict == fit.verdict
        else:
            free.append((r.score, r.verdict == "allow"))
    low = max((s for s, allowed in free if not allowed), default=-math.inf)
    assert low < min((s for s, allowed in free if allowed), default=math.inf)


def test_longest_rule_and_odd_urls(spark):
    assert Rule("allow", "com", "/").name == "com/"
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://EXAMPLE.com/en/x"), (5, "https://a.www.example.com/en/"), (6, "x://com"), (7, "x://notexample.com/en/"), (8, "x://a.net/fr/?q#z"), (8, "x://a.net/fr/?q#z"), (None, "y://b.org/" + "a" * 50_000)]
    found = judged(spark, rows)
    assert [found[k].rule for k in range(1, 9)] == [None, None, None, "example.com/en/", "www.example.com/en/", None, "com/", "net/fr/"]
    assert [(found[k].host, found[k].path) for k in (1, 2, 3, 6)] == [("", ""), ("", ""), ("", ""), ("com", "")]
    assert found[1].score is None and found[None].path == "/" + "a" * 50_000
    assert judged(spark, []) == {}
