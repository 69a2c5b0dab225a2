import math
import random
import re
import zlib
from collections import Counter

import pytest

from salesops.llm import queries, urls
from tests.llm.conftest import SMALL


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path, rules):
    fits = []
    for verdict, text in rules:
        at = text.find("/") if "/" in text else len(text)
        if (host == text[:at] or host.endswith("." + text[:at])) and path.startswith(text[at:]):
            fits.append((len(text), at, text, verdict))
    return max(fits)[2:] if fits else (None, None)


def plain_features(whole, host, path):
    query = re.match(r"[^?#]*\?([^#]*)", whole)
    query = query[1] if query else ""
    runs, n = Counter(whole), len(whole)
    entropy = math.log2(n) - sum(c * math.log2(c) for c in sorted(runs.values())) / n if n else 0.0
    digits = len(re.findall("[0-9]", whole))
    values = [
        n / 4, len(host) / 2, len(path) / 2, len(query) / 4, path.count("/"), digits / n * 32 if n else 0,
        len(re.findall("[0-9]", path)), len(re.findall("[0-9]", host)), round(entropy, 9) * 4, len(re.findall("[^&]+", query)),
        len(re.findall(r"[^.]+", host)), host.count("-"), whole.count("%"), whole.lower().startswith("https://"), "#" in whole,
    ]
    return [min(int(v), urls.BINS - 1) for v in values]


def suffix(host, k):
    return ".".join(host.split(".")[-k:])


def plain_judge(given, rules):
    """All steps by lists and loops: features, suffix statistics without the own fold, trees over single rows."""
    rows = []
    for key, url in given:
        host, path = plain_split(url)
        rule, verdict = plain_rule(host, path, rules)
        rows.append((key, url or "", host, path, rule, verdict))
    labelled = [r for r in rows if r[5]]
    total, blocked = len(labelled), sum(r[5] == "block" for r in labelled)
    mean = blocked / total if total else 0.0
    fold = lambda whole: zlib.crc32(whole.encode()) % urls.FOLDS
    seen, bad = Counter(), Counter()
    for _, whole, host, _, _, verdict in labelled:
        for k in urls.SUFFIXES:
            for f in (None, fold(whole)):
                seen[k, suffix(host, k), f] += 1
                bad[k, suffix(host, k), f] += verdict == "block"
    bins = []
    for _, whole, host, path, _, verdict in rows:
        row = plain_features(whole, host, path)
        for k in urls.SUFFIXES:
            at = (k, suffix(host, k))
            n, b = seen[*at, None], bad[*at, None]
            if verdict:
                n, b = n - seen[*at, fold(whole)], b - bad[*at, fold(whole)]
            row += [min(int((b + urls.PRIOR * mean) / (n + urls.PRIOR) * urls.BINS), urls.BINS - 1), int(math.log2(n + 1))]
        bins.append(row)
    scores = [0.0] * len(rows)
    if total:
        scores = [math.log((blocked + 0.5) / (total - blocked + 0.5))] * len(rows)
        train = [k for k, r in enumerate(rows) if r[5]]
        for _ in range(urls.TREES):
            weights = {}
            for k in train:
                p = 1 / (1 + math.exp(-scores[k]))
                g = math.floor(p * urls.UNIT + 0.5) - urls.UNIT * (rows[k][5] == "block")
                weights[k] = (g, math.floor(p * (1 - p) * urls.UNIT + 0.5))
            tree = plain_tree(bins, train, weights, 0)
            if tree[0] is None:
                break
            for k, row in enumerate(bins):
                at = tree
                while at[0] is not None:
                    at = at[2] if row[at[0]] <= at[1] else at[3]
                scores[k] += at[1]
    return [
        (key, host, path, rule, verdict or ("block" if s > 0 else "allow"), round(1 / (1 + math.exp(-s)), 6))
        for (key, _, host, path, rule, verdict), s in zip(rows, scores, strict=True)
    ]


def plain_tree(bins, members, weights, depth):
    """(feature, last bin, left, right), or (None, value)."""
    total = [sum(weights[k][i] for k in members) for i in (0, 1)]
    gain = lambda g, h: (g / urls.UNIT) ** 2 / (h / urls.UNIT + urls.RIDGE)
    best = None
    for feature in range(len(urls.FEATURES) if depth < urls.DEPTH else 0):
        for last in range(urls.BINS - 1):
            g, h = (sum(weights[k][i] for k in members if bins[k][feature] <= last) for i in (0, 1))
            if min(h, total[1] - h) >= urls.LEAST_WEIGHT * urls.UNIT:
                gained = gain(g, h) + gain(total[0] - g, total[1] - h) - gain(*total)
                if gained > (best[0] if best else 1e-9):
                    best = (gained, feature, last)
    if not best:
        return None, -urls.RATE * (total[0] / urls.UNIT) / (total[1] / urls.UNIT + urls.RIDGE)
    sides = [[k for k in members if (bins[k][best[1]] <= best[2]) == left] for left in (True, False)]
    return (*best[1:], *(plain_tree(bins, side, weights, depth + 1) for side in sides))


def rounded(rows):
    return sorted(((*r[:-1], round(r.score, 6)) for r in rows), key=str)


def test_query_by_brute_force(spark):
    given = [(r.page_id, r.url) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    found = queries.op11_url_filters(spark, SMALL)
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().toString())
    assert rounded(found.collect()) == sorted(plain_judge(given, queries.URL_RULES), key=str)


ODD_URLS = [
    None, "", "no scheme/at/all", "://", "http://", "http://ORG", "http://org", "http://org/", "HTTPS://A.Org/x?y=1&z=2#f",
    "http://norg/", "http://x.example.org/es/", "http://example.org/es", "http://example.org/en/15?q", "http://example.org?en/1",
    "http://münchen.com/de/ü%20", "http://a.com/fr/x://y.org/", "x" * 50_000 + "://b.com/de/" + "9" * 50_000, "http://user@com:80/fr/",
    "http://a.com/fr/😀😀", "http://com/de/\nz", "http://a.b.c.d.e.com/de/", "http://com.", "http://.com/de/",
]


def test_odd_urls(spark):
    given = [(k if k % 7 else None, u) for k, u in enumerate(ODD_URLS * 3)]
    rows = spark.createDataFrame([(u, k, "c", "h") for k, u in given], "url string, page_id long, rule string, host string")
    found = urls.judge(rows, queries.URL_RULES)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    assert rounded(found.collect()) == sorted(plain_judge(given, queries.URL_RULES), key=str)
    assert urls.judge(rows.limit(0), queries.URL_RULES).collect() == []
    # Without labelled URLs, and without rules at all.
    assert {r.verdict for r in urls.judge(rows, [urls.Rule("block", "nowhere/")]).collect()} == {"allow"}
    assert {r.rule for r in urls.judge(rows, []).collect()} == {None}


def test_rules(spark):
    rules = [("block", "com"), ("allow", "a.com/x"), ("block", "a.com/xy/"), ("allow", "Deep.b.com/"), ("block", "m/xxxxx")]
    given = [(k, u) for k, u in enumerate(["s://a.com/xy/z", "s://a.com/xy", "s://a.com/y", "s://q.deep.b.com/", "s://deep.b.com", "s://m/xxxxxx"])]
    frame = spark.createDataFrame(given, "page_id long, url string")
    split = frame.selectExpr("page_id", "url AS whole")
    host, path = urls.host_and_path(split.whole)
    found = urls.with_rules(spark, split.withColumns({"host": host, "path": path}), [urls.Rule(*r) for r in rules])
    want = [("block", "a.com/xy/"), ("allow", "a.com/x"), ("block", "com"), ("allow", "Deep.b.com/"), ("block", "com"), ("block", "m/xxxxx")]
    assert [(r.ruled, r.rule) for r in found.orderBy("page_id").collect()] == want
    for broken in ([("maybe", "a/")], [("allow", "/x")], [("allow", "a/"), ("block", "a/")]):
        with pytest.raises(ValueError):
            urls.with_rules(spark, split, [urls.Rule(*r) for r in broken])


def test_learns_what_blocked_urls_look_like(spark):
    """Unlisted hosts: long addresses of many digits and parameters against short ones."""
    rnd = random.Random(11)

    def url(bad, tld):
        host = "".join(rnd.choices("abcdefghij", k=rnd.randrange(4, 10)))
        if not bad:
            return f"https://{host}.{tld}/" + "/".join(rnd.choices(["news", "shop", "about", "blog"], k=rnd.randrange(1, 3)))
        digits = "".join(rnd.choices("0123456789", k=rnd.randrange(8, 25)))
        return f"http://{host}-{digits[:4]}.{tld}/{digits}?" + "&".join(f"p{k}={digits[k]}" for k in range(rnd.randrange(2, 7)))

    given = [(k, url(k % 2 == 1, rnd.choice(["good", "bad"][k % 2 :: 2]) if k < 600 else "new")) for k in range(1000)]
    rules = [urls.Rule("allow", "good/"), urls.Rule("block", "bad/")]
    found = urls.judge(spark.createDataFrame(given, "page_id long, url string"), rules).where("rule is null").collect()
    assert len(found) == 400
    assert sum((r.verdict == "block") == (r.page_id % 2 == 1) for r in found) > 390
