import random

from pyspark.sql import functions as F

from orderflow.llm.url_templates import RULES, url_verdicts


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fitting = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fitting)[1:] if fitting else None


URLS = [
    None, "", "nope", "http://", "://", "http:///x", "HTTP://A.COM?x=/y", "x://Example.com/en/?q", "x://a.b.example.com/en/1", "x://www.example.com/en/1#z",
    "x://x.www.example.com/en/", "x://notexample.com/en/", "x://a.net/es/1", "x://net/fr/", "x://a.net/ES/1", "x://com", "x://com/", "x://é.com/ß?x#y",
    "x://a.org/b://c/d", "x://ÀB.com/", "x://a.net/fr", "x://h.org/" + "a/" * 3000,
]


def pages(spark, urls):
    rows = [(k, u) for k, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "1 as template", "2 as shape", "3 as label")


def test_rules(spark):
    urls = URLS + URLS[:3]
    got = {r.page_id: r for r in url_verdicts(pages(spark, urls)).collect()}
    assert len(got) == len(urls)
    for k, url in enumerate(urls):
        host, path, rule = brute(url)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule and rule[0]), url
        if rule:
            assert got[k].verdict == rule[1]


def test_templates_learn_from_labels(spark):
    spam = [f"x://s.org/item/{k}/buy-now" for k in range(30)]
    good = [f"x://s.org/post/{k}/{name}" for k in range(30) for name in ("read",)]
    users = [f"x://s.org/user/name{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(100)]
    urls = spam + good + users + ["x://s.org/item/99999/buy-now", "x://s.org/post/99999/read", "x://s.org/item/1/other"]
    label = F.when(F.col("page_id") < 20, False).when((F.col("page_id") >= 30) & (F.col("page_id") < 50), True)
    got = url_verdicts(pages(spark, urls), rules=(), label=label).collect()
    verdict = {r.page_id: r.verdict for r in got}
    assert all(verdict[k] == "block" for k in range(30)) and verdict[160] == "block"
    assert all(verdict[k] == "allow" for k in [*range(30, 160), 161])
    assert {r.template for r in got if 60 <= r.page_id < 160} == {"/user/*"}


def test_small_branches_keep_their_own_labels(spark):
    """A wholly bad branch of under 2% is rejected; an unlabelled one of that size is not."""
    names = [a + b for a in "abcdefghij" for b in "klmnopqrst"]
    urls = [f"x://g.org/good/{n}{m}" for n in names for m in names[:4]] + [f"x://g.org/spam/p{n}" for n in names[:6]]
    urls += [f"x://b.net/{lang}/{n}{m}" for lang in ("es", "fr") for n in names for m in names[:2]] + [f"x://b.net/clean/{n}" for n in names[:6]]
    label = F.when(F.col("url").contains("/good/"), True).when(F.col("url").rlike("/(spam|es|fr)/"), False)
    got = url_verdicts(pages(spark, urls), rules=(), label=label).collect()
    for r in got:
        bad = "spam" in urls[r.page_id] or "/es/" in urls[r.page_id] or "/fr/" in urls[r.page_id]
        assert r.verdict == ("block" if bad else "allow"), (urls[r.page_id], r.template)


def test_every_segment_counts(spark):
    deep = "x://d.org/a/b/c/d/e/f/g"
    urls = [f"{deep}/bad/{n}" for n in range(20)] + [f"{deep}/new/{n}" for n in range(20)] + [f"{deep}/new", deep]
    got = url_verdicts(pages(spark, urls), rules=(), label=F.when(F.col("page_id") < 20, False)).collect()
    assert {(r.template, r.verdict) for r in got} == {
        ("/a/b/c/d/e/f/g/bad/{n}", "block"), ("/a/b/c/d/e/f/g/new/{n}", "allow"), ("/a/b/c/d/e/f/g/new", "allow"), ("/a/b/c/d/e/f/g", "allow"),
    }


def brute_templates(shapes, least_share=0.02, z=2.0):
    """Template of each (host, shape) of {(host, shape): (urls, good, bad)}, one tree at a time."""
    out = {}

    def rate(rows):
        return sum(c[1] for *_, c in rows), sum(c[2] for *_, c in rows)

    def grow(template, rows):
        """rows: (key, rest, counts) of all shapes under a template."""
        while len({tuple(r[1][:1]) for r in rows}) == 1 and rows[0][1]:
            template += "/" + rows[0][1][0]
            rows = [(k, rest[1:], c) for k, rest, c in rows]
        branches = {}
        for k, rest, c in rows:
            if rest:
                branches.setdefault(rest[0], []).append((k, rest[1:], c))
            else:
                out[k] = template
        urls = sum(c[0] for some in branches.values() for *_, c in some)
        good, bad = rate([r for some in branches.values() for r in some])
        pooled = (bad + 0.5) / (good + bad + 1)
        labelled = sum(sum(rate(some)) > 0 for some in branches.values())
        tails = {}
        for segment, some in branches.items():
            times = {}
            for _, rest, c in some:
                times["/".join(rest)] = times.get("/".join(rest), 0) + c[0]
            tails[segment] = max(times, key=lambda t: (times[t], t))
        merged = {}
        for segment, some in branches.items():
            own_good, own_bad = rate(some)
            labels, size = own_good + own_bad, sum(c[0] for *_, c in some)
            differs = labels > 0 and abs(own_bad / labels - pooled) > z * (pooled * (1 - pooled) / labels) ** 0.5
            alike = sum(t == tails[segment] for t in tails.values())
            if alike >= 8 and not differs or labels == 0 and size < least_share * urls:
                name = "*"
            else:
                name = "*#" if labelled > 1 and labels > 0 and not differs else segment
            merged.setdefault(name, []).extend(some)
        for name, some in merged.items():
            grow(f"{template}/{name}", some)

    for host in {h for h, _ in shapes}:
        grow("", [((h, shape), shape.split("/")[1:], c) for (h, shape), c in shapes.items() if h == host])
    return out


def test_templates_equal_a_tree_grown_one_by_one(spark):
    rnd = random.Random(8)
    urls, labels = [], []
    for _ in range(1500):
        host = rnd.choice(["a.org", "b.net", "c.io"])
        first = rnd.choice(["x", "y", "blog", *[f"u{c}" for c in "abcdefghijklm"]])
        path = f"/{first}" + rnd.choice(["", "/{n}", "/{n}/edit", "/p/{n}", "/p/{n}/q", f"/tag/{rnd.choice('abcdefghijkl')}"])
        urls.append(f"x://{host}{path}")
        labels.append(rnd.choice([None, None, True, False]) if first < "n" else None if rnd.random() < 0.7 else host == "a.org")
    label = F.element_at(F.array(*[F.lit(x).cast("boolean") for x in labels]), F.col("page_id").cast("int") + 1)
    got = url_verdicts(pages(spark, urls), rules=(), label=label).collect()
    shapes = {}
    for url, x in zip(urls, labels):
        host, path = url[4:].split("/", 1)
        n, g, b = shapes.get((host, f"/{path}"), (0, 0, 0))
        shapes[host, f"/{path}"] = (n + 1, g + (x is True), b + (x is False))
    want = brute_templates(shapes)
    wrong = {(r.path, r.template, want[r.host, r.path]) for r in got if r.template != want[r.host, r.path]}
    assert wrong == set() and len({r.template for r in got}) > 10


def test_a_variable_segment_passes_labels_on(spark):
    """The registered rules block /es/ and /fr/ of a host whose first segment is one of many alike; few alike keep apart."""
    codes = [f"{a}{b}" for a in "abcdefghij" for b in "xy"] + ["es", "fr"]
    urls = [f"x://many.net/{code}/{n}.html" for code in codes for n in range(10)]
    urls += [f"x://few.net/{code}/{n}.html" for code in ("en", "de", "es", "fr") for n in range(50)]
    urls += [f"x://shop.net/{name}{c}/{n}" for name in ("p", "q") for c in "abcdefghijklmnopqrst" for n in range(30)] + ["x://shop.net/es/1"] * 3
    got = url_verdicts(pages(spark, urls)).collect()
    assert {r.verdict for r in got if r.host == "many.net"} == {"block"} and {r.rule for r in got if r.host == "many.net"} == {None, "net/es/", "net/fr/"}
    assert all((r.verdict == "block") == (r.rule is not None) for r in got if r.host != "many.net")


def test_empty_table(spark):
    assert url_verdicts(pages(spark, ["a"]).limit(0)).count() == 0
