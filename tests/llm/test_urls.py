import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from equigauge.llm import urls
from equigauge.llm.queries import URL_RULES


def parse(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def shaped(path):
    out = []
    for s in [s for s in path.split("/") if s]:
        if re.search(r"^[0-9]+(\.[A-Za-z0-9]{1,5})?$|^[0-9a-fA-F-]{16,}$", s):
            s = "{n}"
        elif re.search(r"^[A-Za-z0-9_=-]{20,}$", s) and sum(c in "0123456789" for c in s) >= 4:
            s = "{t}"
        out.append(s)
    return tuple(out)


def differing(family):
    """Children of one node (labelled, blocked) whose share differs from the others'."""
    l_all, b_all = (sum(x[k] for x in family.values()) for k in (0, 1))
    out = set()
    for name, (own, b) in family.items():
        rest = l_all - own
        if own and rest:
            p = b_all / l_all
            if abs(b / own - (b_all - b) / rest) > urls.ALIKE_Z * (p * (1 - p) * (1 / own + 1 / rest)) ** 0.5:
                out.add(name)
    return out


def slow(rows, rules=URL_RULES):
    """Comparing, merging and smoothing, one url at a time."""
    seen = [(page, *parse(url)) for page, url in rows]
    seen = [(page, host, path, rule_of(host, path, rules), shaped(path)) for page, host, path in seen]
    families = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
    for _, host, _, rule, parts in seen:
        for k, s in enumerate(parts):
            x = families[host, parts[:k]][s]
            x[0] += rule is not None
            x[1] += rule is not None and rule.verdict == "block"
            x[2] += 1
    name = {}
    for node, family in families.items():
        odd = differing({s: x[:2] for s, x in family.items()})
        total = sum(x[2] for x in family.values())
        for s, (labelled, _, n) in family.items():
            rare = n < urls.LEAST_COUNT or n < urls.COMMON_SHARE * total
            if s in ("{n}", "{t}") or s in odd or len(family) == 1:
                name[node, s] = s
            elif labelled or (rare and len(family) > urls.MANY and not odd):
                name[node, s] = "{x}"
            else:
                name[node, s] = "{u}" if rare else s
    template = {(host, parts): tuple(name[(host, parts[:k]), s] for k, s in enumerate(parts)) for _, host, _, _, parts in seen}
    count = defaultdict(lambda: [0, 0])
    for _, host, _, rule, parts in seen:
        t = template[host, parts]
        for k in range(len(t) + 1):
            count[host, t[:k]][0] += rule is not None
            count[host, t[:k]][1] += rule is not None and rule.verdict == "block"
    below = defaultdict(dict)
    for (host, t), x in count.items():
        if t:
            below[host, t[:-1]][t[-1]] = x
    torn = {node for node, family in below.items() if differing(family)}
    domain = defaultdict(lambda: [0, 0])
    for host in {h for h, _ in count}:
        for k in (0, 1):
            domain[".".join(host.split(".")[-2:])][k] += count[host, ()][k]

    def smoothed(x, above):
        prior = urls.PRIOR_SHARE + urls.FROM_ABOVE * (above - urls.PRIOR_SHARE)
        return (x[1] + urls.PRIOR_WEIGHT * prior) / (x[0] + urls.PRIOR_WEIGHT)

    out = []
    for page, host, path, rule, parts in seen:
        t = template[host, parts]
        p = smoothed(domain[".".join(host.split(".")[-2:])], urls.PRIOR_SHARE)
        for k in range(len(t) + 1):
            p = smoothed(count[host, t[:k]], urls.PRIOR_SHARE if k and (host, t[: k - 1]) in torn else p)
        verdict = rule.verdict if rule else "block" if p >= urls.BLOCK_SHARE else "allow"
        out.append((page, host, path, rule.name if rule else None, "/" * bool(t) + "/".join(t), round(p, 9), verdict))
    return out


def test_judging_equals_brute_force(spark):
    rnd = random.Random(1)
    hosts = ["a.example.net", "WWW.example.com", "b.example.com", "example.com", "x.org", "y.x.org", "com", "acom", "net:80", "q.net"]
    rows = [
        (900, None), (901, ""), (902, "no scheme"), (903, "http://"), (904, "http://x.com"), (905, "HTTP://X.COM/?q=a://b/c"), (906, "ftp://é.net/fr/#a"),
        (907, "a\nb://x.net/es/\n1"), (908, "http://x.com/" + "s/" * 5000), (901, ""),
    ]
    for i in range(900):
        host = rnd.choice(hosts[:3] if i % 2 else hosts)
        path = rnd.choice(["", "/", "/en/", "/fr/", "/es/", "/de/", "/en"]) + rnd.choice(["", f"{rnd.randint(1, 99)}", f"{i}.html", f"slug-{i}", "news/today", "a/b/c/d/e"])
        rows.append((i, f"https://{host}{path}{rnd.choice(['', '?a=/b', '#t'])}"))
    pages = spark.createDataFrame([(u, p, "x") for p, u in rows], "url string, page_id bigint, host string").repartition(4)
    got = [(r.page_id, r.host, r.path, r.rule, r.template, round(r.purity, 9), r.verdict) for r in urls.judge(pages, URL_RULES).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got)) == sorted(map(key, slow(rows)))


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id bigint, url string"), URL_RULES).count() == 0


def test_unknown_hosts_are_allowed_and_clear_branches_rejected(spark):
    rows = [(i, f"http://h.net/fr/{i}") for i in range(50)] + [(100, "http://h.net/fr"), (101, "http://new.org/a/1"), (102, "http://h.net/other/page")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = {r.page_id: r for r in urls.judge(pages, URL_RULES).collect()}
    assert got[0].verdict == "block" and got[0].rule == "net/fr/"
    assert (got[100].verdict, got[100].rule) == ("block", None)
    assert got[101].verdict == "allow"


def judged(spark, rows, rules=URL_RULES):
    return urls.judge(spark.createDataFrame(rows, "page_id bigint, url string"), rules).collect()


def test_deep_and_wide_trees_equal_brute_force(spark):
    rnd = random.Random(3)
    rows = [(900, None), (901, "http://x.com/" + "s/" * 30), (902, "http://x.com/" + "s/" * 9 + "7/t"), (903, "http://lone.net/es/" + "r/3/" * 12)]
    rows += [(910 + k, "http://lone.com/a/b/c/d/e/f/7/g") for k in range(6)]
    for i in range(700):
        head = rnd.choice(["/en/a/b/c", "/fr/a/b/c", "/a/b/c/d", "/de/a/b/c"])
        tail = "".join("/" + rnd.choice(["bad", "good", str(i), f"s{i}", "abcd1234efgh5678ijklmnop"]) for _ in range(rnd.randint(0, 5)))
        rows.append((i, f"http://{rnd.choice(['a.net', 'b.example.com', 'x.org'])}{head}{tail}"))
    got = [(r.page_id, r.host, r.path, r.rule, r.template, round(r.purity, 9), r.verdict) for r in judged(spark, rows)]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got)) == sorted(map(key, slow(rows)))
    assert {"{x}", "{u}", "{t}"} <= {s for r in got for s in r[4].split("/")}


def test_a_rule_deep_down_leaves_its_siblings(spark):
    rules = [urls.Rule("block", "h.org", "/a/b/c/d/bad/"), urls.Rule("allow", "h.org", "/a/b/c/d/good/0/")]
    rows = [(i, f"http://h.org/a/b/c/d/bad/{i}") for i in range(90)] + [(100 + i, f"http://h.org/a/b/c/d/good/0/{i}") for i in range(30)]
    rows += [(200 + i, f"http://h.org/a/b/c/d/good/{i + 7}") for i in range(30)]
    got = {r.page_id: r for r in judged(spark, rows, rules)}
    assert {got[200 + i].verdict for i in range(30)} == {"allow"} and got[200].template == "/a/b/c/d/good/{n}"


def test_branches_are_compared_before_they_are_merged(spark):
    """A mixed parent: one blocked branch, one allowed, one without labels; variable segments below all of them."""
    rules = [urls.Rule("block", "h.org", "/es/"), urls.Rule("allow", "h.org", "/en/"), urls.Rule("block", "k.org", "/es/"), urls.Rule("block", "k.org", "/fr/")]
    rows, n = [], 0
    for host in ("h.org", "k.org"):
        for branch in ("es", "en", "fr", "de"):
            for i in range(40):
                rows.append((n, f"http://{host}/{branch}/{1000 + i}"))
                n += 1
    rows.append((n, "http://h.org/es"))
    got = judged(spark, rows, rules)
    of = {(r.host, r.path.split("/")[1]): r for r in got if r.path.count("/") == 2}
    assert of["h.org", "es"].template == "/es/{n}" and of["h.org", "en"].template == "/en/{n}" and of["h.org", "de"].template == "/de/{n}"
    assert of["k.org", "es"].template == of["k.org", "fr"].template == "/{x}/{n}"  # alike, so merged
    assert {r.verdict for r in got if r.rule is None and r.path.count("/") == 2} == {"allow"}
    assert [r.verdict for r in got if r.path == "/es"] == ["block"]  # its own branch speaks clearly


def test_many_rare_children_are_one_variable(spark):
    rules = [urls.Rule("block", "h.org", f"/p/w{i}x/") for i in range(40)]
    rows = [(i, f"http://h.org/p/w{i}x/") for i in range(80)]
    got = {r.page_id: r for r in judged(spark, rows, rules)}
    assert {r.template for r in got.values()} == {"/p/{x}"}
    assert {got[i].verdict for i in range(40, 80)} == {"block"}


def test_without_rules_everything_is_allowed(spark):
    got = judged(spark, [(1, "http://h.net/es/1"), (2, None)], [])
    assert [(r.rule, r.verdict) for r in got] == [(None, "allow")] * 2


def test_traps_of_many_segments(spark):
    trap = "http://trap.net/" + "a/b/" * 1500
    got = judged(spark, [(1, trap), (2, trap + "c"), (3, trap + "d/1"), (4, "http://trap.net/es/1")])
    assert {r.verdict for r in got if r.page_id < 4} == {"allow"} and {r.template.count("/") for r in got if r.page_id == 2} == {3001}


def test_no_page_is_rejected_for_other_branches(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = urls.judge(pages, URL_RULES).withColumn("branch", F.split("path", "/")[1])
    labelled = got.where("rule IS NOT NULL").groupBy("host", "branch").agg(F.count_if(F.col("verdict") == "block").alias("b"))
    blind = got.where("rule IS NULL AND verdict = 'block'").join(labelled, ["host", "branch"], "left").where("coalesce(b, 0) = 0")
    assert blind.count() == 0
