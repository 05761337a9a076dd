import random
import re
from collections import Counter

import compare
import duckdb
import pytest

from beneflow.llm import oracle
from beneflow.llm import url_templates as U

SCHEMA = "page_id bigint, url string, host string, n int, s1 string"


def urls():
    out = [None, "", "no scheme", "://", "http://", "http://HOST.Org", "http://host.org/?x=/a", "x://a.org/b://c.com/fr/1",
           "http://example.org/es/1", "http://sub.example.org/en/12", "http://notexample.org/es/1", "http://example.org/en/2",
           "http://a.com/fr/", "http://a.com/fr", "http://a.com/de/1#x", "http://acom/de/1", "http://com/de/x",
           "http://É.com/DE/1", "http://a.net//fr//1", "http://a.net/é\n/b"]
    # Variable segments, branches alike, and a branch of its own kind.
    for i in range(400):
        out.append(f"http://shop.com/item-{chr(97 + i % 26)}{chr(97 + i // 26)}/{i}")
        out.append(f"http://news.com/{('en', 'fr', 'de', 'es')[i % 4]}/{i}.html")
        out.append(f"http://news.com/api/v{i % 3}/x/y/z/{i}" if i % 5 == 0 else f"http://m.news.com/en/{i}")
    return out


def plain_tree(urls):
    """Verdict, template and purity of every url by a plain recursive tree without a last level."""
    pages, shapes = [], {}
    for url in urls:
        found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[1].lower(), found[2]) if found else ("", "")
        fit = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fit, key=lambda r: len(r.text), default=None)
        shape = tuple(s for s in re.sub("[0-9]+", "{n}", path).split("/") if s)
        pages.append((host, shape, rule))
        counts = shapes.setdefault(host, {}).setdefault(shape, [0, 0, 0])
        for i, add in enumerate((True, rule is not None and rule.verdict == "allow", rule is not None)):
            counts[i] += add

    def total(group):
        return [sum(c[i] for c in group.values()) for i in range(3)]

    def smoothed(group, parent):
        _, g, l = total(group)
        return (g + 10 * parent) / (l + 10)

    leaves = {}

    def grow(host, node, purity, group, at):
        """``group``: counts by shape, all of one node at depth ``at``."""
        tails, branches = Counter(), {}
        for shape, counts in group.items():
            tails[shape[at + 1 :]] += counts[0]
            branches.setdefault(shape[at] if len(shape) > at else None, {})[shape] = counts
        n_p, good_p, labelled_p = total(group)
        rate = good_p / labelled_p if labelled_p else 0
        children = {}
        for own, branch in branches.items():
            n_b, good_b, labelled_b = total(branch)
            own_tails = Counter()
            for shape, counts in branch.items():
                own_tails[shape[at + 1 :]] += counts[0]
            distance = sum(abs(own_tails[t] / n_b - n / n_p) for t, n in tails.items()) / 2
            differ = (good_b - labelled_b * rate) ** 2 > labelled_b * rate * (1 - rate) * 3.84
            variable = len(branches) >= 16 and n_b < n_p * 0.05
            like = distance <= 0.2 + 1 / n_b**0.5 and not differ
            children.setdefault(None if own is None else "*" if variable or like else own, {}).update(branch)
        for template, branch in children.items():
            below = smoothed(branch, purity)
            if template is None:
                for shape in branch:
                    leaves[host, shape] = ("/" + "/".join(node), below)
            else:
                grow(host, [*node, template], below, branch, at + 1)

    everything = [total(group) for group in shapes.values()]
    prior = (sum(t[1] for t in everything) + 1) / (sum(t[2] for t in everything) + 2)
    for host, group in shapes.items():
        grow(host, [], smoothed(group, prior), group, 0)
    out = []
    for host, shape, rule in pages:
        template, purity = leaves[host, shape]
        out.append((rule.verdict if rule else "block" if purity < 0.5 else "allow", template, round(purity, 9)))
    return out


def deep_urls():
    """Paths that differ, in labels and in what follows, only far from the host."""
    rng = random.Random(5)
    out = ["http://a.net/" + "x/" * 300, "http://a.net/" + "x/" * 300 + "y", "http://a.net/" + "x/" * 299 + "!", "http://a.net/x!/x/", "http://a.net/"]
    for i in range(600):
        kind = ("fr", "de", "es")[i % 3]
        # Pages of the rules' own hosts give labels; a longer rule than those of the contract reads the sixth segment.
        out.append(f"http://deep.com/a/b/c/d/e/{kind}/{i}/{rng.choice('pqr')}")
        out.append(f"http://deep.com/a/b/c/d/e/{kind}/x{rng.randrange(40)}/p")
        out.append("http://wild.org/" + "/".join(rng.choice("ab") for _ in range(rng.randrange(9))))
        out.append("http://wild.net/" + "/".join(rng.choice("abc") for _ in range(rng.randrange(7))))
    return out


DEEP_RULES = (U.Rule("deep.com", "/a/b/c/d/e/fr/1", "allow"), U.Rule("deep.com", "/a/b/c/d/e/de/1", "block"), U.Rule("wild.net", "/a/b/a/", "block"))


@pytest.mark.parametrize("rules", [U.RULES, DEEP_RULES])
def test_paths_of_any_depth_equal_a_plain_tree(spark, monkeypatch, rules):
    monkeypatch.setattr(U, "RULES", rules)
    rows = deep_urls() + urls()
    df = spark.createDataFrame([(i, u, None, None, None) for i, u in enumerate(rows)], SCHEMA).repartition(4)
    found = {r.page_id: (r.verdict, r.template, round(r.purity, 9)) for r in U.judge(df, rules).collect()}
    wrong = [(u, found[i], w) for i, (u, w) in enumerate(zip(rows, plain_tree(rows), strict=True)) if found[i] != w]
    assert not wrong, (len(wrong), wrong[:3])
    if rules is DEEP_RULES:
        # Beyond the sixth segment: pages without a rule follow the labels of their branch.
        far = {kind: {found[i][0] for i, u in enumerate(rows) if u and f"/e/{kind}/" in u} for kind in ("fr", "de")}
        assert far == {"fr": {"allow"}, "de": {"block"}}


@pytest.mark.parametrize("rows", [urls(), urls()[:3], []])
def test_equals_sql(spark, rows):
    df = spark.createDataFrame([(i, u, "own", 1, "x") for i, u in enumerate(rows)] + [(None, "http://a.com/de/1", None, None, None)][: len(rows)], SCHEMA)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    for row in df.select("page_id", "url").collect():
        connection.execute("INSERT INTO pages VALUES (?, ?)", list(row))
    judged = U.judge(df)
    assert compare.difference(judged.select("page_id", "host", "path", "rule", "verdict"), connection, oracle.URL_TEMPLATES) is None


def test_rules_and_templates(spark):
    rows = urls()
    df = spark.createDataFrame([(i, u, None, None, None) for i, u in enumerate(rows)], SCHEMA)
    found = {(None if r.page_id is None else rows[r.page_id]): r for r in U.judge(df).collect()}
    rule = lambda u: found[u].rule
    assert rule("http://HOST.Org") is None  # an empty path does not start with /
    assert rule("x://a.org/b://c.com/fr/1") == "org/"
    assert rule("http://example.org/es/1") == "example.org/es/"
    assert rule("http://sub.example.org/en/12") == "example.org/en/1"
    assert rule("http://notexample.org/es/1") == "org/"
    assert rule("http://com/de/x") == "com/de/"
    assert rule("http://acom/de/1") is None
    # Names of many items are one wildcard; languages with clear labels stay, those without are merged.
    assert found["http://shop.com/item-aa/0"].template == "/*/*"
    assert found["http://news.com/fr/1.html"].template.startswith("/fr/")
    assert found["http://news.com/en/0.html"].template == found["http://news.com/es/3.html"].template
    assert found["http://news.com/en/0.html"].template.startswith("/*/")
    assert found["http://news.com/api/v0/x/y/z/0"].template.startswith("/api/")


def test_plan_has_no_python(spark, folder):
    plan = U.judge(spark.read.parquet(f"{folder}/pages.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
