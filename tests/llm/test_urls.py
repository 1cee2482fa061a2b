"""URL filter: parsing, rules and the template tree against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from quizframe.llm import urls
from quizframe.llm.urls import RULES, judged


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for verdict, rule in RULES:
        domain, slash, prefix = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith(slash + prefix):
            fits.append((len(rule), rule, verdict))
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


URLS = [
    None, "", "no scheme", "http://", "http://A.com", "http://a.com/", "https://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/1",
    "https://sub.www.example.com/en/", "http://www.example.com/EN/", "http://x.net/es/1", "http://x.net/es", "http://x.net/fr/?q", "http://notcom/x",
    "http://.com/", "http://É.COM/é", "http://a.org?x/y", "http://a.org#x://b.com/", "x://y://z/w", "http://a.net/fr//", "http://a.com/" + "x/" * 3000, "http://h.org/" + "9" * 100_000,
    "http://a.com/\nen/", "http://example.com/en/x", "http://myexample.com/en/x", "http://u:p@b.net:80/fr/1",
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://a.com/"), (3, "http://a.com/"), (3, "http://a.com/")]
    frame = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'q' as host", "'q' as path", "'q' as rule", "'q' as key", "1 as n")
    found = judged(frame).collect()
    want = sorted(((i, *plain(u)[:3]) for i, u in rows), key=str)
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"]) for r in found), key=str) == want
    for r in found:
        said = {rule: v for v, rule in RULES}.get(r["rule"])
        assert r["verdict"] in ("allow", "block") and said in (None, r["verdict"])


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(urls, "FAN", 3)


def test_templates_generalise_merge_and_reject(spark, few):
    rules = [("block", "h.org/bad/1"), ("block", "h.org/bad/2"), ("allow", "h.org/good/1"), ("block", "g.org/x1/"), ("block", "g.org/x2/"), ("allow", "k.org/")]
    rows = [f"http://h.org/bad/{i}" for i in range(10, 30)] + [f"http://h.org/bad/{i}" for i in range(100, 400)]
    rows += [f"http://h.org/good/{i}" for i in range(10, 30)]
    rows += [f"http://h.org/user/name{i}/post" for i in range(30)] + ["http://h.org/user/me/post"] * 40
    rows += [f"http://g.org/x{j}/{i}/p" for j in (1, 2) for i in range(50)]
    rows += [f"http://m.org/{a}/y{j}/{i}/p" for a in ("d", "e") for j in (1, 2) for i in range(20)]
    rows += [f"http://k.org/{i}" for i in range(300)]
    frame = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    found = {rows[r["page_id"]]: r for r in judged(frame, rules=rules).collect()}
    assert len(found) == len(set(rows))
    # Digits share a template; most labelled urls of it are blocked, so the rest is rejected too.
    assert found["http://h.org/bad/399"]["template"] == "/bad/{n}"
    assert found["http://h.org/bad/399"]["rule"] is None and found["http://h.org/bad/399"]["verdict"] == "block"
    assert found["http://h.org/good/29"]["verdict"] == "allow"
    # Many rare children are one wildcard, a frequent one keeps its name.
    assert found["http://h.org/user/name7/post"]["template"] == "/user/{*}/post"
    assert found["http://h.org/user/me/post"]["template"] == "/user/me/post"
    # Sisters with the same profile and the same labels are one branch.
    assert found["http://g.org/x1/3/p"]["template"] == found["http://g.org/x2/4/p"]["template"] == "/{x1~}/{n}/p"
    # The same deeper down, and then for the branches that have become alike.
    assert {found[f"http://m.org/{a}/y{j}/3/p"]["template"] for a in ("d", "e") for j in (1, 2)} == {"/{d~}/{y1~}/{n}/p"}


def shape(segment):
    if re.fullmatch("[0-9]+", segment):
        return "{n}"
    if m := re.fullmatch(r"[0-9]+\.([A-Za-z]{1,5})", segment):
        return "{n}." + m[1]
    return "{x}" if re.fullmatch("[0-9a-fA-F-]{8,}", segment) and re.search("[0-9]", segment) else segment


def tree(rows, rules):
    """{id: (template, verdict)} by dictionaries, one url at a time."""
    half_up = lambda x: int(x + 0.5)
    parsed = {}
    for i, url in rows:
        host, path, _, _ = plain(url)
        segments = tuple(shape(s) for s in path.split("/") if s)
        if len(segments) > urls.DEPTH:
            segments = (*segments[: urls.DEPTH], "/".join(segments[urls.DEPTH :]))
        fits = [(len(r), v) for v, r in rules for d, s, p in [r.partition("/")] if (host == d or host.endswith("." + d)) and path.startswith(s + p)]
        parsed[i] = host, segments, max(fits, default=(0, None))[1]
    named = {(h, s): s for h, s, _ in parsed.values()}
    depth = max(map(len, named.values()), default=0)
    for level in range(depth):
        count = defaultdict(Counter)
        for h, s, _ in parsed.values():
            t = named[h, s]
            if len(t) > level:
                count[h, t[:level]][t[level]] += 1
        for (h, s), t in named.items():
            c = count.get((h, t[:level]))
            if len(t) > level and len(c) > urls.FAN and c[t[level]] * urls.FAN < sum(c.values()):
                named[h, s] = (*t[:level], urls.WILD, *t[level + 1 :])
    for level in range(depth - 2, -1, -1):
        below, labels = defaultdict(Counter), defaultdict(list)
        for h, s, said in parsed.values():
            t = named[h, s]
            if len(t) > level + 1 and t[level] != urls.WILD:
                below[h, t[:level], t[level]]["/".join(t[level + 1 :])] += 1
                labels[h, t[:level], t[level]] += [said == "block"] * (said is not None)
        alike, leans = defaultdict(list), defaultdict(set)
        for place, c in below.items():
            profile = frozenset((b, half_up(8 * n / sum(c.values()))) for b, n in c.items() if half_up(8 * n / sum(c.values())))
            if labels[place]:
                leans[place[:2], profile].add(half_up(4 * sum(labels[place]) / len(labels[place])))
            alike[place[:2], profile].append(place)
        renamed = {}
        for (at, profile), places in alike.items():
            groups, one = defaultdict(list), leans[at, profile]
            for place in places:
                own = labels[place]
                groups[half_up(4 * sum(own) / len(own)) if own else min(one) if len(one) == 1 else -1].append(place)
            for sisters in groups.values():
                if len(sisters) > 1:
                    renamed |= dict.fromkeys(sisters, "{" + min(s[2] for s in sisters) + "~}")
        for (h, s), t in named.items():
            if len(t) > level + 1 and (h, t[:level], t[level]) in renamed:
                named[h, s] = (*t[:level], renamed[h, t[:level], t[level]], *t[level + 1 :])
    said = [v == "block" for _, _, v in parsed.values() if v]
    base = sum(said) / len(said) if said else 0
    own = defaultdict(list)
    for h, s, v in parsed.values():
        own[h, named[h, s]] += [v == "block"] * (v is not None)
    out = {}
    for i, (h, s, v) in parsed.items():
        labels = own[h, named[h, s]]
        purity = (sum(labels) + urls.WEIGHT * base) / (len(labels) + urls.WEIGHT)
        out[i] = "/" + "/".join(named[h, s]), v or ("block" if purity >= urls.REJECT else "allow")
    return out


def test_random_urls_against_a_dictionary_tree(spark, few):
    rng = random.Random(4)
    rules = [("block", "h.org/bad/"), ("block", "h.org/x/bad1/"), ("allow", "h.org/x/good/"), ("block", "g.org/"), ("allow", "g.org/ok/"), ("block", "k.org/u1/")]
    words = ["bad", "x", "good", "bad1", "bad2", "ok", "u1", "u2", "7", "42", "99.html", "deadbeef01", "a", "b", "c", "d"]
    rows = []
    for i in range(1500):
        depth = rng.choice((0, 1, 2, 2, 3, 3, 4, 12))
        rows.append((i, f"http://{rng.choice(['h.org', 'g.org', 'k.org', 'q.org'])}/" + "/".join(rng.choice(words[: rng.choice((3, 9, 16))]) for _ in range(depth))))
    for host in ("s.org", "t.org"):
        rows += [(2000 + len(rows) + i, f"http://{host}/u{i % 3}/{i}/p") for i in range(240)]
    rules += [("block", "s.org/u1/"), ("block", "s.org/u2/"), ("block", "t.org/u1/"), ("allow", "t.org/u2/")]
    frame = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    found = {r["page_id"]: (r["template"], r["verdict"]) for r in judged(frame, rules=rules).collect()}
    assert found == tree(rows, rules)
    # Unlabelled sisters join labelled ones that agree, and stay apart where these differ.
    at = {u: found[i] for i, u in rows if i >= 2000}
    assert {at[u][0] for u in at if "s.org" in u} == {"/{u0~}/{n}/p"} and {at[u][1] for u in at if "s.org" in u} == {"block"}
    assert {at[u][0] for u in at if "t.org" in u} == {"/u0/{n}/p", "/u1/{n}/p", "/u2/{n}/p"}


def test_number_of_labels_does_not_flip_a_sister(spark, few):
    for n in (5, 12, 30, 90):
        rows = [f"http://s.org/{u}/{i}/p" for u in ("a", "b") for i in range(n)] + [f"http://s.org/new/{i}/p" for i in range(8)]
        rows += [f"http://z.org/ok/{i}" for i in range(n)]
        frame = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
        found = judged(frame, rules=[("block", "s.org/a/"), ("block", "s.org/b/"), ("allow", "z.org/")]).collect()
        assert len({r["template"] for r in found if r["host"] == "s.org"}) == 1


def test_empty_table(spark):
    assert judged(spark.createDataFrame([], "page_id long, url string")).collect() == []
